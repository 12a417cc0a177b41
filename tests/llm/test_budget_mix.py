import hashlib
import random
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from nestgate.llm import budget_mix as B

DDL = "doc_id long, lang string, source string, text string, n_tokens int, extra string"


def fill(budget, children):
    """Water filling with whole tokens: ``children`` are (name, cap, weight)."""
    open_, taken, out = sorted(children), 0, {}
    while True:
        w = sum(c[2] for c in open_)
        full = [c for c in open_ if c[1] * w <= c[2] * (budget - taken)]
        if not full:
            break
        out |= {c[0]: c[1] for c in full}
        taken += sum(c[1] for c in full)
        open_ = [c for c in open_ if c not in full]
    w = sum(c[2] for c in open_)
    for n, _, v in open_:
        out[n] = v * (budget - taken) // w
    spare = budget - sum(out.values())
    for n, *_ in open_[:spare]:
        out[n] += 1
    return out


def brute(rows, epochs, percent, seed=B.SEED, weights=None):
    weights = B.WEIGHTS if weights is None else weights
    size = defaultdict(int)
    leaf = {}
    for k, (i, lang, src, text, *_) in enumerate(rows):
        d = ""
        if src and src[-1].isdigit():
            d = f"domain{int(''.join(c for c in src if c.isdigit())) % 4}"
        leaf[k] = (d, lang or "", src or "", len((text or "").split()))
        size[leaf[k][:3]] += leaf[k][3]
    total = sum(size.values())

    def weight(level, name):
        return Fraction(str(weights.get(level, {}).get(name, B.OTHER)))
    usable = {p: n * all(weight(level, x) > 0 for level, x in zip(B.LEVELS, p)) for p, n in size.items()}
    budgets = {(): min(total * percent // 100, sum(usable.values()) * epochs)}
    for depth, level in enumerate(B.LEVELS):
        nxt = {}
        for up, b in budgets.items():
            caps = defaultdict(int)
            for path, n in usable.items():
                if path[:depth] == up:
                    caps[path[depth]] += n * epochs
            got = fill(b, [(n, c, weight(level, n) or 1) for n, c in caps.items()]) if b or caps else {}
            nxt |= {(*up, n): v for n, v in got.items()}
        budgets = nxt
    out = []
    for k, (i, lang, src, text, *_) in enumerate(rows):
        path, n = leaf[k][:3], leaf[k][3]
        copies = 0
        if n:
            whole, rest = divmod(budgets[path], size[path])

            def key(r):
                return hashlib.md5(f"{seed}:{whole}:{'' if r[0] is None else r[0]}".encode()).hexdigest()
            upto = sum(leaf[j][3] for j, r in enumerate(rows) if leaf[j][:3] == path and key(r) <= key(rows[k]))
            copies = whole + (upto <= rest)
        out.append((i, lang, src, leaf[k][0], n, budgets[path], copies))
    return sorted(out, key=str)


def table(seed, n=160):
    r = random.Random(seed)
    rows = [(i, r.choice(["en", "en", "de", "fr", None]), r.choice(["src0"] * 5 + ["src1", "src2", "src7", "other", None]),
             r.choice([None, "", " "] + ["w " * r.randrange(1, 40)] * 9), 7, "x") for i in range(n)]
    return rows + [(3, "en", "src0", "again and again", 7, "x")] * 4 + [(None, "en", "src0", "no id", 7, "x")]


@pytest.mark.parametrize("seed,epochs,percent", [(1, 2, 100), (2, 1, 40), (3, 3, 290)])
def test_against_brute_force(spark, seed, epochs, percent):
    rows = table(seed)
    df = spark.createDataFrame(rows, DDL).repartition(3)
    got = B.mix(df, B.source_domain(F.col("source")), epochs=epochs, percent=percent)
    cols = ["doc_id", "lang", "source", "leaf_domain", "n_tokens", "leaf_budget", "copies"]
    assert sorted(map(tuple, got.select(cols).collect()), key=str) == brute(rows, epochs, percent)
    assert "extra" in got.columns


def test_shortage_goes_to_siblings_first(spark):
    """src4 and src0 share a domain; what src4 can not fill goes to src0, not to other domains."""
    rows = [(i, "en", "src4" if i < 2 else "src0" if i < 60 else "src1", "a b c d", 0, "") for i in range(120)]
    got = B.mix(spark.createDataFrame(rows, DDL), B.source_domain(F.col("source")), epochs=1, percent=50,
                weights={"domain": {"domain0": 1, "domain1": 1}, "source": {"src4": 10}})
    budget = {r.source: r.leaf_budget for r in got.collect()}
    assert budget == {"src4": 8, "src0": 112, "src1": 120}


def test_pipeline_form_and_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert B.document_mix(empty).count() == 0
    df = spark.createDataFrame([(i, "one two", "en", f"src{i % 2}", 7) for i in range(8)], empty.schema)
    out = B.mixed_documents(df)
    assert out.columns == df.columns and out.count() == sum(r.copies for r in B.document_mix(df).collect())


@pytest.mark.parametrize("weights", [
    {"domain": {"domain0": 0.7, "domain1": 0.3}, "lang": {"en": 1.9, "de": "0.25"}, "source": {"src0": 0.5}},
    {"domain": {"domain1": 0}, "lang": {"fr": 0, "en": 3}, "source": {"src7": 0, "other": 0.001}},
    {"domain": {"domain0": 0, "domain1": 0, "domain2": 0, "domain3": 0, "": 0}},
    {"source": {"o'brien": 3, "back\\slash": 2.5, 'quo"te': 0, "src0": 1}}])
def test_zero_and_fractional_weights_and_odd_names(spark, weights):
    rows = table(5) + [(1000 + i, "en", s, "w " * (5 + i), 7, "x") for i, s in enumerate(
        ["o'brien", "back\\slash", 'quo"te', "o'brien"] * 4)]
    got = B.mix(spark.createDataFrame(rows, DDL).repartition(3), B.source_domain(F.col("source")), weights=weights)
    cols = ["doc_id", "lang", "source", "leaf_domain", "n_tokens", "leaf_budget", "copies"]
    assert sorted(map(tuple, got.select(cols).collect()), key=str) == brute(rows, 2, 100, weights=weights)


def test_unusable_weights_are_refused():
    for w in ({"lang": {"en": -1}}, {"lang": {"en": 0.00000001}}):
        with pytest.raises(ValueError):
            B.whole_weights(w)

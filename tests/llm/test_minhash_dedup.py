import random
import re

import numpy as np
import pytest

from nestgate.llm import minhash_dedup as M
from nestgate.llm.components import components

DDL = "doc_id long, text string, lang string, source string, n_chars long"


def brute(rows):
    """Shingle sets as tuples of words, all pairs, union-find."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = min(x for x in (least.get(r), d) if x is not None) if d is not None or r in least else None
    return sorted(((d, len(sets[i]), least[find(i)], d is not None and d == least[find(i)])
                   for i, (d, _) in enumerate(rows)), key=str)


def corpus(seed, n=40):
    r = random.Random(seed)
    vocab = [f"w{i}é" if i % 9 == 0 else f"W{i}" for i in range(60)]
    base = [[r.choice(vocab) for _ in range(r.choice([3, 6, 30, 120]))] for _ in range(8)]
    texts = [None, "", " \n\t", "One", "one", "a b c d", "A b  c\nd", "x" * 5000]
    for _ in range(n):
        w = list(r.choice(base))
        for _ in range(r.randrange(0, 5)):
            w[r.randrange(len(w))] = r.choice(vocab)
        texts.append(" ".join(w))
    r.shuffle(texts)
    return list(enumerate(texts, 5))


def run(spark, rows):
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DDL).repartition(3)
    return sorted((tuple(r) for r in M.document_components(df).select(
        "doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def test_against_brute_force(spark):
    rows = corpus(1, 120)
    assert run(spark, rows) == brute(rows)


def test_blocks(spark, monkeypatch):
    """A near-copy group over many blocks gives the same components."""
    monkeypatch.setattr(M, "BLOCK", 5)
    rows = corpus(2, 60)
    assert run(spark, rows) == brute(rows)


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, "q r s"), (7, None)]
    assert run(spark, rows) == brute(rows)


def test_empty_table_and_pipeline_form(spark):
    assert M.document_components(spark.createDataFrame([], DDL)).count() == 0
    df = spark.createDataFrame([(2, "a b", "en", "s", 1, 9), (1, "A b", "en", "s", 1, 9)], DDL + ", id long")
    assert [tuple(r) for r in M.first_of_each_class(df).collect()] == [(1, "A b", "en", "s", 1, 9)]


def test_pipeline_form_goes_by_rows(spark):
    """Repeated rows, null ids and two texts under one id: one row of each component stays, through stages 2 and 3."""
    from nestgate.llm.suffix_dedup import without_repeats

    def text(seed):
        r = random.Random(seed)
        return " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(60))
    near = text(3).rsplit(" ", 1)[0] + " other"
    rows = [(1, text(1)), (1, text(1)), (1, text(1)),        # repeated rows
            (None, text(2)),                                 # alone, without id
            (5, text(3)), (3, near), (3, text(4)),           # a near copy; another text under a kept id
            (9, text(4)),                                    # its copy
            (None, text(5)), (None, text(5)),                # null ids only
            (None, text(6)), (8, text(6)),                   # nulls come last
            (None, None), (None, " "), (7, ""), (7, "")]     # empty sets all stay
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DDL).repartition(3)
    want = [(1, text(1)), (None, text(2)), (3, near), (3, text(4)), (None, text(5)), (8, text(6)),
            (None, None), (None, " "), (7, ""), (7, "")]
    kept = M.first_of_each_class(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)
    assert sorted(((r.doc_id, r.text) for r in without_repeats(kept).collect()), key=str) == sorted(want, key=str)


def test_threshold_is_exact():
    a = np.arange(100, dtype=np.uint64)
    assert M.linked(a, a[:85]) and not M.linked(a, a[:84])


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    r = random.Random(seed)
    edges = [(i, i + 1) for i in range(40)] + [(r.randrange(50, 99), r.randrange(50, 99)) for _ in range(30)]
    up = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(60):
        for u, v in edges:
            if u != v:
                up[u] = up[v] = min(up[u], up[v])
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == up

"""The corpus pipeline against the operators' brute-force versions, stage by stage, on the smallest tables."""

import re
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus_pipeline  # noqa: E402
import test_best_fit_pack as packing  # noqa: E402
import test_budget_mix as mixing  # noqa: E402
import test_minhash_dedup as near  # noqa: E402
from nestgate.llm import budget_mix as B  # noqa: E402
from nestgate.llm import line_quality as Q  # noqa: E402

SF = "/root/testdata/sf0.001"


def judge(text):
    """Cleaned text of a kept document, None for a rejected one; the rules in plain Python."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen = {}
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    hit = {j for i, g in enumerate(grams) if seen[g] > 1 for j in range(i, i + 5)}
    total = lost = 0
    left = []
    for line in (text or "").split("\n"):
        n = len(re.findall(r"[^\x20\x09-\x0D]+", line))
        low = line.lower()
        bad = n > 0 and (len(re.findall(Q.NOISE, line)) * 10 >= n * 3 or len(re.findall(Q.SEPARATORS, line)) * 10 >= n * 3
                         or (n <= Q.MENU_WORDS and re.search(Q.MENU, low, re.A))
                         or (n <= Q.BOILERPLATE_WORDS and any(p in low for p in Q.BOILERPLATE)))
        total += len(line) * (n > 0)
        lost += len(line) * bool(bad)
        if not bad:
            left.append(line)
    kept = len(words) >= 10 and 100 * len(hit) <= 20 * len(words) and lost * 100 <= total * Q.MAX_LOST_PERCENT
    return "\n".join(left) if kept else None


def cut(texts, width=200):
    enc = [t.encode() for t in texts]
    seen = {}
    for b in enc:
        for i in range(len(b) - width + 1):
            seen[b[i:i + width]] = seen.get(b[i:i + width], 0) + 1
    out = []
    for b in enc:
        gone = [False] * len(b)
        for i in range(len(b) - width + 1):
            if seen[b[i:i + width]] > 1:
                gone[i:i + width] = [True] * width
        out.append(bytes(c for c, g in zip(b, gone) if not g).decode("utf-8", "ignore"))
    return out


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows after each stage, each stage fed with what its predecessor wrote."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out, folder = [docs.collect()], tmp_path_factory.mktemp("stages")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        columns = docs.columns
        result = stage(spark, docs, SF)
        if i + 1 < len(corpus_pipeline.STAGES):
            assert result.columns == columns and result.dtypes == docs.dtypes
        result.write.parquet(str(folder / str(i)))
        docs = spark.read.parquet(str(folder / str(i)))
        out.append(docs.collect())
    return out


def test_quality(stages):
    want = sorted((r.doc_id, t, len(t)) for r in stages[0] if (t := judge(r.text)) is not None)
    assert sorted((r.doc_id, r.text, r.n_chars) for r in stages[1]) == want
    assert 0 < len(want) < len(stages[0])


def test_near_dedup(stages):
    want = [d for d, _, _, kept in near.brute([(r.doc_id, r.text) for r in stages[1]]) if kept]
    assert sorted(r.doc_id for r in stages[2]) == sorted(want)


def test_repeats(stages):
    rows = sorted(stages[2], key=lambda r: r.doc_id)
    got = sorted((r.doc_id, r.text, r.n_chars) for r in stages[3])
    assert got == [(r.doc_id, t, len(t)) for r, t in zip(rows, cut([r.text for r in rows]))]


def test_mix(stages):
    rows = [(r.doc_id, r.lang, r.source, r.text) for r in stages[3]]
    want = sorted(i for i, *_, copies in mixing.brute(rows, B.EPOCHS, B.BUDGET_PERCENT) for _ in range(copies))
    assert sorted(r.doc_id for r in stages[4]) == want


def test_packing(stages):
    packing.check(stages[5], [(r.doc_id, r.text) for r in stages[4]], 2048)


def test_run_and_names():
    assert [n for n, _ in corpus_pipeline.STAGES] and corpus_pipeline.ORACLE_SQL is None


def test_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0

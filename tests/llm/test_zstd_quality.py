import zlib

import numpy as np
import pytest

from nestgate.llm import zstd_quality as Z
from nestgate.llm.queries import queries

DOCS = "doc_id long, text string, score string, held_out int"
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def scored(spark):
    d = "/root/testdata/sf0.1"
    out = queries()["op10_zstd_quality"](spark, d).toPandas()
    return out, spark.read.parquet(f"{d}/labels.parquet").toPandas()


def test_held_out_accuracy(scored):
    out, labels = scored
    m = out[out.held_out].merge(labels, on="doc_id")
    assert len(m) > 300 and set(m.quality) == {0, 1}
    s, y = m.score.to_numpy(), m.quality.to_numpy()
    pairs = (s[y == 1][:, None] > s[y == 0][None, :]) + 0.5 * (s[y == 1][:, None] == s[y == 0][None, :])
    assert pairs.mean() > 0.97
    assert (m.predicted == m.quality).mean() > 0.95
    assert abs(m.score.mean() - m.quality.mean()) < 0.05


def test_folds_and_ranges(scored):
    out, _ = scored
    assert out.score.between(0, 1).all() and ((out.score >= Z.THRESHOLD) == (out.predicted == 1)).all()
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(out.doc_id, out.held_out))


def test_scores_against_direct_computation():
    rows = [(f"good prose number {i} is here. " * 30, 1) for i in range(60)] + [(f"BUY!! NOW!! {i} $$$ " * 30, 0) for i in range(60)]
    model = Z.fit_rows(rows, 0.7)
    score = model.scorer()(["good prose is here. " * 400, "BUY!! NOW!! $$$ " * 400, None, ""])
    assert score[0] > 0.5 > score[1] and score[2] == score[3]
    d = Z.differences(model.good, model.bad)(["good prose is here. " * 400])[0]
    assert score[0] == pytest.approx(0.98 * np.interp(d, model.knots, model.values) + 0.02 / (1 + np.exp(-40 * d)))


def test_isotonic():
    x, v = Z.isotonic(np.array([1., 2, 3, 4]), np.array([0., 1, 0, 1]), np.ones(4))
    assert v.tolist() == [0, 0.5, 1] and x.tolist() == [1, 2.5, 4]


def test_few_or_no_labels(spark):
    docs = spark.createDataFrame([(1, "a", "x", 1), (None, None, "x", 1), (1, "a", "x", 1)], DOCS)
    empty = spark.createDataFrame([], LABELS)
    out = Z.document_scores(docs, empty).collect()
    assert [(r.score, r.predicted) for r in out] == [(0.5, 1)] * 3
    assert Z.document_scores(docs, spark.createDataFrame([(1, 0, 0), (1, None, 0), (None, 1, 0)], LABELS)).count() == 3
    assert Z.document_scores(spark.createDataFrame([], DOCS), empty).count() == 0


def test_sample_and_curve_against_direct_computation(spark, monkeypatch):
    """Whole texts of the sampled rows: chosen, compressed and calibrated by hand."""
    import random

    import zstandard

    r = random.Random(3)
    docs, labels = [], []
    for i in range(300):
        good = i % 3 > 0
        word = ["river", "stone", "quiet", "garden"] if good else ["BUY", "$$$", "click!!", "win"]
        n = r.choice([5, 60, 4000]) if i % 40 == 0 else 60
        docs.append((i, " ".join(r.choice(word) + str(r.randrange(30)) for _ in range(n)), "x", 0))
        labels.append((i, int(good), 0))
    d, lab = spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(labels, LABELS)
    monkeypatch.setattr(Z, "SAMPLE_ROWS", 70)
    monkeypatch.setattr(Z, "SAMPLE_BYTES", 30_000)
    hashes = {x["doc_id"]: x["h"] for x in d.selectExpr("doc_id", "xxhash64(doc_id) as h").collect()}
    texts = {i: t for i, t, *_ in docs}
    chosen, used, taken = [], [0, 0], [0, 0]
    for i in sorted(hashes, key=lambda i: (hashes[i], i)):
        y = labels[i][1]
        if zlib.crc32(str(i).encode()) % 5 == 0:
            continue
        taken[y] += 1
        if taken[y] <= 70 and used[y] + len(texts[i].encode()) <= 30_000:
            used[y] += len(texts[i].encode())
            chosen.append((texts[i], y))
    known = [y for i, y, _ in labels if zlib.crc32(str(i).encode()) % 5]
    share = sum(known) / len(known)
    built, rest, seen = {0: [], 1: []}, [], [0, 0]
    for t, y in chosen:
        seen[y] += 1
        if seen[y] % 3:
            b = t.encode()
            built[y] += [b[k:k + Z.BLOCK] for k in range(0, len(b), Z.BLOCK)]
        else:
            rest.append((t, y))
    form = zstandard.ZstdCompressionParameters.from_level(
        Z.LEVEL, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_dict_id=0, write_checksum=0)
    packs = []
    for y in (1, 0):
        made = zstandard.train_dictionary(min(Z.DICTIONARY, sum(map(len, built[y])) // 8), built[y], k=512, d=8, level=Z.LEVEL)
        packs.append(zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(made.as_bytes()), compression_params=form))

    def difference(t):
        b = t.encode()
        parts = [b[k:k + Z.BLOCK] for k in range(0, len(b), Z.BLOCK)]
        return (sum(len(packs[1].compress(x)) for x in parts) - sum(len(packs[0].compress(x)) for x in parts)) / len(b)
    x = np.array([difference(t) for t, _ in rest])
    y = np.array([v for _, v in rest], float)
    w = np.where(y == 1, share / y.sum(), (1 - share) / (len(y) - y.sum()))
    knots, values = Z.isotonic(x, y, w)
    for row in Z.document_scores(d, lab).collect():
        diff = difference(texts[row.doc_id])
        want = 0.98 * np.interp(diff, knots, values) + 0.02 / (1 + np.exp(-40 * diff))
        assert row.score == pytest.approx(float(np.clip(want, 0, 1)), abs=1e-9)

import zlib

import numpy as np
import pytest

from nestgate.llm.feistel_shards import document_shards, locate, permute, row_at, shard_rows
from pyspark.sql import functions as F

DDL = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 1000, 4097])
def test_permutation_and_inverse(n):
    p = permute(np.arange(n), n, 7)
    assert sorted(p) == list(range(n))
    assert (permute(p, n, 7, inverse=True) == np.arange(n)).all()


def test_large_domain_round_trip():
    n = (1 << 40) + 12345
    x = np.array([0, 1, n - 1, n // 2])
    assert (permute(permute(x, n, 3), n, 3, inverse=True) == x).all()
    s, k = locate(77, n, 24, 3)
    assert row_at(s, k, n, 24, 3) == 77


def test_query_against_brute_force(spark):
    rows = [(i, None if i % 11 == 0 else "é" * (i % 7), "en", "s", 1) for i in range(200)] + [(5, "same", "en", "s", 1)] * 60
    rows += [(None, "x", None, None, None), (None, None, None, None, None)]
    out = document_shards(spark.createDataFrame(rows, DDL).repartition(5)).collect()
    order = sorted(((r[0] if r[0] is not None else -1, zlib.crc32((r[1] or "").encode()), len((r[1] or "").encode()) + 8) for r in rows))
    place = permute(np.arange(len(order)), len(order), 20)
    want = sorted((*o, int(p) % 24, int(p) // 24) for o, p in zip(order, place))
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.text_crc32, r.size, r.shard, r.slot) for r in out)
    assert got == want
    sizes = {}
    for r in out:
        sizes.setdefault(r.shard, []).append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert all(sorted(v) == list(range(len(v))) for v in sizes.values())
    assert max(map(len, sizes.values())) - min(map(len, sizes.values())) <= 1


def test_same_for_any_partitioning(spark):
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    a, b = (sorted(map(tuple, document_shards(df.repartition(k)).collect())) for k in (1, 9))
    assert a == b


def test_empty_and_clashing_columns(spark):
    assert document_shards(spark.createDataFrame([], DDL)).count() == 0
    df = spark.createDataFrame([(1, 9, 9, 9, 9, 9)], "doc_id long, shard int, slot int, row_no int, _salt int, _at int")
    r = shard_rows(df, [F.col("doc_id")], 4, 1).collect()[0]
    assert (r.row_no, r.slot, r._salt, r._at) == (0, 0, 9, 9)

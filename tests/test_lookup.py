"""Lookup enrichment details: bounded probes, strategy guards, left-join semantics."""

import pytest

from nestgate.operators.lookup import Lookup, enrich_list, lookup_join, probe_size


def test_probe_stops_after_the_bound(spark):
    n, b = probe_size(spark.range(100_000), 100)
    assert n == 101 and b > 0
    assert probe_size(spark.range(7), 100)[0] == 7


def test_key_is_always_needed(spark):
    docs = spark.createDataFrame([(1, [("a",)])], "k bigint, xs array<struct<id:string>>")
    lk = Lookup("id", spark.createDataFrame([("a", "A")], "id string, label string"), "id", "label", "label")
    with pytest.raises(ValueError, match="document key"):
        enrich_list(docs, "xs", [lk], ["id", "label"])


def test_same_result_on_both_sides_of_the_map_limit(spark):
    docs = spark.createDataFrame([(1, [("k5",), ("k9999",)])], "k bigint, xs array<struct<id:string>>")
    out = []
    for n in (1024, 1025):
        terms = spark.range(n).selectExpr("concat('k', id) as id", "concat('L', id) as label")
        lk = Lookup("id", terms, "id", "label", "label")
        out.append(enrich_list(docs, "xs", [lk], ["id", "label"], key="k").collect())
    assert out[0] == out[1]


@pytest.mark.parametrize("strategy", ["map", "join"])
def test_null_labels_are_kept_and_label_order_is_fixed(spark, strategy):
    docs = spark.createDataFrame([(1, [("T1",), ("T2",), ("T9",)])], "k bigint, xs array<struct<id:string>>")
    rows = [("T1", f"L{i:02d}") for i in range(40)] + [("T1", None), ("T2", None)]
    seen = []
    for parts in (1, 3, 7):
        terms = spark.createDataFrame(rows, "id string, label string").repartition(parts)
        lk = Lookup("id", terms, "id", "label", "label")
        seen.append([tuple(e) for e in enrich_list(docs, "xs", [lk], ["id", "label"], key="k",
                                                   strategy=strategy).first()["xs"]])
    assert seen[0] == seen[1] == seen[2]
    assert seen[0] == [("T1", f"L{i:02d}") for i in range(40)] + [("T1", None), ("T2", None), ("T9", None)]


@pytest.mark.parametrize("limit", [0, 100])
def test_join_on_an_equally_named_key(spark, limit):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k bigint, x string")
    right = spark.createDataFrame([(1, "one")], "k bigint, y string")
    out = lookup_join(left, right, "k", "k", max_rows=limit)
    assert out.columns == ["k", "x", "y"]
    assert sorted(map(tuple, out.collect()), key=str) == [(1, "a", "one"), (2, "b", None), (None, "c", None)]


@pytest.mark.parametrize("limit", [0, 1000])
def test_null_ids_without_broadcast(spark, limit):
    docs = spark.createDataFrame([(i, [(None,), ("a",)]) for i in range(50)], "k bigint, xs array<struct<id:string>>")
    lk = Lookup("id", spark.createDataFrame([("a", "A")], "id string, label string"), "id", "label", "label")
    out = enrich_list(docs, "xs", [lk], ["id", "label"], key="k", strategy="join", broadcast_max_rows=limit)
    assert all([tuple(e) for e in r["xs"]] == [(None, None), ("a", "A")] for r in out.collect())


@pytest.mark.parametrize("strategy", ["map", "join"])
def test_left_join_semantics(spark, strategy):
    docs = spark.createDataFrame([(1, [("a", "x"), ("z", "x"), (None, "y")]), (2, None), (3, [])],
                                 "k bigint, xs array<struct<id:string, role:string>>")
    terms = spark.createDataFrame([("a", "A1"), ("a", "A2"), ("x", "X"), (None, "N")], "id string, label string")
    lks = [Lookup("id", terms, "id", "label", "id_label"), Lookup("role", terms, "id", "label", "role_label")]
    out = {r["k"]: [tuple(e) for e in r["xs"]]
           for r in enrich_list(docs, "xs", lks, ["id", "id_label", "role_label"], key="k", strategy=strategy).collect()}
    assert out[1] == [("a", "A1", "X"), ("a", "A2", "X"), ("z", None, "X"), (None, None, None)]
    assert out[2] == [] and out[3] == []

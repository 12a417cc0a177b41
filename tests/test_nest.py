"""Nest / unnest operators on small frames."""

from pyspark.sql import functions as F

from nestgate.operators import nest as N


def frame(spark):
    return spark.createDataFrame(
        [(1, [("b", 2), ("a", 1), ("b", 2)]), (2, []), (3, None), (4, [("c", 3)])],
        "k bigint, xs array<struct<t:string, n:bigint>>")


def test_explode_then_renest_in_source_order(spark):
    df = frame(spark)
    flat = N.explode_elements(df, "k", "xs")
    assert flat.columns == ["k", "pos", "t", "n"] and flat.count() == 4       # empty and null lists: no rows
    back = N.nest_children(flat, "k", ["t", "n"], "xs", order_by=["pos"])
    got = {r["k"]: [tuple(x) for x in r["xs"]] for r in back.collect()}
    assert got == {1: [("b", 2), ("a", 1), ("b", 2)], 4: [("c", 3)]}
    sorted_ = {r["k"]: [tuple(x) for x in r["xs"]] for r in N.nest_children(flat, "k", ["t", "n"], "xs").collect()}
    assert sorted_[1] == [("a", 1), ("b", 2), ("b", 2)]                      # default: full-tuple order


def test_reattach_fills_empty_lists(spark):
    df = frame(spark)
    flat = N.explode_elements(df, "k", "xs")
    nested = N.nest_children(flat, "k", ["t"], "ts", order_by=["pos"])
    out = {r["k"]: r["ts"] for r in N.reattach(df.select("k"), nested, "k").collect()}
    assert [x["t"] for x in out[1]] == ["b", "a", "b"] and out[2] == [] and out[3] == [] and len(out[4]) == 1


def test_rename_filter_fill_drilldown(spark):
    df = frame(spark)
    renamed = N.rename_if_present(df, {"k": "key", "missing": "nothing"})
    assert renamed.columns == ["key", "xs"]
    assert sorted(r["k"] for r in N.filter_list_length(df, "xs", ">", 0).collect()) == [1, 4]
    assert sorted(r["k"] for r in N.filter_list_length(df, "xs", "==", 0).collect()) == [2]   # null list drops out
    filled = {r["k"]: r["xs"] for r in N.fill_empty_list(df, "xs").collect()}
    assert filled[3] == [] and filled[2] == []
    drill = N.drilldown(df, F.col("k") == 1, "k", "xs").collect()
    assert [(r["pos"], r["t"]) for r in drill] == [(0, "b"), (1, "a"), (2, "b")]
    assert [r["n"] for r in df.select(N.list_length("xs").alias("n")).orderBy("n").collect()] == [None, 0, 1, 3]


def test_a_list_that_is_made_is_made_once(spark):
    docs = spark.createDataFrame([(1, "[3,4]"), (2, "[]"), (3, None)], "k long, text string")
    made = docs.select("k", F.from_json("text", "array<int>").alias("v"))
    flat = N.explode_elements(made, "k", "v")
    assert sorted(map(tuple, flat.collect())) == [(1, 0, 3), (1, 1, 4)]
    plan = flat._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1

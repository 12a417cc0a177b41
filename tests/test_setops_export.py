"""Set operations (U1/U2) and export fingerprints (K2)."""

from pyspark.sql import functions as F

from nestgate.operators import setops as U
from nestgate.plans import export as K

SCHEMA = "k bigint, xs array<struct<t:string, n:bigint>>"


def test_parity_ignores_order_and_finds_differences(spark):
    a = spark.createDataFrame([(1, [("x", 1), ("y", 2)]), (2, []), (2, [])], SCHEMA)
    b = spark.createDataFrame([(2, []), (1, [("y", 2), ("x", 1)]), (2, [])], SCHEMA)     # rows and lists reordered
    r = U.parity(a, b).first()
    assert (r["rows_a"], r["rows_b"], r["only_in_a"], r["only_in_b"]) == (3, 3, 0, 0)
    c = spark.createDataFrame([(1, [("x", 1), ("y", 3)]), (2, [])], SCHEMA)              # one value changed, a copy gone
    r = U.parity(a, c).first()
    assert (r["only_in_a"], r["only_in_b"]) == (2, 1)


def test_differences_are_named(spark):
    a = spark.createDataFrame([(1, [("x", 1)]), (2, []), (2, []), (3, None), (None, [("z", 1)])], SCHEMA)
    b = spark.createDataFrame([(1, [("x", 2)]), (2, []), (3, []), (None, [("z", 1)])], SCHEMA)
    got = sorted((r["side"], r["k"], r["copies"]) for r in U.differences(a, b, "k").collect())
    assert got == [("a", 1, 1), ("a", 2, 1), ("a", 3, 1), ("b", 1, 1), ("b", 3, 1)]
    assert U.differences(a, a, "k").count() == 0


def test_parity_tells_nulls_from_neighbours_and_signs_of_zero(spark):
    a = spark.createDataFrame([(None, "x"), ("y", None)], "p string, q string")
    b = spark.createDataFrame([("x", None), (None, "y")], "p string, q string")
    assert U.parity(a, b).first()["only_in_a"] == 2
    z = spark.createDataFrame([(0.0, [-0.0])], "v double, w array<double>")
    assert U.parity(z, spark.createDataFrame([(-0.0, [0.0])], z.schema)).first()["only_in_a"] == 0


def test_parity_in_few_buckets(spark, monkeypatch):
    """Differences are found whatever the number of buckets, many rows share one."""
    a = spark.range(2000).withColumn("v", F.col("id") * 3)
    b = a.withColumn("v", F.when(F.col("id") % 500 == 7, 0).otherwise(F.col("v")))
    for bits in (0, 3, 14):
        monkeypatch.setattr(U, "BUCKET_BITS", bits)
        assert sorted(r["id"] for r in U.differences(a, b, "id").filter("side = 'b'").collect()) == [7, 507, 1007, 1507]


def test_parity_shuffles_hashes_only(spark):
    """The documents are hashed in the first pass; what follows reads hashes."""
    wide = spark.range(10).select(F.col("id"), F.array_repeat(F.lit("text"), 50).alias("words"))
    plan = U.differences(wide, wide, "id")._jdf.queryExecution().toString()
    assert "words" not in plan and "Exchange" in plan


def test_row_hashes_are_compiled(spark):
    """Lists of plain structs are hashed by value: none is rebuilt or written as text."""
    df = spark.createDataFrame([(1, [("x", 1), ("y", 2)])], SCHEMA)
    found = U.row_hashes(df, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "to_json" not in found and "structstojson" not in found.lower()
    assert found.count("sort_array(") >= 1 and "named_struct(t" not in found


def test_hashes_by_value_tell_what_json_texts_tell(spark):
    """The hashes by value and by JSON text agree on which of these rows are equal."""
    lists = [None, [], [None], [None, None], [(None, None)], [("x", None)], [(None, 1)], [("x", 1)], [("x", 1), (None, None)],
             [("x", 1), None], [None, ("x", 1)], [("x", None), (None, 1)], [("x", 1), ("y", 2)], [("y", 2), ("x", 1)],
             [("x", 1), ("x", 1)], [("n", None)], [("", None)], [("(", None)], [("x", 2), ("y", 1)]]
    deep = [None, [], [[]], [[], []], [["a"], ["b"]], [["b"], ["a"]], [["a", "b"]], [["b", "a"]], [["a", None]], [[None, "a"]],
            [["a"], None], [[None], ["a"]], [["v"]]]
    rows = [(x, y, z, w) for x in (None, "", "n") for y in lists for z in (None, 0.0, -0.0) for w in deep]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "i int, s string, xs array<struct<t:string, n:bigint>>, d double, ll array<array<string>>")
    groups = []
    for by_value in (True, False):
        at = {}
        for r in U.row_hashes(df.withColumnRenamed("i", "side"), (), "side", by_value).collect():
            at.setdefault((r["h1"], r["h2"]), []).append(r["side"])
        groups.append(sorted(sorted(g) for g in at.values()))
    assert groups[0] == groups[1] and 1 < len(groups[0]) < len(rows)


def test_parity_of_other_types_by_text(spark):
    """Maps have no hash, and columns of other types than the other source's have other hashes by value."""
    a = spark.createDataFrame([(1, {"a": 1}), (2, {"b": 2})], "k int, m map<string,int>")
    b = spark.createDataFrame([(1, {"a": 1}), (2, {"b": 3})], "k bigint, m map<string,int>")
    assert [(r["side"], r["k"]) for r in U.differences(a, b, "k").orderBy("side").collect()] == [("a", 2), ("b", 2)]


def test_parity_of_rows_with_a_side(spark):
    """Both sources in one table: the same as two tables; a column named like the helper columns changes nothing."""
    rows = spark.createDataFrame([(1, 1, "x"), (-1, 1, "x"), (1, 2, "y"), (1, 2, "y"), (-1, 2, "y"), (-1, 3, None)],
                                 "side int, k bigint, _0 string")
    r = U.parity_of_sides(rows).first()
    assert (r["rows_a"], r["rows_b"], r["only_in_a"], r["only_in_b"]) == (3, 3, 1, 1)
    got = sorted((r["side"], r["k"], r["copies"]) for r in U.differences_of_sides(rows, "k").collect())
    assert got == [("a", 2, 1), ("b", 3, 1)]


def test_parity_queries_nest_documents_once(spark, monkeypatch, tmp_path):
    """Both routes take their texts from one pass over the nested documents."""
    from nestgate import catalog as C

    calls = []
    docs = spark.createDataFrame([(k, 1, "F", 2.5, None, None, [(1, 7, 8, 1.0, 2.0, 0.1, None, "R", "O", None)] if k % 2 else [])
                                  for k in (97, 101, 102, 103)], C.ORDER_FULL)
    monkeypatch.setattr(C.S, "nested_orders", lambda s, d, **kw: calls.append(kw) or docs)
    got = sorted((r["side"], r["o_orderkey"]) for r in C.QUERIES["parity_differences"](spark, "t").collect())
    assert got == [("a", 97), ("a", 101), ("b", 97)]
    both = C._two_routes(spark, "t")
    assert both.columns[0] == "side" and both.where("side = -1").count() == 3
    assert both._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    assert len(C.QUERIES["source_content"](spark, "t").collect()) == 6
    assert calls == [{"spread": True}] * 3                         # once a query


def test_union_batches_by_name(spark):
    a = spark.createDataFrame([(1, "a")], "k bigint, v string")
    b = spark.createDataFrame([("b", 2)], "v string, k bigint")
    assert sorted(tuple(r) for r in U.union_batches([a, b]).collect()) == [(1, "a"), (2, "b")]


def test_fingerprint_is_order_insensitive_and_content_sensitive(spark):
    a = spark.createDataFrame([(1, [("x", 1)]), (2, [("y", 2)])], SCHEMA)
    b = a.orderBy(F.desc("k")).repartition(3)
    c = spark.createDataFrame([(1, [("x", 1)]), (2, [("y", 5)])], SCHEMA)
    fa, fb, fc = (tuple(K.fingerprint(d).first()) for d in (a, b, c))
    assert fa == fb and fa != fc


def test_one_array_file_is_sorted_by_many_tasks(spark, tmp_path, monkeypatch):
    import json

    from nestgate.plans import export as K

    monkeypatch.setattr(K, "CHUNK", 300)
    docs = spark.range(2000).selectExpr("id % 700 as k", "cast(nullif(id % 2, 1) as string) as g", "repeat('é', 20) as t")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        lines = K.array_lines(docs.withColumn("h", docs["g"]), "h", ["k"])
        tasks = K.line_chunks(lines, "h").filter("part = 1").groupBy("by").agg({"task": "min", "*": "count"}).count()
        spread = K.line_chunks(lines, "h").select("by", "task").distinct().groupBy("by").count().collect()
        K.write_json_arrays(docs.withColumn("h", docs["g"]), str(tmp_path / "out"), "h", ["k"])
    finally:
        spark.conf.set(coalesce, "true")
    assert tasks == 2 and all(r["count"] > 1 for r in spread)
    files = list((tmp_path / "out").glob("h=*/*.txt"))
    assert len(files) == 2
    for f in files:
        rows = json.loads(f.read_text())
        assert len(rows) == 1000 and [r["k"] for r in rows] == sorted(r["k"] for r in rows)


def test_harvested_xml_is_written_packed(spark, tmp_path):
    from nestgate import catalog

    (tmp_path / "t").mkdir()
    one = "cast(1 as bigint)"
    spark.sql(f"select {one} o_orderkey, {one} o_custkey, 'F' o_orderstatus, 2.5D o_totalprice, timestamp_ntz'2020-01-01' "
              "o_orderdate, '1-URGENT' o_orderpriority").write.parquet(str(tmp_path / "t" / "orders.parquet"))
    spark.sql(f"select {one} l_orderkey, {one} l_partkey, {one} l_suppkey, 1 l_linenumber, 1D l_quantity, 1D l_extendedprice, "
              "0D l_discount, 0D l_tax, 'R' l_returnflag, 'F' l_linestatus, timestamp_ntz'2020-01-02' l_shipdate"
              ).write.parquet(str(tmp_path / "t" / "lineitem.parquet"))
    out = catalog.QUERIES["xml_record_harvest"](spark, str(tmp_path / "t"))
    assert out.count() == 1 and all(f.endswith(".xml.gz") for f in out.inputFiles())


def test_keys_order_as_spark_orders(spark):
    """Chunks are merged by keys that Python compares as Spark does: nulls, NaN, text, dates, nested values."""
    import pyarrow as pa

    df = spark.createDataFrame(
        [(x, s, None if s is None else [x], None if x is None else (s, x)) for x in (None, -1.5, float("nan"), float("-inf"), 2.0)
         for s in (None, "", "a", "Z", "é", "😀", "￮")],
        "x double, s string, l array<double>, t struct<s: string, x: double>")
    df = df.withColumn("d", F.expr("date'2020-01-01' + try_cast(x as int)"))
    df = df.withColumn("z", F.expr("case when s > 'a' then timestamp_ntz'1960-01-01' + make_dt_interval(0, 0, 0, length(s)) end"))
    for names in (["x", "s"], ["l", "s", "x"], ["t", "s", "x"], ["d", "x", "s"], ["z", "s", "x"]):
        rows = df.select(F.struct(*names).alias("at"), F.to_json(F.struct(*names)).alias("v")).toArrow()
        keys = K._keys(pa.concat_arrays(rows["at"].chunks))
        mine = [v for _, v in sorted(zip(keys, rows["v"].to_pylist()), key=lambda r: r[0])]
        assert mine == [r["v"] for r in df.orderBy(*names).select(F.to_json(F.struct(*names)).alias("v")).collect()]


ORDERS = [(None if k % 50 == 0 else k % 900, k, "F", 1.5 * k, None if k % 7 == 0 else f"{k % 4}-P") for k in range(2000)]


def test_harvested_arrays_are_packed_and_move_once(spark, tmp_path, monkeypatch):
    """One sorted array file a priority, in less than a fifth of its text, and still read by several tasks."""
    import json

    import pyarrow as pa

    from nestgate import catalog as C

    path, data = str(tmp_path / "arrays"), tmp_path / "t"
    data.mkdir()
    monkeypatch.setattr(C, "scratch_path", lambda s, name: path)
    shape = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string"
    orders = spark.createDataFrame(ORDERS, shape).withColumn("o_orderdate", F.expr("timestamp_ntz'2020-01-01'"))
    orders.write.parquet(str(data / "orders.parquet"))
    spark.range(5000).selectExpr(
        "id % 1100 as l_orderkey", "id as l_partkey", "id % 7 as l_suppkey", "int(id % 3) as l_linenumber",
        "double(id) as l_quantity", "double(nullif(id % 5, 0)) as l_extendedprice", "0.1D as l_discount", "0D as l_tax",
        "'\\\\\"}]{[é' || repeat(sha2(string(id), 256), 12) as l_returnflag", "string(null) as l_linestatus",
        "timestamp_ntz'2020-01-02' as l_shipdate").write.parquet(str(data / "lineitem.parquet"))
    want = sorted(map(repr, C.QUERIES["explode_unnest"](spark, str(data)).collect()))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        out = C.QUERIES["json_array_harvest"](spark, str(data))
        assert sorted(map(repr, out.collect())) == want
        assert out.select(F.spark_partition_id()).distinct().count() > 5
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files, found, text = list((tmp_path / "arrays").glob("priority=*/*.txt")), [], b""
    assert len(files) == 5
    for f in files:
        one = pa.CompressedInputStream(pa.OSFile(str(f)), "zstd").read()            # as any decoder reads it
        text, docs = text + one, json.loads(one)
        keys = [d["o_orderkey"] for d in docs]
        assert keys == sorted(keys, key=lambda k: (k is not None, k)) and len({d["o_orderpriority"] for d in docs}) == 1
        found += [(d["o_orderkey"], d["o_custkey"], d["o_orderstatus"], d["o_totalprice"], d["o_orderpriority"]) for d in docs]
    assert sorted(found, key=repr) == sorted(ORDERS, key=repr)
    assert sum(f.stat().st_size for f in files) < len(text) / 5


def test_lines_to_write_are_shuffled_packed(spark):
    docs = spark.range(20000).selectExpr("id as k", "'a' as g", "repeat('some words ', 20) as t")
    lines = K.array_lines(docs.withColumn("h", docs["g"]), "h", ["k"])
    chunks = K.line_chunks(lines, "h").agg(F.sum(F.length("value")).alias("n")).first()["n"]
    text = lines.agg(F.sum(F.length("value")).alias("n")).first()["n"]
    assert chunks < text / 10
    assert "rangepartitioning" not in K.line_chunks(lines, "h")._jdf.queryExecution().toString()

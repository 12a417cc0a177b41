"""Plan-shape checks: the properties the scale design relies on, read from explain()."""

import contextlib
import io

from pyspark.sql import functions as F

from nestgate.functions import rules as R
from nestgate.operators.lookup import Lookup, enrich_list, lookup_join
from nestgate.plans import collection as M
from nestgate.plans import validate as V
from nestgate.session import scratch_path


def plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_rules_read_only_referenced_nested_leaves(spark, enriched):
    path = scratch_path(spark, "t-plan-scan")
    enriched.write.parquet(path)
    docs = spark.read.parquet(path)
    rules = [R.min_element("gt1", "dimensions", "value", ">", 1), R.any_equal("artist", "constituents", "role", "artist")]
    p = plan(V.summary(docs, rules))
    read = [line for line in p.splitlines() if "ReadSchema" in line]
    assert read == ["ReadSchema: struct<dimensions:array<struct<value:double>>,"
                    "constituents:array<struct<role:string>>>"]


def test_map_enrichment_does_not_shuffle_documents(spark, terms_xml, objects_xml):
    lk = Lookup("nationality_id", terms_xml.where("term_type = 'nationality'"), "term_id", "label", "nationality")
    out = enrich_list(objects_xml, "constituents", [lk], ["name", "nationality"], key="id", strategy="map")
    p = plan(out)
    main, _, subqueries = p.partition("===== Subqueries =====")
    assert "Exchange" not in main.split("\n\n")[0]          # tree of the main query
    assert "Subquery" in subqueries or "subquery" in main


def test_join_enrichment_shuffles_each_side_once(spark, terms_xml, objects_xml):
    """Without broadcasts: the grouped terms, the elements by id, their regrouping and the documents.
    The regrouped lists are joined on the columns they are partitioned by."""
    lk = Lookup("nationality_id", terms_xml, "term_id", "label", "nationality")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = enrich_list(objects_xml, "constituents", [lk], ["name", "nationality"], key="id", strategy="join",
                          broadcast_max_rows=0)
        p = plan(out)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    import re

    tree = p.split("\n\n")[0]
    assert len(re.findall(r"\bExchange \(\d+\)", tree)) <= 5, tree      # elements, terms, terms by (id, salt), regroup, documents


def test_summary_is_one_hash_aggregation(spark, enriched):
    p = plan(V.summary(enriched, [r for r in M.object_rules() if r.level != "frame"]))
    import re

    assert len(re.findall(r"HashAggregate \(\d+\)", p)) == 2   # partial + final: one pass
    assert "SortAggregate" not in p and "ObjectHashAggregate" not in p


def test_child_table_rules_use_partial_hash_aggregation(spark):
    parents = spark.range(100).select(F.col("id").alias("k"))
    kids = spark.range(1000).select((F.col("id") % 100).alias("k"), (F.col("id") % 7).cast("double").alias("v"))
    rules = [R.min_element("v_gt_0", "xs", "v", ">", 0), R.list_size("some", "xs", ">", 0)]
    p = plan(V.summary_from_children(parents, kids, "k", "xs", rules))
    assert "SortAggregate" not in p and "ObjectHashAggregate" not in p and "collect_list" not in p


def test_small_lookup_join_is_broadcast(spark, terms_xml, objects_xml):
    flat = objects_xml.select("id", F.explode("classifications").alias("c")).select("id", "c.term_id")
    terms = terms_xml.select(F.col("term_id").alias("tid"), "label")
    p = plan(lookup_join(flat, terms, "term_id", "tid"))
    assert "BroadcastHashJoin" in p


def test_uniqueness_findings_do_not_shuffle_the_data(spark, enriched):
    tagged = V.with_findings(enriched, [R.unique("id_unique", "object_id")])
    p = plan(tagged)
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_conformance_reads_documents_once_and_shuffles_counts(spark):
    from pyspark.sql import types as T

    from nestgate.plans.conformance import conformance

    docs = spark.createDataFrame([('{"a":1}',)], "doc string")
    p = plan(conformance(spark, docs, "doc", T.StructType.fromDDL("a bigint, b array<struct<c: string>>")))
    import re

    assert len(re.findall(r"\bExchange \(\d+\)", p.split("\n\n")[0])) == 1
    assert "SortAggregate" not in p and "Join" not in p and p.count("parse_json") < 4

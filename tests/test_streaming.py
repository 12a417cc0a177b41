"""Incremental gate over a JSON-lines file stream."""

import json

from nestgate.plans import collection as M
from nestgate.session import scratch_path
from nestgate.streaming.gate import json_document_stream, start_gate


def test_stream_gate(spark, tmp_path):
    from fixtures import OBJECTS

    src = tmp_path / "in"
    src.mkdir()
    docs = []
    for o in OBJECTS:  # the enriched shape is not needed: raw object rules on dimensions/media
        docs.append(json.dumps(o))
    (src / "batch1.json").write_text("\n".join(docs[:3]) + "\n")
    (src / "batch2.json").write_text("\n".join(docs[3:]) + "\n")
    rules = [r for r in M.object_rules() if r.column in ("dimensions", "media")]
    out, summ = scratch_path(spark, "t-stream-out"), scratch_path(spark, "t-stream-summary")
    import uuid

    q = start_gate(json_document_stream(spark, str(src), M.OBJECT, max_files_per_trigger=1), rules, out, summ,
                   name=f"t_gate_{uuid.uuid4().hex[:8]}")
    q.awaitTermination(120)
    res = spark.read.parquet(out)
    got = {r["object_id"]: r["_status"] for r in res.select("object_id", "_status").collect()}
    assert got == {"jar": "clean", "rug": "clean", "mask": "clean", "bell": "clean", "oar": "quarantined",
                   "kite": "quarantined", "lamp": "quarantined"}
    s = spark.read.parquet(summ)
    assert s.select("batch_id").distinct().count() == 2
    assert {r["rule"] for r in s.where("failed > 0").collect()} == {
        "all_dimension_values_gt_1", "all_urls_are_https", "has_primary_image", "has_height_dimension", "all_units_are_cm"}


def test_stream_batch_rerun_is_idempotent(spark):
    """Writing the same batch id twice (as after a restart) leaves one copy of its rows."""
    from nestgate.functions import rules as R
    from nestgate.streaming.gate import write_batch

    out, summ = scratch_path(spark, "t-idem"), scratch_path(spark, "t-idem-sum")
    df = spark.createDataFrame([(1, [0.5]), (2, [3.0])], "id bigint, v array<double>")
    rules = [R.min_element("gt1", "v", None, ">", 1)]
    for _ in range(2):
        write_batch(df, 7, rules, out, summ)
    write_batch(df.where("id = 2"), 8, rules, out, summ)
    res = spark.read.parquet(out)
    assert res.count() == 3
    assert {(r["_batch"], r["_status"]) for r in res.select("_batch", "_status").distinct().collect()} == {
        (7, "clean"), (7, "quarantined"), (8, "clean")}
    assert spark.read.parquet(summ).where("failed > 0").count() == 1

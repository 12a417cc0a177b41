"""Generated wide rows and planted errors: each planted rule fails on exactly its block."""

from pyspark.sql import functions as F

from nestgate.plans import collection as M
from nestgate.plans import validate as V
from nestgate.sources import synth as SY


def test_planted_errors_found_exactly(spark):
    n, k = 4000, 200
    ids = spark.range(n).select(F.col("id").alias("n"))
    df = SY.inject_errors(SY.generate_objects(ids, n), k).drop("n")
    assert df.schema.simpleString() == M.WIDE.simpleString()
    s = {r["rule"]: r["failed"] for r in V.summary(df, M.wide_rules()).collect()}
    planted = {"all_dimension_values_gt_1", "has_at_least_one_constituent", "has_at_least_one_artist",
               "has_primary_image", "has_at_least_one_image", "has_provenance"}
    assert {r for r, v in s.items() if v} == planted
    assert all(s[r] == k for r in planted)
    first = {r["column_name"]: r["rule"] for r in V.first_failures(V.summary(df, M.wide_rules())).collect()}
    assert first == {"dimensions": "all_dimension_values_gt_1", "media": "has_primary_image",
                     "constituents": "has_at_least_one_constituent", "provenance": "has_provenance"}
    row = df.where(F.col("object_id") == "OBJ-0000005").first()
    assert row["title"] == "Artwork 5" and row["date_made"] == 1805 and row["dimensions"][0]["value"] == 0.5
    assert df.where(F.col("object_id") == f"OBJ-{n - 1:07d}").first()["related_objects"][0]["object_id"] == "OBJ-0000000"


def test_command_line(spark, capsys):
    import json

    from nestgate.__main__ import main
    from nestgate.session import scratch_path

    path = scratch_path(spark, "t-cli")
    assert main(["generate", "--rows", "2000", "--out", path], spark=spark) == 0
    capsys.readouterr()
    assert main(["validate", path, "--depth", "full"], spark=spark) == 1
    out = json.loads(capsys.readouterr().out)
    assert {f["rule"] for f in out["failures"]} == {
        "all_dimension_values_gt_1", "has_at_least_one_constituent", "has_at_least_one_artist",
        "has_primary_image", "has_at_least_one_image", "has_provenance"}
    assert all(f["failed"] == 100 for f in out["failures"])
    assert main(["validate", path, "--depth", "types"], spark=spark) == 0
    capsys.readouterr()
    main(["profile", path, "--show", "2"], spark=spark)
    lines = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    prof = {x["column_name"]: x for x in lines if "column_name" in x}
    assert prof["media"]["n_empty"] == 100 and prof["object_id"]["n_rows"] == 2000
    assert len([x for x in lines if "object_id" in x]) == 2


def test_full_size_planted_errors(spark):
    """The reference benchmark's shape: 1,000,000 rows, each planted rule fails on exactly 50,000."""
    ids = spark.range(SY.BENCH_ROWS).select(F.col("id").alias("n"))
    df = SY.inject_errors(SY.generate_objects(ids, SY.BENCH_ROWS), SY.ERRORS_PER_KIND).drop("n")
    s = {r["rule"]: r["failed"] for r in V.summary(df, M.nullability_rules(M.WIDE) + M.wide_rules()).collect()}
    failing = {r: v for r, v in s.items() if v}
    assert failing == {r: 50_000 for r in ("all_dimension_values_gt_1", "has_at_least_one_constituent",
                                           "has_at_least_one_artist", "has_primary_image", "has_at_least_one_image",
                                           "has_provenance")}

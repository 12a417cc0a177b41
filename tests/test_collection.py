"""End-to-end on the small collection of fixtures.py: harvest, enrich, check, gate, export."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from nestgate.functions import rules as R
from nestgate.operators import setops as U
from nestgate.plans import collection as M
from nestgate.plans import export as K
from nestgate.plans import validate as V
from nestgate.session import scratch_path

EXPECTED_CLASSIFICATIONS = {
    "jar": [("Material", "Fired clay")], "rug": [("Use", "Feast days"), ("Material", "Split reed")],
    "mask": [("Material", "Split reed")], "oar": [("Use", "Feast days")],
    "bell": [("Material", "Cast <brass>"), ("Use", None)], "kite": [("Use", "Feast days")], "lamp": [("Material", "Fired clay")],
}
EXPECTED_CONSTITUENTS = {
    "jar": [("Ada", "artist", 1899, "Hill people")],
    "rug": [("Bo", "artist", None, None), ("Cy & Sons", "donor", None, None), ("Di", "artist", 1850, "Shore & isles"),
            ("Ed", "dyer", 1861, None)],
    "mask": [], "oar": [("Flo", "artist", 1870, "Shore & isles")], "bell": [("Gus", "founder", 1755, "Hill people")],
    "kite": [("Hal", "artist", 1950, None)], "lamp": [("Ivy", "artist", 1880, "Hill people")],
}
# which rules each record breaks
BROKEN = {
    "mask": ["has_at_least_one_artist", "has_at_least_one_constituent"], "oar": ["all_dimension_values_gt_1"],
    "bell": ["has_at_least_one_artist", "no_null_labels_in_classifications"],
    "kite": ["all_urls_are_https", "has_primary_image"], "lamp": ["all_units_are_cm", "has_height_dimension"],
}
BROKEN_PAIRS = {(o, r) for o, rules in BROKEN.items() for r in rules}
FIRST_ERRORS = [{"column": "dimensions", "check": "all_dimension_values_gt_1"}, {"column": "media", "check": "all_urls_are_https"},
                {"column": "classifications", "check": "no_null_labels_in_classifications"},
                {"column": "constituents", "check": "has_at_least_one_constituent"}]


def as_tuples(rows):
    return {r["object_id"]: ([tuple(c) for c in r["classifications"]], [tuple(c) for c in r["constituents"]])
            for r in rows}


def test_harvest_xml_shapes(objects_xml, terms_xml):
    assert terms_xml.count() == 8
    assert terms_xml.columns == ["term_id", "term_type", "label"]
    rows = {r["id"]: r for r in objects_xml.collect()}
    assert set(rows) == set(EXPECTED_CONSTITUENTS)
    assert rows["mask"]["date_made"] is None
    assert rows["mask"]["constituents"] == []          # empty wrapper -> []
    assert rows["rug"]["constituents"][1]["birth_year"] is None
    assert rows["jar"]["classifications"][0]["term_id"] == "clay"  # single-child wrapper is a list
    assert rows["oar"]["dimensions"][1]["value"] == 0.25


def test_enriched_matches_expected(enriched):
    got = as_tuples(enriched.collect())
    for oid in EXPECTED_CLASSIFICATIONS:
        assert got[oid][0] == EXPECTED_CLASSIFICATIONS[oid], oid
        assert got[oid][1] == EXPECTED_CONSTITUENTS[oid], oid
    assert enriched.columns == ["object_id", "title", "date_made", "credit_line", "department", "dimensions",
                                "media", "classifications", "constituents"]
    assert enriched.schema.simpleString() == M.ENRICHED.simpleString()


def test_json_source_parity(spark, fixture_paths, enriched):
    terms = M.harvest_terminology_json(spark, fixture_paths["json_terms"], multiline=True)
    objs = M.harvest_objects_json(spark, fixture_paths["json_objects"], multiline=True)
    from_json = M.enrich_objects(terms, objs)
    r = U.parity(enriched, from_json).first()
    assert (r["rows_a"], r["rows_b"], r["only_in_a"], r["only_in_b"]) == (7, 7, 0, 0)


@pytest.mark.parametrize("strategy", ["map", "join"])
def test_enrichment_strategies_agree(terms_xml, objects_xml, enriched, strategy):
    out = M.enrich_objects(terms_xml, objects_xml, strategy=strategy)
    assert as_tuples(out.collect()) == as_tuples(enriched.collect())


def test_rule_outcomes(enriched):
    rules = M.object_rules() + M.cross_column_rules()
    crossed = {("bell", "sculpture_must_have_depth"), ("kite", "birth_years_before_date_made")}
    s = {r["rule"]: r["failed"] for r in V.summary(enriched, rules).collect()}
    assert {k: v for k, v in s.items() if v} == Counter(r for _, r in BROKEN_PAIRS | crossed)
    rows = {(r["object_id"], r["rule"]) for r in V.failing_rows(enriched, rules, "object_id").collect()}
    assert rows == BROKEN_PAIRS | crossed


def test_guarded_artist_rule(enriched):
    guarded = R.any_element_if_any("has_artist_if_any", "constituents", "role", lambda v: v == "artist")
    assert [r["object_id"] for r in V.failing_rows(enriched, [guarded], "object_id").collect()] == ["bell"]   # not mask


def test_first_failure_per_column(enriched):
    passed, errors = M.check_objects(enriched)
    assert not passed
    assert errors == FIRST_ERRORS


def test_failing_elements(enriched):
    rows = V.failing_elements(enriched, M.object_rules(), "object_id").collect()
    assert sorted((r["object_id"], r["rule"], r["pos"], json.loads(r["value"])[0]) for r in rows) == [
        ("bell", "no_null_labels_in_classifications", 1, None), ("kite", "all_urls_are_https", 0, "http://pics.test/kite"),
        ("lamp", "all_units_are_cm", 0, "in"), ("oar", "all_dimension_values_gt_1", 1, 0.25)]


def test_gate_and_quarantine(enriched):
    with pytest.raises(V.ValidationError) as e:
        V.gate(enriched, M.object_rules())
    assert {f["rule"] for f in e.value.failures} == {r for _, r in BROKEN_PAIRS}
    assert V.gate(enriched, M.object_rules(), mode="warn") is enriched
    clean, bad = V.quarantine(enriched, M.object_rules())
    assert sorted(r["object_id"] for r in clean.collect()) == ["jar", "rug"]
    assert {r["object_id"]: sorted(f["rule"] for f in r["_failed_rules"]) for r in bad.collect()} == BROKEN


def test_duplicate_terms_multiply_and_missing_terms_stay(spark, terms_xml, objects_xml):
    dup = terms_xml.unionByName(spark.createDataFrame([("clay", "material", "Walnut")], terms_xml.schema))
    missing = terms_xml.where(F.col("term_id") != "feast")
    for strategy in ("map", "join"):
        out = {r["object_id"]: r for r in M.enrich_objects(dup, objects_xml, strategy=strategy).collect()}
        assert [tuple(c) for c in out["jar"]["classifications"]] == [("Material", "Fired clay"),
                                                                     ("Material", "Walnut")]
        out = M.enrich_objects(missing, objects_xml, strategy=strategy)
        row = {r["object_id"]: r for r in out.collect()}["rug"]
        assert tuple(row["classifications"][0]) == ("Use", None)
        nulls = R.elements_not_null("no_null_labels_in_classifications", "classifications", "term_label")
        assert V.summary(out, [nulls]).first()["failed"] == 4            # rug, oar, kite, and bell as before


def test_duplicate_parent_rows_keep_their_own_lists(spark, terms_xml, objects_xml):
    twice = objects_xml.unionByName(objects_xml.where(F.col("id") == "rug"))
    for strategy in ("map", "join"):
        rows = [r for r in M.enrich_objects(terms_xml, twice, strategy=strategy).collect()
                if r["object_id"] == "rug"]
        assert len(rows) == 2
        assert all(len(r["classifications"]) == 2 for r in rows)
    uniq = next(r for r in M.object_rules() if r.name == "object_id_unique")
    enriched = M.enrich_objects(terms_xml, twice)
    assert V.summary(enriched, [uniq]).first()["failed"] == 2


def test_parquet_roundtrip_and_json_export(spark, enriched):
    r = K.roundtrip_report(spark, enriched, scratch_path(spark, "t-roundtrip")).first()
    assert r["rows_written"] == r["rows_read"] == 7 and r["schema_equal"] and r["content_equal"]
    path = scratch_path(spark, "t-json")
    K.write_json_lines(enriched, path)
    docs = [json.loads(line) for line in spark.read.text(path).toPandas()["value"]]
    obj3 = next(d for d in docs if d["object_id"] == "mask")
    assert obj3["date_made"] is None and "date_made" in obj3 and obj3["constituents"] == []
    obj1 = next(d for d in docs if d["object_id"] == "rug")
    assert obj1["constituents"][1] == {"name": "Cy & Sons", "role": "donor", "birth_year": None,
                                       "nationality": None}
    one = K.document_by_id(enriched, "object_id", "bell").first()
    assert json.loads(one["document"])["department"] == "Sculpture"
    bulk = K.bulk_index_lines(enriched, "object_id", "objects").first()["value"].split("\n")
    assert json.loads(bulk[0])["index"]["_index"] == "objects"


def test_write_split_one_pass(spark, enriched):
    tagged = V.with_findings(enriched, M.object_rules()).withColumn(
        "_status", F.when(F.size("_failed_rules") == 0, "clean").otherwise("quarantined"))
    path = scratch_path(spark, "t-split")
    K.write_split(tagged, path)
    back = spark.read.parquet(path)
    assert {r["_status"]: r["count"] for r in back.groupBy("_status").count().collect()} == {
        "clean": 2, "quarantined": 5}


def test_malformed_xml_files(spark, tmp_path, fixture_paths):
    import shutil
    from pathlib import Path

    from nestgate.sources.xml import assert_well_formed, malformed_xml_files

    d = tmp_path / "objs"
    shutil.copytree(fixture_paths["xml_objects"], d)
    (d / "BAD-1.xml").write_text('<?xml version="1.0"?>\n<object id="B1"><title>x</title><dimensions>')
    (d / "BAD-2.xml").write_text('<?xml version="1.0"?>\n<thing id="B2"><title>wrong root</title></thing>')
    (d / "BAD-3.xml").write_text('<?xml version="1.0"?>\n<object id="B3"><title>ok</title></object>\n<object id="B3b">')
    (d / "BAD-4.xml").write_text("")
    (d / "BAD-5.xml").write_text('<objects><object id="B5"><title>ok</title></object>')
    (d / "BAD-6.xml").write_text('<object id="B6"><title>ok</title></object>\nand more')
    (d / "good name.xml").write_text('<object id="G1"><title>ok</title></object >\n<!-- end -->\n')
    (d / "good2.xml").write_text('<objects><object id="G2"><title>a &lt; b</title></object></objects>')
    report = malformed_xml_files(spark, str(d), "object", M.OBJECT_XML_READ)
    got = {(Path(r["file_path"]).name, r["reason"]) for r in report.collect()}
    assert got == {("BAD-1.xml", "corrupt"), ("BAD-2.xml", "no_record"), ("BAD-3.xml", "corrupt"), ("BAD-4.xml", "empty"),
                   ("BAD-5.xml", "unclosed"), ("BAD-6.xml", "corrupt")}
    listed = str(tmp_path / "listed")
    with pytest.raises(ValueError, match=r"Malformed XML: 6 file\(s\), listed in"):
        assert_well_formed(report, listed)
    assert spark.read.parquet(listed).count() == 6
    assert_well_formed(malformed_xml_files(spark, fixture_paths["xml_objects"], "object", M.OBJECT_XML_READ), listed)


def test_json_lines_keep_every_row_and_the_wrong_form_is_refused(spark, tmp_path, capsys):
    from fixtures import OBJECTS, TERMS
    from nestgate.__main__ import main

    lines, terms = tmp_path / "objects.jsonl", tmp_path / "terms.jsonl"
    lines.write_text("\n".join(json.dumps(o) for o in OBJECTS) + "\n\n")
    terms.write_text("\n".join(json.dumps({"term_id": i, "term_type": t, "label": x}) for i, t, x in TERMS))
    assert M.harvest_objects_json(spark, str(lines)).count() == 7
    out = str(tmp_path / "out")
    args = ["collection", "--out", out, "--json-objects", str(lines), "--json-terms", str(terms), "--mode", "warn"]
    assert main(args, spark=spark) == 0
    assert spark.read.json(json.loads(capsys.readouterr().out.strip().splitlines()[-1])["output"]).count() == 7
    with pytest.raises(ValueError, match="Malformed JSON: 2 file"):
        main([*args, "--multiline"], spark=spark)
    cut = tmp_path / "cut.json"
    cut.write_text(json.dumps(OBJECTS)[:-30])
    whole = tmp_path / "whole.json"
    whole.write_text(json.dumps([{"term_id": i, "term_type": t, "label": x} for i, t, x in TERMS], indent=1))
    with pytest.raises(ValueError, match="Malformed JSON: 1 file"):
        M.materialize_collection(spark, out, json_objects=str(cut), json_terms=str(whole), mode="warn", multiline=True)


def test_profile(enriched):
    from nestgate.plans.profile import nested_columns, table_profile

    assert nested_columns(enriched) == ["dimensions", "media", "classifications", "constituents"]
    p = {r["column_name"]: r for r in table_profile(enriched).collect()}
    assert p["date_made"]["n_nulls"] == 1
    assert p["constituents"]["n_empty"] == 1 and p["constituents"]["n_elements"] == 9
    assert p["media"]["max_len"] == 2 and p["title"]["n_empty"] is None


def test_materialize_collection_modes(spark, fixture_paths):
    base = scratch_path(spark, "t-flow")
    with pytest.raises(V.ValidationError, match="all_dimension_values_gt_1"):
        M.materialize_collection(spark, base + "-block", xml_objects=fixture_paths["xml_objects"],
                                 xml_terms=fixture_paths["xml_terms"])
    out = M.materialize_collection(spark, base + "-warn", json_objects=fixture_paths["json_objects"],
                                   json_terms=fixture_paths["json_terms"], multiline=True, mode="warn")
    assert not out["passed"] and spark.read.json(out["output"]).count() == 7
    rows = {(r["object_id"], r["rule"]) for r in spark.read.parquet(out["failing_rows"]).collect()}
    assert rows == BROKEN_PAIRS
    el = spark.read.parquet(out["failing_elements"]).where("column_name = 'dimensions' and object_id = 'oar'").first()
    assert (el["rule"], el["pos"], el["value"]) == ("all_dimension_values_gt_1", 1, "[0.25]")
    out = M.materialize_collection(spark, base + "-q", xml_objects=fixture_paths["xml_objects"],
                                   xml_terms=fixture_paths["xml_terms"], mode="quarantine")
    back = spark.read.parquet(out["output"])
    assert {r["object_id"] for r in back.where("_status = 'quarantined'").collect()} == set(BROKEN)


def test_json_mistyped_value_nulls_only_that_value(spark, tmp_path):
    from fixtures import OBJECTS

    objs = [dict(o) for o in OBJECTS]
    objs[1]["date_made"] = "circa 1900"
    path = tmp_path / "objects.json"
    path.write_text(json.dumps(objs, indent=2))
    rows = {r["object_id"]: r for r in M.harvest_objects_json(spark, str(path), multiline=True).collect()}
    assert len(rows) == 7 and rows["rug"]["date_made"] is None
    assert rows["rug"]["title"] == "The rug" and rows["jar"]["date_made"] == 1931
    assert rows["rug"]["dimensions"][0]["value"] == 90.5


def test_empty_xml_element_kept_as_empty_string(spark, tmp_path):
    from fixtures import OBJECTS, object_xml

    d = tmp_path / "x"
    d.mkdir()
    (d / "E.xml").write_text(object_xml(OBJECTS[0]).replace("<name>Ada</name>", "<name/>"))
    row = M.harvest_objects_xml(spark, str(d)).first()
    assert row["constituents"][0]["name"] == ""
    rule = R.no_empty_strings("no_empty_names", "constituents", "name")
    assert M.harvest_objects_xml(spark, str(d)).where(rule.failed()).count() == 1


def test_null_document_key_keeps_its_list(spark, terms_xml, objects_xml):
    no_key = objects_xml.withColumn("id", F.when(F.col("id") == "jar", F.lit(None)).otherwise(F.col("id")))
    for strategy in ("map", "join"):
        rows = M.enrich_objects(terms_xml, no_key, strategy=strategy).collect()
        row = next(r for r in rows if r["object_id"] is None)
        assert [tuple(c) for c in row["classifications"]] == [("Material", "Fired clay")], strategy


def test_hot_identical_copies_keep_single_lists(spark, terms_xml, objects_xml):
    """A third of the rows are copies of one document: every copy keeps exactly its own
    list (no merged lists, no pairs), through both enrichment strategies."""
    hot = objects_xml.where(F.col("id") == "rug")
    copies = hot.withColumn("_c", F.explode(F.sequence(F.lit(1), F.lit(1024)))).drop("_c")
    docs = objects_xml.where(F.col("id") != "rug").unionByName(copies)
    for strategy in ("map", "join"):
        out = M.enrich_objects(terms_xml, docs, strategy=strategy)
        sizes = out.where(F.col("object_id") == "rug").groupBy(F.size("classifications").alias("n")).count()
        assert [(r["n"], r["count"]) for r in sizes.collect()] == [(2, 1024)], strategy


def test_materialize_collection_refuses_malformed_xml(spark, tmp_path, fixture_paths):
    import shutil

    d = tmp_path / "objs"
    shutil.copytree(fixture_paths["xml_objects"], d)
    (d / "BAD.xml").write_text('<?xml version="1.0"?>\n<object id="B"><title>x</title><dimensions>')
    with pytest.raises(ValueError, match=r"Malformed XML: 1 file\(s\)"):
        M.materialize_collection(spark, scratch_path(spark, "t-flow-bad"), xml_objects=str(d),
                                 xml_terms=fixture_paths["xml_terms"], mode="warn")


def test_xml_attribute_and_child_with_the_same_name(spark):
    from nestgate.sources.xml import clean_names, parse_xml_column

    df = spark.createDataFrame([('<c role="attr-role"><role>child-role</role><name>n</name></c>',)], "x string")
    parsed = df.select(parse_xml_column("x", "_role string, role string, name string").alias("r")).select("r.*")
    row = clean_names(parsed.drop("_corrupt_record")).first()
    assert (row["role"], row["role_attr"], row["name"]) == ("child-role", "attr-role", "n")


def test_materialize_collection_counts_untyped_values(spark, tmp_path, fixture_paths):
    import shutil

    d = tmp_path / "objs"
    shutil.copytree(fixture_paths["xml_objects"], d)
    p = d / "rug.xml"
    p.write_text(p.read_text().replace('value="90.5"', 'value="abc"').replace("<birth_year>1850", "<birth_year>about 1850"))
    out = M.materialize_collection(spark, scratch_path(spark, "t-flow-typing"), xml_objects=str(d),
                                   xml_terms=fixture_paths["xml_terms"], mode="warn")
    assert out["untyped_values"] == {"dimensions": 1, "constituents": 1}
    ok = M.materialize_collection(spark, scratch_path(spark, "t-flow-typing-ok"), json_objects=fixture_paths["json_objects"],
                                  json_terms=fixture_paths["json_terms"], multiline=True, mode="warn")
    assert ok["untyped_values"] == {}


def test_materialize_collection_bulk_output(spark, fixture_paths):
    out = M.materialize_collection(spark, scratch_path(spark, "t-flow-bulk"), json_objects=fixture_paths["json_objects"],
                                   json_terms=fixture_paths["json_terms"], multiline=True, mode="warn", bulk_index="objects")
    lines = [r["value"] for r in spark.read.text(out["output"]).collect()]
    assert len(lines) == 14
    actions = [json.loads(x) for x in lines if x.startswith('{"index"')]
    assert sorted(a["index"]["_id"] for a in actions) == sorted(EXPECTED_CONSTITUENTS)


def test_command_line_collection(spark, fixture_paths, capsys):
    from nestgate.__main__ import main

    out_dir = scratch_path(spark, "t-cli-flow")
    rc = main(["collection", "--out", out_dir, "--xml-objects", fixture_paths["xml_objects"],
               "--xml-terms", fixture_paths["xml_terms"], "--mode", "quarantine"], spark=spark)
    assert rc == 0
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert res["passed"] is False and res["errors"] == FIRST_ERRORS
    assert spark.read.parquet(res["output"]).where("_status = 'clean'").count() == 2

"""Source edge cases: wrapper unwrapping (empty vs missing) and JSON string columns."""

from nestgate.sources.json import parse_json_column
from nestgate.sources.xml import parse_xml_column, unwrap_lists

XML_SCHEMA = "_id string, dims struct<dim: array<struct<_v: string>>>"


def test_unwrap_empty_missing_and_single(spark):
    docs = spark.createDataFrame([
        ('<o id="1"><dims><dim v="1"/><dim v="2"/></dims></o>',),
        ('<o id="2"><dims/></o>',),                 # empty wrapper -> []
        ('<o id="3"></o>',),                        # no wrapper -> null
        ('<o id="4"><dims><dim v="9"/></dims></o>',),   # one child is still a list
    ], "x string")
    parsed = docs.select(parse_xml_column("x", XML_SCHEMA).alias("r")).select("r.*").drop("_corrupt_record")
    out = {r["_id"]: r["dims"] for r in unwrap_lists(parsed, {"dims": "dim"}).collect()}
    assert [d["_v"] for d in out["1"]] == ["1", "2"]
    assert out["2"] == [] and out["3"] is None and [d["_v"] for d in out["4"]] == ["9"]


def test_json_column_parse(spark):
    df = spark.createDataFrame([('{"k": 3, "extra": true}',), ("not json",), (None,)], "s string")
    got = [r["k"] for r in df.select(parse_json_column("s", "k bigint")["k"].alias("k")).collect()]
    assert got == [3, None, None]

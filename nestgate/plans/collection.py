"""The collection-object model: harvested objects, terminology, enrichment, rules.

Fixed values that must equal the reference for identical results (schemas,
rule names, thresholds, the allowed role set, column renames) are gathered
here, in natural order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestgate.functions import rules as R
from nestgate.operators.lookup import Lookup, enrich_list
from nestgate.operators.nest import rename_if_present

# ---------------------------------------------------------------- fixed values
# Schemas (field order as in the source documents).
TERMINOLOGY = T.StructType([
    T.StructField("term_id", T.StringType()),
    T.StructField("term_type", T.StringType()),
    T.StructField("label", T.StringType()),
])
DIMENSION = T.StructType([T.StructField("type", T.StringType()), T.StructField("value", T.DoubleType()),
                          T.StructField("unit", T.StringType())])
MEDIA = T.StructType([T.StructField("type", T.StringType()), T.StructField("url", T.StringType()),
                      T.StructField("caption", T.StringType())])
CONSTITUENT_IDS = T.StructType([T.StructField("name", T.StringType()), T.StructField("role", T.StringType()),
                                T.StructField("birth_year", T.LongType()),
                                T.StructField("nationality_id", T.StringType())])
CLASSIFICATION_IDS = T.StructType([T.StructField("type_id", T.StringType()), T.StructField("term_id", T.StringType())])
OBJECT = T.StructType([
    T.StructField("object_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("date_made", T.LongType()),
    T.StructField("credit_line", T.StringType()),
    T.StructField("department", T.StringType()),
    T.StructField("constituents", T.ArrayType(CONSTITUENT_IDS)),
    T.StructField("classification_ids", T.ArrayType(CLASSIFICATION_IDS)),
    T.StructField("dimensions", T.ArrayType(DIMENSION)),
    T.StructField("media", T.ArrayType(MEDIA)),
])
CLASSIFICATION = T.StructType([T.StructField("type_label", T.StringType()),
                               T.StructField("term_label", T.StringType())])
CONSTITUENT = T.StructType([T.StructField("name", T.StringType()), T.StructField("role", T.StringType()),
                            T.StructField("birth_year", T.LongType()), T.StructField("nationality", T.StringType())])
ENRICHED = T.StructType([
    T.StructField("object_id", T.StringType(), False),
    T.StructField("title", T.StringType(), False),
    T.StructField("date_made", T.LongType(), True),
    T.StructField("credit_line", T.StringType(), False),
    T.StructField("department", T.StringType(), False),
    T.StructField("dimensions", T.ArrayType(DIMENSION), False),
    T.StructField("media", T.ArrayType(MEDIA), False),
    T.StructField("classifications", T.ArrayType(CLASSIFICATION), False),
    T.StructField("constituents", T.ArrayType(CONSTITUENT), False),
])
# Source-name normalisation (XML sources carry id / classifications).
SOURCE_RENAMES = {"id": "object_id", "classifications": "classification_ids"}
NATIONALITY_TERM_TYPE = "nationality"
# Allowed constituent roles of the set-membership rule (study frame).
VALID_ROLES = ["Artist", "Sculptor", "Painter", "Curator", "Designer"]


# ---------------------------------------------------------------- enrichment
def enrich_objects(terminology: DataFrame, objects: DataFrame, strategy: str = "auto") -> DataFrame:
    """The transform: resolve classification and constituent ids, pass the rest through.

    classifications: (type_id, term_id) -> (type_label, term_label), the same
    terminology used in two roles; constituents: nationality_id -> nationality
    via the terminology restricted to nationality terms.  dimensions and media
    are passed through untouched; null or empty lists become ``[]``."""
    objects = rename_if_present(objects, SOURCE_RENAMES)
    terms = terminology.select("term_id", "term_type", "label")
    nationality = terms.where(F.col("term_type") == NATIONALITY_TERM_TYPE)
    out = enrich_list(
        objects, "classification_ids",
        [Lookup("type_id", terms, "term_id", "label", "type_label"),
         Lookup("term_id", terms, "term_id", "label", "term_label")],
        ["type_label", "term_label"], out_col="classifications", key="object_id", strategy=strategy)
    out = enrich_list(
        out, "constituents",
        [Lookup("nationality_id", nationality, "term_id", "label", "nationality")],
        ["name", "role", "birth_year", "nationality"], key="object_id", strategy=strategy)
    return out.select("object_id", "title", "date_made", "credit_line", "department", "dimensions", "media",
                      "classifications", "constituents")


# ---------------------------------------------------------------- rules
def object_rules() -> list[R.Rule]:
    """Rules of the enriched-object schema, in declared column order."""
    return [
        R.unique("object_id_unique", "object_id"),
        R.string_length("title_min_length_1", "title", min_len=1),
        R.min_element("all_dimension_values_gt_1", "dimensions", "value", ">", 1),
        R.any_equal("has_height_dimension", "dimensions", "type", "height"),
        R.all_compare("all_units_are_cm", "dimensions", "unit", "==", "cm"),
        R.starts_with("all_urls_are_https", "media", "url", "https://"),
        R.count_equal("has_primary_image", "media", "type", "primary", "==", 1),
        R.list_size("has_at_least_one_image", "media", ">", 0),
        R.no_null_elements("no_null_labels_in_classifications", "classifications", "term_label"),
        R.list_size("has_at_least_one_constituent", "constituents", ">", 0),
        R.no_empty_strings("no_empty_constituent_names", "constituents", "name"),
        R.any_equal("has_at_least_one_artist", "constituents", "role", "artist"),
    ]


def cross_column_rules() -> list[R.Rule]:
    """The two documented cross-column rules (vacuously true on missing data)."""
    return [
        R.implies_rule("sculpture_must_have_depth", F.col("department") == "Sculpture",
                       R.any_equal("has_depth", "dimensions", "type", "depth")),
        R.elements_vs_parent("birth_years_before_date_made", "constituents", "birth_year", "<", "date_made"),
    ]


def nullability_rules(schema: T.StructType) -> list[R.Rule]:
    """``not_null`` rules for every non-nullable declared column (level ``type``)."""
    from nestgate.plans.validate import nullability_rules as rules_for

    return rules_for(schema)


# Wide benchmark object: extra columns and their rules.
EXHIBITION = T.StructType([T.StructField("title", T.StringType()), T.StructField("year", T.LongType()),
                           T.StructField("venue", T.StringType())])
PROVENANCE = T.StructType([T.StructField("owner", T.StringType()), T.StructField("acquired", T.LongType()),
                           T.StructField("method", T.StringType())])
BIBLIOGRAPHY = T.StructType([T.StructField("author", T.StringType()), T.StructField("title", T.StringType()),
                             T.StructField("year", T.LongType()), T.StructField("pages", T.StringType())])
INSCRIPTION = T.StructType([T.StructField("text", T.StringType()), T.StructField("location", T.StringType()),
                            T.StructField("type", T.StringType())])
CONSERVATION = T.StructType([T.StructField("date", T.StringType()), T.StructField("treatment", T.StringType()),
                             T.StructField("conservator", T.StringType())])
RELATED = T.StructType([T.StructField("object_id", T.StringType()), T.StructField("relationship", T.StringType())])
ALT_TITLE = T.StructType([T.StructField("language", T.StringType()), T.StructField("title", T.StringType())])
LOCATION = T.StructType([T.StructField("gallery", T.StringType()), T.StructField("floor", T.LongType()),
                         T.StructField("wing", T.StringType())])
WIDE = T.StructType([
    T.StructField("object_id", T.StringType(), False),
    T.StructField("title", T.StringType(), False),
    T.StructField("date_made", T.LongType(), True),
    T.StructField("credit_line", T.StringType(), False),
    T.StructField("department", T.StringType(), False),
    T.StructField("accession_number", T.StringType(), False),
    T.StructField("is_public_domain", T.BooleanType(), False),
    T.StructField("gallery_number", T.StringType(), False),
    T.StructField("dimensions", T.ArrayType(DIMENSION), False),
    T.StructField("media", T.ArrayType(MEDIA), False),
    T.StructField("classifications", T.ArrayType(CLASSIFICATION), False),
    T.StructField("constituents", T.ArrayType(CONSTITUENT), False),
    T.StructField("exhibitions", T.ArrayType(EXHIBITION), False),
    T.StructField("provenance", T.ArrayType(PROVENANCE), False),
    T.StructField("bibliography", T.ArrayType(BIBLIOGRAPHY), False),
    T.StructField("inscriptions", T.ArrayType(INSCRIPTION), False),
    T.StructField("conservation", T.ArrayType(CONSERVATION), False),
    T.StructField("related_objects", T.ArrayType(RELATED), False),
    T.StructField("alt_titles", T.ArrayType(ALT_TITLE), False),
    T.StructField("locations", T.ArrayType(LOCATION), False),
])


def wide_rules() -> list[R.Rule]:
    """Full benchmark rule set: id uniqueness, title length and 18 nested checks."""
    base = [r for r in object_rules()]
    for r in base:
        if r.name == "no_null_labels_in_classifications":
            base[base.index(r)] = R.no_null_elements("no_null_labels", "classifications", "term_label")
        if r.name == "no_empty_constituent_names":
            base[base.index(r)] = R.no_empty_strings("no_empty_names", "constituents", "name")
    return base + [
        R.all_compare("exhibition_year_after_1800", "exhibitions", "year", ">", 1800),
        R.list_size("has_provenance", "provenance", ">", 0),
        R.no_empty_strings("no_empty_owners", "provenance", "owner"),
        R.all_compare("bib_year_after_1400", "bibliography", "year", ">", 1400),
        R.no_empty_strings("no_empty_inscription_text", "inscriptions", "text"),
        R.no_empty_strings("no_empty_conservator", "conservation", "conservator"),
        R.element_string_length("language_code_is_2_chars", "alt_titles", "language", exact=2),
        R.all_compare("floor_non_negative", "locations", "floor", ">=", 0),
    ]


def unit_rules() -> list[R.Rule]:
    """Rules of the one-bad-row study frames (birth year, roles, names)."""
    return [
        R.all_compare("birth_year_positive", "constituents", "birth_year", ">", 0),
        R.elements_not_null("name_not_null", "constituents", "name"),
        R.all_in("valid_roles", "constituents", "role", VALID_ROLES),
    ]


# ---------------------------------------------------------------- harvest
# XML read schema: leaves as strings, attributes prefixed, one wrapper per list.
OBJECT_XML_READ = (
    "_id string, title string, date_made string, credit_line string, department string, "
    "constituents struct<constituent: array<struct<_role: string, name: string, birth_year: string, "
    "nationality_id: string>>>, "
    "classifications struct<classification: array<struct<_type_id: string, _term_id: string>>>, "
    "dimensions struct<dimension: array<struct<_type: string, _value: string, _unit: string>>>, "
    "media struct<image: array<struct<_type: string, url: string, caption: string>>>")
OBJECT_XML_WRAPPERS = {"constituents": "constituent", "classifications": "classification",
                       "dimensions": "dimension", "media": "image"}
TERM_XML_READ = "_id string, _type string, _VALUE string"
TERM_XML_RENAMES = {"id": "term_id", "type": "term_type", "text": "label"}


def object_xml_typed() -> T.StructType:
    """The harvested XML object: source names ``id`` and ``classifications`` kept."""
    fields = []
    for f in OBJECT.fields:
        name = {"object_id": "id", "classification_ids": "classifications"}.get(f.name, f.name)
        fields.append(T.StructField(name, f.dataType, True))
    return T.StructType(fields)


def harvest_objects_xml_text(spark, path: str) -> DataFrame:
    """Object XML documents unwrapped and renamed, every leaf still text."""
    from nestgate.sources.xml import clean_names, read_xml_records, unwrap_lists

    raw = read_xml_records(spark, path, "object", OBJECT_XML_READ, file_col=None)
    raw = raw.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    return clean_names(unwrap_lists(raw, OBJECT_XML_WRAPPERS))


def harvest_objects_xml(spark, path: str) -> DataFrame:
    """Object XML documents (one per file) -> typed nested rows.

    Malformed records are left out here; use
    :func:`nestgate.sources.xml.malformed_xml_files` as the load gate, and
    :func:`nestgate.functions.coerce.coercion_failures` on
    :func:`harvest_objects_xml_text` to count values that could not be typed."""
    from nestgate.functions.coerce import coerce_to_schema

    return coerce_to_schema(harvest_objects_xml_text(spark, path), object_xml_typed())


def harvest_terminology_xml(spark, path: str) -> DataFrame:
    """``<term id type>label</term>`` elements -> (term_id, term_type, label)."""
    from nestgate.sources.xml import clean_names, read_xml_records

    raw = read_xml_records(spark, path, "term", TERM_XML_READ, file_col=None).drop("_corrupt_record")
    return clean_names(raw, renames=TERM_XML_RENAMES)


def harvest_objects_json(spark, path: str, multiline: bool = False) -> DataFrame:
    """JSON lines (with ``multiline`` one object or array a file) with the declared nested schema.

    Leaves are read as text and typed by name with ``try_cast``: with a typed
    read schema one mistyped value would make the whole multi-line file
    corrupt; here only that value becomes null (and nullability rules see it)."""
    from nestgate.functions.coerce import coerce_to_schema, string_leaves
    from nestgate.sources.json import read_json_documents

    raw = read_json_documents(spark, path, string_leaves(OBJECT), multiline=multiline, corrupt_col=None)
    return coerce_to_schema(raw, OBJECT, strict=True)


def harvest_terminology_json(spark, path: str, multiline: bool = False) -> DataFrame:
    """Flat JSON lookup."""
    from nestgate.sources.json import read_json_documents

    return read_json_documents(spark, path, TERMINOLOGY, multiline=multiline, corrupt_col=None)


# ---------------------------------------------------------------- check run
def check_objects(enriched: DataFrame, rules: list[R.Rule] | None = None) -> tuple[bool, list[dict]]:
    """Every column visited; the first failing rule of each column reported.

    One counting pass for all rules; only the per-column result (bounded by
    the number of columns) reaches the driver."""
    from nestgate.plans.validate import first_failures, summary

    rules = rules if rules is not None else nullability_rules(ENRICHED) + object_rules()
    first = first_failures(summary(enriched, rules)).collect()
    order: dict[str, int] = {}
    for i, r in enumerate(rules):
        order.setdefault(r.column, i)
    errors = sorted(({"column": r["column_name"], "check": r["rule"]} for r in first),
                    key=lambda e: order.get(e["column"], 0))
    return (not errors), errors


# ---------------------------------------------------------------- end-to-end run
def materialize_collection(spark, out_dir: str, xml_objects: str | None = None, xml_terms: str | None = None,
                           json_objects: str | None = None, json_terms: str | None = None,
                           mode: str = "block", strategy: str = "auto", bulk_index: str | None = None,
                           multiline: bool = False) -> dict:
    """Harvest -> Parquet -> enrich -> Parquet (round-trip checked) -> check -> gate -> JSON lines.

    Either the XML pair or the JSON pair of inputs is given; JSON is read as lines,
    or with ``multiline`` as one object or array a file.  Nothing is loaded when a
    file is malformed; ``findings/malformed_files`` then lists all of them.  ``mode``:
    ``block`` raises :class:`~nestgate.plans.validate.ValidationError` before
    any output is written; ``warn`` writes everything; ``quarantine`` writes
    clean rows to the output and failing rows (with rule names) aside, in one
    pass.  ``bulk_index`` writes search-engine bulk pairs (action line, then
    document) instead of plain JSON lines.  Returns the paths written, the
    per-column first failures and the count of values that could not be typed."""
    from nestgate.functions.coerce import coerce_to_schema, string_leaves, with_coercion_counts
    from nestgate.plans import export as K
    from nestgate.plans import validate as V

    if xml_objects:
        from nestgate.sources.xml import assert_well_formed, malformed_xml_files

        # load gate: every malformed file is listed and nothing is loaded
        assert_well_formed(malformed_xml_files(spark, xml_objects, "object", OBJECT_XML_READ).unionByName(
            malformed_xml_files(spark, xml_terms, "term", TERM_XML_READ)), f"{out_dir}/findings/malformed_files")
        text, typed, strict = harvest_objects_xml_text(spark, xml_objects), object_xml_typed(), False
        terms = harvest_terminology_xml(spark, xml_terms)
    else:
        from nestgate.sources.json import assert_json_well_formed, malformed_json, read_json_documents

        assert_json_well_formed(malformed_json(spark, json_objects, multiline).unionByName(
            malformed_json(spark, json_terms, multiline)), f"{out_dir}/findings/malformed_files")
        text, typed, strict = read_json_documents(spark, json_objects, string_leaves(OBJECT), multiline=multiline,
                                                  corrupt_col=None), OBJECT, True
        terms = harvest_terminology_json(spark, json_terms, multiline)
    # values present in the source that could not be typed are counted while the typed rows are written
    untyped = Observation()
    out = {"harvest_objects": f"{out_dir}/harvest/objects", "harvest_terminology": f"{out_dir}/harvest/terminology",
           "transform": f"{out_dir}/transform/objects_enriched"}
    K.write_parquet(coerce_to_schema(with_coercion_counts(text, typed, untyped), typed, strict=strict), out["harvest_objects"])
    out["untyped_values"] = {c: n for c, n in untyped.get.items() if n}
    K.write_parquet(terms, out["harvest_terminology"])
    enriched = enrich_objects(spark.read.parquet(out["harvest_terminology"]),
                              spark.read.parquet(out["harvest_objects"]), strategy=strategy)
    rt = K.roundtrip_report(spark, enriched, out["transform"]).first()
    if not (rt["schema_equal"] and rt["content_equal"]):
        raise AssertionError(f"Parquet round trip changed the data: {rt.asDict()}")
    transformed = spark.read.parquet(out["transform"])
    rules = nullability_rules(ENRICHED) + object_rules()
    passed, errors = check_objects(transformed, rules)
    out["passed"], out["errors"] = passed, errors
    if not passed:
        # which rows and which nested elements fail: written as tables, not collected
        out["failing_rows"] = K.write_parquet(V.failing_rows(transformed, rules, "object_id"),
                                              f"{out_dir}/findings/failing_rows")
        out["failing_elements"] = K.write_parquet(V.failing_elements(transformed, rules, "object_id"),
                                                  f"{out_dir}/findings/failing_elements")
    if not passed and mode == "block":
        raise V.ValidationError([{"column_name": e["column"], "rule": e["check"], "failed": None} for e in errors])
    if mode == "quarantine":
        tagged = V.with_findings(transformed, rules).withColumn(
            "_status", F.when(F.size("_failed_rules") == 0, "clean").otherwise("quarantined"))
        out["output"] = K.write_split(tagged, f"{out_dir}/output/objects")
    elif bulk_index:
        # search-engine bulk format: an action line, then the document, per object
        path = f"{out_dir}/output/objects_bulk"
        K.bulk_index_lines(transformed, "object_id", bulk_index).write.mode("overwrite").text(path)
        out["output"] = path
    else:
        out["output"] = K.write_json_lines(transformed, f"{out_dir}/output/objects")
    return out

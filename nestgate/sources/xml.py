"""XML harvest (S1-S5) on Spark's built-in XML source and ``from_xml``.

Harvest reads leaves as **strings** and types them afterwards with
``try_cast`` by name: with a typed read schema one bad number marks the whole
document corrupt and nulls every later field, so ``_corrupt_record`` would
mix "malformed" with "mistyped".  Steps:

1. :func:`read_xml_records` / :func:`parse_xml_column` -- one row per record
   element, nested children kept, PERMISSIVE with a corrupt-record column;
2. :func:`unwrap_lists` -- ``<dims><dim/>...</dims>`` becomes a list, an
   empty wrapper an empty list, a missing wrapper stays null;
3. :func:`clean_names` -- attribute prefix stripped, the text value renamed;
4. :func:`nestgate.functions.coerce.coerce_to_schema` -- declared types.

Many small files (one record per file) are packed into tasks by
``spark.sql.files.maxPartitionBytes`` / ``openCostInBytes``.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
ATTRIBUTE_PREFIX = "_"
VALUE_TAG = "_VALUE"


def _with_corrupt(schema: T.StructType | str, corrupt_col: str) -> T.StructType:
    st = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if corrupt_col not in st.fieldNames():
        st = T.StructType(st.fields + [T.StructField(corrupt_col, T.StringType())])
    return st


def read_xml_records(spark: SparkSession, path: str | list[str], row_tag: str, schema: T.StructType | str,
                     corrupt_col: str = CORRUPT, file_col: str | None = "_source_file",
                     options: Mapping[str, str] | None = None) -> DataFrame:
    """One row per ``row_tag`` element of the files under ``path``.

    Declared schema (no inference: inference sorts fields alphabetically),
    PERMISSIVE mode; malformed records keep their text in ``corrupt_col``."""
    st = _with_corrupt(schema, corrupt_col)
    reader = (spark.read.format("xml").option("rowTag", row_tag).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", corrupt_col).options(**(options or {})).schema(st))
    df = reader.load(path)
    if file_col:
        df = df.withColumn(file_col, F.col("_metadata.file_path"))
    return df


def parse_xml_column(c: Column | str, schema: T.StructType | str, corrupt_col: str = CORRUPT) -> Column:
    """S1 for documents held in a string column: a struct per row (PERMISSIVE)."""
    st = _with_corrupt(schema, corrupt_col)
    return F.from_xml(F.col(c) if isinstance(c, str) else c, st,
                      {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_col})


def unwrap_lists(df: DataFrame, wrappers: Mapping[str, str]) -> DataFrame:
    """S3: replace wrapper structs by their repeated child list.

    ``{column: child}``; an empty wrapper (``<dims/>``) gives ``[]``, a missing
    wrapper element stays null (the two are kept distinct)."""
    out = {}
    for col, child in wrappers.items():
        list_t = df.schema[col].dataType[child].dataType
        out[col] = F.when(F.col(col).isNull(), F.lit(None).cast(list_t)).otherwise(
            F.coalesce(F.col(f"{col}.{child}"), F.array().cast(list_t)))
    return df.withColumns(out)


def xml_name(name: str, text_name: str = "text", prefix: str = ATTRIBUTE_PREFIX, value_tag: str = VALUE_TAG) -> str:
    if name == value_tag:
        return text_name
    if name.startswith(prefix) and name != CORRUPT:
        return name[len(prefix):]
    return name


def _is_attribute(name: str) -> bool:
    return name.startswith(ATTRIBUTE_PREFIX) and name not in (CORRUPT, VALUE_TAG)


def _clean_level(names: list[str], rn) -> dict[str, str]:
    """New names for one struct level; an attribute whose name a child element
    already uses keeps an ``_attr`` suffix instead of colliding with it."""
    children = {rn(n) for n in names if not _is_attribute(n)}
    return {n: (rn(n) + "_attr" if _is_attribute(n) and rn(n) in children else rn(n)) for n in names}


def _clean(c: Column, dt: T.DataType, rn) -> tuple[Column, T.DataType]:
    if isinstance(dt, T.StructType):
        new = _clean_level([f.name for f in dt.fields], rn)
        parts, fields = [], []
        for f in dt.fields:
            sub, st = _clean(c[f.name], f.dataType, rn)
            parts.append(sub.alias(new[f.name]))
            fields.append(T.StructField(new[f.name], st, True))
        t = T.StructType(fields)
        return F.when(c.isNull(), F.lit(None).cast(t)).otherwise(F.struct(*parts)), t
    if isinstance(dt, T.ArrayType):
        _, et = _clean(F.lit(None).cast(dt.elementType), dt.elementType, rn)
        return F.transform(c, lambda x: _clean(x, dt.elementType, rn)[0]), T.ArrayType(et, True)
    return c, dt


def clean_names(df: DataFrame, text_name: str = "text", renames: Mapping[str, str] | None = None) -> DataFrame:
    """Strip the attribute prefix and rename the text value, at every depth.

    ``renames`` maps cleaned names to final ones.  Where an attribute and a
    child element share a name, the attribute becomes ``<name>_attr``."""
    renames = dict(renames or {})

    def rn(n: str) -> str:
        n2 = xml_name(n, text_name)
        return renames.get(n2, n2)

    top = _clean_level([f.name for f in df.schema.fields], rn)
    cols = []
    for f in df.schema.fields:
        expr, _ = _clean(F.col(f"`{f.name}`"), f.dataType, rn)
        cols.append(expr.alias(top[f.name]))
    return df.select(*cols)


def _ends_its_root(text: Column) -> Column:
    """Whether a document's text closes the element it opens first (or that element is empty)."""
    body = F.trim(F.regexp_replace(F.regexp_replace(text, r"(?s)<!--.*?-->|<\?.*?\?>|<!DOCTYPE[^>\[]*(\[.*?\])?\s*>", ""),
                                   "[\\s\ufeff]+", " "))
    root = F.regexp_extract(body, r"^<([^\s/>]+)", 1)
    end = F.concat(F.lit("</"), root, F.lit(">"))
    closed = F.regexp_replace(body, r"\s+>$", ">").endswith(end)
    return (root != "") & (closed | body.rlike(r"^<[^>]*/>$"))


def malformed_xml_files(spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str,
                        glob: str = "*.xml") -> DataFrame:
    """Every malformed file under ``path``: ``(file_path, reason, n_parsed)``.

    ``corrupt`` -- the reader flagged a record of the file as malformed;
    ``empty`` -- the file has no bytes;
    ``unclosed`` -- the file does not end with the end tag of its root element
    (cut off, or followed by other content);
    ``no_record`` -- the file yielded no ``row_tag`` record (e.g. a wrong root).
    One reason a file, the first that applies.  ``n_parsed`` counts the file's
    records whose first declared field parsed.  Distributed: one aggregation per
    file over the parse, joined to the listing of the files; both name files by
    ``_metadata.file_path``, so encoded names agree."""
    st = _with_corrupt(schema, CORRUPT)
    first = st.fields[0].name
    recs = read_xml_records(spark, path, row_tag, st, options={"pathGlobFilter": glob})
    per_file = recs.groupBy(F.col("_source_file").alias("file_path")).agg(
        F.count_if(F.col(CORRUPT).isNotNull()).alias("n_corrupt"),
        F.count(F.col(f"`{first}`")).alias("n_parsed"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    listing = files.select(F.col("_metadata.file_path").alias("file_path"),
                           _ends_its_root(F.col("content").cast("string")).alias("whole"))
    # file scans leave out files without bytes; the driver's own listing has them
    # (with more slashes after ``file:`` than the scans have)
    named = spark.createDataFrame([(re.sub("^file:/+", "file:/", f),) for f in files.inputFiles()], "name string")
    reason = (F.when(F.col("whole").isNull(), "empty").when(F.col("n_corrupt") > 0, "corrupt")
              .when(~F.col("whole"), "unclosed").when(F.col("n_corrupt").isNull(), "no_record"))
    name = F.regexp_replace("file_path", "^file:/+", "file:/")
    return (named.join(listing.withColumn("name", name).drop("file_path"), "name", "left")
            .join(per_file.withColumn("name", name).drop("file_path"), "name", "left")
            .withColumnRenamed("name", "file_path")
            .withColumn("reason", reason).where(F.col("reason").isNotNull())
            .select("file_path", "reason", F.coalesce("n_parsed", F.lit(0)).cast("bigint").alias("n_parsed")))


def assert_well_formed(report: DataFrame, out: str) -> None:
    """Load gate: the whole report is written as a table under ``out``; if it has rows, raise with
    their number and the table's path."""
    report.write.mode("overwrite").parquet(out)
    n = report.sparkSession.read.schema(report.schema).parquet(out).count()
    if n:
        raise ValueError(f"Malformed XML: {n} file(s), listed in {out}")


def to_xml_document(df: DataFrame, row_tag: str, indent: str | None = None) -> Column:
    """The whole row as one XML document (``_x`` fields become attributes), indented as Spark does or by ``indent``."""
    options = {"rowTag": row_tag} | ({} if indent is None else {"indent": indent})
    return F.to_xml(F.struct(*[F.col(f"`{c}`") for c in df.columns]), options)


def to_xml_documents(df: DataFrame, row_tag: str, out_col: str = "xml") -> DataFrame:
    """One XML document string per row."""
    return df.select(to_xml_document(df, row_tag).alias(out_col))

"""JSON harvest (S6/S7): nested documents and flat lookups with declared schemas.

JSON lines are split at line ends.  Files that hold one value over many lines
(``multiline=True``) are split too: :mod:`nestgate.sources.json_scan` cuts them into the
elements of their array, so one large file is read by many tasks.  Leaves may be read as
strings and typed afterwards (see :mod:`nestgate.functions.coerce`): one mistyped value
then nulls only itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestgate.sources.json_scan import is_one_object, json_elements, json_problems

CORRUPT = "_corrupt_record"


def read_json_documents(spark: SparkSession, path: str | list[str], schema: T.StructType | str,
                        multiline: bool = False, corrupt_col: str | None = CORRUPT, packed: bool = False) -> DataFrame:
    """Nested JSON documents (lines, or one object or array a file with ``multiline``, also ``packed``).

    With ``corrupt_col``, text that is no record of the schema is kept there; with ``multiline`` also text
    outside the file's value and an element whose end is missing.  Every element is read, also of files with
    several values; :func:`malformed_json` reports such files.  Row order is not the order in the file."""
    st = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if corrupt_col and corrupt_col not in st.fieldNames():
        st = T.StructType(st.fields + [T.StructField(corrupt_col, T.StringType())])
    options = {"mode": "PERMISSIVE"} | ({"columnNameOfCorruptRecord": corrupt_col} if corrupt_col else {})
    if not multiline:
        return spark.read.options(**options).schema(st).json(path)
    texts = json_elements(spark, path, with_problems=bool(corrupt_col), packed=packed)
    # out of a generator: Catalyst puts no filter below it that would parse every text again
    return texts.select(F.inline_outer(F.array(F.from_json("text", st, options))))


def parse_json_column(c: Column | str, schema: T.StructType | str) -> Column:
    """S6 for a string column: a struct per row; unparsable text gives null."""
    return F.from_json(F.col(c) if isinstance(c, str) else c, schema, {"mode": "PERMISSIVE"})


def malformed_json(spark: SparkSession, path: str | list[str], multiline: bool = False) -> DataFrame:
    """``(file_path, n_bad)`` of files that are not what the reader expects.

    JSON lines: lines that are not one JSON object alone.  ``multiline``: problems of files that are not one
    JSON object or one array of objects (:func:`~nestgate.sources.json_scan.json_problems` names them)."""
    if multiline:
        return json_problems(spark, path).groupBy("file_path").agg(F.sum("n").alias("n_bad"))
    text = spark.read.text(path).select(F.col("_metadata.file_path").alias("file_path"), "value")
    bad = (F.trim(F.col("value"), F.lit(" \t\r")) != "") & ~is_one_object(F.col("value"))
    return text.where(bad).groupBy("file_path").agg(F.count(F.lit(1)).alias("n_bad"))


def assert_json_well_formed(report: DataFrame, out: str) -> None:
    """Load gate: the report as a table under ``out``; raise with the number of files if it has any."""
    report.write.mode("overwrite").parquet(out)
    n = report.sparkSession.read.schema(report.schema).parquet(out).count()
    if n:
        raise ValueError(f"Malformed JSON: {n} file(s), listed in {out}")

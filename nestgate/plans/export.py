"""Sinks and inspection (K1-K4): nested Parquet, JSON documents, round-trip checks.

Output is always distributed (one file per task); nothing is gathered into a
single document on the driver.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain, groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestgate.sources.packed_text import FRAME, OPTIONS, pack, unpack

JSON_OPTIONS = {"ignoreNullFields": "false"}


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> str:
    """K1: nested Parquet, lists and structs kept native."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def to_json_document(df: DataFrame) -> Column:
    """K3: the whole row as one JSON document; nulls and empty lists written explicitly."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), JSON_OPTIONS)


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """K3: JSON lines, one document per line, null fields kept."""
    df.write.mode(mode).options(**JSON_OPTIONS).json(path)
    return path


def array_lines(df: DataFrame, by: str, order: list[str]) -> DataFrame:
    """``(by, part, at, value)``: the lines of one JSON array for each value of ``by``, a document a line.

    ``at`` (the order columns) orders the documents.  Every document follows a comma;
    :func:`write_lines_by` leaves out the one before a file's first."""
    at = F.struct(*[F.col(c) for c in order])
    lines = df.select(F.col(by), F.lit(1).alias("part"), at.alias("at"),
                      F.concat(F.lit(","), to_json_document(df.drop(by))).alias("value"))
    ends = df.select(by).distinct().select(by, F.explode(F.array(
        F.struct(F.lit(0).alias("part"), F.lit("[").alias("value")),
        F.struct(F.lit(2).alias("part"), F.lit("]").alias("value")))).alias("e"))
    return lines.unionByName(ends.select(by, "e.part", F.lit(None).cast(lines.schema["at"].dataType).alias("at"), "e.value"))


CHUNK = 1 << 16                 # characters of neighbouring lines that move as one value
RUN = 1 << 25                   # characters of lines that a task sorts at once


def _sortable(v: object) -> tuple:
    """What Python orders as Spark orders ``v``: null first, NaN last, structs and lists by their elements."""
    if isinstance(v, dict | list):
        return (True, *map(_sortable, v.values() if isinstance(v, dict) else v))
    return (True, v != v, 0.0 if v != v else v) if isinstance(v, float) else (v is not None, v)


def _keys(at: pa.StructArray) -> list[tuple]:
    """The order columns of each row as one key."""
    columns = []
    for c in at.flatten():
        if pa.types.is_temporal(c.type):                     # also years that Python has no dates for
            c = c.view(pa.int32() if c.type.bit_width == 32 else pa.int64())
        plain = not (pa.types.is_floating(c.type) or pa.types.is_nested(c.type))
        columns.append([(v is not None, v) for v in c.to_pylist()] if plain else [*map(_sortable, c.to_pylist())])
    return list(zip(*columns)) if columns else [()] * len(at)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted runs of lines, by file and part in chunks of packed keys and texts, each with its first ``at``."""
    task, held, size = TaskContext.get().partitionId(), {}, 0

    def run() -> Iterator[pa.RecordBatch]:
        for by, part, lines in held.values():
            lines.sort(key=lambda x: x[0])
            start = n = 0
            for i, (_, text, *_) in enumerate(lines):
                n += len(text)
                if n > CHUNK or i + 1 == len(lines):
                    keys, texts, (at, *_), (row, *_) = zip(*lines[start:i + 1])
                    start, n = i + 1, 0
                    yield pa.RecordBatch.from_arrays(
                        [by, pa.array([part], pa.int32()), at.slice(row, 1), pa.array([task], pa.int64()),
                         pa.array([pack(pickle.dumps((keys, texts)))], pa.binary())], ["by", "part", "at", "task", "value"])
        held.clear()

    for b in batches:
        bys, at = b.column("by"), b.column("at")
        for i, (by, part, key, text) in enumerate(zip(bys.to_pylist(), b.column("part").to_pylist(), _keys(at),
                                                      b.column("value").to_pylist())):
            which = repr(by), part
            if which not in held:
                held[which] = (bys.slice(i, 1), part, [])
            held[which][2].append((key, text, at, i))
            size += len(text)
        if size > RUN:
            yield from run()
            size = 0
    yield from run()


def line_chunks(lines: DataFrame, by: str) -> DataFrame:
    """``(by, part, at, task, value)``: the lines of every task in sorted runs, cut into chunks of packed text.

    ``at`` is that of a chunk's first line; the runs of a file overlap."""
    schema = (T.StructType([T.StructField("by", lines.schema[by].dataType)]).add("part", T.IntegerType())
              .add("at", lines.schema["at"].dataType).add("task", T.LongType()).add("value", T.BinaryType()))
    return lines.select(F.col(by).alias("by"), "part", "at", "value").mapInArrow(_chunks, schema)


def _merged(chunks: Iterator[pa.Buffer]) -> Iterator[str]:
    """The lines of chunks that come by their first line, in order; one chunk of a run is open at a time."""
    heap: list[tuple] = []
    for n, chunk in enumerate(chunks):
        keys, texts = pickle.loads(unpack(chunk))
        while heap and heap[0][0] <= keys[0]:
            yield _next(heap)
        heapq.heappush(heap, (keys[0], n, 0, keys, texts))
    while heap:
        yield _next(heap)


def _next(heap: list[tuple]) -> str:
    _, n, i, keys, texts = heap[0]
    if i + 1 < len(keys):
        heapq.heapreplace(heap, (keys[i + 1], n, i + 1, keys, texts))
    else:
        heapq.heappop(heap)
    return texts[i]


def _in_order(batches: Iterator[pa.RecordBatch], packed: bool) -> Iterator[pa.RecordBatch]:
    """The text of whole files, many lines a row; the comma before a file's first document is left out."""
    def chunks() -> Iterator[tuple]:
        for b in batches:
            bys, values = b.column("by"), b.column("value")
            for i, (by, part) in enumerate(zip(bys.to_pylist(), b.column("part").to_pylist())):
                yield (repr(by), part), bys.slice(i, 1), values[i].as_buffer()

    def row() -> pa.RecordBatch:
        text = "\n".join(held)
        held.clear()
        return pa.RecordBatch.from_arrays(
            [by, pa.array([pack(f"{text}\n".encode())], pa.binary()) if packed else pa.array([text])], ["by", "value"])

    file, by, held, size = None, None, [], 0
    for (name, part), rows in groupby(chunks(), lambda r: r[0]):
        first = next(rows)
        if held and name != file:
            yield row()
            size = 0
        file, by = name, first[1]
        for n, text in enumerate(_merged(r[2] for r in chain([first], rows))):
            held.append(text.removeprefix(",") if part == 1 and n == 0 else text)
            size += len(text)
            if size > FRAME:
                yield row()
                size = 0
    if held:
        yield row()


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def write_lines_by(lines: DataFrame, path: str, by: str, packed: bool = False) -> str:
    """One text file for each value of ``by``, its lines in the order of ``(part, at)``.

    Every task sorts its lines in runs of bounded size and packs them in chunks.  A file has one writer, which
    merges the runs: its memory grows with their number (a chunk each), not with the file.  The lines move once, packed;
    what was shuffled for them is deleted when they are written.  ``packed``: files as in
    :mod:`nestgate.sources.packed_text`."""
    spark, kind = lines.sparkSession, lines.schema[by].dataType
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType([T.StructField("by", kind), T.StructField("value", T.BinaryType() if packed else T.StringType())])
    out = (line_chunks(lines, by).repartition(files, "by").sortWithinPartitions("by", "part", "at", "task")
           .mapInArrow(lambda batches: _in_order(batches, packed), schema)
           .select(F.col("by").alias(by), F.col("value").cast("string").alias("value")))
    # lines arrive in file order; with a limit set, the writer keeps files open instead of sorting all rows again
    with _settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": "4096",
                           "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        out.write.mode("overwrite").options(**(OPTIONS if packed else {})).partitionBy(by).format("text").save(path)
    return path


def write_json_arrays(df: DataFrame, path: str, by: str, order: list[str], packed: bool = False) -> str:
    """K3: one JSON array file for each value of ``by``, the documents in ``order``."""
    return write_lines_by(array_lines(df, by, order), path, by, packed)


def bulk_index_lines(df: DataFrame, id_col: str, index: str) -> DataFrame:
    """K3 option: search-engine bulk format, an action line followed by the document."""
    action = F.to_json(F.struct(F.struct(F.lit(index).alias("_index"), F.col(id_col).cast("string").alias("_id"))
                                .alias("index")))
    return df.select(F.concat_ws("\n", action, to_json_document(df)).alias("value"))


def write_split(tagged: DataFrame, path: str, status_col: str = "_status", mode: str = "overwrite") -> str:
    """Write clean and quarantined rows in **one** pass, partitioned by status."""
    tagged.write.mode(mode).partitionBy(status_col).parquet(path)
    return path


def document_by_id(df: DataFrame, id_col: str, value: object | Column) -> DataFrame:
    """K4: the JSON document(s) of one key (filter pushed to the scan)."""
    return df.where(F.col(id_col) == value).select(F.col(id_col), to_json_document(df).alias("document"))


def documents_by_ids(df: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """K4 for a set of keys given as a table (one column ``id_col``): a semi-join,
    so the documents are never duplicated and no key list passes the driver."""
    sel = df.join(ids.select(id_col).distinct(), on=id_col, how="left_semi")
    return sel.select(F.col(id_col), to_json_document(df).alias("document"))


def schema_string(df: DataFrame) -> str:
    """Type listing that ignores nullability (Parquet re-reads turn it to nullable)."""
    return df.schema.simpleString()


def _fingerprint_columns(df: DataFrame) -> list[Column]:
    cols = [F.col(f"`{c}`") for c in df.columns]
    return [F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(F.xxhash64(*cols).cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").alias("h1"),
            F.coalesce(F.sum(F.hash(*cols).cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").alias("h2")]


def fingerprint(df: DataFrame) -> DataFrame:
    """Order-insensitive content fingerprint ``(rows, h1, h2)`` in one pass, no shuffle.

    Sums of two independent 64-bit row hashes (as decimals, no overflow)."""
    return df.agg(*_fingerprint_columns(df))


def write_observed(df: DataFrame, path: str, *metrics: Column) -> dict:
    """K1, and the given aggregates of the written rows: taken while they are written, in the same pass."""
    seen = Observation()
    write_parquet(df.observe(seen, *metrics), path)
    return seen.get


def roundtrip_report(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """K1+K2: write, re-read, compare schema text and content fingerprint.

    ``(rows_written, rows_read, schema_equal, content_equal)``.  ``df`` is evaluated once: its
    fingerprint is taken from the rows on their way to the files."""
    seen = write_observed(df, path, *_fingerprint_columns(df))
    back = spark.read.parquet(path)
    return fingerprint(back).select(
        F.lit(seen["rows"]).cast("bigint").alias("rows_written"),
        F.col("rows").alias("rows_read"),
        F.lit(schema_string(df) == schema_string(back)).alias("schema_equal"),
        ((F.col("rows") == seen["rows"]) & (F.col("h1") == F.lit(seen["h1"])) & (F.col("h2") == F.lit(seen["h2"])))
        .alias("content_equal"),
    )

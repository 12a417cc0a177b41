"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestgate.session import checkpoint_root

# characters that separate words in the word pattern [^\x20\x09-\x0D]+
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """Lineage cut: the rows in the shared checkpoint folder, computed once."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows``, so that few of their texts are Python objects at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that the input does not have (compared as Spark does, without case)."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem = "_" + stem
    return stem


def behind_names(docs: DataFrame, own: list[str], step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``step(docs)`` with every column but ``own`` under a neutral name, so that no name of the operator's
    can meet one of the input's; ``step`` returns the columns it was given, in their order."""
    hidden = docs.toDF(*[c if c in own else f"_input{i}" for i, c in enumerate(docs.columns)])
    return step(hidden).toDF(*docs.columns)


def row_numbers(df: DataFrame, keys: list, name: str, partitions: int | None = None) -> tuple[DataFrame, int]:
    """``df`` with a gapless row number from 0 in the order of ``keys``, and the row count.

    One range shuffle.  The sorted rows are saved with their place inside the
    partition; the counts per partition (one row each) give the offsets.  Equal
    keys are interchangeable rows: a salt lets the range split them.
    """
    spark = df.sparkSession
    salt, at = free_name(df, "_salt"), free_name(df, "_at")
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = df.withColumn(salt, F.monotonically_increasing_id())
    order = [*keys, F.col(salt)]
    placed = saved(salted.repartitionByRange(n, *order).sortWithinPartitions(*order).drop(salt)
                   .withColumn(at, F.monotonically_increasing_id()))
    part = F.shiftright(F.col(at), 33).cast("int")
    counts = {r[0]: r[1] for r in placed.groupBy(part.alias("p")).count().collect()}   # a row for each partition
    starts, total = [], 0
    for p in sorted(counts):
        starts.append((p, total))
        total += counts[p]
    if not total:
        return placed.withColumn(name, F.lit(0).cast("long")).drop(at), 0
    p_col, start = free_name(df, "_part"), free_name(df, "_start")
    offsets = spark.createDataFrame(starts, f"`{p_col}` int, `{start}` long")
    numbered = (placed.withColumn(p_col, part).join(F.broadcast(offsets), p_col)
                .withColumn(name, F.col(start) + F.col(at).bitwiseAND(F.lit((1 << 33) - 1))))
    return numbered.drop(at, p_col, start), total


def each_group(df: DataFrame, keys: list[str], step: Callable, schema: str) -> DataFrame:
    """``step(columns) -> columns`` for each group of ``keys``, one group in memory at a time.

    ``columns`` is a dict of Python lists.  The rows of a group are dealt to one task and sorted
    together, so small groups cost no data frame each; the caller bounds the size of a group.
    """
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = None, None
        out: dict[str, list] = {}

        def flush(force: bool):
            if out and (force or len(next(iter(out.values()))) >= 4096):
                done = pa.RecordBatch.from_pydict(out)
                out.clear()
                return done
            return None

        def close():
            for k, v in step(held).items():
                out.setdefault(k, []).extend(v)

        for b in batches:
            cols = {n: b.column(i).to_pylist() for i, n in enumerate(names)}
            marks = list(zip(*(cols[k] for k in keys)))
            start = 0
            for i in range(len(marks) + 1):
                if i < len(marks) and marks[i] == now:
                    continue
                if held is not None:
                    for n in names:
                        held[n].extend(cols[n][start:i])
                if i < len(marks):
                    if held is not None:
                        close()
                        if (done := flush(False)) is not None:
                            yield done
                    held, now, start = {n: [] for n in names}, marks[i], i
        if held is not None:
            close()
        if (done := flush(True)) is not None:
            yield done

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartition(n, *keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, schema)

"""Set operations (U1/U2): batch concatenation and content parity of two sources.

Parity reads both sources once and keeps two 64-bit hashes and the key of every row, taken without regard
to the order of lists.  Hashes fall into buckets, and each bucket holds sums over its rows, counted up for
one source and down for the other, so equal content cancels.  Only rows of buckets whose sums differ are
counted by their hashes; documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def union_batches(batches: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name (schemas must agree)."""
    out = batches[0]
    for b in batches[1:]:
        out = out.unionByName(b)
    return out


def canonical(c: Column, dt: T.DataType) -> Column:
    """Order-insensitive form of a nested value: every list sorted, recursively."""
    if isinstance(dt, T.ArrayType):
        inner = F.transform(c, lambda x: canonical(x, dt.elementType)) \
            if isinstance(dt.elementType, (T.ArrayType, T.StructType, T.FloatType, T.DoubleType)) else c
        return F.array_sort(inner)
    if isinstance(dt, T.StructType):
        return F.when(c.isNull(), F.lit(None)).otherwise(
            F.struct(*[canonical(c[f.name], f.dataType).alias(f.name) for f in dt.fields]))
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return (c + F.lit(0.0)).cast(dt)                           # -0.0 equals 0.0
    return c


def canonicalize(df: DataFrame) -> DataFrame:
    return df.select(*[canonical(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


BUCKET_BITS = 14                # at most 2^14 buckets are broadcast
# leaves whose hashes by value tell the same values apart as their JSON texts
HASHED = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType,
          T.StringType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType)


def hashed_by_value(dt: T.DataType) -> bool:
    if isinstance(dt, T.StructType):
        return all(hashed_by_value(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return hashed_by_value(dt.elementType)
    return isinstance(dt, HASHED) and (not isinstance(dt, T.StringType) or dt == T.StringType())


def _holds_list(dt: T.DataType) -> bool:
    return isinstance(dt, T.ArrayType) or isinstance(dt, T.StructType) and any(_holds_list(f.dataType) for f in dt.fields)


def _ordered(c: Column, dt: T.DataType) -> Column:
    """:func:`canonical` for hashes by value, which take -0.0 for 0.0: only lists that hold lists are rebuilt."""
    if not _holds_list(dt):
        return c
    if isinstance(dt, T.ArrayType):
        return F.sort_array(F.transform(c, lambda x: _ordered(x, dt.elementType)) if _holds_list(dt.elementType) else c)
    return F.when(c.isNull(), F.lit(None)).otherwise(
        F.struct(*[_ordered(c[f.name], f.dataType).alias(f.name) for f in dt.fields]))


def _any_null(c: Column, dt: T.DataType) -> Column:
    out = c.isNull()
    for f in dt.fields if isinstance(dt, T.StructType) else ():
        out = out | _any_null(c[f.name], f.dataType)
    return out


def _shape(c: Column, dt: T.DataType) -> Column:
    """The places of nulls, and the sizes of lists, as a text."""
    inside = F.lit("v")
    if isinstance(dt, T.StructType):
        inside = F.concat(F.lit("("), *[_shape(c[f.name], f.dataType) for f in dt.fields], F.lit(")"))
    if isinstance(dt, T.ArrayType):
        inside = F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: _shape(x, dt.elementType)), ""), F.lit("]"))
    return F.when(c.isNull(), "n").otherwise(inside)


def _told(c: Column, dt: T.DataType) -> list[Column]:
    """What a hash takes of a value.  Hashes pass over nulls and run on from one value to the next; so the shape of
    a list comes first, which is its size where nothing in it is null."""
    if isinstance(dt, T.StructType):
        return [c.isNull(), *(x for f in dt.fields for x in _told(c[f.name], f.dataType))]
    if not isinstance(dt, T.ArrayType):
        return [c.isNull(), c]
    ordered = _ordered(c, dt)
    if _holds_list(dt.elementType):
        return [_shape(ordered, dt), ordered]
    null_inside = F.exists(c, lambda x: _any_null(x, dt.elementType))
    return [c.isNull(), F.size(c), null_inside, F.when(null_inside, _shape(ordered, dt)), ordered]


def row_hashes(df: DataFrame, key: Sequence[str] = (), side: str | None = None, by_value: bool = True) -> DataFrame:
    """``(*key, side, h1, h2)``: two 64-bit hashes of every row up to the order of its lists; ``side`` is not hashed.

    Rows with types that have no hash (and all rows without ``by_value``) are hashed by their JSON texts, in which
    nulls are written."""
    fields = sorted((f for f in df.schema.fields if f.name != side), key=lambda f: f.name)
    kept = [canonical(F.col(f"`{k}`"), df.schema[k].dataType).alias(k) for k in (*key, *([side] if side else []))]
    held = [F.struct(*kept).alias("_kept")] if kept else []
    if by_value and all(hashed_by_value(f.dataType) for f in fields):
        told = [x for f in fields for x in _told(F.col(f"`{f.name}`"), f.dataType)]
        rows = df.select(*held, *[x.alias(f"_{i}") for i, x in enumerate(told)])
    else:
        text = F.to_json(F.struct(*[canonical(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in fields]),
                         {"ignoreNullFields": "false"})
        rows = df.select(*held, text.alias("_0"))
    taken = [c for c in rows.columns if c != "_kept"]
    return rows.select(*(["_kept.*"] if kept else []), *[F.xxhash64(F.lit(seed), *taken).alias(f"h{seed}") for seed in (1, 2)])


def _sums() -> list[Column]:
    """Exact sums of a bucket; halves of the hashes, so that they stay in range."""
    def halves(h: str) -> list[Column]:
        return [F.col(h).bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32)]

    parts = halves("h1") + halves("h2")
    return [F.sum("side").alias("s")] + [F.sum(F.col("side") * x).alias(f"s{i}") for i, x in enumerate(parts)]


def _unequal() -> Column:
    out = F.col("s") != 0
    for i in range(4):
        out = out | (F.col(f"s{i}") != 0)
    return out


def _hashes(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    """``(*key, side, h1, h2)`` of two sources; hashes by value need equal types."""
    b = b.select(*[F.col(f"`{c}`") for c in a.columns])
    alike = a.schema.simpleString() == b.schema.simpleString()
    return row_hashes(a, key, by_value=alike).withColumn("side", F.lit(1)).unionByName(
        row_hashes(b, key, by_value=alike).withColumn("side", F.lit(-1)))


def _compared(hashes: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows per source (one row) and the row contents whose counts differ: ``(*key, net)``."""
    from nestgate.session import scratch_path

    spark, path = hashes.sparkSession, scratch_path(hashes.sparkSession, "row-hashes")
    hashes.write.parquet(path)                                     # both sources are read once
    hashes = spark.read.schema(hashes.schema).parquet(path)
    rows = hashes.agg(F.count_if(F.col("side") > 0).alias("rows_a"), F.count_if(F.col("side") < 0).alias("rows_b"))
    bucket = F.col("h1").bitwiseAND(F.lit((1 << BUCKET_BITS) - 1))
    differing = hashes.groupBy(bucket.alias("bucket")).agg(*_sums()).filter(_unequal()).select("bucket")
    left = hashes.withColumn("bucket", bucket).join(F.broadcast(differing), "bucket", "left_semi")
    # a further level of buckets would shuffle as many rows of sums as there are hashes here
    net = left.groupBy("h1", "h2").agg(F.sum("side").alias("net"), F.min(F.struct(*[F.col(f"`{k}`") for k in key])
                                                                         if key else F.lit(0)).alias("_key"))
    return rows, net.filter("net <> 0")


def _parity(hashes: DataFrame) -> DataFrame:
    rows, net = _compared(hashes, ())
    only = net.agg(F.coalesce(F.sum(F.greatest("net", F.lit(0))), F.lit(0)).cast("bigint").alias("only_in_a"),
                   F.coalesce(F.sum(F.greatest(-F.col("net"), F.lit(0))), F.lit(0)).cast("bigint").alias("only_in_b"))
    return rows.crossJoin(only)                                    # one row each


def _differences(hashes: DataFrame, keys: Sequence[str]) -> DataFrame:
    _, net = _compared(hashes, keys)
    return net.select(F.when(F.col("net") > 0, "a").otherwise("b").alias("side"), *[F.col("_key")[k].alias(k) for k in keys],
                      F.abs("net").cast("bigint").alias("copies"))


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def parity(a: DataFrame, b: DataFrame) -> DataFrame:
    """``(rows_a, rows_b, only_in_a, only_in_b)`` up to row and list order, as bags of rows."""
    return _parity(_hashes(a, b, ()))


def differences(a: DataFrame, b: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """``(side, *key, copies)`` of every row that one source has more often than the other.

    A row that differs in content is listed once for each side."""
    return _differences(_hashes(a, b, _keys(key)), _keys(key))


def parity_of_sides(rows: DataFrame) -> DataFrame:
    """:func:`parity` of rows that say where they are from: ``side`` is 1 in the first source, -1 in the second.

    For sources made in one pass from the same rows."""
    return _parity(row_hashes(rows, (), "side"))


def differences_of_sides(rows: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """:func:`differences` of rows with a ``side``, as in :func:`parity_of_sides`."""
    return _differences(row_hashes(rows, _keys(key), "side"), _keys(key))

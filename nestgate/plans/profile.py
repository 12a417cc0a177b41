"""Table profile (K5/K6/A7): rows, nulls and list metrics per column, one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nested_columns(df: DataFrame) -> list[str]:
    """K6: the list-typed columns."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]


def table_profile(df: DataFrame) -> DataFrame:
    """``(column_name, data_type, n_rows, n_nulls, n_empty, n_elements, max_len)``.

    List metrics are null for scalar columns.  One aggregation over the table."""
    lists = set(nested_columns(df))
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(df.columns):
        col = F.col(f"`{c}`")
        aggs.append(F.count_if(col.isNull()).alias(f"_n{i}"))
        if c in lists:
            n = F.when(col.isNotNull(), F.size(col))      # size(null) is -1 when ANSI mode is off
            aggs += [F.count_if(n == 0).alias(f"_e{i}"),
                     F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(f"_s{i}"),
                     F.max(n).cast("bigint").alias(f"_m{i}")]
    row = df.agg(*aggs)
    parts = []
    for i, f in enumerate(df.schema.fields):
        if f.name in lists:
            e, s, m = F.col(f"_e{i}"), F.col(f"_s{i}"), F.col(f"_m{i}")
        else:
            e = s = m = F.lit(None).cast("bigint")
        parts.append(F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                              F.col("_rows").cast("bigint").alias("n_rows"), F.col(f"_n{i}").cast("bigint").alias("n_nulls"),
                              e.cast("bigint").alias("n_empty"), s.alias("n_elements"), m.alias("max_len")))
    return row.select(F.inline(F.array(*parts)))

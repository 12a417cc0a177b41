"""Nest / unnest toolkit (explode, re-nest, re-attach, fill, drill down).

Positions are kept when exploding (``posexplode``) so re-nested lists can be
put back in source order; re-nested lists are always sorted, so results are
deterministic regardless of shuffle order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestgate.functions.rules import compare


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def explode_elements(df: DataFrame, key: str | Sequence[str], list_col: str, pos_col: str | None = "pos",
                     outer: bool = False) -> DataFrame:
    """One row per element with the key kept and struct fields unnested.

    Empty and null lists yield no row (``outer=False``).  They are dropped behind the generator:
    the filter that Catalyst would put below it repeats the whole expression that makes the list
    (a parse, say) for every row, up to twice."""
    keys = _keys(key)
    flat = df.select(*keys, F.posexplode_outer(list_col).alias("_pos", "_elem"))
    if not outer:
        flat = flat.where(F.col("_pos").isNotNull())
    elem_type = df.schema[list_col].dataType.elementType
    cols = [F.col(f"_elem.{f.name}").alias(f.name) for f in elem_type.fields] \
        if isinstance(elem_type, T.StructType) else [F.col("_elem").alias(list_col)]
    pos = [F.col("_pos").alias(pos_col)] if pos_col else []
    return flat.select(*keys, *pos, *cols)


def nest_children(children: DataFrame, key: str | Sequence[str], fields: Sequence[str | Column],
                  out_col: str, order_by: Sequence[str] | None = None) -> DataFrame:
    """Group children by key into ``array<struct<fields...>>``.

    The struct carries exactly ``fields`` in the given order.  The list is
    sorted by ``order_by`` (e.g. a position column, dropped afterwards) or,
    when not given, by the full element tuple, so it is deterministic."""
    keys = _keys(key)
    field_cols = [F.col(f) if isinstance(f, str) else f for f in fields]
    if order_by:
        sort_cols = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)]
        packed = F.struct(*sort_cols, F.struct(*field_cols).alias("_v"))
        agg = F.transform(F.array_sort(F.collect_list(packed)), lambda s: s["_v"])
    else:
        agg = F.array_sort(F.collect_list(F.struct(*field_cols)))
    return children.groupBy(*keys).agg(agg.alias(out_col))


def empty_list_like(df: DataFrame, col: str) -> Column:
    return F.array().cast(df.schema[col].dataType)


def fill_empty_list(df: DataFrame, *cols: str) -> DataFrame:
    """Null lists become empty lists of the same element type."""
    return df.withColumns({c: F.coalesce(F.col(c), empty_list_like(df, c)) for c in cols})


def reattach(parent: DataFrame, nested: DataFrame, key: str | Sequence[str], fill: bool = True) -> DataFrame:
    """Left-join re-nested children to the parent; parents without children get ``[]``."""
    keys = _keys(key)
    lists = [c for c in nested.columns if c not in keys]
    out = parent.join(nested, on=keys, how="left")
    return fill_empty_list(out, *lists) if fill else out


def rename_if_present(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename only the columns that exist (source-format normalisation)."""
    present = {old: new for old, new in mapping.items() if old in df.columns}
    return df.withColumnsRenamed(present) if present else df


def filter_list_length(df: DataFrame, list_col: str, op: str, bound: int) -> DataFrame:
    """P5: keep rows whose list length satisfies ``op bound``; a null list drops out."""
    return df.where(compare(list_length(list_col), op, bound))


def list_length(list_col: str) -> Column:
    """Length of a list column (null for a null list, whatever the ANSI mode)."""
    return F.when(F.col(list_col).isNotNull(), F.size(F.col(list_col)))


def field_values(list_col: str, fld: str) -> Column:
    """The list of one struct field over a list (``list.field``); reads only that leaf."""
    return F.col(f"{list_col}.{fld}")


def drilldown(df: DataFrame, condition: Column, key: str | Sequence[str], list_col: str,
              pos_col: str = "pos") -> DataFrame:
    """The elements of the rows selected by ``condition``, one row each."""
    return explode_elements(df.where(condition), key, list_col, pos_col)

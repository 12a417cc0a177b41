"""Nested coercion by field *name* (P17/V5) and schema-driven renames.

``cast`` of a struct is positional in Spark (fields are matched by position,
values can swap silently), so coercion rebuilds every struct from the target
schema by name, walks arrays with ``transform`` and casts leaves with
``try_cast``: a bad leaf becomes null instead of aborting the job under ANSI
mode.  :func:`coercion_failures` counts the leaves that became null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _field(st: T.StructType, name: str) -> T.StructField | None:
    for f in st.fields:
        if f.name == name:
            return f
    return None


def _same_shape(src: T.DataType, dst: T.DataType) -> bool:
    """Whether two types differ in their leaves only: the same names in the same order at every level."""
    if isinstance(src, T.StructType) and isinstance(dst, T.StructType):
        return src.names == dst.names and all(_same_shape(a.dataType, b.dataType) for a, b in zip(src, dst))
    if isinstance(src, T.ArrayType) and isinstance(dst, T.ArrayType):
        return _same_shape(src.elementType, dst.elementType)
    return not any(isinstance(t, (T.StructType, T.ArrayType, T.MapType)) for t in (src, dst))


def _nullable(dt: T.DataType) -> T.DataType:
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType), True) for f in dt.fields])
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(_nullable(dt.elementType), True)
    return dt


def coerce_column(c: Column, src: T.DataType, dst: T.DataType) -> Column:
    """Expression turning ``c`` of type ``src`` into ``dst`` (by name, leaves try_cast).

    Where names and positions agree one ``try_cast`` does a whole list or struct, also leaf by leaf, and is
    compiled; the rebuilding of every struct of a list is not."""
    if isinstance(dst, (T.StructType, T.ArrayType)) and _same_shape(src, dst):
        return c.try_cast(_nullable(dst))
    if isinstance(dst, T.StructType):
        if not isinstance(src, T.StructType):
            return F.lit(None).cast(dst)
        parts = []
        for f in dst.fields:
            sf = _field(src, f.name)
            v = coerce_column(c[f.name], sf.dataType, f.dataType) if sf else F.lit(None).cast(f.dataType)
            parts.append(v.alias(f.name))
        return F.when(c.isNull(), F.lit(None).cast(dst)).otherwise(F.struct(*parts))
    if isinstance(dst, T.ArrayType):
        if not isinstance(src, T.ArrayType):
            return F.lit(None).cast(dst)
        return F.transform(c, lambda x: coerce_column(x, src.elementType, dst.elementType))
    if src == dst:
        return c
    if isinstance(src, (T.StructType, T.ArrayType, T.MapType)):
        return F.lit(None).cast(dst)
    return c.try_cast(dst)


def coerce_to_schema(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Columns of ``schema`` in its order, coerced by name; absent columns are null.

    With ``strict`` the undeclared columns are dropped, otherwise they are
    kept after the declared ones."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(coerce_column(_top(f.name), df.schema[f.name].dataType, f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    extra = [] if strict else [_top(c) for c in df.columns if _field(schema, c) is None]
    return df.select(*cols, *extra)


def _top(name: str) -> Column:
    """A top-level column by name, even if the name contains dots."""
    return F.col(f"`{name}`")


def leaf_nulls(c: Column, dt: T.DataType) -> Column:
    """Number of null leaves in a (nested) value; a null container counts once."""
    if isinstance(dt, T.StructType):
        inner = [leaf_nulls(c[f.name], f.dataType) for f in dt.fields]
        total = inner[0]
        for x in inner[1:]:
            total = total + x
        return F.when(c.isNull(), F.lit(1)).otherwise(total)
    if isinstance(dt, T.ArrayType):
        return F.when(c.isNull(), F.lit(1)).otherwise(
            F.aggregate(F.transform(c, lambda x: leaf_nulls(x, dt.elementType)), F.lit(0), lambda a, b: a + b))
    return F.when(c.isNull(), F.lit(1)).otherwise(F.lit(0))


def _new_nulls(before: T.StructType, schema: T.StructType) -> dict[str, Column]:
    """Leaves of each declared column that coercion makes null, as one number a row."""
    out = {}
    for f in schema.fields:
        if f.name in before.fieldNames():
            c, dt = _top(f.name), before[f.name].dataType
            out[f.name] = leaf_nulls(coerce_column(c, dt, f.dataType), f.dataType) - leaf_nulls(c, dt)
    return out


def coercion_failures(before: DataFrame, schema: T.StructType) -> DataFrame:
    """Per declared column: leaves that are not null before coercion but are after.

    Both sides are evaluated on the same rows in one pass: ``(column_name, new_nulls)``."""
    lost = _new_nulls(before.schema, schema)
    counts = before.select(*[c.alias(n) for n, c in lost.items()]).agg(
        *[F.sum(_top(n)).cast("bigint").alias(n) for n in lost])
    stack = ", ".join(f"'{n}', `{n}`" for n in lost)
    return counts.selectExpr(f"stack({len(lost)}, {stack}) as (column_name, new_nulls)")


def with_coercion_counts(before: DataFrame, schema: T.StructType, seen: Observation) -> DataFrame:
    """``before``; when its rows pass (for example, to be written), ``seen`` gets the new nulls by column."""
    return before.observe(seen, *[F.sum(c).cast("bigint").alias(n) for n, c in _new_nulls(before.schema, schema).items()])


def rename_fields(c: Column, dt: T.DataType, rename: Callable[[str], str]) -> tuple[Column, T.DataType]:
    """Rename struct fields at every depth; returns the new expression and type."""
    if isinstance(dt, T.StructType):
        parts, fields = [], []
        for f in dt.fields:
            sub, st = rename_fields(c[f.name], f.dataType, rename)
            parts.append(sub.alias(rename(f.name)))
            fields.append(T.StructField(rename(f.name), st, True))
        new_t = T.StructType(fields)
        return F.when(c.isNull(), F.lit(None).cast(new_t)).otherwise(F.struct(*parts)), new_t
    if isinstance(dt, T.ArrayType):
        _, et = rename_fields(F.lit(None).cast(dt.elementType), dt.elementType, rename)
        return F.transform(c, lambda x: rename_fields(x, dt.elementType, rename)[0]), T.ArrayType(et, True)
    return c, dt


def string_leaves(dt: T.DataType) -> T.DataType:
    """The same nested shape with every leaf as string (read as text, type later)."""
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, string_leaves(f.dataType), True) for f in dt.fields])
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(string_leaves(dt.elementType), True)
    if isinstance(dt, T.MapType):
        return T.MapType(T.StringType(), string_leaves(dt.valueType), True)
    return T.StringType()

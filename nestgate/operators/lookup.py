"""Lookup enrichment of nested lists (explode / join / re-nest, re-expressed).

Strategies, chosen per call by a *bounded* size probe of the lookup table:

``map``
    The lookup (one row per key, duplicate labels kept as an array) is folded
    into a single ``map`` by an uncorrelated scalar subquery that Spark runs
    once; every list is rewritten in place with ``transform``.  No shuffle of
    the documents, no regrouping, row-local.  Map access is a linear scan, so
    this is used only below ``map_max_keys`` keys.
``join``
    Elements are exploded with their position, joined with the lookup
    (broadcast when the size probe proves it small, otherwise a shuffle join
    where AQE splits hot keys), regrouped and re-attached.  Regrouping is by
    (row key, hash of the list) with ``collect_set`` over (position, output),
    so duplicate parent rows each keep exactly their own list and identical
    copies are de-duplicated map-side instead of being multiplied.

Semantics of both (same as a left join): an element whose key has no match
keeps a null label; a key with several lookup rows yields one element per
match; null and empty lists come back as empty lists.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAP_MAX_KEYS = 1024
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class Lookup:
    """Resolve element field ``element_key`` via ``table[key] -> table[value]`` into ``out``."""

    element_key: str
    table: DataFrame
    key: str
    value: str
    out: str


def probe_size(df: DataFrame, max_rows: int) -> tuple[int, int]:
    """(rows, approx bytes) of ``df``, looking at no more than ``max_rows + 1`` rows.

    The limit and the sums run in the executors; one row reaches the driver."""
    size = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    row = df.select(size.alias("b")).limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum("b"), F.lit(0))).first()
    return row[0], row[1]


def grouped_lookup(lk: Lookup) -> DataFrame:
    """One row per lookup key: ``(key, array of values)``; null keys never match.

    Values are ordered (nulls last) and null values kept, as a left join keeps them."""
    value = F.struct(F.col(lk.value).isNull().alias("n"), F.col(lk.value).alias("v"))
    return (
        lk.table.where(F.col(lk.key).isNotNull())
        .groupBy(F.col(lk.key).alias("_k"))
        .agg(F.transform(F.sort_array(F.collect_list(value)), lambda s: s["v"]).alias("_vals"))
    )


def lookup_map(lk: Lookup) -> Column:
    """Scalar-subquery ``map<key, array<value>>`` computed once per query."""
    g = grouped_lookup(lk)
    return g.agg(F.map_from_entries(F.collect_list(F.struct("_k", "_vals")))).scalar()


def _value_type(lk: Lookup) -> T.DataType:
    return lk.table.schema[lk.value].dataType


def _combine(elem: Column, lookups: Sequence[Lookup], labels: Sequence[Column], fields: Sequence[str]) -> Column:
    """array<struct<fields>> for one element: cartesian product over the label arrays."""

    def rec(i: int, bound: dict[str, Column]) -> Column:
        if i == len(lookups):
            return F.array(F.struct(*[(bound[f] if f in bound else elem[f]).alias(f) for f in fields]))
        lk = lookups[i]
        vals = F.coalesce(labels[i], F.array(F.lit(None).cast(_value_type(lk))))
        return F.flatten(F.transform(vals, lambda v: rec(i + 1, {**bound, lk.out: v})))

    return rec(0, {})


def probe_lookup(lk: Lookup, max_rows: int = BROADCAST_MAX_ROWS) -> tuple[int, int]:
    """Bounded probe of the raw lookup rows ``(key, value)`` (see :func:`probe_size`).

    Raw rows bound the grouped lookup from above (one grouped row per distinct
    key, never more bytes), so one cheap limited scan answers both questions:
    is it small enough for the in-place map, and may it be broadcast?"""
    return probe_size(lk.table.select(lk.key, lk.value), max_rows)


def choose_strategy(probes: Sequence[tuple[int, int]], map_max_keys: int = MAP_MAX_KEYS) -> str:
    return "map" if all(n <= map_max_keys for n, _ in probes) else "join"


def enrich_list(df: DataFrame, list_col: str, lookups: Sequence[Lookup], fields: Sequence[str],
                out_col: str | None = None, key: str | Sequence[str] | None = None,
                strategy: str = "auto", map_max_keys: int = MAP_MAX_KEYS,
                broadcast_max_rows: int = BROADCAST_MAX_ROWS,
                broadcast_max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Resolve ids inside ``list_col`` through lookups; output elements carry ``fields``.

    ``fields`` may name element fields and lookup outputs, in the order wanted.
    ``key`` (the document key) is always required, so a call does not start to fail
    when the lookup outgrows the ``map`` strategy."""
    if key is None:
        raise ValueError("enrich_list needs the document key")
    out_col = out_col or list_col
    memo: dict[tuple[int, str, str], tuple[int, int]] = {}
    probes = []
    if strategy != "map":  # a forced map needs no size facts
        for lk in lookups:  # one probe per distinct (table, key, value)
            k = (id(lk.table), lk.key, lk.value)
            if k not in memo:
                memo[k] = probe_lookup(lk, broadcast_max_rows)
            probes.append(memo[k])
    if strategy == "auto":
        strategy = choose_strategy(probes, map_max_keys)
    if strategy == "map":
        # Subqueries may not appear inside lambdas: project each map once, then use it.
        map_cols = {f"_map{i}": lookup_map(lk) for i, lk in enumerate(lookups)}
        expr = F.flatten(F.transform(list_col, lambda x: _combine(
            x, lookups, [F.col(f"_map{i}")[x[lk.element_key]] for i, lk in enumerate(lookups)], fields)))
        out = df.withColumns(map_cols).withColumn(out_col, expr).drop(*map_cols)
    elif strategy == "join":
        small = [n <= broadcast_max_rows and b <= broadcast_max_bytes for n, b in probes]
        out = _enrich_by_join(df, list_col, lookups, fields, out_col, key, small)
    else:
        raise ValueError(f"unknown strategy {strategy}")
    elem_type = out.schema[out_col].dataType
    out = out.withColumn(out_col, F.coalesce(F.col(out_col), F.array().cast(elem_type)))
    if out_col != list_col:
        out = out.drop(list_col)
    return out


def _enrich_by_join(df: DataFrame, list_col: str, lookups: Sequence[Lookup], fields: Sequence[str],
                    out_col: str, key: str | Sequence[str], small: Sequence[bool]) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    # Never-null stand-ins of the keys: plain equality on them is null-safe (a document with a null key
    # keeps its own list) and the regrouped rows are joined on the columns they are partitioned by.
    row_key = {}
    for i, k in enumerate(keys):
        row_key[f"_rn{i}"] = F.col(k).isNull()
        row_key[f"_rk{i}"] = F.coalesce(F.col(k).cast("string"), F.lit(""))
    row_key["_lh"] = F.xxhash64(list_col)
    flat = df.select(*[c.alias(n) for n, c in row_key.items()], F.posexplode(list_col).alias("_pos", "_e"))
    label_cols = []
    for i, lk in enumerate(lookups):
        g = grouped_lookup(lk).withColumnsRenamed({"_k": f"_k{i}", "_vals": f"_vals{i}"})
        if small[i]:  # proven small by the bounded probe
            flat = flat.join(F.broadcast(g), F.col("_e")[lk.element_key] == F.col(f"_k{i}"), "left").drop(f"_k{i}")
        else:
            # elements without id match nothing: a salt spreads them over the partitions
            no_id = F.col("_e")[lk.element_key].isNull()
            flat = flat.withColumn("_salt", F.when(no_id, F.xxhash64("_lh", "_pos")).otherwise(F.lit(0).cast("long")))
            g = g.withColumn("_one", F.lit(0).cast("long"))
            flat = flat.join(g, (F.col("_e")[lk.element_key] == F.col(f"_k{i}")) & (F.col("_salt") == F.col("_one")),
                             "left").drop(f"_k{i}", "_salt", "_one")
        label_cols.append(F.col(f"_vals{i}"))
    flat = flat.select(*row_key, "_pos", _combine(F.col("_e"), lookups, label_cols, fields).alias("_out"))
    regrouped = flat.groupBy(*row_key).agg(F.collect_set(F.struct("_pos", "_out")).alias("_g"))
    regrouped = regrouped.select(*row_key, F.flatten(F.transform(F.array_sort("_g"), lambda s: s["_out"])).alias("_new"))
    return (
        df.withColumns(row_key)
        .join(regrouped, on=list(row_key), how="left")
        .drop(*row_key)
        .withColumn(out_col, F.col("_new"))
        .drop("_new")
    )


def lookup_join(df: DataFrame, lookup: DataFrame, on_left: str, on_right: str,
                max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Flat left lookup join; broadcast only behind a bounded size probe."""
    n, b = probe_size(lookup, max_rows)
    same = on_left == on_right
    if same:  # one key column in the result
        lookup = lookup.withColumnRenamed(on_right, "_rk")
    right = F.broadcast(lookup) if (n <= max_rows and b <= max_bytes) else lookup
    out = df.join(right, df[on_left] == right["_rk" if same else on_right], "left")
    return out.drop("_rk") if same else out

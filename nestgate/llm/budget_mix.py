"""Mixing sources to target weights by hierarchical budgets.

Documents hang under domain / language / source.  A token budget is handed down
the tree in proportion to the weights; a node that can not take its share (its
tokens times ``epochs``) is filled, and what it leaves goes to its siblings in
proportion to their weights.  A subtree's capacity is that of its leaves, so a
shortage reaches the ancestors' level only when all siblings are full.  Budgets
are whole tokens and add up exactly.

A leaf takes whole epochs while its budget lasts and then a token-prefix of one
more: documents in the order of a hash of (seed, epoch, id), up to the last one
that fits.  The prefix of a leaf is cut with one key, found from sums over 4096
key ranges and a running sum inside the range where the budget ends, so a leaf
with most of the corpus is never sorted in one task.

Defined results: null domains, languages or sources are nodes named ``''``;
documents without tokens and leaves without tokens are never chosen; equal ids
in a leaf are chosen together; a node without weight has ``OTHER`` as weight, a
weight of 0 takes nothing, fractions keep their exact proportions (as decimals, up to whole numbers of
``MAX_WEIGHT``) and negative weights are refused; names may hold any character; an empty table gives no rows; other columns pass through unless a new column
has their name (then the new one replaces them).
"""

from __future__ import annotations

import math
import re
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestgate.llm.common import behind_names, free_name, saved

SEED = 20
EPOCHS = 2
BUDGET_PERCENT = 100           # of the corpus's tokens
BROADCAST_LEAVES = 100_000     # leaf rows (a few hundred bytes each) that may be broadcast
OTHER = 1
MAX_WEIGHT = 1_000_000
# Parameters of the registered query: weights of the nodes at each level.
WEIGHTS = {
    "domain": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1},
    "lang": {"en": 5, "de": 2, "fr": 2, "es": 1},
    "source": {"src0": 2},
}
LEVELS = ["domain", "lang", "source"]


def _literal(name: str) -> str:
    """A string literal of both SQL dialects (they escape quotes and backslashes differently)."""
    parts = re.split(r"(['\\])", name)
    return "(" + " || ".join(f"chr({ord(x)})" if x in ("'", "\\") else f"'{x}'" for x in parts) + ")"


def whole_weights(weights: dict) -> tuple[dict[str, dict[str, int]], dict[str, int]]:
    """Weights of each level (and of nodes without one) as whole numbers in the same proportions."""
    scaled, others = {}, {}
    for level in LEVELS:
        exact = {k: Fraction(str(w)) for k, w in weights.get(level, {}).items()}
        if any(w < 0 for w in exact.values()):
            raise ValueError(f"a weight of {level} is negative")
        scale = math.lcm(*(w.denominator for w in exact.values()), 1)
        scaled[level] = {k: int(w * scale) for k, w in exact.items()}
        others[level] = OTHER * scale
        if max([others[level], *scaled[level].values()]) > MAX_WEIGHT:
            raise ValueError(f"the weights of {level} need whole numbers above {MAX_WEIGHT} to keep their proportions")
    return scaled, others


def _weight(level: str, weights: tuple[dict, dict]) -> str:
    cases = " ".join(f"when {_literal(k)} then {w}" for k, w in sorted(weights[0][level].items()))
    return f"case {level} {cases} else {weights[1][level]} end" if cases else str(weights[1][level])


def _fill(i: int, div: str) -> str:
    """CTEs that hand the budgets of level ``i - 1`` down to level ``i``."""
    name, part = LEVELS[i], ", ".join(LEVELS[:i]) or "one"
    cols = ", ".join(LEVELS[:i + 1])
    up = (f"join {LEVELS[i - 1]}_done u on " + " and ".join(f"n.{c} = u.{c}" for c in LEVELS[:i])) if i else \
        "cross join root u"
    n_cols = ", ".join(f"n.{c}" for c in LEVELS[:i + 1])
    order = f"partition by {part} order by cap / w, {name}"
    return f"""
{name}_in as (select {n_cols}, n.cap, n.w, u.budget, 1 as one from {name}_node n {up}),
{name}_sum as (
  select *, coalesce(sum(cap) over ({order} rows between unbounded preceding and 1 preceding), 0) as cap_before,
    sum(w) over ({order} rows between current row and unbounded following) as w_rest from {name}_in),
{name}_full as (select *, cap * w_rest <= w * (budget - cap_before) as is_full from {name}_sum),
{name}_open as (
  select *, sum(case when is_full then cap else 0 end) over (partition by {part}) as taken,
    sum(case when is_full then 0 else w end) over (partition by {part}) as w_open from {name}_full),
{name}_base as (
  select *, case when is_full then cap else (w * (budget - taken)) {div} w_open end as share from {name}_open),
{name}_spare as (
  select *, budget - sum(share) over (partition by {part}) as spare,
    sum(case when is_full then 0 else 1 end) over (partition by {part} order by {name}) as nth from {name}_base),
{name}_done as (
  select {cols}, cap, cast(case when not is_full and nth <= spare then share + 1 else share end as bigint) as budget
  from {name}_spare)"""


def budget_sql(rows: str, weights: dict, epochs: int, percent: int, div: str) -> str:
    """CTEs from rows ``(domain, lang, source, n_tokens)`` to ``leaf``: the budget, whole epochs and rest of a leaf."""
    nodes, whole = [], whole_weights(weights)
    # a leaf below a weight of 0 can take nothing
    shut = " or ".join(f"{_weight(name, whole)} = 0" for name in LEVELS)
    for i, name in enumerate(LEVELS):
        cols = ", ".join(LEVELS[:i + 1])
        nodes.append(f"{name}_node as (select {cols}, cast(sum(usable) * {epochs} as bigint) as cap, "
                     f"cast(greatest({_weight(name, whole)}, 1) as bigint) as w from size group by {cols})")
    return f"""
size as (
  select domain, lang, source, cast(sum(n_tokens) as bigint) as tokens,
    cast(case when {shut} then 0 else sum(n_tokens) end as bigint) as usable
  from {rows} group by domain, lang, source),
{", ".join(nodes)},
root as (
  select cast(least(sum(tokens) * {percent} {div} 100, sum(usable) * {epochs}) as bigint) as budget from size),
{",".join(_fill(i, div) for i in range(len(LEVELS)))},
leaf as (
  select s.domain, s.lang, s.source, s.tokens, d.budget,
    case when s.tokens > 0 then cast(d.budget {div} nullif(s.tokens, 0) as bigint) else 0 end as full_epochs,
    case when s.tokens > 0 then cast(d.budget % nullif(s.tokens, 0) as bigint) else 0 end as rest
  from size s join source_done d on s.domain = d.domain and s.lang = d.lang and s.source = d.source)"""


def order_key(seed: int, epoch: Column, id_col: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"),
                          F.coalesce(id_col.cast("string"), F.lit(""))))


def _small(leaves: DataFrame) -> DataFrame:
    """Saved leaf rows with a broadcast hint where their number allows it: a leaf's documents then stay
    where they are.  Beyond, a shuffle join, whose hot keys Spark splits."""
    return F.broadcast(leaves) if leaves.count() <= BROADCAST_LEAVES else leaves


def leaf_plan(rows: DataFrame, weights: dict, epochs: int, percent: int, seed: int) -> DataFrame:
    """One row a leaf: budget, whole epochs, and the largest key of the last epoch that is taken ('' for none).

    ``rows``: ``(id, domain, lang, source, n_tokens)``, read more than once.
    """
    spark = rows.sparkSession
    leaf = saved(spark.sql("with " + budget_sql("{rows}", weights, epochs, percent, "div") + " select * from leaf",
                           rows=rows))
    keyed = (rows.filter("n_tokens > 0").join(_small(leaf), LEVELS)
             .withColumn("key", order_key(seed, F.col("full_epochs"), F.col("id")))
             .withColumn("bucket", F.substring("key", 1, 3)))
    from pyspark.sql import Window

    sums = keyed.groupBy(*LEVELS, "bucket", "rest").agg(F.sum("n_tokens").alias("n"))
    by = Window.partitionBy(*LEVELS).orderBy("bucket")
    placed = sums.withColumn("upto", F.sum("n").over(by))
    # the range in which the rest ends: its first key range that does not fit
    ends = (placed.filter("upto > rest").groupBy(*LEVELS)
            .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("n")).alias("before"))).alias("e"))
            .select(*LEVELS, F.col("e.bucket").alias("bucket"), F.col("e.before").alias("before")))
    inside = Window.partitionBy(*LEVELS).orderBy("key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ends = saved(ends)
    last = (keyed.join(_small(ends), [*LEVELS, "bucket"])
            .withColumn("upto", F.col("before") + F.sum("n_tokens").over(inside))
            .filter("upto <= rest").groupBy(*LEVELS).agg(F.max("key").alias("cut")))
    return (leaf.join(ends, LEVELS, "left").join(last, LEVELS, "left")
            .withColumn("cut", F.when(F.col("rest") == 0, F.lit(""))
                        .otherwise(F.coalesce("cut", "bucket", F.lit(""))))       # all keys before the range
            .select(*LEVELS, "budget", "full_epochs", "cut"))


def source_domain(source: Column) -> Column:
    """Domain of a source in the driver's tables: its number modulo four."""
    return F.concat(F.lit("domain"), (F.regexp_extract(F.coalesce(source, F.lit("")), "([0-9]+)$", 1)
                                      .try_cast("int") % 4).cast("string"))


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def mix(df: DataFrame, domain: Column, id_col: str = "doc_id", tokens: Column | None = None, lang: str = "lang",
        source: str = "source", weights: dict | None = None, epochs: int = EPOCHS, percent: int = BUDGET_PERCENT,
        seed: int = SEED) -> DataFrame:
    """``df`` with ``leaf_domain``, ``n_tokens``, ``leaf_budget`` and ``copies`` (epochs that hold the row)."""
    names = ["leaf_domain", "n_tokens", "leaf_budget", "copies"]
    if tokens is None:
        tokens = word_count(F.col("text"))

    def node(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit(""))

    slim = saved(df.select(F.col(id_col).alias("id"), node(domain).alias("domain"), node(F.col(lang)).alias("lang"),
                           node(F.col(source)).alias("source"), tokens.alias("n_tokens")))
    plan = leaf_plan(slim, WEIGHTS if weights is None else weights, epochs, percent, seed)
    p = free_name(df, "_p")
    plan = _small(saved(plan).select(*[F.col(c).alias(f"{p}_{c}") for c in plan.columns]))
    kept = df.drop(*names)
    added = df.select("*", node(domain).alias(f"{p}d"), tokens.alias(f"{p}n"))
    on = ((F.col(f"{p}d") == F.col(f"{p}_domain")) & (node(F.col(lang)) == F.col(f"{p}_lang"))
          & (node(F.col(source)) == F.col(f"{p}_source")))
    key = order_key(seed, F.col(f"{p}_full_epochs"), F.col(id_col))
    copies = F.when(F.col(f"{p}n") > 0, F.col(f"{p}_full_epochs") + (key <= F.col(f"{p}_cut")).cast("long")).otherwise(
        F.lit(0).cast("long"))
    return added.join(plan, on, "left").select(
        *kept.columns, F.col(f"{p}d").alias("leaf_domain"), F.col(f"{p}n").alias("n_tokens"),
        F.col(f"{p}_budget").alias("leaf_budget"), copies.alias("copies"))


def document_mix(docs: DataFrame) -> DataFrame:
    """Query form."""
    return mix(docs.select("doc_id", "lang", "source", "text"), source_domain(F.col("source"))).drop("text")


def mixed_documents(docs: DataFrame, weights: dict | None = None) -> DataFrame:
    """Pipeline form: each document as often as its epochs hold it, in the columns of ``docs``; columns that
    share a name with one of this operator's keep their values."""
    def step(df: DataFrame) -> DataFrame:
        mixed = mix(df, source_domain(F.col("source")), weights=weights)
        time = free_name(mixed, "_time")
        return mixed.withColumn(time, F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select(*df.columns)
    return behind_names(docs, ["doc_id", "lang", "source", "text"], step)


MIX_SQL = f"""
with rows as (
  select doc_id, coalesce(lang, '') as lang, coalesce(source, '') as source, lang as l0, source as s0,
    coalesce('domain' || (try_cast(nullif(regexp_extract(coalesce(source, ''), '([0-9]+)$', 1), '') as int) % 4), '')
      as domain,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''))::bigint as n_tokens
  from documents),
{budget_sql("rows", WEIGHTS, EPOCHS, BUDGET_PERCENT, "//")},
keyed as (
  select r.*, l.budget, l.full_epochs, l.rest,
    md5('{SEED}:' || l.full_epochs || ':' || coalesce(r.doc_id::varchar, '')) as k
  from rows r join leaf l on r.domain = l.domain and r.lang = l.lang and r.source = l.source),
run as (
  select *, sum(n_tokens) over (partition by domain, lang, source order by k
    range between unbounded preceding and current row) as upto from keyed)
select doc_id, l0 as lang, s0 as source, domain as leaf_domain, n_tokens, budget as leaf_budget,
  case when n_tokens > 0 then full_epochs + (upto <= rest)::bigint else 0 end as copies
from run
"""

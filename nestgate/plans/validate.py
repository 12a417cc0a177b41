"""Validation runs: one fused pass for all row rules, findings as tables.

* :func:`summary`         -- one row per rule with its failure count (A9/R2/R6/R9)
* :func:`first_failures`  -- first failing rule per column, declared order (R1)
* :func:`failing_rows`    -- ``(key, column_name, rule)`` for every failing row (R4)
* :func:`failing_elements`-- ``(key, column_name, rule, pos, value)`` per failing element (R5)
* :func:`gate` / :func:`quarantine` -- blocking gate and row split (R7)
* :func:`summary_from_children` -- the same counts for parent + child tables,
  from one partial-aggregating ``groupBy`` (no lists built)
* :func:`validate_frame`  -- declared schema (coercion, types, nullability) plus
  rules at a depth, as one report

All row rules of a run are evaluated in **one** aggregation over the input
(a single scan, partial aggregation, one tiny shuffle of per-task counters).
Uniqueness needs a shuffle on the key; it is a separate aggregation that reads
only the key columns, so the two scans touch disjoint column sets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestgate.functions.rules import FRAME, Rule, select_rules
from nestgate.operators.seen_twice import repeated_keys


class ValidationError(Exception):
    """Raised by :func:`gate` in ``block`` mode; carries the failing summary rows."""

    def __init__(self, failures: list[dict]):
        self.failures = failures
        lines = ", ".join(f"[{f['column_name']}] {f['rule']}" + (f": {f['failed']}" if f.get("failed") is not None
                                                                   else "") for f in failures)
        super().__init__(f"{len(failures)} rule(s) failed: {lines}")


def _row_rules(rules: Sequence[Rule]) -> list[Rule]:
    return [r for r in rules if r.level != FRAME]


def _frame_rules(rules: Sequence[Rule]) -> list[Rule]:
    return [r for r in rules if r.level == FRAME]


def _distinct_rules(rules: Sequence[Rule]) -> list[Rule]:
    """A rule is named by (column, name); repeats of one are evaluated once."""
    return list({(r.column, r.name): r for r in reversed(rules)}.values())[::-1]


def unique_violations(df: DataFrame, rule: Rule) -> DataFrame:
    """Rows whose key occurs more than once: one row ``(failed)``.  Null keys are equal to each other.

    Keys that are seen once, nearly all of them, leave their task as a few bits
    (:mod:`nestgate.operators.seen_twice`); a hot key sends one row per task."""
    return (
        repeated_keys(df, list(rule.keys), "count")
        .agg(F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias("failed"))
    )


def duplicate_keys(df: DataFrame, rule: Rule, max_rows: int = 1_000_000) -> tuple[DataFrame, bool]:
    """The key values that occur more than once, and whether they may be broadcast.

    Found by :func:`~nestgate.operators.seen_twice.repeated_keys` from the key columns only; the result is cut
    from its lineage (checkpoint in the shared folder) and, when a bounded
    probe shows it small -- the usual case, few duplicates -- broadcast, so
    attaching uniqueness findings does not shuffle the data itself."""
    from nestgate.operators.lookup import probe_size
    from nestgate.session import checkpoint_root

    keys = list(rule.keys)
    checkpoint_root(df.sparkSession)
    dup = repeated_keys(df, keys, "_count").drop("_count").checkpoint(eager=True)
    n, b = probe_size(dup, max_rows)
    return dup, (n <= max_rows and b <= 64 * 1024 * 1024)


def _on_keys(df: DataFrame, dup: DataFrame, small: bool, keys: Sequence[str], how: str) -> DataFrame:
    """Join with duplicated keys; nulls match nulls, as in the count of violations."""
    right = dup.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)})
    cond = None
    for i, k in enumerate(keys):
        c = df[k].eqNullSafe(right[f"_k{i}"])
        cond = c if cond is None else cond & c
    return df.join(F.broadcast(right) if small else right, cond, how).drop(*[f"_k{i}" for i in range(len(keys))])


def summary(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``(rule_order, rule, column_name, level, failed)``: one row per rule.

    Row rules: one ``count_if`` per rule in a single aggregation (R2/R9)."""
    parts: list[DataFrame] = []
    rules = _distinct_rules(rules)
    row = _row_rules(rules)
    order = {(r.column, r.name): i for i, r in enumerate(rules)}
    if row:
        counts = df.agg(*[F.count_if(r.failed()).cast("bigint").alias(f"r{i}") for i, r in enumerate(row)])
        stack = ", ".join(
            f"{order[r.column, r.name]}L, '{_q(r.name)}', '{_q(r.column)}', '{r.level}', r{i}" for i, r in enumerate(row)
        )
        parts.append(counts.selectExpr(f"stack({len(row)}, {stack}) as (rule_order, rule, column_name, level, failed)"))
    for r in _frame_rules(rules):
        parts.append(
            unique_violations(df, r).select(
                F.lit(order[r.column, r.name]).cast("bigint").alias("rule_order"),
                F.lit(r.name).alias("rule"),
                F.lit(r.column).alias("column_name"),
                F.lit(r.level).alias("level"),
                F.col("failed"),
            )
        )
    if not parts:
        return df.sparkSession.createDataFrame([], SUMMARY_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


SUMMARY_SCHEMA = "rule_order bigint, rule string, column_name string, level string, failed bigint"


def _q(s: str) -> str:
    return s.replace("\\", "\\\\").replace("'", "\\'")


def first_failures(summary_df: DataFrame) -> DataFrame:
    """First failing rule per column in declared order (R1): ``(column_name, rule, failed)``.

    Operates on the per-rule summary (one row per rule), never on data rows."""
    failing = summary_df.where(F.col("failed") > 0)
    return failing.groupBy("column_name").agg(
        F.min_by("rule", "rule_order").alias("rule"),
        F.min_by("failed", "rule_order").alias("failed"),
    )


def summary_by_depth(df: DataFrame, rules: Sequence[Rule], depths: Sequence[str] = ("types", "flat", "full")) -> DataFrame:
    """``(depth, n_rules, failing_rules, failed_rows_total)`` per depth.

    All depths share one pass: the full rule set is counted once and each
    depth is a selection of rule rows."""
    rules = _distinct_rules(rules)
    s = summary(df, rules)
    at = {(r.column, r.name): i for i, r in enumerate(rules)}
    parts = []
    for d in depths:
        names = [at[r.column, r.name] for r in select_rules(rules, d)]
        parts.append(
            s.where(F.col("rule_order").isin(names) if names else F.lit(False))
            .agg(
                F.count_if(F.col("failed") > 0).cast("bigint").alias("failing_rules"),
                F.coalesce(F.sum("failed"), F.lit(0)).cast("bigint").alias("failed_total"),
            )
            .select(F.lit(d).alias("depth"), F.lit(len(names)).cast("bigint").alias("n_rules"), "*")
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


FINDING = "struct<column_name:string,rule:string>"


def _named(r: Rule) -> Column:
    """A rule as findings name it: its column and its name."""
    return F.struct(F.lit(r.column).alias("column_name"), F.lit(r.name).alias("rule"))


def failed_rules(rules: Sequence[Rule]) -> Column:
    """``array<struct<column_name, rule>>`` of the row rules that the row fails."""
    row = _row_rules(rules)
    if not row:
        return F.array().cast(f"array<{FINDING}>")
    return F.filter(F.array(*[F.when(r.failed(), _named(r)) for r in row]), lambda x: x.isNotNull())


def failing_rows(df: DataFrame, rules: Sequence[Rule], key: str | Sequence[str]) -> DataFrame:
    """One row ``(*key, column_name, rule)`` per failing (row, rule) pair.

    Row-local: no shuffle. Frame rules add the rows of duplicated keys."""
    keys = [key] if isinstance(key, str) else list(key)
    rules = _distinct_rules(rules)
    out = df.select(*keys, F.explode(failed_rules(rules)).alias("f"))
    for r in _frame_rules(rules):
        rows = _on_keys(df, *duplicate_keys(df, r), r.keys, "left_semi")
        out = out.unionByName(rows.select(*keys, _named(r).alias("f")))
    return out.select(*keys, "f.column_name", "f.rule")


def failing_elements(df: DataFrame, rules: Sequence[Rule], key: str | Sequence[str]) -> DataFrame:
    """``(*key, column_name, rule, pos, value)`` for every element that breaks an element rule.

    One row-local pass for all rules: per row, each element rule contributes
    the (position, value) of its failing elements -- the element test is
    evaluated inside the row, so it may use other columns -- and the
    concatenation is exploded once.  Only rows that fail some element rule
    produce output; ``value`` is the offending field rendered as JSON text."""
    keys = [key] if isinstance(key, str) else list(key)
    per_rule = []
    for r in _distinct_rules(_row_rules(rules)):
        if r.element is None:
            continue
        e = r.element
        src = F.col(f"{e.list_col}.{e.field}") if e.field else F.col(e.list_col)
        tested = F.transform(src, lambda v, i: F.struct(
            i.cast("bigint").alias("pos"), v.alias("v"), F.coalesce(e.passes(v), F.lit(True)).alias("ok")))
        # only failing elements are rendered
        bad = F.transform(F.filter(tested, lambda x: ~x["ok"]), lambda x: F.struct(
            F.lit(r.column).alias("column_name"), F.lit(r.name).alias("rule"), x["pos"].alias("pos"),
            F.to_json(F.array(x["v"])).alias("value")))
        # skip the element scan for rows that pass the rule
        per_rule.append(F.when(r.failed(), bad))
    if not per_rule:
        raise ValueError("no element rules given")
    found = F.flatten(F.filter(F.array(*per_rule), lambda a: a.isNotNull()))
    out = df.select(*keys, F.explode(found).alias("f"))
    return out.select(*keys, "f.column_name", "f.rule", "f.pos", "f.value")


def failures(summary_df: DataFrame) -> list[dict]:
    """Collect the failing summary rows (one row per rule, bounded by the rule count)."""
    return [r.asDict() for r in summary_df.where(F.col("failed") > 0).orderBy("rule_order").collect()]


def gate(df: DataFrame, rules: Sequence[Rule], mode: str = "block") -> DataFrame:
    """Blocking gate before output.

    ``block``: raise :class:`ValidationError` if any rule fails; ``warn``:
    return the frame unchanged.  For ``quarantine`` use :func:`quarantine`."""
    if mode not in ("block", "warn"):
        raise ValueError("mode must be 'block' or 'warn'; use quarantine() to split rows")
    bad = failures(summary(df, rules))
    if bad and mode == "block":
        raise ValidationError(bad)
    return df


def with_findings(df: DataFrame, rules: Sequence[Rule], col: str = "_failed_rules") -> DataFrame:
    """Attach the failing rules per row, each with its column; frame rules via a semi-join on duplicates."""
    rules = _distinct_rules(rules)
    out = df.withColumn(col, failed_rules(rules))
    for r in _frame_rules(rules):
        keys_df, small = duplicate_keys(df, r)
        out = (
            _on_keys(out, keys_df.withColumn("_dup", F.lit(True)), small, r.keys, "left")
            .withColumn(col, F.when(F.col("_dup"), F.array_append(F.col(col), _named(r))).otherwise(F.col(col)))
            .drop("_dup")
        )
    return out


def quarantine(df: DataFrame, rules: Sequence[Rule], col: str = "_failed_rules") -> tuple[DataFrame, DataFrame]:
    """Split into (clean rows, quarantined rows with the columns and names of the rules that failed).

    To write both sides in one pass use :func:`nestgate.plans.export.write_split`."""
    tagged = with_findings(df, rules, col)
    return tagged.where(F.size(col) == 0).drop(col), tagged.where(F.size(col) > 0)


# ---------------------------------------------------------------- child-table evaluation
def _child_agg(r: Rule, i: int) -> list[Column]:
    a = r.agg
    v = F.col(a.field) if a.field else None
    if a.kind in ("all",):
        return [F.bool_and(F.coalesce(a.pred(v), F.lit(True))).alias(f"_a{i}")]
    if a.kind in ("any", "any_if_any"):
        return [F.bool_or(F.coalesce(a.pred(v), F.lit(False))).alias(f"_a{i}")]
    if a.kind == "count":
        return [F.count_if(F.coalesce(a.pred(v), F.lit(False))).alias(f"_a{i}")]
    if a.kind == "min":
        return [F.min(v).alias(f"_a{i}")]
    if a.kind == "max":
        return [F.max(v).alias(f"_a{i}")]
    if a.kind == "size":
        return []
    raise ValueError(a.kind)


def _parent_outcome(r: Rule, i: int) -> Column:
    from nestgate.functions.rules import compare

    a = r.agg
    x, n = F.col(f"_a{i}"), F.coalesce(F.col("_n"), F.lit(0))
    if a.kind == "all":
        out = F.coalesce(x, F.lit(True))
    elif a.kind == "any":
        out = F.coalesce(x, F.lit(False))
    elif a.kind == "any_if_any":
        out = (n == 0) | F.coalesce(x, F.lit(False))
    elif a.kind == "count":
        out = compare(F.coalesce(x, F.lit(0)), a.op, a.bound)
    elif a.kind in ("min", "max"):
        out = compare(x, a.op, a.bound)
    else:  # size
        out = compare(n, a.op, a.bound)
    if a.when_parent is not None:
        out = ~F.coalesce(a.when_parent, F.lit(False)) | out
    return F.coalesce(out, F.lit(True))


def summary_from_children(parents: DataFrame, children: DataFrame, key: str | Sequence[str], list_col: str,
                          rules: Sequence[Rule]) -> DataFrame:
    """:func:`summary` for documents held as a parent table plus a child table.

    Equal to ``summary(parents with list_col = their children, rules)`` where
    parents without children hold an empty list, but no list is ever built:
    every rule over ``list_col`` is a decomposable aggregate (all / any /
    count / min / max / size), computed in **one** ``groupBy(key)`` over the
    child rows.  Partial aggregation runs map-side, so a key holding a third
    of all children still sends one row per task to the shuffle; the
    aggregated table (one row per key) is then joined to the parents, where
    the remaining row rules are evaluated in the same counting pass.

    Children carry the element fields as columns plus ``key``; element rules
    reading parent columns get them by joining those columns first."""
    keys = [key] if isinstance(key, str) else list(key)
    rules = _distinct_rules(rules)
    list_rules = [r for r in rules if r.level != FRAME and r.column == list_col]
    if any(r.agg is None for r in list_rules):
        missing = [r.name for r in list_rules if r.agg is None]
        raise ValueError(f"rules without an aggregate form: {missing}")
    refs = sorted({c for r in list_rules for c in r.agg.parent_refs})
    kids = children
    group = list(keys)
    if refs:
        # distinct (key, referenced parent values): duplicated parents add no child copies
        pr = parents.select(*keys, *[F.col(c).alias(f"_p_{c}") for c in refs]).distinct()
        kids = kids.join(pr, on=keys, how="inner").withColumns({c: F.col(f"_p_{c}") for c in refs})
        group += [f"_p_{c}" for c in refs]
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, r in enumerate(list_rules):
        aggs += _child_agg(r, i)
    per_key = kids.groupBy(*group).agg(*aggs)
    if refs:
        cond = [parents[k] == per_key[k] for k in keys] + [parents[c].eqNullSafe(per_key[f"_p_{c}"]) for c in refs]
        joined = parents.join(per_key, on=cond, how="left").drop(*[per_key[k] for k in keys])
    else:
        joined = parents.join(per_key, on=keys, how="left")
    other = [r for r in rules if r.level != FRAME and r.column != list_col]
    order = {(r.column, r.name): i for i, r in enumerate(rules)}
    counted = list_rules + other
    cols = [F.count_if(~_parent_outcome(r, j)).alias(f"r{j}") if j < len(list_rules)
            else F.count_if(r.failed()).alias(f"r{j}") for j, r in enumerate(counted)]
    counts = joined.agg(*cols)
    stack = ", ".join(f"{order[r.column, r.name]}L, '{_q(r.name)}', '{_q(r.column)}', '{r.level}', r{j}"
                      for j, r in enumerate(counted))
    out = counts.selectExpr(f"stack({len(counted)}, {stack}) as (rule_order, rule, column_name, level, failed)")
    out = out.withColumn("failed", F.col("failed").cast("bigint"))
    for r in _frame_rules(rules):
        out = out.unionByName(unique_violations(parents, r).select(
            F.lit(order[r.column, r.name]).cast("bigint").alias("rule_order"), F.lit(r.name).alias("rule"),
            F.lit(r.column).alias("column_name"), F.lit(r.level).alias("level"), F.col("failed")))
    return out


# ---------------------------------------------------------------- schema + rules in one call
def failing_elements_from_children(children: DataFrame, key: str | Sequence[str], list_col: str,
                                   rules: Sequence[Rule], parents: DataFrame | None = None,
                                   pos_col: str | None = None) -> DataFrame:
    """R5 for parent + child tables: ``(*key, column_name, rule, value)`` per failing child row
    (plus ``pos`` when the children carry their position in ``pos_col``).

    The same element tests as :func:`failing_elements`, evaluated in one pass
    over the child rows (each row collects the names and values of the rules
    it breaks, then one explode).  Rules comparing elements with parent
    columns need ``parents``; only the distinct (key, referenced columns) are
    joined to the children."""
    keys = [key] if isinstance(key, str) else list(key)
    el_rules = [r for r in _row_rules(rules) if r.column == list_col and r.element is not None]
    if not el_rules:
        raise ValueError("no element rules over this list")
    refs = sorted({c for r in el_rules for c in r.element.parent_refs})
    kids = children
    if refs:
        if parents is None:
            raise ValueError(f"rules read parent columns {refs}: pass parents")
        kids = kids.join(parents.select(*keys, *refs).distinct(), on=keys, how="inner")
    per_rule = []
    for r in el_rules:
        e = r.element
        v = F.col(e.field) if e.field else F.col(list_col)
        per_rule.append(F.when(~F.coalesce(e.passes(v), F.lit(True)),
                               F.struct(F.lit(r.column).alias("column_name"), F.lit(r.name).alias("rule"),
                                        F.to_json(F.array(v)).alias("value"))))
    found = F.filter(F.array(*per_rule), lambda x: x.isNotNull())
    pos = [F.col(pos_col).cast("bigint").alias("pos")] if pos_col else []
    out = kids.select(*keys, *pos, F.explode(found).alias("f"))
    return out.select(*keys, "f.column_name", "f.rule", *(["pos"] if pos_col else []), "f.value")


def nullability_rules(schema: T.StructType) -> list[Rule]:
    """V4: a ``not_null`` rule (level ``types``) for every non-nullable declared column.

    For a list of structs the rule reads one primitive field (``list.f`` is null
    exactly when the list is), so Parquet decodes one leaf, not the whole list."""
    from nestgate.functions.rules import not_null

    out = []
    for f in schema.fields:
        if f.nullable:
            continue
        probe = None
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
            leaves = [x.name for x in f.dataType.elementType.fields
                      if not isinstance(x.dataType, (T.StructType, T.ArrayType, T.MapType))]
            probe = leaves[0] if leaves else None
        out.append(not_null(f"{f.name}_not_null", f.name, probe_field=probe))
    return out


class ValidationReport:
    """Outcome of :func:`validate_frame`: the (coerced) frame, type problems, rule summary.

    ``not_evaluated``: (column, rule) pairs that could not be evaluated.  They have
    no count of failures; the report does not pass while there are any."""

    def __init__(self, frame: DataFrame, dtype_problems: list[dict], summary_df: DataFrame,
                 not_evaluated: Sequence[tuple[str, str]] = ()):
        self.frame = frame
        self.dtype_problems = dtype_problems
        self.not_evaluated = list(not_evaluated)
        self.summary = summary_df
        self._failures: list[dict] | None = None

    def failures(self) -> list[dict]:
        """Failing rules (one row per rule reaches the driver)."""
        if self._failures is None:
            self._failures = failures(self.summary)
        return self._failures

    @property
    def passed(self) -> bool:
        return not self.dtype_problems and not self.not_evaluated and not self.failures()

    def raise_if_failed(self) -> DataFrame:
        if self.dtype_problems:
            raise ValidationError([{"column_name": p["column"], "rule": f"dtype:{p['problem']}", "failed": None}
                                   for p in self.dtype_problems])
        if self.not_evaluated or self.failures():
            raise ValidationError([{"column_name": c, "rule": f"not_evaluated:{r}", "failed": None}
                                   for c, r in self.not_evaluated] + self.failures())
        return self.frame


def validate_frame(df: DataFrame, schema, rules: Sequence[Rule] = (), depth: str = "full",
                   coerce: bool = False, strict: bool = False) -> ValidationReport:
    """Declared schema plus rules, checked like a declarative schema validation.

    1. ``coerce``: columns rebuilt by name and leaves ``try_cast`` to the
       declared types (a leaf that cannot be cast becomes null and is caught by
       the nullability rules where the column is not nullable);
    2. type check on metadata: missing columns, wrong (nested) types, and with
       ``strict`` undeclared columns -- no data pass;
    3. nullability rules for every non-nullable declared column (depth ``types``);
    4. the given rules selected by ``depth`` (``types`` / ``flat`` / ``full``),
       all counted in one pass by :func:`summary`.
    Nothing is evaluated until the report is read."""
    from nestgate.functions.coerce import coerce_to_schema
    from nestgate.plans.conformance import dtype_report

    frame = coerce_to_schema(df, schema, strict=strict) if coerce else df
    problems = dtype_report(frame, schema, strict=strict)
    wrong = {p["column"] for p in problems if p["problem"] != "undeclared"}
    chosen, left = [], []
    for r in nullability_rules(schema) + select_rules(list(rules), depth):
        if r.column in wrong or not _evaluable(frame, r):
            left.append((r.column, r.name))
        else:
            chosen.append(r)
    return ValidationReport(frame, problems, summary(frame, chosen), left)


def _evaluable(frame: DataFrame, rule: Rule) -> bool:
    """Whether the frame has what the rule reads (analysis only, no data pass)."""
    from pyspark.errors import AnalysisException

    try:
        if rule.level == FRAME:
            return set(rule.keys) <= set(frame.columns)
        frame.select(rule.failed()).schema  # noqa: B018
    except AnalysisException:
        return False
    return True

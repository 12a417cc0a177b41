"""Declarative data-quality rules over flat and nested columns.

A rule is a name, the column it belongs to, and a boolean ``Column`` that is
true when a row passes.  Null outcomes pass (a null list or a null field is
judged by the separate not-null rules).  List rules address ``list.field``
paths so that Parquet reads only the referenced nested leaf.

Null semantics inside lists:
  * ``all``   ignores null outcomes (``forall`` over ``coalesce(p, true)``)
  * ``any``   treats a null outcome as false
  * ``count`` counts true outcomes only
  * ``min``   ignores null values; an empty list has no minimum and passes

Each list rule comes in up to three equivalent forms:
  * the row predicate over the nested list (lambda builders use ``forall`` /
    ``exists`` / ``filter``; the ``all_compare`` / ``any_equal`` /
    ``count_equal`` / ``no_empty_strings`` / ``no_null_elements`` / ``all_in``
    builders use array functions that compile into whole-stage code);
  * an :class:`ElementTest` for element-level findings;
  * a :class:`ListAgg`, the rule as a decomposable aggregate over child rows,
    used when documents are held as parent + child tables.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rule levels, used to select validation depth (types only / flat / full).
TYPE, FLAT, NESTED, FRAME = "type", "flat", "nested", "frame"

_OPS: dict[str, Callable[[Column, object], Column]] = {
    ">": operator.gt,
    ">=": operator.ge,
    "<": operator.lt,
    "<=": operator.le,
    "==": operator.eq,
    "!=": operator.ne,
}


def compare(value: Column, op: str, bound: object) -> Column:
    return _OPS[op](value, bound)


@dataclass(frozen=True)
class ElementTest:
    """How to find the failing elements of a list rule (element findings)."""

    list_col: str
    field: str | None
    passes: Callable[[Column], Column]  # element value -> pass predicate
    parent_refs: tuple[str, ...] = ()  # parent columns the predicate reads


@dataclass(frozen=True)
class ListAgg:
    """The same list rule as a decomposable aggregate over child rows.

    ``kind``: ``all`` / ``any`` / ``any_if_any`` (element predicate), ``count``
    (predicate, then ``op bound``), ``min`` / ``max`` (field, then ``op bound``),
    ``size`` (``op bound``).  ``parent_refs`` are parent columns the predicate
    reads; ``when_parent`` is an implication condition on the parent row."""

    kind: str
    field: str | None = None
    pred: Callable[[Column], Column] | None = None
    op: str | None = None
    bound: object = None
    parent_refs: tuple[str, ...] = ()
    when_parent: Column | None = None


@dataclass(frozen=True)
class Rule:
    name: str
    column: str
    check: Column | None  # row-level predicate, true = pass; None for frame rules
    level: str = NESTED
    element: ElementTest | None = None
    keys: tuple[str, ...] = field(default_factory=tuple)  # frame-level uniqueness
    agg: ListAgg | None = None  # aggregate form, for rules over a list column

    def passed(self) -> Column:
        """Row outcome with the null-passes convention applied."""
        if self.check is None:
            raise ValueError(f"rule {self.name} is frame-level; use validate.unique_violations")
        return F.coalesce(self.check, F.lit(True))

    def failed(self) -> Column:
        return ~self.passed()


def _path(list_col: str, fld: str | None) -> Column:
    return F.col(f"{list_col}.{fld}") if fld else F.col(list_col)


# ---------------------------------------------------------------- list rules
def all_elements(name: str, list_col: str, fld: str | None, pred: Callable[[Column], Column],
                 level: str = NESTED, parent_refs: Sequence[str] = ()) -> Rule:
    """Every element (or element field) satisfies ``pred``; nulls ignored."""
    check = F.forall(_path(list_col, fld), lambda v: F.coalesce(pred(v), F.lit(True)))
    return Rule(name, list_col, check, level, ElementTest(list_col, fld, pred, tuple(parent_refs)),
                agg=ListAgg("all", fld, pred, parent_refs=tuple(parent_refs)))


def any_element(name: str, list_col: str, fld: str | None, pred: Callable[[Column], Column],
                level: str = NESTED) -> Rule:
    """At least one element satisfies ``pred``; an empty list fails."""
    check = F.exists(_path(list_col, fld), lambda v: F.coalesce(pred(v), F.lit(False)))
    return Rule(name, list_col, check, level, agg=ListAgg("any", fld, pred))


def any_element_if_any(name: str, list_col: str, fld: str | None, pred: Callable[[Column], Column],
                       level: str = NESTED) -> Rule:
    """Guarded form: an empty list passes, otherwise like :func:`any_element`."""
    check = F.when(F.col(list_col).isNotNull(), F.size(F.col(list_col)) == 0) | F.exists(
        _path(list_col, fld), lambda v: F.coalesce(pred(v), F.lit(False)))
    return Rule(name, list_col, check, level, agg=ListAgg("any_if_any", fld, pred))


def count_elements(name: str, list_col: str, fld: str | None, pred: Callable[[Column], Column],
                   op: str, bound: int, level: str = NESTED) -> Rule:
    """Number of elements satisfying ``pred`` compared with ``bound``."""
    n = F.size(F.filter(_path(list_col, fld), lambda v: F.coalesce(pred(v), F.lit(False))))
    check = F.when(F.col(list_col).isNotNull(), compare(n, op, bound))
    return Rule(name, list_col, check, level, agg=ListAgg("count", fld, pred, op, bound))


def min_element(name: str, list_col: str, fld: str | None, op: str, bound: object,
                level: str = NESTED) -> Rule:
    """Minimum of the list (nulls ignored) compared with ``bound``; empty passes."""
    check = compare(F.array_min(_path(list_col, fld)), op, bound)
    return Rule(name, list_col, check, level,
                ElementTest(list_col, fld, lambda v: compare(v, op, bound)), agg=ListAgg("min", fld, None, op, bound))


def max_element(name: str, list_col: str, fld: str | None, op: str, bound: object,
                level: str = NESTED) -> Rule:
    check = compare(F.array_max(_path(list_col, fld)), op, bound)
    return Rule(name, list_col, check, level,
                ElementTest(list_col, fld, lambda v: compare(v, op, bound)), agg=ListAgg("max", fld, None, op, bound))


def list_size(name: str, list_col: str, op: str, bound: int, level: str = NESTED) -> Rule:
    """Length of the list compared with ``bound`` (a null list passes)."""
    # guarded: with ANSI mode off size(null) is -1, not null
    check = F.when(F.col(list_col).isNotNull(), compare(F.size(F.col(list_col)), op, bound))
    return Rule(name, list_col, check, level, agg=ListAgg("size", None, None, op, bound))


def in_set(name: str, list_col: str, fld: str | None, values: Iterable[object],
           level: str = NESTED) -> Rule:
    vals = list(values)
    return all_elements(name, list_col, fld, lambda v: v.isin(vals), level)


def starts_with(name: str, list_col: str, fld: str | None, prefix: str, level: str = NESTED) -> Rule:
    return all_elements(name, list_col, fld, lambda v: v.startswith(prefix), level)


def elements_not_null(name: str, list_col: str, fld: str | None, level: str = NESTED) -> Rule:
    return all_elements(name, list_col, fld, lambda v: v.isNotNull(), level)


def element_string_length(name: str, list_col: str, fld: str | None, min_len: int | None = None,
                          max_len: int | None = None, exact: int | None = None,
                          level: str = NESTED) -> Rule:
    """Character length of every element field within bounds (null ignored)."""
    return all_elements(name, list_col, fld, lambda v: _len_test(v, min_len, max_len, exact), level)


def elements_vs_parent(name: str, list_col: str, fld: str | None, op: str, parent_col: str,
                       level: str = NESTED) -> Rule:
    """Compare every element field with a column of the same row.

    Null on either side passes (vacuous truth on missing data)."""
    parent = F.col(parent_col)
    if op in (">", ">=", "<", "<="):
        # all(v op p), nulls ignored, empty passes  ==  min(v) op p  (or max for < / <=):
        # the aggregate form needs no join of the children with the parent column.
        kind = "min" if op in (">", ">=") else "max"
        p = _path(list_col, fld)
        check = compare(F.array_min(p) if kind == "min" else F.array_max(p), op, parent)
        return Rule(name, list_col, check, level,
                    ElementTest(list_col, fld, lambda v: compare(v, op, parent), (parent_col,)),
                    agg=ListAgg(kind, fld, None, op, parent))
    return all_elements(name, list_col, fld, lambda v: compare(v, op, parent), level, parent_refs=(parent_col,))


# -------------------------------------------------- codegen-friendly forms
# Same outcomes as the lambda builders above, written with array functions that
# compile into whole-stage code (no interpreted lambda per element).  The
# element test is kept for element-level findings.
def all_compare(name: str, list_col: str, fld: str | None, op: str, bound: object, level: str = NESTED) -> Rule:
    """Every element ``op bound`` (nulls ignored, empty passes) via array_min/array_max."""
    p = _path(list_col, fld)
    if op in (">", ">="):
        check = compare(F.array_min(p), op, bound)
    elif op in ("<", "<="):
        check = compare(F.array_max(p), op, bound)
    elif op == "==":
        check = (F.array_min(p) == bound) & (F.array_max(p) == bound)
    elif op == "!=":
        check = ~F.coalesce(F.array_contains(p, bound), F.lit(False))
    else:
        raise ValueError(op)
    return Rule(name, list_col, check, level, ElementTest(list_col, fld, lambda v: compare(v, op, bound)),
                agg=ListAgg("all", fld, lambda v: compare(v, op, bound)))


def any_equal(name: str, list_col: str, fld: str | None, value: object, level: str = NESTED) -> Rule:
    """Some element equals ``value`` (an empty list fails)."""
    p = _path(list_col, fld)
    check = F.when(F.col(list_col).isNotNull(), F.coalesce(F.array_contains(p, value), F.lit(False)))
    return Rule(name, list_col, check, level, agg=ListAgg("any", fld, lambda v: v == value))


def count_equal(name: str, list_col: str, fld: str | None, value: object, op: str, bound: int,
                level: str = NESTED) -> Rule:
    """Number of elements equal to ``value`` compared with ``bound``."""
    p = _path(list_col, fld)
    check = F.when(F.col(list_col).isNotNull(), compare(F.size(p) - F.size(F.array_remove(p, value)), op, bound))
    return Rule(name, list_col, check, level, agg=ListAgg("count", fld, lambda v: v == value, op, bound))


def no_empty_strings(name: str, list_col: str, fld: str | None, level: str = NESTED) -> Rule:
    """Every element string has at least one character (nulls ignored)."""
    p = _path(list_col, fld)
    check = F.when(F.col(list_col).isNotNull(), ~F.coalesce(F.array_contains(p, ""), F.lit(False)))
    return Rule(name, list_col, check, level, ElementTest(list_col, fld, lambda v: F.char_length(v) > 0),
                agg=ListAgg("all", fld, lambda v: F.char_length(v) > 0))


def no_null_elements(name: str, list_col: str, fld: str | None, level: str = NESTED) -> Rule:
    """No element (field) is null."""
    p = _path(list_col, fld)
    check = F.when(F.col(list_col).isNotNull(), F.size(F.array_compact(p)) == F.size(p))
    return Rule(name, list_col, check, level,
                ElementTest(list_col, fld, lambda v: v.isNotNull()), agg=ListAgg("all", fld, lambda v: v.isNotNull()))


def all_in(name: str, list_col: str, fld: str | None, values: Iterable[object], level: str = NESTED) -> Rule:
    """Every element is one of ``values`` (nulls ignored)."""
    vals = list(values)
    p = _path(list_col, fld)
    check = F.when(F.col(list_col).isNotNull(),
                   F.size(F.array_except(F.array_compact(p), F.array(*[F.lit(v) for v in vals]))) == 0)
    return Rule(name, list_col, check, level, ElementTest(list_col, fld, lambda v: v.isin(vals)),
                agg=ListAgg("all", fld, lambda v: v.isin(vals)))


# ---------------------------------------------------------------- row rules
def _len_test(v: Column, min_len: int | None, max_len: int | None, exact: int | None) -> Column:
    n = F.char_length(v)
    conds = []
    if exact is not None:
        conds.append(n == exact)
    if min_len is not None:
        conds.append(n >= min_len)
    if max_len is not None:
        conds.append(n <= max_len)
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def string_length(name: str, column: str, min_len: int | None = None, max_len: int | None = None,
                  exact: int | None = None, level: str = FLAT) -> Rule:
    return Rule(name, column, _len_test(F.col(column), min_len, max_len, exact), level)


def row_rule(name: str, column: str, expr: Column, level: str = FLAT) -> Rule:
    """Any boolean expression over the row."""
    return Rule(name, column, expr, level)


def implies(name: str, column: str, condition: Column, consequence: Column, level: str = NESTED) -> Rule:
    """``condition => consequence``; a null condition counts as not met."""
    return Rule(name, column, ~F.coalesce(condition, F.lit(False)) | consequence, level)


def implies_rule(name: str, condition: Column, rule: Rule, level: str = NESTED) -> Rule:
    """``condition => rule`` where ``rule`` is a list rule; keeps its aggregate form."""
    agg = None
    if rule.agg is not None:
        a = rule.agg
        agg = ListAgg(a.kind, a.field, a.pred, a.op, a.bound, a.parent_refs, condition)
    check = ~F.coalesce(condition, F.lit(False)) | rule.passed()
    return Rule(name, rule.column, check, level, agg=agg)


def not_null(name: str, column: str, level: str = TYPE, probe_field: str | None = None) -> Rule:
    """Nullability: the column (scalar or list) must not be null.

    Written as ``when(isNull, false)`` so the outcome is never null.  For a
    list of structs ``probe_field`` names one field: ``list.field`` is null
    exactly when the list is, and Parquet then reads that one leaf instead of
    every field of the list."""
    target = F.col(f"{column}.{probe_field}") if probe_field else F.col(column)
    return Rule(name, column, F.when(target.isNull(), F.lit(False)).otherwise(F.lit(True)), level)


def unique(name: str, *keys: str) -> Rule:
    """Frame-level uniqueness of ``keys`` (computed by a separate aggregation)."""
    return Rule(name, keys[0], None, FRAME, keys=tuple(keys))


def element_udf(name: str, list_col: str, fn: Callable[[Column], Column], level: str = NESTED) -> Rule:
    """A rule whose outcome is computed by a (pandas) UDF on the whole list."""
    return Rule(name, list_col, fn(F.col(list_col)), level)


def select_rules(rules: Sequence[Rule], depth: str) -> list[Rule]:
    """Rule subset for a validation depth: ``types``, ``flat`` or ``full``."""
    levels = {"types": {TYPE}, "flat": {TYPE, FLAT, FRAME}, "full": {TYPE, FLAT, FRAME, NESTED}}[depth]
    return [r for r in rules if r.level in levels]

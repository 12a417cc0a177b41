"""Randomised check of every list-rule builder against the documented null semantics.

``all`` ignores null outcomes, ``any`` treats them as false, ``count`` counts
true outcomes, ``min``/``max`` ignore nulls, and a null outcome passes (a null
list passes every list rule).  The child-table evaluation must agree with the
nested one when null lists are read as empty lists.
"""

import random

from pyspark.sql import functions as F

from nestgate.functions import rules as R
from nestgate.operators.nest import explode_elements
from nestgate.plans import validate as V

SCHEMA = "k bigint, xs array<struct<t:string, n:bigint>>"


def make_rows(seed=7, n=300):
    rnd = random.Random(seed)
    rows = []
    for k in range(n):
        if rnd.random() < 0.1:
            rows.append((k, None))
            continue
        xs = []
        for _ in range(rnd.randint(0, 5)):
            if rnd.random() < 0.1:
                xs.append(None)
            else:
                xs.append((rnd.choice(["a", "b", "", None]), rnd.choice([None, -3, -1, 0, 1, 2, 4, 5])))
        rows.append((k, xs))
    return rows


def py_outcome(kind, xs, fld, pred=None, op=None, bound=None):
    if xs is None:
        return None
    vals = [None if e is None else e[fld] for e in xs]
    ops = {">": lambda a, b: a > b, "<": lambda a, b: a < b, "==": lambda a, b: a == b, ">=": lambda a, b: a >= b}
    if kind == "all":
        return all(p for p in (pred(v) for v in vals) if p is not None)
    if kind == "any":
        return any(pred(v) is True for v in vals)
    if kind == "count":
        return ops[op](sum(pred(v) is True for v in vals), bound)
    if kind in ("min", "max"):
        present = [v for v in vals if v is not None]
        if not present:
            return None
        return ops[op](min(present) if kind == "min" else max(present), bound)
    if kind == "size":
        return ops[op](len(xs), bound)
    raise ValueError(kind)


def nullable(f):
    return lambda v: None if v is None else f(v)


def cases():
    return [
        (R.all_compare("n_pos", "xs", "n", ">", 0), ("all", 1, nullable(lambda v: v > 0))),
        (R.all_elements("n_pos_l", "xs", "n", lambda v: v > 0), ("all", 1, nullable(lambda v: v > 0))),
        (R.all_compare("n_small", "xs", "n", "<", 4), ("all", 1, nullable(lambda v: v < 4))),
        (R.all_compare("t_is_a", "xs", "t", "==", "a"), ("all", 0, nullable(lambda v: v == "a"))),
        (R.any_equal("has_a", "xs", "t", "a"), ("any", 0, nullable(lambda v: v == "a"))),
        (R.any_element("has_a_l", "xs", "t", lambda v: v == "a"), ("any", 0, nullable(lambda v: v == "a"))),
        (R.count_equal("one_a", "xs", "t", "a", "==", 1), ("count", 0, nullable(lambda v: v == "a"), "==", 1)),
        (R.count_elements("one_a_l", "xs", "t", lambda v: v == "a", "==", 1),
         ("count", 0, nullable(lambda v: v == "a"), "==", 1)),
        (R.min_element("min_pos", "xs", "n", ">", 0), ("min", 1, None, ">", 0)),
        (R.max_element("max_small", "xs", "n", "<", 4), ("max", 1, None, "<", 4)),
        (R.list_size("two_plus", "xs", ">", 1), ("size", 0, None, ">", 1)),
        (R.no_empty_strings("no_empty", "xs", "t"), ("all", 0, nullable(lambda v: len(v) > 0))),
        (R.element_string_length("no_empty_l", "xs", "t", min_len=1), ("all", 0, nullable(lambda v: len(v) >= 1))),
        (R.no_null_elements("t_not_null", "xs", "t"), ("all", 0, lambda v: v is not None)),
        (R.all_in("t_known", "xs", "t", ["a", "b"]), ("all", 0, nullable(lambda v: v in ("a", "b")))),
    ]


def expected_failures(rows, spec):
    kind, fld, pred, *rest = spec
    op, bound = (rest + [None, None])[:2]
    return sorted(k for k, xs in rows if py_outcome(kind, xs, fld, pred, op, bound) is False)


def test_rule_builders_follow_null_semantics(spark):
    rows = make_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    rules = [r for r, _ in cases()]
    got = {}
    for r in V.failing_rows(df, rules, "k").collect():
        got.setdefault(r["rule"], []).append(r["k"])
    for rule, spec in cases():
        assert sorted(got.get(rule.name, [])) == expected_failures(rows, spec), rule.name


def test_child_table_path_matches_nested(spark):
    rows = [(k, xs if xs is not None else []) for k, xs in make_rows(seed=11)]
    nested = spark.createDataFrame(rows, SCHEMA)
    parents = nested.select("k")
    children = explode_elements(nested, "k", "xs", pos_col=None)
    rules = [r for r, _ in cases()]
    a = {r["rule"]: r["failed"] for r in V.summary(nested, rules).collect()}
    b = {r["rule"]: r["failed"] for r in V.summary_from_children(parents, children, "k", "xs", rules).collect()}
    assert a == b
    assert children.where(F.col("t").isNull() & F.col("n").isNull()).count() > 0   # null elements were kept


def test_rules_do_not_depend_on_ansi_mode(spark):
    rows = make_rows(seed=5)
    df = spark.createDataFrame(rows, SCHEMA)
    rules = [r for r, _ in cases()]
    on = {r["rule"]: r["failed"] for r in V.summary(df, rules).collect()}
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        off = {r["rule"]: r["failed"] for r in V.summary(df, rules).collect()}
        from nestgate.plans.profile import table_profile

        prof = {r["column_name"]: r for r in table_profile(df).collect()}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert on == off
    assert prof["xs"]["n_elements"] == sum(len(xs) for _, xs in rows if xs is not None)


def test_child_table_element_findings_match_nested(spark):
    rows = [(k, xs if xs is not None else []) for k, xs in make_rows(seed=3)]
    nested = spark.createDataFrame(rows, SCHEMA).withColumn("lim", (F.col("k") % 4).cast("bigint"))
    parents = nested.select("k", "lim")
    children = explode_elements(nested, "k", "xs", pos_col="p")
    rules = [r for r, _ in cases()] + [R.elements_vs_parent("n_below_lim", "xs", "n", "<", "lim")]
    a = sorted((r["k"], r["rule"], r["pos"], r["value"]) for r in V.failing_elements(nested, rules, "k").collect())
    b = sorted((r["k"], r["rule"], r["pos"], r["value"]) for r in V.failing_elements_from_children(
        children, "k", "xs", rules, parents=parents, pos_col="p").collect())
    assert a == b and len(a) > 0

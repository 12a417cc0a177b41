"""One-bad-row study frames (F5): every rule builder on small nested frames."""

from pyspark.sql import functions as F

from nestgate.functions import rules as R
from nestgate.functions.udf_rules import min_greater_than
from nestgate.plans import collection as M
from nestgate.plans import validate as V

CONS = "id bigint, constituents array<struct<name:string, role:string, birth_year:bigint, nationality:string>>"


def failing_ids(df, rule, key="id"):
    return sorted(r[key] for r in df.where(rule.failed()).select(key).collect())


def cons_frame(spark, bad_row=None, **bad):
    rows = []
    for i in range(1, 6):
        c = {"name": f"Person {i}", "role": "Artist", "birth_year": 1800 + i, "nationality": "Northern"}
        if i == bad_row:
            c.update(bad)
        rows.append((i, [tuple(c.values())]))
    return spark.createDataFrame(rows, CONS)


def test_birth_year_positive(spark):
    df = cons_frame(spark, 3, birth_year=-50)
    assert failing_ids(df, next(r for r in M.unit_rules() if r.name == "birth_year_positive")) == [3]


def test_valid_roles(spark):
    df = cons_frame(spark, 2, role="INVALID_ROLE")
    assert failing_ids(df, next(r for r in M.unit_rules() if r.name == "valid_roles")) == [2]


def test_empty_and_null_names(spark):
    df = cons_frame(spark, 2, name="")
    assert failing_ids(df, R.element_string_length("no_empty", "constituents", "name", min_len=1)) == [2]
    nulls = cons_frame(spark, 4, name=None)
    # a null name passes the length rule; the not-null rule catches it
    assert failing_ids(nulls, R.element_string_length("no_empty", "constituents", "name", min_len=1)) == []
    assert failing_ids(nulls, next(r for r in M.unit_rules() if r.name == "name_not_null")) == [4]


def test_dimension_value_and_types(spark):
    df = spark.createDataFrame(
        [(1, [("height", 10.0, "cm")]), (2, [("height", 0.5, "cm"), ("width", 3.0, "cm")]), (3, [])],
        "id bigint, dimensions array<struct<type:string, value:double, unit:string>>")
    rule = R.min_element("all_dimension_values_gt_1", "dimensions", "value", ">", 1)
    assert failing_ids(df, rule) == [2]            # empty list has no minimum -> passes
    assert failing_ids(df, R.any_element("h", "dimensions", "type", lambda v: v == "height")) == [3]
    assert failing_ids(df, R.all_elements("cm", "dimensions", "unit", lambda v: v == "cm")) == []


def test_url_prefix_and_counts(spark):
    df = spark.createDataFrame(
        [(1, [("primary", "https://a")]), (2, [("primary", "http://b")]), (3, [("detail", "https://c")]),
         (4, [("primary", "https://d"), ("primary", "https://e")])],
        "id bigint, media array<struct<type:string, url:string>>")
    assert failing_ids(df, R.starts_with("https", "media", "url", "https://")) == [2]
    assert failing_ids(df, R.count_elements("one_primary", "media", "type", lambda v: v == "primary", "==", 1)) == [3, 4]


def test_null_field_null_list_empty_list(spark):
    df = spark.createDataFrame([(1, [("a", 1)]), (2, [(None, 2)]), (3, None), (4, [])],
                               "id bigint, items array<struct<name:string, score:bigint>>")
    assert failing_ids(df, R.elements_not_null("name_not_null", "items", "name")) == [2]
    assert failing_ids(df, R.not_null("items_not_null", "items")) == [3]
    assert failing_ids(df, R.list_size("non_empty", "items", ">", 0)) == [4]  # null list passes: nullability's job
    tags = spark.createDataFrame([(1, ["a"]), (2, [])], "id bigint, tags array<string>")
    assert failing_ids(tags, R.list_size("non_empty_list", "tags", ">", 0)) == [2]


def test_list_of_scalars_element_rules(spark):
    df = spark.createDataFrame([(1, ["ab", "cd"]), (2, ["abc"]), (3, ["ab", "ab"])], "id bigint, tags array<string>")
    assert failing_ids(df, R.element_string_length("two_chars", "tags", None, exact=2)) == [2]
    assert failing_ids(df, R.in_set("known", "tags", None, ["ab", "cd"])) == [2]
    unique_elems = R.row_rule("distinct_tags", "tags", F.size(F.array_distinct("tags")) == F.size("tags"))
    assert failing_ids(df, unique_elems) == [3]


def test_cross_column_rules(spark):
    """The department of the rule is fixed; a missing date compares with nothing."""
    df = spark.createDataFrame(
        [(10, "Sculpture", [("width", 2.0)], 1500, [1500]), (20, "Sculpture", [("width", 2.0), ("depth", 0.5)], 1500, [1499, None]),
         (30, "Toys", [], 1500, [1400, 1600]), (40, None, [("width", 2.0)], None, [9999]), (50, "Sculpture", None, 1, None)],
        "id bigint, department string, dimensions array<struct<type:string, value:double>>, date_made bigint, "
        "births array<bigint>")
    depth = next(r for r in M.cross_column_rules() if r.name == "sculpture_must_have_depth")
    assert failing_ids(df, depth) == [10]        # a null list gives no outcome
    before = R.elements_vs_parent("births_before_made", "births", None, "<", "date_made")
    assert failing_ids(df, before) == [10, 30]


def test_row_and_element_reports(spark):
    df = spark.createDataFrame([(1, [(10.0,)]), (2, [(0.5,)]), (3, [(15.0,)]), (4, [(-1.0,)]), (5, [(0.0,)])],
                               "id bigint, dims array<struct<v:double>>")
    rule = R.min_element("positive_values", "dims", "v", ">", 1)
    assert sorted(r["id"] for r in V.failing_rows(df, [rule], "id").collect()) == [2, 4, 5]
    el = spark.createDataFrame([(1, [("height", 10.0), ("width", 0.5)])],
                               "id bigint, dims array<struct<type:string, value:double>>")
    r2 = R.min_element("gt1", "dims", "value", ">", 1)
    assert [(r["pos"], r["value"]) for r in V.failing_elements(el, [r2], "id").collect()] == [(1, "[0.5]")]


def test_deep_nesting(spark):
    df = spark.createDataFrame(
        [(1, [("r1", [("a", 1), ("b", 2)])]), (2, [("r2", [("c", -3)])])],
        "id bigint, records array<struct<name:string, items array<struct<label:string, value:bigint>>>>")
    rule = R.all_elements("all_item_values_positive", "records", "items",
                          lambda items: F.forall(items, lambda it: F.coalesce(it["value"] > 0, F.lit(True))))
    assert failing_ids(df, rule) == [2]


def test_duplicate_lists_and_unique_keys(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, ["a", "b"]), (3, ["c"])], "id bigint, tags array<string>")
    uniq = R.unique("tags_unique", "tags")
    assert V.summary(df, [uniq]).first()["failed"] == 2
    assert sorted(r["id"] for r in V.failing_rows(df, [uniq], "id").collect()) == [1, 2]


def test_udf_rule_matches_builtin(spark):
    df = spark.createDataFrame([(1, [10.0, 2.0]), (2, [0.5]), (3, []), (4, None), (5, [None, 3.0]), (6, [None, 0.2]),
                                (7, [None])], "id bigint, v array<double>")
    udf_rule = R.element_udf("udf_gt1", "v", lambda c: min_greater_than(1.0)(c))
    builtin = R.min_element("gt1", "v", None, ">", 1)
    assert failing_ids(df, udf_rule) == failing_ids(df, builtin) == [2, 6]


def test_summary_depths(spark):
    df = spark.createDataFrame([(1, "", [0.5]), (1, "t", [2.0])], "id bigint, title string, v array<double>")
    rules = [R.unique("id_unique", "id"), R.string_length("title_len", "title", min_len=1),
             R.not_null("v_not_null", "v"), R.min_element("gt1", "v", None, ">", 1)]
    d = {r["depth"]: (r["n_rules"], r["failing_rules"]) for r in V.summary_by_depth(df, rules).collect()}
    assert d == {"types": (1, 0), "flat": (3, 2), "full": (4, 3)}


def test_null_struct_element(spark):
    """A null element inside a list: its fields read as null, so ``all`` rules ignore it,
    ``any`` rules do not count it, and it still counts towards the list length."""
    df = spark.createDataFrame([(1, [None, ("height", 2.0)]), (2, [None])],
                               "id bigint, dims array<struct<type:string, value:double>>")
    assert failing_ids(df, R.all_compare("gt1", "dims", "value", ">", 1)) == []
    assert failing_ids(df, R.min_element("gt1_min", "dims", "value", ">", 1)) == []
    assert failing_ids(df, R.any_equal("has_height", "dims", "type", "height")) == [2]
    assert failing_ids(df, R.list_size("non_empty", "dims", ">", 0)) == []
    assert failing_ids(df, R.no_null_elements("no_null_types", "dims", "type")) == [1, 2]


def test_fast_forms_agree_with_lambda_forms(spark):
    df = spark.createDataFrame(
        [(1, [("a", 1, "x")]), (2, [("b", -1, "")]), (3, []), (4, None), (5, [(None, None, None), ("a", 5, "y")]),
         (6, [("a", 0, "z"), ("a", 3, "w")])],
        "id bigint, xs array<struct<t:string, n:bigint, s:string>>")
    pairs = [
        (R.all_compare("c1", "xs", "n", ">", 0), R.all_elements("l1", "xs", "n", lambda v: v > 0)),
        (R.all_compare("c2", "xs", "n", ">=", 0), R.all_elements("l2", "xs", "n", lambda v: v >= 0)),
        (R.all_compare("c3", "xs", "n", "<", 4), R.all_elements("l3", "xs", "n", lambda v: v < 4)),
        (R.all_compare("c4", "xs", "t", "==", "a"), R.all_elements("l4", "xs", "t", lambda v: v == "a")),
        (R.all_compare("c5", "xs", "t", "!=", "b"), R.all_elements("l5", "xs", "t", lambda v: v != "b")),
        (R.any_equal("c6", "xs", "t", "a"), R.any_element("l6", "xs", "t", lambda v: v == "a")),
        (R.count_equal("c7", "xs", "t", "a", "==", 1),
         R.count_elements("l7", "xs", "t", lambda v: v == "a", "==", 1)),
        (R.no_empty_strings("c8", "xs", "s"), R.element_string_length("l8", "xs", "s", min_len=1)),
        (R.no_null_elements("c9", "xs", "t"), R.elements_not_null("l9", "xs", "t")),
        (R.all_in("c10", "xs", "t", ["a"]), R.in_set("l10", "xs", "t", ["a"])),
    ]
    for fast, slow in pairs:
        assert failing_ids(df, fast) == failing_ids(df, slow), fast.name


def test_child_table_summary_equals_nested(spark):
    from nestgate.operators.nest import nest_children, reattach

    parents = spark.createDataFrame(
        [(1, "F", 10), (2, "O", 20), (3, "F", 30), (3, "F", 5), (4, None, None)],
        "k bigint, status string, made bigint")
    kids = spark.createDataFrame(
        [(1, 0.5, "F", 9), (1, 3.0, "O", 11), (2, 2.0, "O", 1), (3, 4.0, "O", 29), (3, None, "F", None),
         (9, 1.0, "F", 1)],
        "k bigint, q double, st string, born bigint")
    rules = [
        R.unique("k_unique", "k"),
        R.string_length("status_len", "status", min_len=1),
        R.min_element("q_gt_1", "xs", "q", ">", 1),
        R.all_compare("q_ge_0", "xs", "q", ">=", 0),
        R.any_equal("has_f", "xs", "st", "F"),
        R.any_element_if_any("has_f_if_any", "xs", "st", lambda v: v == "F"),
        R.count_equal("one_o", "xs", "st", "O", "==", 1),
        R.list_size("non_empty", "xs", ">", 0),
        R.no_null_elements("q_not_null", "xs", "q"),
        R.all_in("st_known", "xs", "st", ["F", "O"]),
        R.elements_vs_parent("born_before_made", "xs", "born", "<", "made"),
        R.elements_vs_parent("born_is_made", "xs", "born", "==", "made"),       # join-first path
        R.implies_rule("f_has_f", F.col("status") == "F", R.any_equal("hf", "xs", "st", "F")),
    ]
    nested = reattach(parents, nest_children(kids, "k", ["q", "st", "born"], "xs"), "k")
    a = {r["rule"]: r["failed"] for r in V.summary(nested, rules).collect()}
    b = {r["rule"]: r["failed"] for r in V.summary_from_children(parents, kids, "k", "xs", rules).collect()}
    assert a == b
    assert a["born_before_made"] == 2 and a["k_unique"] == 2 and a["non_empty"] == 1


def test_empty_and_frame_only_rule_sets(spark):
    df = spark.createDataFrame([(1, [1.0]), (1, [2.0])], "id bigint, v array<double>")
    assert V.summary(df, []).count() == 0
    uniq = [R.unique("id_unique", "id")]
    assert V.summary(df, uniq).first()["failed"] == 2
    assert sorted(r["id"] for r in V.failing_rows(df, uniq, "id").collect()) == [1, 1]
    clean, bad = V.quarantine(df, uniq)
    assert clean.count() == 0 and bad.count() == 2
    V.gate(df, [])                                   # nothing to check: passes

"""Stand-in nested documents built from the driver's star-schema tables.

*object* = ``orders`` with its ``lineitem`` rows nested as ``lines``;
*terminology* = nation, region, part and supplier names with prefixed ids;
*constituents* = the ordering customer, with a nationality id.

Lists are sorted by the full element tuple (``(l_orderkey, l_linenumber)``
is not unique in the data), so every list has one deterministic order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestgate.functions import rules as R
from nestgate.operators.nest import fill_empty_list, nest_children, reattach

LINE_FIELDS = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
               "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
ORDER_FIELDS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
# SQL ORDER BY equal to the element order of ``lines``.
LINE_ORDER_SQL = ", ".join(LINE_FIELDS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def nested_lines(spark: SparkSession, sf_dir: str, keys: DataFrame | None = None) -> DataFrame:
    """``(o_orderkey, lines)`` for every order (of ``keys``) that has lines."""
    li = table(spark, sf_dir, "lineitem")
    if keys is not None:  # the lines of other orders are left out before they are nested
        li = li.join(keys.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    return nest_children(li, "l_orderkey", LINE_FIELDS, "lines").withColumnRenamed("l_orderkey", "o_orderkey")


def constituents_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(c_custkey, constituents)`` -- the customer as a one-element list."""
    cust = table(spark, sf_dir, "customer")
    person = F.struct(
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("acctbal"),
        F.concat(F.lit("N-"), F.col("c_nationkey").cast("string")).alias("nationality_id"),
    )
    return cust.select("c_custkey", F.array(person).alias("constituents"))


def nested_orders(spark: SparkSession, sf_dir: str, with_constituents: bool = False,
                  keys: DataFrame | None = None, spread: bool = False) -> DataFrame:
    """Orders as documents (those of ``keys`` where given); orders without lines carry ``[]``.

    ``spread``: for steps that take long for their bytes, in as many tasks as there are shuffle partitions;
    adaptive execution would merge them by size, and a few tasks more than cores take twice the time.
    Customer is joined to the flat orders first (cheaper than moving the
    nested documents), then the nested lines are attached by order key."""
    orders = table(spark, sf_dir, "orders").select(*ORDER_FIELDS)
    if keys is not None:
        orders = orders.join(keys, "o_orderkey", "left_semi")
    if with_constituents:
        cons = constituents_of(spark, sf_dir)
        orders = fill_empty_list(
            orders.join(cons, orders.o_custkey == cons.c_custkey, "left").drop("c_custkey"), "constituents")
    if spread:
        orders = orders.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "o_orderkey")
    return reattach(orders, nested_lines(spark, sf_dir, keys), "o_orderkey")


def terminology(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(term_id, term_type, label)`` over nation, region, part and supplier."""
    def part(name: str, prefix: str, key: str, label: str) -> DataFrame:
        return table(spark, sf_dir, name).select(
            F.concat(F.lit(prefix), F.col(key).cast("string")).alias("term_id"),
            F.lit(name).alias("term_type"),
            F.col(label).alias("label"),
        )

    return (part("nation", "N-", "n_nationkey", "n_name")
            .unionByName(part("region", "R-", "r_regionkey", "r_name"))
            .unionByName(part("part", "P-", "p_partkey", "p_name"))
            .unionByName(part("supplier", "S-", "s_suppkey", "s_name")))


TERMINOLOGY_SQL = """(
  select 'N-' || cast(n_nationkey as varchar) as term_id, 'nation' as term_type, n_name as label from nation
  union all select 'R-' || cast(r_regionkey as varchar), 'region', r_name from region
  union all select 'P-' || cast(p_partkey as varchar), 'part', p_name from part
  union all select 'S-' || cast(s_suppkey as varchar), 'supplier', s_name from supplier)"""


def line_refs(df: DataFrame) -> DataFrame:
    """Lines reduced to their ids (like classification ids): part and supplier."""
    return df.withColumn("line_refs", F.transform("lines", lambda x: F.struct(
        x["l_linenumber"].alias("l_linenumber"),
        F.concat(F.lit("P-"), x["l_partkey"].cast("string")).alias("part_id"),
        F.concat(F.lit("S-"), x["l_suppkey"].cast("string")).alias("supplier_id"),
    )))


# ---------------------------------------------------------------- stand-in rules
def order_rules() -> list[R.Rule]:
    """Stand-ins for the object rules on nested orders, in declared order."""
    return [
        R.unique("orderkey_unique", "o_orderkey"),
        R.string_length("priority_min_length_1", "o_orderpriority", min_len=1),
        R.not_null("orderdate_not_null", "o_orderdate"),
        R.min_element("all_quantities_gt_1", "lines", "l_quantity", ">", 1),
        R.any_element("has_returned_line", "lines", "l_returnflag", lambda v: v == "R"),
        R.all_elements("all_lines_open", "lines", "l_linestatus", lambda v: v == "O"),
        R.count_elements("exactly_one_first_line", "lines", "l_linenumber", lambda v: v == 1, "==", 1),
        R.list_size("has_lines", "lines", ">", 0),
        R.all_elements("discount_at_most_0_08", "lines", "l_discount", lambda v: v <= 0.08),
        R.in_set("returnflag_in_a_n", "lines", "l_returnflag", ["A", "N"]),
        R.elements_vs_parent("shipped_after_order", "lines", "l_shipdate", ">", "o_orderdate"),
        R.implies_rule("finished_order_has_finished_line", F.col("o_orderstatus") == "F",
                       R.any_element("has_finished_line", "lines", "l_linestatus", lambda v: v == "F")),
    ]


def constituent_rules() -> list[R.Rule]:
    return [
        R.starts_with("names_have_customer_prefix", "constituents", "name", "Customer#"),
        R.element_string_length("no_empty_names", "constituents", "name", min_len=1),
        R.any_element("has_building_customer", "constituents", "segment", lambda v: v == "BUILDING"),
        R.elements_not_null("no_null_nationality", "constituents", "nationality_id"),
    ]

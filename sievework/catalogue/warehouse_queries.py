"""Staging, dimensions, fact, mart and layer counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.catalogue.gate_queries import gated_lines
from sievework.catalogue.registry import LINES_SQL, line_quantities, query, table
from sievework.operators.checks import gate_balance, gate_counts, layer_mismatch, total_mismatches
from sievework.operators.gate import accepted_rows
from sievework.operators.model import (
    build_dimension,
    build_fact,
    build_mart,
    conform,
    layer_counts,
)
from sievework.schemas import declare

STAGING = declare("order_code string, line int, quantity long, flag string, shipped string")


def staged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_code"),
        F.col("l_linenumber").alias("line"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_shipdate").alias("shipped"),
    )
    return conform(lines, STAGING)


@query(
    """
    select cast(l_orderkey as varchar) as order_code, cast(l_linenumber as integer) as line,
           cast(l_quantity as bigint) as quantity, l_returnflag as flag,
           strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as shipped
    from lineitem
    """
)
def staging_cast(spark, sf_dir):
    return staged_lines(spark, sf_dir)


@query(
    """
    select md5(cast(c_custkey as varchar)) as customer_key, c_custkey, max(c_name) as c_name
    from customer group by c_custkey
    """
)
def dim_customer(spark, sf_dir):
    return build_dimension(table(spark, sf_dir, "customer"), "customer", "c_custkey", "c_name")


@query(
    """
    select md5(c_mktsegment) as segment_key, c_mktsegment, max(c_name) as c_name
    from customer group by c_mktsegment
    """
)
def dim_segment(spark, sf_dir):
    return build_dimension(table(spark, sf_dir, "customer"), "segment", "c_mktsegment", "c_name")


@query(
    "select md5(p_brand) as brand_key, p_brand, max(p_type) as p_type from part group by p_brand"
)
def dim_brand(spark, sf_dir):
    return build_dimension(table(spark, sf_dir, "part"), "brand", "p_brand", "p_type")


@query(
    """
    select md5(cast(user_id as varchar)) as user_key, user_id, max(event_type) as event_type
    from events group by user_id
    """
)
def dim_user(spark, sf_dir):
    return build_dimension(table(spark, sf_dir, "events"), "user", "user_id", "event_type")


FACT_KEY = ["l_orderkey", "l_linenumber"]


@query(
    LINES_SQL
    + """
    select md5(cast(l_orderkey as varchar) || '|' || cast(l_linenumber as varchar))
               as observation_key,
           md5(cast(l_orderkey as varchar)) as order_key, md5(l_returnflag) as flag_key,
           quantity, l_linestatus
    from accepted
    """
)
def fact_lineitem(spark, sf_dir):
    return build_fact(
        accepted_rows(gated_lines(spark, sf_dir)),
        FACT_KEY,
        {"order": "l_orderkey", "flag": "l_returnflag"},
        ["quantity", "l_linestatus"],
    )


@query(
    LINES_SQL
    + """
    select n_nationkey, n_name, o_orderstatus, cast(sum(quantity) as bigint) as total_quantity
    from accepted
    join orders on o_orderkey = l_orderkey
    join customer on c_custkey = o_custkey
    join nation on n_nationkey = c_nationkey
    group by all
    """
)
def mart_sales_by_nation(spark, sf_dir):
    """Each join sees sums per key, not order lines."""
    accepted = accepted_rows(gated_lines(spark, sf_dir))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    per_order = accepted.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("quantity").alias("quantity")
    )
    per_customer = (
        per_order.join(orders, "o_orderkey")
        .groupBy(F.col("o_custkey").alias("c_custkey"), "o_orderstatus")
        .agg(F.sum("quantity").alias("quantity"))
    )
    sales = per_customer.join(customer, "c_custkey")
    fact = build_fact(
        sales,
        ["c_custkey", "o_orderstatus"],
        {"nation": "c_nationkey"},
        ["o_orderstatus", "quantity"],
    )
    nation = build_dimension(table(spark, sf_dir, "nation"), "nation", "n_nationkey", "n_name")
    return build_mart(fact, nation, "nation_key", ["o_orderstatus"], "quantity", "total_quantity")


@query(
    """
    select 'raw' as layer, count(*) as row_count from lineitem
    union all select 'staging', count(*) from lineitem
    union all select 'fact', count(*) from lineitem
    """,
    name="layer_counts",
)
def layer_row_counts(spark, sf_dir):
    staged = staged_lines(spark, sf_dir)
    fact = build_fact(staged, ["order_code", "line"], {"flag": "flag"}, ["quantity"])
    return layer_counts(
        {"raw": table(spark, sf_dir, "lineitem"), "staging": staged, "fact": fact}
    )


@query(
    LINES_SQL
    + """
    select least(n_lines, n_accepted) as minimum_count,
           greatest(n_lines, n_accepted) as maximum_count
    from (select (select count(*) from lines) as n_lines,
                 (select count(*) from accepted) as n_accepted)
    where n_lines <> n_accepted
    """
)
def layer_reconcile(spark, sf_dir):
    """Layers that do not reconcile: the gate removed rows in between."""
    lines = line_quantities(spark, sf_dir)
    accepted = accepted_rows(gated_lines(spark, sf_dir))
    return layer_mismatch(layer_counts({"lines": lines, "accepted": accepted}))


@query(
    LINES_SQL
    + """
    select (select count(*) from lines) as input_rows,
           count(*) filter (where quality_rule is null) as accepted_rows,
           count(*) filter (where quality_rule is not null) as quarantined_rows,
           true as balanced
    from gated
    """
)
def input_equals_accepted_plus_quarantined(spark, sf_dir):
    counts = gate_counts(line_quantities(spark, sf_dir), gated_lines(spark, sf_dir))
    return gate_balance(counts)


@query(
    """
    with actual as (
        select user_id, count(*) as n from events where event_type = 'purchase' group by 1
    ),
    expected as (
        select user_id, count(*) as n from events where event_type = 'signup' group by 1
    )
    select user_id, actual.n as actual, expected.n as expected
    from actual full outer join expected using (user_id)
    where actual.n is distinct from expected.n
    """
)
def expected_totals_mismatch(spark, sf_dir):
    """Purchases per user against an expectation of one per sign-up."""

    def per_user(event_type: str) -> DataFrame:
        events = table(spark, sf_dir, "events").filter(F.col("event_type") == event_type)
        return events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))

    return total_mismatches(per_user("purchase"), per_user("signup"), ["user_id"], "n")

"""Cleaning, rules, gate, provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.catalogue.registry import (
    FAULTY_EVENTS_SQL,
    LINES_SQL,
    LOADED_AT,
    document_digests,
    faulty_events,
    line_quantities,
    query,
    table,
)
from sievework.functions.keys import row_fingerprint
from sievework.functions.text import trim_columns
from sievework.operators.compare import compare_rows
from sievework.operators.gate import (
    GateSpec,
    accepted_rows,
    conflicting_keys,
    count_outcomes,
    mark_duplicates,
    quality_gate,
    quarantined_rows,
)
from sievework.operators.model import rename_columns
from sievework.operators.provenance import RunMetadata, with_provenance
from sievework.operators.rules import (
    OUTCOME,
    classify,
    count_by_outcome,
    split,
    standard_rules,
)
from sievework.operators.skew import rows_with_keys, rows_without_keys, tasks_for

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_GATE = GateSpec(
    key=LINE_KEY, measure="quantity", order_by=["l_returnflag", "l_linestatus"]
)


def gated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gate(line_quantities(spark, sf_dir), LINE_GATE)


_COUNTS_SQL = (
    LINES_SQL
    + """
    select coalesce(quality_rule, 'accepted') as quality_rule, count(*) as n
    from gated group by 1
    """
)


@query(_COUNTS_SQL)
def gate_rule_counts(spark, sf_dir):
    return count_by_outcome(gated_lines(spark, sf_dir))


@query(_COUNTS_SQL)
def gate_outcome_counts(spark, sf_dir):
    """The same counts from sums per key."""
    return count_outcomes(line_quantities(spark, sf_dir), LINE_GATE)


@query(
    LINES_SQL
    + "select l_orderkey, l_linenumber, quantity, l_returnflag, l_linestatus from accepted"
)
def gate_accepted(spark, sf_dir):
    return accepted_rows(gated_lines(spark, sf_dir))


@query(LINES_SQL + "select * from gated where quality_rule is not null")
def gate_quarantined(spark, sf_dir):
    return quarantined_rows(gated_lines(spark, sf_dir))


def event_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hundreds of value per user, type and day."""
    return faulty_events(spark, sf_dir).select(
        "user_id",
        "event_type",
        F.col("ts").cast("date").cast("string").alias("day"),
        F.floor(F.col("value") / 100).cast("long").alias("hundreds"),
        F.hour("ts").cast("long").alias("hour_of_day"),
    )


@query(
    "with"
    + FAULTY_EVENTS_SQL
    + """,
    cleaned as (
        select user_id, trim(event_type) as event_type,
               cast(cast(ts as date) as varchar) as day,
               cast(floor(value / 100) as bigint) as hundreds,
               cast(extract(hour from ts) as bigint) as hour_of_day
        from faulty
    ),
    tagged as (
        select *, case when event_type is null or event_type = '' then 'missing_dimension'
                       when hundreds is null then 'invalid_observation'
                       when hundreds < 0 then 'negative_observation' end as row_rule
        from cleaned
    ),
    spread as (
        select user_id, event_type, day, count(distinct hundreds) as n_values
        from tagged where row_rule is null group by 1, 2, 3
    ),
    valid as (
        select tagged.*, n_values,
               row_number() over (
                   partition by tagged.user_id, tagged.event_type, tagged.day, hundreds
                   order by hour_of_day
               ) as position
        from tagged join spread using (user_id, event_type, day)
        where row_rule is null
    )
    select user_id, event_type, day, hundreds, hour_of_day, row_rule as quality_rule
    from tagged where row_rule is not null
    union all
    select user_id, event_type, day, hundreds, hour_of_day,
           case when n_values > 1 then 'conflicting_duplicate'
                when position > 1 then 'exact_duplicate' end
    from valid
    """
)
def gate_faulted_events(spark, sf_dir):
    """All five outcomes besides acceptance, on rows with missing, invalid and negative values."""
    spec = GateSpec(
        key=["user_id", "event_type", "day"], measure="hundreds", dimensions=["event_type"]
    )
    return quality_gate(event_observations(spark, sf_dir), spec)


@query(
    """
    with lines as (
        select l_returnflag, case when l_returnflag = 'R' then 0 else l_linenumber end as line,
               l_linestatus, extract(year from l_shipdate) as ship_year
        from lineitem
    ),
    spread as (select l_returnflag, count(distinct line) as n_values from lines group by 1),
    ranked as (
        select lines.*, n_values,
               row_number() over (
                   partition by lines.l_returnflag, line order by l_linestatus, ship_year
               ) as position
        from lines join spread using (l_returnflag)
    )
    select l_returnflag, l_linestatus, cast(ship_year as integer) as ship_year,
           case when n_values > 1 then 'conflicting_duplicate'
                when position > 1 then 'exact_duplicate' else 'accepted' end as quality_rule,
           count(*) as n
    from ranked group by all
    """
)
def gate_heavy_keys(spark, sf_dir):
    """Three keys with a third of all rows each, one of them free of conflicts."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        F.when(F.col("l_returnflag") == "R", 0).otherwise(F.col("l_linenumber")).alias("line"),
        "l_linestatus",
        F.year("l_shipdate").alias("ship_year"),
    )
    # the row threshold is low, so that small test tables take the way of large ones
    gated = quality_gate(
        lines, GateSpec(key=["l_returnflag"], measure="line", rules=()), heavy_rows=1000
    )
    rule = F.coalesce(F.col(OUTCOME), F.lit("accepted")).alias(OUTCOME)
    return gated.groupBy("l_returnflag", "l_linestatus", "ship_year", rule).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    LINES_SQL + "select l_orderkey, l_linenumber from spread where n_values > 1",
    name="conflicting_keys",
)
def conflicting_line_keys(spark, sf_dir):
    return conflicting_keys(line_quantities(spark, sf_dir), LINE_KEY, "quantity")


@query(
    LINES_SQL
    + """
    select lines.* from lines join spread using (l_orderkey, l_linenumber) where n_values > 1
    """
)
def conflict_rows(spark, sf_dir):
    lines = line_quantities(spark, sf_dir)
    return rows_with_keys(lines, conflicting_keys(lines, LINE_KEY, "quantity"), LINE_KEY)


@query(
    LINES_SQL
    + """
    select lines.* from lines join spread using (l_orderkey, l_linenumber) where n_values = 1
    """
)
def non_conflict_rows(spark, sf_dir):
    lines = line_quantities(spark, sf_dir)
    return rows_without_keys(lines, conflicting_keys(lines, LINE_KEY, "quantity"), LINE_KEY)


@query(
    """
    select doc_id, sha256(text) as text_sha,
           case when row_number() over (partition by text order by doc_id) > 1
                then 'exact_duplicate' end as quality_rule
    from documents
    """
)
def exact_dedup_documents(spark, sf_dir):
    # the digest of the whole text stands for it, so texts are not shuffled
    docs = document_digests(spark, sf_dir).select("doc_id", "text_sha")
    return mark_duplicates(docs, ["text_sha"], ["doc_id"])


@query(
    """
    select c_custkey as code, c_name as label, c_nationkey as area_code,
           c_acctbal as observation, c_mktsegment as segment
    from customer
    """
)
def rename_projection(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return rename_columns(
        customer, customer.columns, ["code", "label", "area_code", "observation", "segment"]
    )


@query(
    """
    select doc_id, trim('  ' || lang || ' ') as lang,
           trim(' ' || source || chr(9) || ' ') as source,
           sha256(trim(text)) as text_sha, length(trim(text)) as text_length
    from documents
    """
)
def trim_dimensions(spark, sf_dir):
    """Spaces go, a tab stays."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(F.lit("  "), "lang", F.lit(" ")).alias("lang"),
        F.concat(F.lit(" "), "source", F.lit("\t ")).alias("source"),
        "text",
    )
    return trim_columns(docs, ["lang", "source", "text"]).select(
        "doc_id",
        "lang",
        "source",
        F.sha2("text", 256).alias("text_sha"),
        F.length("text").cast("long").alias("text_length"),
    )


def _accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer with blank segments in one nation and no balance in another."""
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_nationkey") == 7, "").otherwise(F.col("c_mktsegment")).alias("segment"),
        F.when(F.col("c_nationkey") != 11, F.col("c_acctbal")).alias("balance"),
    )


_ACCOUNTS_SQL = """
    with accounts as (
        select c_custkey,
               case when c_nationkey = 7 then '' else c_mktsegment end as segment,
               case when c_nationkey <> 11 then c_acctbal end as balance
        from customer
    ),
    tagged as (
        select *, case when segment is null or segment = '' then 'missing_dimension'
                       when balance is null then 'invalid_observation'
                       when balance < 0 then 'negative_observation' end as quality_rule
        from accounts
    )
"""


@query(_ACCOUNTS_SQL + "select * from tagged")
def rule_classify(spark, sf_dir):
    return classify(_accounts(spark, sf_dir), standard_rules(["segment"], "balance"))


@query(_ACCOUNTS_SQL + "select c_custkey, segment, balance from tagged where quality_rule is null")
def valid_rows(spark, sf_dir):
    valid, _ = split(rule_classify(spark, sf_dir))
    return valid


@query(_ACCOUNTS_SQL + "select * from tagged where quality_rule is not null")
def invalid_rows(spark, sf_dir):
    _, invalid = split(rule_classify(spark, sf_dir))
    return invalid


def _order_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"),
    )


_ORDER_HASH_SQL = """
    sha256(concat_ws('||', cast(o_orderkey as varchar), cast(o_custkey as varchar), o_orderstatus,
                     cast(cast(o_totalprice as decimal(18, 2)) as varchar),
                     cast(cast(o_orderdate as date) as varchar),
                     coalesce(nullif(o_orderpriority, '5-LOW'), '<null>')))
"""


@query(
    f"select o_orderkey, {_ORDER_HASH_SQL} as record_hash from orders", name="row_fingerprint"
)
def row_fingerprints(spark, sf_dir):
    orders = _order_texts(spark, sf_dir)
    return orders.select("o_orderkey", row_fingerprint(orders.columns).alias("record_hash"))


@query(
    f"""
    select o_orderkey, 'TS009' as dataset_id, '2021' as edition, 1 as version,
           repeat('a', 64) as source_checksum, 'run-1' as pipeline_run_id,
           {_ORDER_HASH_SQL} as source_record_hash, '2026-01-01 00:00:00' as loaded_at
    from orders
    """
)
def provenance_stamp(spark, sf_dir):
    orders = _order_texts(spark, sf_dir)
    run = RunMetadata("TS009", "2021", 1, "a" * 64, "run-1", LOADED_AT)
    stamped = with_provenance(orders, run, orders.columns)
    loaded_utc = F.to_utc_timestamp("loaded_at", F.current_timezone())
    return stamped.drop(*[c for c in orders.columns if c != "o_orderkey"]).withColumn(
        "loaded_at", F.date_format(loaded_utc, "yyyy-MM-dd HH:mm:ss")
    )


@query(
    LINES_SQL
    + """
    select count(*) as n_rows,
           count(distinct sha256(concat_ws('||', cast(l_orderkey as varchar),
                 cast(l_linenumber as varchar), cast(quantity as varchar), l_returnflag,
                 l_linestatus))) as n_hashes
    from accepted
    """
)
def fingerprint_distinct(spark, sf_dir):
    accepted = accepted_rows(gated_lines(spark, sf_dir))
    hashes = accepted.select(F.unhex(row_fingerprint(accepted.columns)).alias("h"))
    # hardly any hash recurs, so all of them are held: in a number of tasks that follows their number
    dealt = hashes.repartition(tasks_for(line_quantities(spark, sf_dir).count()), "h")
    return dealt.groupBy("h").agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("n_rows"), F.count("h").alias("n_hashes")
    )


@query(
    LINES_SQL
    + """
    select 'other distribution' as comparison, count(*) as left_rows, count(*) as right_rows,
           cast(0 as bigint) as different_rows, true as same
    from gated
    union all
    select 'without duplicates', count(*),
           count(*) filter (where quality_rule is distinct from 'exact_duplicate'),
           count(*) filter (where quality_rule = 'exact_duplicate'),
           count(*) filter (where quality_rule = 'exact_duplicate') = 0
    from gated
    """
)
def partition_invariance(spark, sf_dir):
    """The gate over two distributions of the same rows, and against what differs from it."""
    lines = table(spark, sf_dir, "lineitem").select(
        *LINE_KEY,
        F.col("l_quantity").cast("long").alias("quantity"),
        "l_returnflag",
        "l_linestatus",
        "l_suppkey",
    )
    gated = quality_gate(lines.repartition("l_suppkey"), LINE_GATE).drop("l_suppkey")
    other = quality_gate(lines.repartition("l_orderkey", "l_suppkey"), LINE_GATE).drop("l_suppkey")
    fewer = other.filter(~F.col(OUTCOME).eqNullSafe("exact_duplicate"))
    same, less = compare_rows(gated, other), compare_rows(gated, fewer)
    return same.select(F.lit("other distribution").alias("comparison"), "*").unionByName(
        less.select(F.lit("without duplicates").alias("comparison"), "*")
    )

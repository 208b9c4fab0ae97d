"""Versions of tables: incremental loads, publication, histories, revisions, backfills, distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.catalogue.gate_queries import LINE_KEY, gated_lines
from sievework.catalogue.registry import LINES_SQL, query, table
from sievework.errors import AlreadyPublishedError, CommitConflictError
from sievework.operators.digests import differing_rows, same_content
from sievework.operators.distribution import distribution_mart, rollup_mismatches, with_bands
from sievework.operators.gate import accepted_rows
from sievework.operators.revisions import as_of, revision_mart, validity_windows
from sievework.plans.backfill import BackfilledLayer
from sievework.plans.incremental import KeyedTable
from sievework.plans.publication import RunLedger
from sievework.schemas import declare
from sievework.session import fresh_folder, saved

ORDER_ROWS = declare("o_orderkey long, o_custkey long, o_orderstatus string")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(*ORDER_ROWS.names)


def _second_version(orders: DataFrame) -> DataFrame:
    """One key in five is gone, one in seven corrected, and those the first version lacks are there."""
    corrected = F.when(F.col("o_orderkey") % 7 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))
    return orders.filter("o_orderkey % 5 <> 1").withColumn("o_custkey", corrected)


def loaded_orders(spark: SparkSession, sf_dir: str) -> tuple[KeyedTable, list[tuple[str, object]]]:
    """orders in a first load, a rerun, a complete second version and a batch of changes."""
    orders = _orders(spark, sf_dir)
    held = KeyedTable(spark, fresh_folder(spark, "keyed-orders"), ["o_orderkey"], ORDER_ROWS, buckets=8)
    first = orders.filter("o_orderkey % 10 <> 0")
    some = _second_version(orders).unionByName(orders.filter("o_orderkey % 5 = 1")).filter("o_orderkey % 11 = 0")
    changes = some.withColumn("o_orderstatus", F.lit("X")).withColumn("gone", F.col("o_orderkey") % 2 == 0)
    results = [
        ("first", held.load(first, 1, "run-1")),
        ("rerun", held.load(first, 1, "run-1-again")),
        ("second", held.load(_second_version(orders), 2, "run-2")),
        ("changes", held.load(changes, 3, "run-3", complete=False, removed="gone")),
    ]
    return held, results


_KEYED_SQL = """
    with v1 as (select o_orderkey, o_custkey, o_orderstatus from orders where o_orderkey % 10 <> 0),
    v2 as (
        select o_orderkey, case when o_orderkey % 7 = 0 then o_custkey + 1 else o_custkey end as o_custkey, o_orderstatus
        from orders where o_orderkey % 5 <> 1
    ),
    batch as (
        select o_orderkey, case when o_orderkey % 7 = 0 and o_orderkey % 5 <> 1 then o_custkey + 1 else o_custkey end as o_custkey,
               'X' as o_orderstatus, o_orderkey % 2 = 0 as gone
        from orders where o_orderkey % 11 = 0
    ),
    v3 as (
        select * from v2 where o_orderkey % 11 <> 0
        union all select o_orderkey, o_custkey, o_orderstatus from batch where not gone
    )
"""


@query(
    _KEYED_SQL
    + """,
    steps as (
        select 'first' as load, 'added' as change, count(*) as n from v1
        union all select 'rerun', 'unchanged', count(*) from v1
        union all select 'second', 'added', count(*) from v2 where o_orderkey % 10 = 0
        union all select 'second', 'removed', count(*) from v1 where o_orderkey % 5 = 1
        union all
        select 'second', case when v1.o_custkey <> v2.o_custkey then 'revised' else 'unchanged' end, count(*)
        from v1 join v2 using (o_orderkey) group by 2
        union all select 'changes', 'added', count(*) from batch where not gone and o_orderkey % 5 = 1
        union all select 'changes', 'revised', count(*) from batch where not gone and o_orderkey % 5 <> 1
        union all select 'changes', 'removed', count(*) from batch where gone and o_orderkey % 5 <> 1
    )
    select * from steps where n > 0
    """
)
def incremental_load(spark, sf_dir):
    """What each load of orders did, key by key, from the commits and their change feeds."""
    held, results = loaded_orders(spark, sf_dir)
    counts = []
    for name, result in results:
        feed = held.changes(result.commit) if name != "rerun" else None
        unchanged = result.changes["unchanged"]
        if feed is not None:
            counts.append(feed.groupBy("change").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("load"), "change", "n"))
        if name in ("rerun", "second") and unchanged:
            counts.append(spark.range(1).select(F.lit(name).alias("load"), F.lit("unchanged").alias("change"), F.lit(unchanged).cast("long").alias("n")))
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


@query(_KEYED_SQL + "select * from v3")
def incremental_state(spark, sf_dir):
    """The rows that the last commit names."""
    return loaded_orders(spark, sf_dir)[0].read()


@query(_KEYED_SQL + "select * from v1")
def incremental_time_travel(spark, sf_dir):
    """The rows as of the first commit, after later ones."""
    return loaded_orders(spark, sf_dir)[0].read(0)


@query(
    _KEYED_SQL
    + """
    select 'full refresh' as against, (select count(*) from v3) as left_rows, (select count(*) from v3) as right_rows, true as same
    union all
    select 'altered', (select count(*) from v3), (select count(*) from v3 where o_orderkey % 1000 <> 2),
           (select count(*) from v3 where o_orderkey % 1000 in (2, 3)) = 0
    """
)
def incremental_equals_full(spark, sf_dir):
    """The incremental state against a full refresh and against one with altered rows, by digests."""
    held, full, altered = _state_and_refresh(spark, sf_dir)
    parts = [
        same_content(held, other, ["o_orderkey"]).select(F.lit(name).alias("against"), "left_rows", "right_rows", "same")
        for name, other in (("full refresh", full), ("altered", altered))
    ]
    return parts[0].unionByName(parts[1])


def _state_and_refresh(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    held = loaded_orders(spark, sf_dir)[0].read()
    orders = _orders(spark, sf_dir)
    key = F.col("o_orderkey")
    corrected = F.when((key % 7 == 0) & (key % 5 != 1), F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))
    kept = ((key % 11 != 0) & (key % 5 != 1)) | ((key % 11 == 0) & (key % 2 == 1))
    status = F.when(key % 11 == 0, "X").otherwise(F.col("o_orderstatus"))
    full = orders.filter(kept).withColumns({"o_custkey": corrected, "o_orderstatus": status})
    altered = full.filter(key % 1000 != 2).withColumn(
        "o_custkey", F.when(key % 1000 == 3, F.lit(-1).cast("long")).otherwise(F.col("o_custkey"))
    )
    return held, full, altered


@query(
    _KEYED_SQL
    + """
    select *, 1 as left_rows, 0 as right_rows from v3 where o_orderkey % 1000 in (2, 3)
    union all
    select o_orderkey, -1, o_orderstatus, 0, 1 from v3 where o_orderkey % 1000 = 3
    """
)
def digest_differences(spark, sf_dir):
    """Rows that make the altered refresh differ, looked for in the leaves whose digests differ."""
    held, _, altered = _state_and_refresh(spark, sf_dir)
    found = differing_rows(held, altered, ["o_orderkey"])
    return found.withColumns({c: F.col(c).cast("int") for c in ("left_rows", "right_rows")})


@query(
    """
    with counts as (select o_orderstatus as edition, count(*) as n from orders group by 1)
    select edition, 'run-a' as run_id, 'claimed' as state, null::bigint as n_rows from counts
    union all select edition, 'run-a', 'published', n from counts where edition <> 'P'
    union all select edition, 'run-b', 'refused', null from counts
    union all select edition, 'run-a', 'abandoned', null from counts where edition = 'P'
    union all select edition, 'run-b', 'claimed', null from counts where edition = 'P'
    union all select edition, 'run-b', 'published', n from counts where edition = 'P'
    union all select edition, 'run-a', 'repeated', null from counts where edition <> 'P'
    union all select 'raced', 'run-c', 'refused', (select count(*) from orders)
    """
)
def publication_ledger(spark, sf_dir):
    """orders by status as editions, published by one of two runs each; the run that claims P dies.

    In the end two runs put the same commit number, after both saw the same state.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderstatus")
    ledger = RunLedger(spark, fresh_folder(spark, "run-ledger"))
    verdicts: list[tuple[str, str, str, int | None]] = []
    for edition in ("F", "O", "P"):
        count = orders.filter(F.col("o_orderstatus") == edition).count()
        if not count:
            continue
        mine = ledger.claim("ORDERS", edition, 1, "run-a", "a" * 64)
        try:
            ledger.claim("ORDERS", edition, 1, "run-b", "b" * 64)
        except AlreadyPublishedError:
            verdicts.append((edition, "run-b", "refused", None))
        if edition == "P":
            ledger.abandon(mine)
            theirs = ledger.claim("ORDERS", edition, 1, "run-b", "b" * 64)
            ledger.publish(theirs, count)
        else:
            ledger.publish(mine, count)
            if ledger.claim("ORDERS", edition, 1, "run-a", "a" * 64) is None:
                verdicts.append((edition, "run-a", "repeated", None))
    seen = ledger.log.latest()
    raced = RunLedger(spark, fresh_folder(spark, "raced-ledger"))
    raced.log.put(seen + 1, {"run_id": "run-b"})
    try:
        raced.log.put(seen + 1, {"run_id": "run-c"})
    except CommitConflictError:
        verdicts.append(("raced", "run-c", "refused", orders.count()))
    steps = ledger.history().select("edition", "run_id", "state", "n_rows")
    return steps.unionByName(spark.createDataFrame(verdicts, "edition string, run_id string, state string, n_rows long"))


def _customer_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer in six versions that arrive out of order; keys are absent from some, segments change in some."""
    arrived = F.explode(F.array(*map(F.lit, (2, 1, 6, 3, 5, 4)))).alias("version")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", arrived)
    segment = F.when((F.col("c_custkey") + F.col("version")) % 4 == 0, "OTHER").otherwise(F.col("c_mktsegment"))
    return rows.filter((F.col("c_custkey") * 3 + F.col("version")) % 11 != 0).withColumn("c_mktsegment", segment)


_HISTORY_SQL = """
    with observed as (
        select c_custkey, version, case when (c_custkey + version) % 4 = 0 then 'OTHER' else c_mktsegment end as c_mktsegment
        from customer, (select unnest(range(1, 7)) as version)
        where (c_custkey * 3 + version) % 11 <> 0
    ),
    marked as (
        select *, case when lag(version) over w = version - 1 and lag(c_mktsegment) over w = c_mktsegment then 0 else 1 end as starts
        from observed window w as (partition by c_custkey order by version)
    ),
    islands as (select *, sum(starts) over (partition by c_custkey order by version) as island from marked),
    history as (
        select c_custkey, any_value(c_mktsegment) as c_mktsegment, cast(min(version) as integer) as valid_from,
               cast(case when max(version) < 6 then max(version) + 1 end as integer) as valid_to
        from islands group by c_custkey, island
    )
"""


@query(_HISTORY_SQL + "select * from history")
def revision_history(spark, sf_dir):
    return validity_windows(_customer_versions(spark, sf_dir), ["c_custkey"], ["c_mktsegment"], "version")


@query(
    _HISTORY_SQL
    + """
    select o_orderkey, o_custkey as c_custkey, cast(1 + o_orderkey % 7 as integer) as version, c_mktsegment
    from orders left join history
      on c_custkey = o_custkey and valid_from <= 1 + o_orderkey % 7 and (valid_to is null or 1 + o_orderkey % 7 < valid_to)
    """
)
def as_of_lookup(spark, sf_dir):
    """The segment of each order's customer as of the order's version; version 7 is after the last one known."""
    history = saved(revision_history(spark, sf_dir), "history")
    probes = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("c_custkey"), (F.col("o_orderkey") % 7 + 1).cast("int").alias("version")
    )
    return as_of(history, probes, ["c_custkey"], "version")


@query(
    LINES_SQL
    + """,
    v1 as (select * from accepted where l_orderkey % 17 <> 0),
    v2 as (
        select l_orderkey, l_linenumber, l_returnflag, quantity + case when l_orderkey % 7 = 0 then l_linenumber - 3 else 0 end as quantity
        from accepted where l_orderkey % 13 <> 0
    )
    select case when v2.l_orderkey is null then v1.l_returnflag else v2.l_returnflag end as l_returnflag,
           case when v1.l_orderkey is null then 'added' when v2.l_orderkey is null then 'removed'
                when v1.quantity <> v2.quantity then 'revised' else 'unchanged' end as change,
           count(*) as n_keys, cast(coalesce(sum(v1.quantity), 0) as bigint) as old_total,
           cast(coalesce(sum(v2.quantity), 0) as bigint) as new_total,
           cast(sum(coalesce(v2.quantity, 0) - coalesce(v1.quantity, 0)) as bigint) as delta
    from v1 full outer join v2 on v1.l_orderkey = v2.l_orderkey and v1.l_linenumber = v2.l_linenumber
    group by 1, 2
    """,
    name="revision_mart",
)
def revision_mart_of_lines(spark, sf_dir):
    """Accepted order lines in two versions: added, removed and revised quantities per return flag."""
    lines = accepted_rows(gated_lines(spark, sf_dir)).select(*LINE_KEY, "l_returnflag", "quantity")
    step = F.when(F.col("l_orderkey") % 7 == 0, F.col("l_linenumber") - 3).otherwise(0)
    new = lines.filter("l_orderkey % 13 <> 0").withColumn("quantity", F.col("quantity") + step)
    return revision_mart(lines.filter("l_orderkey % 17 <> 0"), new, LINE_KEY, ["l_returnflag"], "quantity")


_LAYER = declare("n_lines long, quantity long, year int")


def _yearly_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("year"), (F.col("l_orderkey") % 3).cast("int").alias("version"), "l_orderkey", "l_linenumber",
        F.col("l_quantity").cast("long").alias("quantity"),
    )


def backfilled_years(spark: SparkSession, sf_dir: str) -> tuple[BackfilledLayer, list[DataFrame]]:
    """Two versions, then a late one for the years from 1996 on, then nothing new."""
    def build(rows: DataFrame) -> DataFrame:
        return rows.groupBy("year").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("quantity").alias("quantity"))

    layer = BackfilledLayer(spark, fresh_folder(spark, "yearly"), "year", "version", build, _LAYER)
    lines = _yearly_lines(spark, sf_dir)
    late = lines.filter("version < 2 or year >= 1996")
    return layer, [layer.refresh(lines.filter("version < 2"), "run-1"), layer.refresh(late, "run-2"), layer.refresh(late, "run-3")]


@query(
    """
    with lines as (select year(l_shipdate) as year, l_orderkey % 3 as version from lineitem)
    select 'run-1' as run_id, cast(year as varchar) as partition, string_agg(distinct version::varchar, ',' order by version::varchar) as versions
    from lines where version < 2 group by 2
    union all
    select 'run-2', cast(year as varchar), '2' from lines where version = 2 and year >= 1996 group by 2
    """
)
def backfill_versions(spark, sf_dir):
    """Which years each refresh rebuilt, and the versions that made them stale."""
    _, refreshed = backfilled_years(spark, sf_dir)
    runs = [
        stale.select(F.lit(f"run-{i}").alias("run_id"), "partition", F.array_join("versions", ",").alias("versions"))
        for i, stale in enumerate(refreshed, 1)
    ]
    return runs[0].unionByName(runs[1]).unionByName(runs[2])


@query(
    """
    select year(l_shipdate)::integer as year, count(*) as n_lines, cast(sum(cast(l_quantity as bigint)) as bigint) as quantity
    from lineitem where l_orderkey % 3 < 2 or year(l_shipdate) >= 1996 group by 1
    """
)
def backfilled_layer(spark, sf_dir):
    return backfilled_years(spark, sf_dir)[0].read()


# Bands of line numbers, which stand for ages here.
_BANDS = {"young": (None, 2), "middle": (3, 5), "old": (6, None)}
_LEVELS = {
    "total": [],
    "area": ["l_linestatus"],
    "area_age": ["l_linestatus", "age"],
    "area_sex": ["l_linestatus", "l_returnflag"],
    "area_age_sex": ["l_linestatus", "age", "l_returnflag"],
}


def line_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of order lines by status (area), band of line numbers (age) and return flag (sex)."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_linestatus", "l_returnflag", "l_linenumber", F.floor("l_extendedprice").cast("long").alias("price")
    )
    banded = with_bands(lines, "l_linenumber", _BANDS, "age")
    return distribution_mart(banded, _LEVELS, "price", {"median": 0.5, "p95": 0.95})


_DISTRIBUTION_SQL = """
    with lines as (
        select l_linestatus, l_returnflag, case when l_linenumber <= 2 then 'young' when l_linenumber <= 5 then 'middle' else 'old' end as age,
               cast(floor(l_extendedprice) as bigint) as price
        from lineitem
    ),
    classed as (
        select *, case when price < 16 then price else (price >> (length(bin(price)) - 4)) << (length(bin(price)) - 4) end as class
        from lines
    ),
    grouped as (
        select grouping(l_linestatus) as no_area, grouping(age) as no_age, grouping(l_returnflag) as no_sex, l_linestatus, age, l_returnflag,
               count(*) as n_rows, cast(sum(price) as bigint) as total, min(price) as minimum, max(price) as maximum,
               list_sort(list(class)) as classes
        from classed
        group by grouping sets ((), (l_linestatus), (l_linestatus, age), (l_linestatus, l_returnflag), (l_linestatus, age, l_returnflag))
    )
    select case when no_area = 1 then 'total' when no_age = 1 and no_sex = 1 then 'area' when no_sex = 1 then 'area_age'
                when no_age = 1 then 'area_sex' else 'area_age_sex' end as level,
           l_linestatus, age, l_returnflag, n_rows, total, minimum, maximum,
           cast(classes[cast(ceil(n_rows * 0.5) as bigint)] as bigint) as median,
           cast(classes[cast(ceil(n_rows * 0.95::double) as bigint)] as bigint) as p95
    from grouped
"""


@query(_DISTRIBUTION_SQL, name="distribution_mart")
def distribution_of_lines(spark, sf_dir):
    return line_distribution(spark, sf_dir).withColumn("total", F.col("total").cast("long"))


@query(
    f"""
    with mart as ({_DISTRIBUTION_SQL})
    select 'total from area' as reconciled, count(*) as whole_groups, 0 as mismatches from mart where level = 'total'
    union all select 'area from area_age', count(*), 0 from mart where level = 'area'
    union all select 'area from area_sex', count(*), 0 from mart where level = 'area'
    union all select 'area_age from area_age_sex', count(*), 0 from mart where level = 'area_age'
    union all select 'area from broken', count(*), count(*) from mart where level = 'area'
    """
)
def distribution_reconcile(spark, sf_dir):
    """Levels against the sums of finer ones; the last pair leaves out a return flag, so no group agrees."""
    mart = saved(line_distribution(spark, sf_dir), "distribution")
    lost = mart.filter("level = 'area_sex' and l_returnflag <> 'R'").withColumn("level", F.lit("broken"))
    pairs = [("area", "total", []), ("area_age", "area", ["l_linestatus"]), ("area_sex", "area", ["l_linestatus"]),
             ("area_age_sex", "area_age", ["l_linestatus", "age"]), ("broken", "area", ["l_linestatus"])]
    both = mart.unionByName(lost).withColumn("all", F.lit(0))
    out = None
    for parts, whole, by in pairs:
        groups = mart.filter(F.col("level") == whole).select(F.lit(1).alias("g"), F.lit(0).alias("w"))
        wrong = rollup_mismatches(both, parts, whole, ["all", *by]).select(F.lit(0).alias("g"), F.lit(1).alias("w"))
        row = groups.unionAll(wrong).agg(F.sum("g").alias("whole_groups"), F.sum("w").alias("mismatches"))
        row = row.select(F.lit(f"{whole} from {parts}").alias("reconciled"), "whole_groups", "mismatches")
        out = row if out is None else out.unionByName(row)
    return out

"""Registration of catalogue queries and inputs they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.session import fresh_folder
from sievework.sinks.parquet import save_layer

Query = Callable[[SparkSession, str], DataFrame]

# When the catalogue says its rows were loaded: fixed, so that runs agree with their SQL.
LOADED_AT = "2026-01-01 00:00:00+00:00"

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own or a given name, with the equivalent SQL if there is one."""

    def register(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key] = function
        if sql:
            ORACLES[key] = sql.strip()
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def line_quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as observations: integral quantity per order line."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").cast("long").alias("quantity"),
        "l_returnflag",
        "l_linestatus",
    )


# the same, gated: every line with its outcome, NULL meaning accepted
LINES_SQL = """
    with lines as (
        select l_orderkey, l_linenumber, cast(l_quantity as bigint) as quantity,
               l_returnflag, l_linestatus
        from lineitem
    ),
    spread as (
        select l_orderkey, l_linenumber, count(distinct quantity) as n_values
        from lines group by 1, 2
    ),
    ranked as (
        select lines.*, n_values,
               row_number() over (
                   partition by lines.l_orderkey, lines.l_linenumber, quantity
                   order by l_returnflag, l_linestatus
               ) as position
        from lines join spread using (l_orderkey, l_linenumber)
    ),
    gated as (
        select l_orderkey, l_linenumber, quantity, l_returnflag, l_linestatus,
               case when n_values > 1 then 'conflicting_duplicate'
                    when position > 1 then 'exact_duplicate' end as quality_rule
        from ranked
    ),
    accepted as (select * from gated where quality_rule is null)
"""


def document_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with the digest of the whole text in place of the text.

    Saved, so that operators with several passes read and hash the texts once.
    """
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "n_chars", F.sha2("text", 256).alias("text_sha")
    )
    return save_layer(docs, fresh_folder(spark, "digests"))


def faulty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with blank or no type, no or negative value, where the payload number says so."""
    number = F.get_json_object("props", "$.k").cast("int")
    events = table(spark, sf_dir, "events").withColumn("k", number)
    k = F.col("k")
    return events.select(
        "event_id",
        "ts",
        "user_id",
        F.when(k == 13, F.lit("  "))
        .when(k == 14, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(" "), "event_type", F.lit("  ")))
        .alias("event_type"),
        F.when(k == 29, F.lit(None).cast("double"))
        .when(k == 47, -F.col("value"))
        .otherwise(F.col("value"))
        .alias("value"),
        "props",
    )


FAULTY_EVENTS_SQL = """
    faulty as (
        select event_id, ts, user_id,
               case when k = 13 then '  ' when k = 14 then null
                    else ' ' || event_type || '  ' end as event_type,
               case when k = 29 then null when k = 47 then -value else value end as value,
               props
        from (select *, cast(json_extract_string(props, '$.k') as integer) as k from events)
    )
"""

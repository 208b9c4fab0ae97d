"""Queries that write to the shared folder and return what is read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.catalogue.gate_queries import LINE_GATE, LINE_KEY, gated_lines
from sievework.catalogue.landing_queries import MANIFEST_SQL, page_manifest
from sievework.catalogue.registry import (
    FAULTY_EVENTS_SQL,
    LINES_SQL,
    LOADED_AT,
    faulty_events,
    line_quantities,
    query,
    table,
)
from sievework.operators.checks import gate_counts
from sievework.operators.model import build_dimension
from sievework.operators.provenance import RunMetadata
from sievework.operators.rules import classify, count_by_outcome, standard_rules
from sievework.errors import SchemaContractError
from sievework.plans import census
from sievework.plans.warehouse import Layers, ModelSpec, build_layers
from sievework.schemas import declare
from sievework.session import fresh_folder
from sievework.sinks.parquet import write_gate_result
from sievework.sinks.reports import SUMMARY_SCHEMA, run_summary, write_json
from sievework.sinks.tables import materialize
from sievework.sources.delimited import read_delimited
from sievework.sources.documents import read_json_objects
from sievework.sources.tables import read_table

CUSTOMER = declare(
    "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
)


@query("select * from customer")
def csv_typed_scan(spark, sf_dir):
    """customer through a delimited file with a declared header and types."""
    path = fresh_folder(spark, "customer-csv")
    table(spark, sf_dir, "customer").write.option("header", True).csv(path)
    return read_delimited(spark, path, CUSTOMER)


@query(
    """
    select 'declared' as header, 'accepted' as verdict, count(*) as n from customer
    union all select 'other order', 'refused', 0
    union all select 'one more', 'refused', 0
    """
)
def header_gate(spark, sf_dir):
    """customer in files with the declared header and with two that differ from it."""
    rows = table(spark, sf_dir, "customer").select(*CUSTOMER.names)
    headers = {
        "declared": rows,
        "other order": rows.select(*CUSTOMER.names[::-1]),
        "one more": rows.withColumn("extra", F.lit(1)),
    }
    verdicts = []
    for name, frame in headers.items():
        path = fresh_folder(spark, "customer-csv")
        frame.write.option("header", True).csv(path)
        try:
            read, verdict = read_delimited(spark, path, CUSTOMER), "accepted"
        except SchemaContractError:
            read, verdict = rows.limit(0), "refused"
        count = read.agg(F.count(F.lit(1)).alias("n"))
        verdicts.append(count.select(F.lit(name).alias("header"), F.lit(verdict).alias("verdict"), "n"))
    return verdicts[0].unionByName(verdicts[1]).unionByName(verdicts[2])


@query(
    """
    select o_orderpriority as geography_label, cast(o_orderkey as varchar) as geography_code,
           'all' as age_label, '0' as age_code, o_orderstatus as sex_label, o_orderstatus as sex_code,
           cast(o_custkey as bigint) as observation, 'TS009' as dataset_id, '2021' as edition,
           1 as version, repeat('a', 64) as source_checksum, 'run-1' as pipeline_run_id,
           sha256(cast(o_orderkey as varchar)) as source_record_hash, '2026-01-01 00:00:00' as loaded_at
    from orders
    """
)
def seed_scan(spark, sf_dir):
    """orders as a stamped extract in a file, read back with its 14 types."""
    key = F.col("o_orderkey").cast("string")
    values = [
        "o_orderpriority", key, F.lit("all"), F.lit("0"), "o_orderstatus", "o_orderstatus",
        F.col("o_custkey").cast("long"), F.lit("TS009"), F.lit("2021"), F.lit(1), F.lit("a" * 64),
        F.lit("run-1"), F.sha2(key, 256), F.lit("2026-01-01 00:00:00"),
    ]
    columns = [F.col(v) if isinstance(v, str) else v for v in values]
    path = fresh_folder(spark, "seed-csv")
    stamped = [c.alias(n) for c, n in zip(columns, census.SEED_SCHEMA.names)]
    table(spark, sf_dir, "orders").select(*stamped).write.option("header", True).csv(path)
    read = census.read_seed(spark, path)
    return read.withColumn("loaded_at", F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss"))


@query(
    "with"
    + FAULTY_EVENTS_SQL
    + """,
    typed as (
        select coalesce(trim(event_type), '') as event_type,
               case when trim(event_type) <> 'click' and value is not null
                    then cast(trunc(value) as bigint) end as amount
        from faulty
    )
    select case when event_type = '' then 'missing_dimension'
                when amount is null then 'invalid_observation'
                when amount < 0 then 'negative_observation' else 'accepted' end as quality_rule,
           count(*) as n
    from typed group by 1
    """
)
def csv_malformed_measure(spark, sf_dir):
    """Clicks carry a fraction where an integer is declared: NULL, not an error."""
    path = fresh_folder(spark, "events-csv")
    whole = F.col("value").cast("long").cast("string")
    faulty_events(spark, sf_dir).select(
        F.trim("event_type").alias("event_type"),
        F.when(F.trim("event_type") == "click", F.concat(whole, F.lit(".5")))
        .otherwise(whole)
        .alias("amount"),
    ).write.option("header", True).csv(path)
    scanned = read_delimited(spark, path, declare("event_type string, amount long"))
    return count_by_outcome(classify(scanned, standard_rules(["event_type"], "amount")))


RUN = RunMetadata("LINES", "1998", 3, "a" * 64, "run-2", LOADED_AT)

LINE_MODEL = ModelSpec(
    gate=LINE_GATE,
    hash_columns=(*LINE_KEY, "quantity", "l_returnflag", "l_linestatus"),
    staging=declare(
        "dataset_id string, edition string, version int, l_orderkey long, l_linenumber int, "
        "quantity long, l_returnflag string, l_linestatus string, source_record_hash string"
    ),
    dimensions={
        "line": ("l_linenumber", "l_linestatus"),
        "flag": ("l_returnflag", "l_linestatus"),
    },
    fact_key=("dataset_id", "edition", "version", *LINE_KEY),
    fact_columns=("dataset_id", "edition", "version", "quantity", "source_record_hash"),
    mart_dimension="flag",
    mart_group=("dataset_id", "edition", "version"),
    measure="quantity",
    total="total_quantity",
)


def line_layers(spark: SparkSession, sf_dir: str) -> Layers:
    return build_layers(
        line_quantities(spark, sf_dir), LINE_MODEL, RUN, fresh_folder(spark, "layers")
    )


@query(
    LINES_SQL
    + """
    select 'raw' as layer, count(*) as row_count from accepted
    union all select 'staging', count(*) from accepted
    union all select 'fact', count(*) from accepted
    """
)
def saved_layers(spark, sf_dir):
    return line_layers(spark, sf_dir).audit


@query(
    LINES_SQL
    + """
    select l_returnflag, (select max(l_linestatus) from accepted a
                          where a.l_returnflag = accepted.l_returnflag) as l_linestatus,
           'LINES' as dataset_id, '1998' as edition, 3 as version,
           cast(sum(quantity) as bigint) as total_quantity
    from accepted group by l_returnflag
    """
)
def saved_mart(spark, sf_dir):
    return line_layers(spark, sf_dir).mart


def _written(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    out = fresh_folder(spark, "gate-result")
    gated = gated_lines(spark, sf_dir)
    return write_gate_result(
        gated, RUN, f"{out}/accepted", f"{out}/quarantined", hash_columns=LINE_MODEL.hash_columns
    )


_STAMP_SQL = """'LINES' as dataset_id, '1998' as edition, 3 as version,
           sha256(concat_ws('||', cast(l_orderkey as varchar), cast(l_linenumber as varchar),
                            cast(quantity as varchar), l_returnflag, l_linestatus))
               as source_record_hash"""
_STAMP = ("dataset_id", "edition", "version", "source_record_hash")


@query(LINES_SQL + f"select accepted.* exclude (quality_rule), {_STAMP_SQL} from accepted")
def sink_roundtrip_accepted(spark, sf_dir):
    accepted, _ = _written(spark, sf_dir)
    return accepted.select(*LINE_KEY, "quantity", "l_returnflag", "l_linestatus", *_STAMP)


@query(LINES_SQL + f"select *, {_STAMP_SQL} from gated where quality_rule is not null")
def sink_roundtrip_quarantined(spark, sf_dir):
    _, quarantined = _written(spark, sf_dir)
    columns = (*LINE_KEY, "quantity", "l_returnflag", "l_linestatus", "quality_rule", *_STAMP)
    return quarantined.select(*columns)


@query(
    LINES_SQL
    + """
    select 'run-2' as pipeline_run_id, 'LINES' as dataset_id, '1998' as edition, 3 as version,
           count(*) as input_rows, count(*) filter (where quality_rule is null) as accepted_rows,
           count(*) filter (where quality_rule is not null) as quarantined_rows
    from gated
    """
)
def summary_roundtrip(spark, sf_dir):
    path = fresh_folder(spark, "summary")
    counts = gate_counts(line_quantities(spark, sf_dir), gated_lines(spark, sf_dir))
    write_json(run_summary(counts, RUN), path)
    return read_json_objects(spark, path, SUMMARY_SCHEMA)


@query(MANIFEST_SQL)
def manifest_roundtrip(spark, sf_dir):
    manifest = page_manifest(spark, sf_dir)
    path = fresh_folder(spark, "manifest")
    write_json(manifest, path)
    return (
        spark.read.schema(manifest.schema)
        .json(path)
        .withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"))
    )


@query(
    "select md5(p_type) as type_key, p_type, max(p_brand) as p_brand from part group by p_type"
)
def materialized_view(spark, sf_dir):
    dimension = build_dimension(table(spark, sf_dir, "part"), "type", "p_type", "p_brand")
    materialize(dimension, "sievework_dim_type")
    return read_table(spark, "sievework_dim_type")

"""Table checks, contracts and constraints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.catalogue.registry import FAULTY_EVENTS_SQL, faulty_events, query, table
from sievework.operators.checks import (
    Check,
    Finds,
    NotNull,
    Related,
    Unique,
    negative_rows,
    null_counts,
    orphan_keys,
    orphan_rows,
    repeated_values,
    run_checks,
    source_freshness,
    summarize_results,
)
from sievework.operators.contracts import (
    ARTIFACT_KINDS,
    SHA256_PATTERN,
    at_least,
    constraint_violations,
    contract_drift,
    matches,
    metadata_drift,
    one_of,
    optional,
    unknown_fields,
)
from sievework.schemas import declare


@query("select * from supplier where s_acctbal < 0")
def negative_measure_rows(spark, sf_dir):
    return negative_rows(table(spark, sf_dir, "supplier"), "s_acctbal")


@query(
    "with"
    + FAULTY_EVENTS_SQL
    + """
    select 'event_id' as "column", count(*) - count(event_id) as failures from faulty
    union all select 'user_id', count(*) - count(user_id) from faulty
    union all select 'event_type', count(*) - count(event_type) from faulty
    union all select 'value', count(*) - count(value) from faulty
    """
)
def not_null_profile(spark, sf_dir):
    columns = ["event_id", "user_id", "event_type", "value"]
    return null_counts(faulty_events(spark, sf_dir), columns)


@query(
    """
    select sha256(text) as text_sha, count(*) as n from documents group by 1 having count(*) > 1
    """
)
def unique_violations(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("text_sha"))
    return repeated_values(docs, "text_sha")


@query(
    """
    select conv_id, count(*) as n from conversations
    where role = 'user' group by 1 having count(*) > 1
    """
)
def conversations_with_several_questions(spark, sf_dir):
    questions = table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    return repeated_values(questions, "conv_id")


@query("select conv_id, turn, count(*) as n from conversations group by 1, 2 having count(*) > 1")
def repeated_turns(spark, sf_dir):
    """A key of two columns over all rows."""
    return repeated_values(table(spark, sf_dir, "conversations"), ["conv_id", "turn"])


@query(
    """
    select doc_id, count(*) as n from documents
    where doc_id not in (select doc_id from labels) group by 1
    """
)
def orphans_documents_without_label(spark, sf_dir):
    return orphan_keys(
        table(spark, sf_dir, "documents"), "doc_id", table(spark, sf_dir, "labels"), "doc_id"
    )


@query(
    """
    select l_orderkey, l_linenumber, l_suppkey from lineitem
    where l_orderkey not in (select o_orderkey from orders where o_orderstatus <> 'P')
    """
)
def orphan_lines(spark, sf_dir):
    """Lines of orders that are not in the set of settled orders."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    settled = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "P")
    return orphan_rows(lines, "l_orderkey", settled, "o_orderkey")


SUITE: list[Check] = [
    NotNull("orders", ["o_orderkey", "o_custkey", "o_totalprice"]),
    NotNull("events", ["event_type", "value"]),
    Unique("orders", "o_orderkey"),
    Unique("orders", "o_custkey"),
    Unique("customer", "c_custkey"),
    Related("orders", "o_custkey", "customer", "c_custkey"),
    Related("documents", "doc_id", "labels", "doc_id"),
    Finds("no_negative", "customer", lambda t: negative_rows(t["customer"], "c_acctbal")),
]


def suite_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("orders", "customer", "documents", "labels")
    tables = {name: table(spark, sf_dir, name) for name in names}
    return run_checks({**tables, "events": faulty_events(spark, sf_dir)}, SUITE)


SUITE_SQL = (
    "with"
    + FAULTY_EVENTS_SQL
    + """,
    repeated as (
        select 'o_orderkey' as c, count(*) as n
        from (select 1 from orders group by o_orderkey having count(*) > 1)
        union all
        select 'o_custkey', count(*)
        from (select 1 from orders group by o_custkey having count(*) > 1)
        union all
        select 'c_custkey', count(*)
        from (select 1 from customer group by c_custkey having count(*) > 1)
    ),
    found as (
        select 'not_null' as "check", 'orders' as target, 'o_orderkey' as "column",
               count(*) - count(o_orderkey) as failures from orders
        union all
        select 'not_null', 'orders', 'o_custkey', count(*) - count(o_custkey) from orders
        union all
        select 'not_null', 'orders', 'o_totalprice', count(*) - count(o_totalprice) from orders
        union all
        select 'not_null', 'events', 'event_type', count(*) - count(event_type) from faulty
        union all
        select 'not_null', 'events', 'value', count(*) - count(value) from faulty
        union all
        select 'unique', case when c = 'c_custkey' then 'customer' else 'orders' end, c, n
        from repeated
        union all
        select 'relationships', 'orders', 'o_custkey', count(*) from orders
        where o_custkey not in (select c_custkey from customer)
        union all
        select 'relationships', 'documents', 'doc_id', count(*) from documents
        where doc_id not in (select doc_id from labels)
        union all
        select 'no_negative', 'customer', null, count(*) from customer where c_acctbal < 0
    ),
    results as (
        select *, case when failures = 0 then 'pass' else 'fail' end as status from found
    )
"""
)


@query(SUITE_SQL + "select * from results")
def check_suite(spark, sf_dir):
    return suite_results(spark, sf_dir)


@query(
    SUITE_SQL
    + """
    select count(*) as executed, count(*) filter (where status = 'pass') as passed,
           count(*) filter (where status = 'fail') as failed
    from results
    """
)
def check_suite_summary(spark, sf_dir):
    return summarize_results(suite_results(spark, sf_dir))


@query(
    """
    with ages as (
        select max(ts) as latest,
               (epoch_us(timestamp '2024-03-01 00:00:00') - epoch_us(max(ts))) / 86400000000.0
                   as age_days
        from events
    )
    select strftime(latest, '%Y-%m-%d %H:%M:%S') as latest, cast(age_days as double) as age_days,
           case when age_days > 60 then 'error' when age_days > 20 then 'warn' else 'pass' end
               as status
    from ages
    """,
    name="source_freshness",
)
def source_age(spark, sf_dir):
    result = source_freshness(
        table(spark, sf_dir, "events"), "ts", "2024-03-01 00:00:00", warn_days=20, error_days=60
    )
    return result.withColumn("latest", F.date_format("latest", "yyyy-MM-dd HH:mm:ss"))


EVENT_CONTRACT = declare(
    "event_id long!, user_id long!, ts timestamp!, event_type string!, value double!, props long, "
    "session string"
)


@query(
    "with"
    + FAULTY_EVENTS_SQL
    + """,
    counts as (
        select count(*) as n, count(*) filter (where event_type is null) as no_type,
               count(*) filter (where value is null) as no_value,
               count(*) filter (where props is not null and try_cast(props as bigint) is null)
                   as lost
        from faulty
    )
    select 'user_id' as "column", 'moved' as problem, '1' as expected, '2' as actual, n as n_rows
    from counts
    union all select 'ts', 'moved', '2', '1', n from counts
    union all select 'event_type', 'null_in_required', 'not null', null, no_type from counts
    where no_type > 0
    union all select 'value', 'null_in_required', 'not null', null, no_value from counts
    where no_value > 0
    union all select 'props', 'retyped', 'bigint', 'string', lost from counts
    union all select 'session', 'missing', 'string', null, n from counts
    """
)
def schema_contract_drift(spark, sf_dir):
    # one timestamp type, however the session reads Parquet timestamps
    events = faulty_events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    return contract_drift(events, EVENT_CONTRACT)


METADATA_COLUMNS = ["code", "label", "observation"]


def _column_json(name: str, datatype: str) -> str:
    return f'{{"name":"{name}","datatype":"{datatype}","required":true}}'


@query(
    """
    with problems as (
        select 'MACHINERY' as segment, 2 as position, 'datatype' as problem,
               'integer|long' as expected, 'string' as actual
        union all select 'BUILDING', 0, 'name', 'code', 'label'
        union all select 'BUILDING', 1, 'name', 'label', 'code'
        union all select 'FURNITURE', 2, 'name', 'observation', null
        union all select 'HOUSEHOLD', 3, 'name', null, 'extra'
    )
    select c_custkey, position, problem, expected, actual
    from customer join problems on segment = c_mktsegment
    """
)
def metadata_contract_drift(spark, sf_dir):
    """One metadata document per customer, broken in one of four ways or sound."""
    code, label, number = (
        _column_json(n, t) for n, t in zip(METADATA_COLUMNS, ("string", "string", "integer"))
    )
    wrong, extra = _column_json("observation", "string"), _column_json("extra", "string")
    variants = {
        "MACHINERY": [code, label, wrong],
        "BUILDING": [label, code, number],
        "FURNITURE": [code, label],
        "HOUSEHOLD": [code, label, number, extra],
    }
    columns = F.lit(",".join([code, label, number]))
    for segment, broken in variants.items():
        columns = F.when(F.col("c_mktsegment") == segment, ",".join(broken)).otherwise(columns)
    docs = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(F.lit('{"tableSchema":{"columns":['), columns, F.lit("]}}")).alias("content"),
    )
    return metadata_drift(docs, "c_custkey", "content", METADATA_COLUMNS, "observation")


@query(
    """
    with artifacts as (
        select page_id, page_id as version, url,
               case when url like 'https:%' then 'html' else 'json' end as kind,
               case when html like '%lang="fr"%' then upper(sha256(html)) else sha256(html) end
                   as sha256,
               strlen(html) - 2000 as size_bytes,
               case when html like '%lang="de"%' then '' end as etag
        from pages
    )
    select page_id, 'kind' as rule from artifacts where kind not in ('csv', 'csvw', 'json')
    union all select page_id, 'version' from artifacts where version < 1
    union all select page_id, 'sha256' from artifacts
    where not regexp_matches(sha256, '^[a-f0-9]{64}$')
    union all select page_id, 'size_bytes' from artifacts where size_bytes < 0
    union all select page_id, 'etag' from artifacts where etag is not null and strlen(etag) < 1
    """
)
def row_constraints(spark, sf_dir):
    html = F.col("html")
    sha = F.sha2(html, 256)
    artifacts = table(spark, sf_dir, "pages").select(
        "page_id",
        F.col("page_id").alias("version"),
        F.when(F.col("url").startswith("https:"), "html").otherwise("json").alias("kind"),
        F.when(html.contains('lang="fr"'), F.upper(sha)).otherwise(sha).alias("sha256"),
        (F.octet_length(html) - 2000).alias("size_bytes"),
        F.when(html.contains('lang="de"'), "").alias("etag"),
    )
    return constraint_violations(
        artifacts,
        ["page_id"],
        {
            "kind": one_of("kind", ARTIFACT_KINDS),
            "version": at_least("version", 1),
            "sha256": matches("sha256", SHA256_PATTERN),
            "size_bytes": at_least("size_bytes", 0),
            "etag": optional("etag", F.octet_length("etag") >= 1),
        },
    )


@query(
    """
    select event_id,
           case when event_type in ('view', 'click') then 'z' else event_type || ',z' end as fields
    from events
    """,
    name="unknown_fields",
)
def rejected_fields(spark, sf_dir):
    """Payloads with one field named after the event type and one that no type declares."""
    extra = F.concat(F.lit(',"'), F.col("event_type"), F.lit('":1,"z":null}'))
    document = F.regexp_replace("props", r"\}$", "")
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.array_join(
            unknown_fields(F.concat(document, extra), ["k", "view", "click"]), ","
        ).alias("fields"),
    )
    return events.filter(F.col("fields") != "")

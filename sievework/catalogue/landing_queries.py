"""Canonical hashes, artifacts, ledger, job status, evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.catalogue.check_queries import SUITE_SQL, suite_results
from sievework.catalogue.gate_queries import gated_lines
from sievework.catalogue.registry import LOADED_AT, document_digests, line_quantities, query, table
from sievework.functions.canonical import HASHED_ROWS, canonical_hash
from sievework.functions.status import job_status, parse_status
from sievework.operators.checks import gate_counts
from sievework.operators.definitions import definition_violations
from sievework.operators.evidence import collect_evidence
from sievework.operators.ledger import (
    LandingRun,
    append_to_ledger,
    build_manifest,
    classify_artifacts,
    conflicting_artifacts,
    new_artifacts,
    with_fingerprint,
    with_object_key,
)
from sievework.operators.provenance import RunMetadata
from sievework.operators.skew import spread_rows
from sievework.plans.landing import open_ledger
from sievework.session import fresh_folder
from sievework.sinks.parquet import save_layer
from sievework.sinks.reports import run_summary
from sievework.sources.artifacts import scan_artifacts


@query(
    """
    select o_orderkey,
           sha256('{"dataset":{"edition":"' || o_orderstatus || '","id":' || o_custkey
                  || '},"dimensions":["sex",{"a":null,"b":true}],"population_type":"'
                  || o_orderpriority || '"}') as filter_hash
    from orders
    """
)
def json_canonical_hash(spark, sf_dir):
    """Definitions with unsorted keys and free spacing."""
    definition = F.concat(
        F.lit('{ "population_type": "'),
        "o_orderpriority",
        F.lit('",\n "dimensions": ["sex", {"b": true, "a": null}], "dataset": {"id": '),
        F.col("o_custkey").cast("string"),
        F.lit(', "edition": "'),
        "o_orderstatus",
        F.lit('"} }'),
    )
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    orders = spread_rows(table(spark, sf_dir, "orders").select(*columns), HASHED_ROWS)
    return orders.select("o_orderkey", canonical_hash(definition).alias("filter_hash"))


@query(
    r"""
    with escaped as (
        select doc_id,
               array_to_string(list_transform(string_split(text, ''), lambda c: case
                   when c = '"' then '\"' when c = '\' then '\\'
                   when unicode(c) = 10 then '\n' when unicode(c) = 13 then '\r'
                   when unicode(c) = 9 then '\t' when unicode(c) = 8 then '\b'
                   when unicode(c) = 12 then '\f'
                   when unicode(c) between 32 and 126 then c
                   when unicode(c) < 65536 then '\u' || format('{:04x}', unicode(c))
                   else '\u' || format('{:04x}', 55296 + (unicode(c) - 65536) // 1024)
                        || '\u' || format('{:04x}', 56320 + (unicode(c) - 65536) % 1024)
               end), '') as body
        from (select doc_id, lang || ' ' || source || ' ' || text as text from documents)
    )
    select doc_id, sha256('{"id":' || doc_id || ',"text":"' || body || '"}') as text_hash
    from escaped
    """
)
def json_canonical_text_hash(spark, sf_dir):
    """Whole texts inside JSON, with everything beyond ASCII escaped."""
    docs = table(spark, sf_dir, "documents").select(
        F.concat_ws(" ", "lang", "source", "text").alias("text"), F.col("doc_id").alias("id")
    )
    document = F.to_json(F.struct("text", "id"))
    return docs.select(F.col("id").alias("doc_id"), canonical_hash(document).alias("text_hash"))


@query(
    """
    with problems as (
        select 'F' as status, 'no_unknown_field' as rule
        union all select 'F', 'edition_is_text'
        union all select 'P', 'version_is_positive'
        union all select 'P', 'dimensions_are_objects'
    )
    select o_orderkey, rule from orders join problems on status = o_orderstatus
    union all
    select o_orderkey, 'population_type_is_text' from orders where o_orderpriority = '5-LOW'
    """
)
def definition_constraints(spark, sf_dir):
    """One definition per order; finished and pending ones break two rules each."""
    status = F.col("o_orderstatus")
    content = F.concat(
        F.lit('{"dataset":{"id":"TS","version":'),
        F.when(status == "P", "0").otherwise("2"),
        F.when(status == "F", "").otherwise(',"edition":"2021"'),
        F.lit("}"),
        F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(',"population_type":"UR"'),
        F.when(status == "F", ',"extra":1').otherwise(""),
        F.when(status == "P", ',"dimensions":[1]}').otherwise(',"dimensions":[{"name":"sex"}]}'),
    )
    docs = table(spark, sf_dir, "orders").select("o_orderkey", content.alias("content"))
    return definition_violations(docs, "o_orderkey", "content")


RUN = LandingRun(
    run_id="run-1",
    created_at="2026-01-01 00:00:00",
    filter_id="filter-1",
    filter_output_id="output-1",
    source_id="TS009",
    source_edition="2021",
    source_version=1,
    filter_hash="b" * 64,
)


def page_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages as landed artifacts."""
    pages = table(spark, sf_dir, "pages").select(
        F.lit("json").alias("kind"),
        F.col("url").alias("source_url"),
        F.lit("text/html").alias("content_type"),
        F.lit(None).cast("string").alias("etag"),
        F.col("html").alias("content"),
    )
    keyed = with_object_key(
        with_fingerprint(pages, "content"),
        F.lit(RUN.source_id),
        F.lit(RUN.source_edition),
        F.lit(RUN.source_version),
        F.lit(RUN.filter_hash),
    )
    return build_manifest(keyed, RUN)


MANIFEST_SQL = """
    select 1 as manifest_version, 'run-1' as run_id, '2026-01-01 00:00:00' as created_at,
           repeat('b', 64) as filter_hash, 'filter-1' as filter_id,
           'output-1' as filter_output_id, 'TS009' as source_id, '2021' as source_edition,
           1 as source_version, 'json' as kind, url as source_url,
           'landing/ons/TS009/edition=2021/version=1/filter=' || repeat('b', 64) || '/json/'
               || sha256(html) as object_key,
           sha256(html) as sha256, cast(strlen(html) as bigint) as size_bytes,
           'text/html' as content_type, cast(null as varchar) as etag
    from pages
"""


@query(MANIFEST_SQL)
def artifact_manifest(spark, sf_dir):
    return page_manifest(spark, sf_dir).withColumn(
        "created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss")
    )


def nation_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation as one text file per key, scanned as binary artifacts: key, checksum and size."""
    path = fresh_folder(spark, "nation-files")
    lines = table(spark, sf_dir, "nation").select(
        "n_nationkey", F.concat_ws("|", F.col("n_nationkey").cast("string"), "n_name").alias("line")
    )
    lines.repartition("n_nationkey").write.partitionBy("n_nationkey").text(path)
    key = F.regexp_extract("path", "n_nationkey=([0-9]+)", 1).cast("long").alias("n_nationkey")
    return scan_artifacts(spark, path, "*.txt").select(key, "sha256", "size_bytes")


_FILES_SQL = """
    select cast(n_nationkey as bigint) as n_nationkey,
           sha256(n_nationkey || '|' || n_name || chr(10)) as sha256,
           cast(strlen(n_nationkey || '|' || n_name) + 1 as bigint) as size_bytes
    from nation
"""


@query(_FILES_SQL)
def binary_artifact_scan(spark, sf_dir):
    return nation_files(spark, sf_dir)


@query(
    f"""
    select *, case when n_nationkey < 10 then 'skipped' when n_nationkey >= 20 then 'conflict'
                   else 'new' end as state
    from ({_FILES_SQL})
    """
)
def landing_run(spark, sf_dir):
    """A landing after an earlier one of ten files, with five keys taken by other bytes."""
    files = save_layer(nation_files(spark, sf_dir), fresh_folder(spark, "fingerprints"))
    artifacts = with_object_key(
        files.select(
            "*",
            F.lit("csv").alias("kind"),
            F.concat(F.lit("https://example.org/"), "n_nationkey").alias("source_url"),
            F.lit("text/csv").alias("content_type"),
        ),
        F.lit(RUN.source_id),
        F.lit(RUN.source_edition),
        F.lit(RUN.source_version),
        F.lit(RUN.filter_hash),
    )
    path = fresh_folder(spark, "ledger")
    ledger = open_ledger(spark, path)
    earlier = artifacts.filter("n_nationkey < 10")
    taken = artifacts.filter("n_nationkey >= 20").withColumn("sha256", F.lit("0" * 64))
    append_to_ledger(earlier.unionByName(taken).select(*ledger.columns), ledger, path)
    landed = classify_artifacts(
        artifacts.select("object_key", "sha256", "n_nationkey", "size_bytes"),
        open_ledger(spark, path),
    )
    return landed.drop("object_key")


def _landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming documents against a ledger of the labelled ones, keyed by language and length.

    The coarse key makes all three outcomes occur.
    """
    docs = document_digests(spark, sf_dir).select(
        "doc_id",
        F.concat_ws("/", "lang", F.col("n_chars").cast("string")).alias("object_key"),
        F.col("text_sha").alias("sha256"),
    )
    labels = table(spark, sf_dir, "labels").select("doc_id")
    ledger = (
        docs.join(labels, "doc_id", "left_semi")
        .groupBy("object_key")
        .agg(F.min("sha256").alias("sha256"))
    )
    return classify_artifacts(docs, ledger)


_LANDING_SQL = """
    with docs as (
        select doc_id, lang || '/' || n_chars as object_key, sha256(text) as sha256 from documents
    ),
    ledger as (
        select object_key, min(sha256) as known
        from docs where doc_id in (select doc_id from labels) group by 1
    ),
    batch as (
        select object_key, min(sha256) as sha256, max(sha256) as other, min(doc_id) as doc_id
        from docs group by 1
    ),
    landed as (
        select object_key, sha256, doc_id,
               case when sha256 <> other then 'conflict' when known is null then 'new'
                    when known = sha256 then 'skipped' else 'conflict' end as state
        from batch left join ledger using (object_key)
    )
"""


@query(_LANDING_SQL + "select * from landed")
def ledger_classify(spark, sf_dir):
    return _landing(spark, sf_dir)


@query(_LANDING_SQL + "select object_key, sha256, doc_id from landed where state = 'new'")
def ledger_append_new(spark, sf_dir):
    return new_artifacts(_landing(spark, sf_dir))


@query(_LANDING_SQL + "select object_key, sha256, doc_id from landed where state = 'conflict'")
def ledger_conflicts(spark, sf_dir):
    return conflicting_artifacts(_landing(spark, sf_dir))


@query(
    """
    select event_id,
           case when k < 70 and event_type <> 'view' and k <> 20 then 'ready'
                when event_type = 'error' then 'error' else 'pending' end as status
    from (select *, cast(json_extract_string(props, '$.k') as integer) as k from events)
    """,
    name="job_status",
)
def export_job_status(spark, sf_dir):
    """One status document per event, with missing links, skipped downloads and error events."""
    k = F.get_json_object("props", "$.k").cast("int")
    csv = F.struct(
        F.when(k < 70, "https://example.org/data").alias("public"), (k == 20).alias("skipped")
    )
    csvw = F.struct(F.when(F.col("event_type") != "view", "/metadata").alias("href"))
    document = F.to_json(
        F.struct(
            F.col("event_id").cast("string").alias("id"),
            F.array(F.struct(F.col("event_type").alias("type"))).alias("events"),
            F.struct(csv.alias("csv"), csvw.alias("csvw")).alias("downloads"),
        )
    )
    events = table(spark, sf_dir, "events").select(
        "event_id", parse_status(document).alias("document")
    )
    return events.select("event_id", job_status(F.col("document")).alias("status"))


@query(
    SUITE_SQL
    + """,
    spread as (
        select l_orderkey, l_linenumber, count(distinct l_quantity) as n_values, count(*) as n_rows,
               count(distinct l_quantity) = 1 as sound
        from lineitem group by 1, 2
    ),
    gate as (
        select sum(n_rows) as n_input, count(*) filter (where sound) as n_accepted from spread
    )
    select 'run' as section, 'pipeline_run_id' as item, 'run-2' as value
    union all select 'run', 'dataset_id', 'LINES'
    union all select 'run', 'edition', '1998'
    union all select 'run', 'version', '3'
    union all select 'run', 'filter_hash', repeat('b', 64)
    union all select 'gate', 'input_rows', cast(n_input as varchar) from gate
    union all select 'gate', 'accepted_rows', cast(n_accepted as varchar) from gate
    union all select 'gate', 'quarantined_rows', cast(n_input - n_accepted as varchar) from gate
    union all select 'artifact', 'json', sha256(html) from pages
    union all select 'checks', 'executed', cast(count(*) as varchar) from results
    union all
    select 'checks', 'passed', cast(count(*) filter (where status = 'pass') as varchar) from results
    union all
    select 'checks', 'failed', cast(count(*) filter (where status = 'fail') as varchar) from results
    """
)
def evidence_long(spark, sf_dir):
    run = RunMetadata("LINES", "1998", 3, "a" * 64, "run-2", LOADED_AT)
    counts = gate_counts(line_quantities(spark, sf_dir), gated_lines(spark, sf_dir))
    summary = run_summary(counts, run)
    return collect_evidence(summary, page_manifest(spark, sf_dir), suite_results(spark, sf_dir))

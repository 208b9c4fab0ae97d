"""Contracts over values, headers, manifests and files; layers that are evaluated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.catalogue.gate_queries import gated_lines
from sievework.catalogue.landing_queries import page_manifest
from sievework.catalogue.registry import LINES_SQL, line_quantities, query, table
from sievework.functions.canonical import HASHED_ROWS, canonical_hash
from sievework.operators.contracts import accepted_values, constraint_violations
from sievework.operators.gate import accepted_rows
from sievework.operators.ledger import manifest_constraints, unknown_manifest_fields
from sievework.operators.model import build_fact, layer_measures
from sievework.operators.skew import spread_rows
from sievework.plans.landing import land_artifacts
from sievework.session import fresh_folder
from sievework.sinks.tables import materialize
from sievework.sources.artifacts import scan_artifacts
from sievework.sources.delimited import header_drift


@query(
    """
    select 'o_orderstatus' as column, o_orderstatus as value, count(*) as n from orders where o_orderstatus <> 'F' group by 2
    union all
    select 'o_orderpriority', o_orderpriority, count(*) from orders
    where o_orderpriority not in (select distinct o_orderpriority from orders where o_orderkey < 3) group by 2
    """,
    name="accepted_values",
)
def accepted_values_of_orders(spark, sf_dir):
    """Only finished orders with the priorities of the first orders are accepted."""
    orders = table(spark, sf_dir, "orders")
    seen = orders.filter("o_orderkey < 3").select(F.lit("o_orderpriority").alias("column"), F.col("o_orderpriority").alias("value"))
    listed = spark.range(1).select(F.lit("o_orderstatus").alias("column"), F.lit("F").alias("value"))
    return accepted_values(orders, seen.unionByName(listed), ["o_orderstatus", "o_orderpriority"])


@query(
    """
    with files as (select n_nationkey as k from nation),
    found as (
        select k, 1 as position, 'c_name' as expected, 'name' as actual from files where k % 5 = 1
        union all select k, 0, 'c_custkey', 'c_name' from files where k % 5 = 2
        union all select k, 1, 'c_name', 'c_custkey' from files where k % 5 = 2
        union all select k, 2, null, 'extra' from files where k % 5 = 3
        union all select k, 1, 'c_name', null from files where k % 5 = 4
    )
    select k as nation, position, expected, actual from found where k in (select c_nationkey from customer)
    """,
    name="header_drift",
)
def header_drift_of_files(spark, sf_dir):
    """customer in a file per nation; four in five have a header that differs, each kind in its own way."""
    path = fresh_folder(spark, "nation-csv")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    shapes = {
        0: rows, 1: rows.withColumnRenamed("c_name", "name"), 2: rows.select("c_name", "c_custkey", "c_nationkey"),
        3: rows.withColumn("extra", F.lit(1)), 4: rows.drop("c_name"),
    }
    for kind, frame in shapes.items():
        part = frame.filter(F.col("c_nationkey") % 5 == kind)
        columns = [c for c in part.columns if c != "c_nationkey"]
        part.select(*columns, "c_nationkey").repartition("c_nationkey").write.partitionBy("c_nationkey").option("header", True).csv(
            f"{path}/kind={kind}"
        )
    found = header_drift(spark, path, ["c_custkey", "c_name"])
    nation = F.regexp_extract("file", "c_nationkey=([0-9]+)", 1).cast("int").alias("nation")
    # the marks that the writer leaves beside its files are no extract
    return found.filter(F.col("file").contains(".csv")).select(nation, "position", "expected", "actual")


FILES = 40


def order_files(spark: SparkSession, sf_dir: str) -> str:
    """orders in text files, one per remainder of the key, lines in key order."""
    path = fresh_folder(spark, "order-files")
    rows = table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") % FILES).cast("int").alias("part"),
        "o_orderkey",
        F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus", F.col("o_custkey").cast("string")).alias("line"),
    )
    sorted_rows = rows.repartition("part").sortWithinPartitions("part", "o_orderkey")
    sorted_rows.select("part", "line").write.partitionBy("part").text(path)
    return path


_ORDER_FILES_SQL = f"""
    with contents as (
        select cast(o_orderkey % {FILES} as integer) as part,
               string_agg(o_orderkey || '|' || o_orderstatus || '|' || o_custkey || chr(10), '' order by o_orderkey) as content
        from orders group by 1
    ),
    files as (select part, sha256(content) as sha256, cast(strlen(content) as bigint) as size_bytes from contents)
"""


@query(_ORDER_FILES_SQL + "select * from files")
def streamed_artifacts(spark, sf_dir):
    """Files of orders; those above a limit, here small enough that some files are on each side, are hashed in chunks."""
    path = order_files(spark, sf_dir)
    limit = table(spark, sf_dir, "orders").count() * 18 // FILES
    found = scan_artifacts(spark, path, "*.txt", stream_above=limit)
    return found.select(F.regexp_extract("path", "part=([0-9]+)", 1).cast("int").alias("part"), "sha256", "size_bytes")


_DEFINITION = '{"dataset":{"id":"TS009","edition":"2021","version":1},"population_type":"UR","dimensions":[{"name":"sex"}]}'
# SHA-256 of the above with sorted keys
_DEFINITION_SORTED = '{"dataset":{"edition":"2021","id":"TS009","version":1},"dimensions":[{"name":"sex"}],"population_type":"UR"}'


@query(
    _ORDER_FILES_SQL
    + f"""
    select part, 'run-1' as run_id, sha256('{_DEFINITION_SORTED}') as filter_hash, 'csv' as kind,
           'landing/ons/TS009/edition=2021/version=1/filter=' || sha256('{_DEFINITION_SORTED}') || '/csv/' || sha256 as object_key,
           sha256, size_bytes, 'https://example.org/' || part as source_url
    from files
    """,
    name="landed_artifacts",
)
def landed_orders(spark, sf_dir):
    """Files of orders landed twice by one run; the second time changes nothing."""
    path = order_files(spark, sf_dir)
    definition = fresh_folder(spark, "definition")
    spark.range(1).select(F.lit(_DEFINITION).alias("value")).coalesce(1).write.text(definition)
    artifacts = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % FILES).cast("string").alias("name")).distinct().select(
        "name", F.lit("csv").alias("kind"), F.concat(F.lit("https://example.org/"), "name").alias("source_url"),
        F.lit("text/csv").alias("content_type"), F.lit(None).cast("string").alias("etag"),
    )
    ledger = fresh_folder(spark, "landing-ledger")

    def land() -> DataFrame:
        return land_artifacts(
            spark, artifacts, f"{path}/part=*/*.txt", definition, ledger, fresh_folder(spark, "landing-manifest"), "run-1", "filter-1",
            "output-1", "2026-01-01 00:00:00", name=F.regexp_extract("path", "part=([0-9]+)", 1),
        )

    land()
    part = F.regexp_extract("source_url", "[0-9]+$", 0).cast("int").alias("part")
    return land().select(part, "run_id", "filter_hash", "kind", "object_key", "sha256", "size_bytes", "source_url")


@query(
    """
    select page_id, 'manifest' as part, 'comment' as field from pages where page_id % 7 = 0
    union all select page_id, 'source', 'title' from pages where page_id % 5 = 0
    union all select page_id, 'artifact 1', 'md5' from pages where page_id % 3 = 0
    """
)
def manifest_unknown_fields(spark, sf_dir):
    """A manifest document with two artifacts per page; some have fields that are not declared."""
    page = F.col("page_id")

    def extra(every: int, name: str) -> Column:
        return F.when(page % every == 0, F.lit(f',"{name}":"x"')).otherwise("")

    content = F.concat(
        F.lit('{"manifest_version":1,"run_id":"r","source":{"id":"TS","edition":"2021","version":1'), extra(5, "title"),
        F.lit('},"artifacts":[{"kind":"csv","sha256":"'), F.sha2("html", 256), F.lit('"},{"kind":"json"'), extra(3, "md5"),
        F.lit("}]"), extra(7, "comment"), F.lit("}"),
    )
    docs = table(spark, sf_dir, "pages").select("page_id", content.alias("content"))
    return unknown_manifest_fields(docs, "page_id", "content")


@query(
    """
    select sha256(html) as sha256, 'source_version_is_positive' as rule from pages where page_id % 4 = 0
    union all select sha256(html), 'kind_is_known' from pages where page_id % 6 = 0
    union all select sha256(html), 'source_url_is_http' from pages
    where not coalesce(regexp_matches(url, '^https?://[^/]+'), false)
    """,
    name="manifest_constraints",
)
def manifest_row_constraints(spark, sf_dir):
    """pages as manifest rows, some with a source version of 0 or an unknown kind."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.sha2("html", 256).alias("sha256")).distinct()
    rows = page_manifest(spark, sf_dir).join(pages, "sha256")
    spoilt = rows.withColumns(
        {
            "source_version": F.when(F.col("page_id") % 4 == 0, 0).otherwise(F.col("source_version")),
            "kind": F.when(F.col("page_id") % 6 == 0, "xml").otherwise(F.col("kind")),
        }
    )
    return constraint_violations(spoilt, ["sha256"], manifest_constraints())


@query(
    LINES_SQL
    + """
    select 'raw' as layer, count(*) as row_count, cast(sum(quantity) as bigint) as total from lines
    union all select 'accepted', count(*), cast(sum(quantity) as bigint) from accepted
    union all select 'fact', count(*), cast(sum(quantity) as bigint) from accepted
    """,
    name="layer_measures",
)
def layer_measures_of_lines(spark, sf_dir):
    """Rows and sums of layers that are each worked out."""
    lines = line_quantities(spark, sf_dir)
    accepted = accepted_rows(gated_lines(spark, sf_dir))
    fact = build_fact(accepted, ["l_orderkey", "l_linenumber"], {"flag": "l_returnflag"}, ["quantity"])
    return layer_measures({"raw": (lines, "quantity"), "accepted": (accepted, "quantity"), "fact": (fact, "quantity")})


@query("select c_nationkey, count(*) as n from customer group by 1")
def materialized_table(spark, sf_dir):
    """A mart saved as a catalog table, twice under one name, and read back by it."""
    counts = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    name = "sievework_customers_by_nation"
    materialize(counts.limit(0), name, "table", fresh_folder(spark, "mart-table"))
    spark.sql(f"drop table {name}")
    return materialize(counts, name, "table", fresh_folder(spark, "mart-table"))


@query(
    """
    select c_custkey,
           sha256('{"a":[' || cast(c_nationkey as varchar) || '.0,1e+22,' || repeat('7', 45) || '],"b":"1.0","z":' || cast(c_custkey as varchar) || '.5}') as filter_hash
    from customer
    """
)
def json_exact_hash(spark, sf_dir):
    """Documents with fractions that end in zeros, exponents and long integers."""
    document = F.concat(
        F.lit('{"z": '), F.col("c_custkey").cast("string"), F.lit('.50, "b": "1.0", "a": ['), F.col("c_nationkey").cast("string"),
        F.lit(".000, 10000e18, " + "7" * 45 + "]}"),
    )
    customers = spread_rows(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), HASHED_ROWS)
    return customers.select("c_custkey", canonical_hash(document).alias("filter_hash"))

"""Physical plans: what is shuffled, read and broadcast."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from sievework.catalogue import QUERIES, contract_queries, gate_queries, landing_queries
from sievework.operators.checks import NotNull, negative_rows, null_counts, run_checks
from sievework.operators.gate import GateSpec, quality_gate
from sievework.operators.model import build_dimension, build_fact, conform
from sievework.operators.provenance import RunMetadata, with_provenance
from sievework.operators.skew import rows_with_keys, tasks_for
from sievework.schemas import declare

SHUFFLE = re.compile(r"Exchange (hash|range|RoundRobin|SinglePartition)")


@pytest.fixture
def shuffled_joins(spark):
    """No side is small enough to broadcast, as with large tables."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def lines(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.range(500).select(
        (F.col("id") % 50).alias("k"),
        (F.col("id") % 3).alias("m"),
        F.concat(F.lit("code"), (F.col("id") % 5).cast("string")).alias("code"),
        F.lit("label").alias("label"),
        F.lit("unused").alias("payload"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def shuffles(frame) -> int:
    return len(SHUFFLE.findall(plan(frame)))


def read_columns(frame) -> list[str]:
    return re.findall(r"(\w+):", re.search(r"ReadSchema: struct<(.*?)>", plan(frame)).group(1))


def test_row_local_operators_do_not_shuffle(spark, lines):
    run = RunMetadata("D", "2021", 1, "a" * 64, "r", "2026-01-01 00:00:00+00:00")
    narrow = [
        with_provenance(lines, run, ["k", "m"]),
        build_fact(lines, ["k", "code"], {"code": "code"}, ["m"]),
        conform(lines, declare("k string, m int")),
        negative_rows(lines, "m"),
    ]
    assert [shuffles(frame) for frame in narrow] == [0, 0, 0, 0]


@pytest.mark.parametrize(
    "name",
    [
        "metadata_contract_drift",
        "row_constraints",
        "definition_constraints",
        "unknown_fields",
        "json_canonical_hash",
        "job_status",
        "artifact_manifest",
        "provenance_stamp",
        "trim_dimensions",
        "rule_classify",
    ],
)
def test_document_queries_are_row_local(spark, name):
    assert shuffles(QUERIES[name](spark, "/root/testdata/sf0.001")) == 0


def test_fingerprints_are_held_by_as_many_tasks_as_their_number_asks_for(spark, monkeypatch):
    monkeypatch.setattr(gate_queries, "tasks_for", lambda rows: tasks_for(rows, 500))
    frame = QUERIES["fingerprint_distinct"](spark, "/root/testdata/sf0.001")
    text = plan(frame)
    assert re.search(r"hashpartitioning\(h#\d+, 12\), REPARTITION_BY_NUM", text)  # 6000 rows
    assert "unhex(" in text
    assert tuple(frame.first()) == tuple(QUERIES["fingerprint_distinct"](spark, "/root/testdata/sf0.001").first())


@pytest.mark.parametrize("name, module", [("json_exact_hash", contract_queries), ("json_canonical_hash", landing_queries)])
def test_documents_are_hashed_by_many_tasks(spark, monkeypatch, name, module):
    """A file's single row group is one task's to read, but not to hash."""
    expected = sorted(map(tuple, QUERIES[name](spark, "/root/testdata/sf0.001").collect()))
    monkeypatch.setattr(module, "HASHED_ROWS", 10)
    frame = QUERIES[name](spark, "/root/testdata/sf0.001")
    assert frame.rdd.getNumPartitions() == -(-len(expected) // 10)
    assert sorted(map(tuple, frame.collect())) == expected


def test_filters_and_columns_reach_the_scan(spark, lines):
    text = plan(negative_rows(lines, "m").select("k"))
    assert "PushedFilters: [IsNotNull(m), LessThan(m,0)]" in text
    assert read_columns(negative_rows(lines, "m").select("k")) == ["k", "m"]
    assert read_columns(build_dimension(lines, "code", "code", "label")) == ["code", "label"]
    gated = quality_gate(lines.select("k", "m"), GateSpec(key=["k"], measure="m"), heavy=[])
    assert read_columns(gated) == ["k", "m"]


def test_all_null_checks_of_a_table_share_one_scan(spark, lines):
    assert plan(null_counts(lines, ["k", "m", "code"])).count("FileScan") == 1
    checks = [NotNull("t", ["k"]), NotNull("t", ["m", "k"]), NotNull("t", ["code"])]
    assert plan(run_checks({"t": lines}, checks)).count("FileScan") == 1


def test_aggregates_combine_before_they_shuffle(spark, shuffled_joins):
    sf_dir = "/root/testdata/sf0.001"
    for name in ("orphans_documents_without_label", "mart_sales_by_nation"):
        text = plan(QUERIES[name](spark, sf_dir))
        join = text.index("SortMergeJoin")
        assert "partial_" in text[join:]
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_a_digest_is_computed_once(spark):
    assert plan(QUERIES["unique_violations"](spark, "/root/testdata/sf0.001")).count("sha2(") == 1


def test_membership_is_one_join(spark, lines, shuffled_joins):
    keys = lines.select("k").distinct()
    text = plan(rows_with_keys(lines, keys, ["k"]))
    assert "Broadcast" not in text and text.count("SortMergeJoin") == 1


def test_filters_pass_through_the_gate(spark, tmp_path):
    rows = spark.range(100).selectExpr("id % 7 as k", "id as m", "id % 2 as edition")
    rows.write.partitionBy("edition").parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    gated = quality_gate(table, GateSpec(key=["edition", "k"], measure="m"), heavy=[])
    text = plan(gated.filter("edition = 1 and k = 3"))
    assert "PartitionFilters: [isnotnull(edition" in text and "(edition#" in text
    assert "EqualTo(k,3)" in text


@pytest.mark.parametrize("name", QUERIES)
def test_no_query_multiplies_rows(spark, name):
    text = plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert "PythonUDF" not in text and "ArrowEvalPython" not in text

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sievework.errors import ObjectConflictError, SchemaContractError
from sievework.operators.checks import (
    Finds,
    NotNull,
    Related,
    Unique,
    gate_balance,
    gate_counts,
    layer_mismatch,
    negative_rows,
    null_counts,
    orphan_keys,
    orphan_rows,
    repeated_values,
    run_checks,
    source_freshness,
    summarize_results,
    total_mismatches,
)
from sievework.operators.contracts import (
    at_least,
    constraint_violations,
    contract_drift,
    enforce_contract,
    matches,
    metadata_drift,
    one_of,
    optional,
    unknown_fields,
)
from sievework.operators.evidence import collect_evidence
from sievework.operators.ledger import (
    LandingRun,
    append_to_ledger,
    build_manifest,
    classify_artifacts,
    manifest_constraints,
)
from sievework.operators.model import (
    build_dimension,
    build_fact,
    build_mart,
    conform,
    layer_counts,
    rename_columns,
)
from sievework.schemas import declare
from sievework.sinks.reports import SUMMARY_SCHEMA


def rows(frame) -> set:
    return {tuple(r) for r in frame.collect()}


def test_null_counts_in_one_pass(spark):
    frame = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    counts = null_counts(frame, ["a", "b"])
    assert rows(counts) == {("a", 1), ("b", 2)}
    assert rows(null_counts(frame.limit(0), ["a"])) == {("a", 0)}


def test_unique_and_relationship_ignore_nulls(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,), (9,), (9,)], "k int")
    parent = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    assert rows(repeated_values(child, "k")) == {(1, 2), (9, 2)}
    assert rows(orphan_keys(child, "k", parent, "id")) == {(9, 2)}
    assert sorted(r[0] for r in orphan_rows(child, "k", parent, "id").collect()) == [9, 9]


def test_orphan_rows_split_a_hot_key(spark):
    """A key with most rows is spread over several tasks by AQE."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        child = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        parent = spark.range(0, 30_000).filter("id <> 7").select(F.col("id").alias("p"))
        orphans = orphan_rows(child, "k", parent, "p")
        found = orphans.collect()
        plan = orphans._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    keys = [i if i % 3 else 7 for i in range(60_000)]
    assert sorted(r["k"] for r in found) == sorted(k for k in keys if k == 7 or k >= 30_000)
    assert "skew=true" in plan


def test_layers_and_balance(spark):
    three, two = spark.range(3), spark.range(2)
    assert rows(layer_counts({"a": three, "b": two})) == {("a", 3), ("b", 2)}
    assert rows(layer_mismatch(layer_counts({"a": three, "b": two}))) == {(2, 3)}
    assert rows(layer_mismatch(layer_counts({"a": three, "b": three}))) == set()
    saved = {"accepted": three, "quarantined": two}
    assert rows(gate_balance(layer_counts({"input": spark.range(5), **saved}))) == {(5, 3, 2, True)}
    assert rows(gate_balance(layer_counts({"input": spark.range(6), **saved}))) == {(6, 3, 2, False)}
    gated = spark.createDataFrame([(None,), (None,), ("x",)], "quality_rule string")
    assert rows(gate_balance(gate_counts(three, gated))) == {(3, 2, 1, True)}
    assert rows(gate_balance(gate_counts(three, gated.limit(0)))) == {(3, 0, 0, False)}


def test_total_mismatches_see_changed_unexpected_and_missing_keys(spark):
    actual = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, t long")
    expected = spark.createDataFrame([("a", 1), ("b", 5), ("d", 4)], "k string, t long")
    assert rows(total_mismatches(actual, expected, ["k"], "t")) == {
        ("b", 2, 5),
        ("c", 3, None),
        ("d", None, 4),
    }


@pytest.mark.parametrize(
    ("now", "status"),
    [("2026-01-05 00:00:00", "pass"), ("2026-01-20 00:00:00", "warn"), ("2026-03-01 00:00:00", "error")],
)
def test_freshness(spark, now, status):
    frame = spark.createDataFrame([(datetime(2026, 1, 1),), (datetime(2025, 1, 1),)], "t timestamp")
    assert source_freshness(frame, "t", now, 10, 30).first()["status"] == status


def test_freshness_of_an_empty_source_is_an_error(spark):
    frame = spark.createDataFrame([], "t timestamp")
    row = source_freshness(frame, "t", datetime(2026, 1, 1), 10, 30).first()
    assert (row["latest"], row["age_days"], row["status"]) == (None, None, "error")


def test_suite_reports_every_check_and_scans_once_for_nulls(spark):
    tables = {
        "c": spark.createDataFrame([(1, -1), (1, 2), (None, 3)], "k int, m int"),
        "p": spark.createDataFrame([(2,)], "k int"),
    }
    checks = [
        NotNull("c", ["k"]),
        NotNull("c", ["m"]),
        Unique("c", "k"),
        Related("c", "k", "p", "k"),
        Finds("no_negative", "c", lambda t: negative_rows(t["c"], "m")),
    ]
    results = run_checks(tables, checks)
    assert rows(results) == {
        ("not_null", "c", "k", 1, "fail"),
        ("not_null", "c", "m", 0, "pass"),
        ("unique", "c", "k", 1, "fail"),
        ("relationships", "c", "k", 2, "fail"),
        ("no_negative", "c", None, 1, "fail"),
    }
    assert tuple(summarize_results(results).first()) == (5, 1, 4)


def test_summary_counts_other_statuses_as_neither(spark):
    statuses = ["success", "pass", "fail", "error", "runtime error", "warn", "skipped"]
    frame = spark.createDataFrame([(s,) for s in statuses], "status string")
    assert tuple(summarize_results(frame).first()) == (7, 2, 3)


CONTRACT = declare("a long!, b string, c string, d int")


def test_contract_drift(spark):
    frame = spark.createDataFrame([(None, "1", "x", 9), (1, "2", "7", 9)], "a long, c string, d string, z int")
    assert rows(contract_drift(frame, CONTRACT)) == {
        ("a", "null_in_required", "not null", None, 1),
        ("b", "missing", "string", None, 2),
        ("c", "moved", "2", "1", 2),
        ("d", "moved", "3", "2", 2),
        ("d", "retyped", "int", "string", 1),
        ("z", "unexpected", None, "int", 2),
    }
    sound = spark.createDataFrame([(1, "b", "c", 4)], "a long, b string, c string, d int")
    assert contract_drift(sound, CONTRACT).count() == 0
    assert enforce_contract(sound, CONTRACT) is sound
    with pytest.raises(SchemaContractError):
        enforce_contract(frame, CONTRACT)


def test_retyped_columns_without_a_cast_lose_every_value(spark):
    frame = spark.createDataFrame([([1], "2026-01-01"), (None, "x")], "a array<int>, d string")
    frame = frame.withColumn("d", F.col("d").try_cast("date"))
    assert rows(contract_drift(frame, declare("a int, d boolean"))) == {
        ("a", "retyped", "int", "array<int>", 1),
        ("d", "retyped", "boolean", "date", 1),
    }


def test_contract_drift_without_any_rule(spark):
    frame = spark.createDataFrame([("x",)], "a string")
    assert contract_drift(frame, declare("a string")).count() == 0


def test_metadata_drift(spark):
    column = lambda n, t="string": {"name": n, "datatype": t}
    import json

    docs = {
        "ok": [column("a"), column("m", "long")],
        "swapped": [column("m", "long"), column("a")],
        "retyped": [column("a"), column("m")],
        "short": [column("a")],
        "untyped": [column("a"), {"name": "m"}],
    }
    data = [(k, json.dumps({"tableSchema": {"columns": v}})) for k, v in docs.items()]
    data += [("none", "{}"), ("text", "hello")]
    found = rows(metadata_drift(spark.createDataFrame(data, "id string, c string"), "id", "c", ["a", "m"], "m"))
    assert found == {
        ("swapped", 0, "name", "a", "m"),
        ("swapped", 1, "name", "m", "a"),
        ("retyped", 1, "datatype", "integer|long", "string"),
        ("short", 1, "name", "m", None),
        ("untyped", 1, "datatype", "integer|long", None),
        *{(d, i, "name", n, None) for d in ("none", "text") for i, n in enumerate("am")},
    }


def test_row_constraints(spark):
    frame = spark.createDataFrame(
        [(1, 1, "a" * 64, "csv", None), (2, 0, "A" * 64, "pdf", "x"), (3, None, None, None, "ok")],
        "i int, v int, s string, k string, e string",
    )
    found = constraint_violations(
        frame,
        ["i"],
        {
            "v": at_least("v", 1),
            "s": matches("s", "^[a-f0-9]{64}$"),
            "k": one_of("k", ["csv", "json"]),
            "e": optional("e", F.length("e") > 1),
        },
    )
    assert rows(found) == {(2, "v"), (2, "s"), (2, "k"), (2, "e"), (3, "v"), (3, "s"), (3, "k")}


def test_unknown_fields(spark):
    frame = spark.createDataFrame([('{"a":1,"z":2,"b":null}',), ('{"a":1}',), ("[1]",)], "d string")
    found = [r[0] for r in frame.select(unknown_fields(F.col("d"), ["a"])).collect()]
    assert found == [["b", "z"], [], None]


def test_model_builders(spark):
    frame = spark.createDataFrame(
        [("g1", "North", "x", 5), ("g1", "North East", "y", 7), ("g2", "South", "x", 1)],
        "g string, label string, s string, m long",
    )
    dimension = build_dimension(frame, "geo", "g", "label")
    assert {(r["g"], r["label"]) for r in dimension.collect()} == {("g1", "North East"), ("g2", "South")}
    fact = build_fact(frame, ["g", "s"], {"geo": "g"}, ["s", "m"])
    assert fact.columns == ["observation_key", "geo_key", "s", "m"]
    assert fact.select("observation_key").distinct().count() == 3
    mart = build_mart(fact, dimension, "geo_key", [], "m", "total")
    assert rows(mart) == {("g1", "North East", 12), ("g2", "South", 1)}
    by_s = build_mart(fact, dimension.filter("g = 'g1'"), "geo_key", ["s"], "m", "total")
    assert rows(by_s) == {("g1", "North East", "x", 5), ("g1", "North East", "y", 7)}
    assert conform(frame, declare("m int, g string")).schema.simpleString() == "struct<m:int,g:string>"
    assert rename_columns(frame, ["g", "m"], ["code", "n"]).columns == ["code", "n"]
    with pytest.raises(ValueError):
        rename_columns(frame, ["g", "m"], ["code"])


LANDING = "object_key string, sha256 string, url string"


def test_ledger_states(spark):
    ledger = spark.createDataFrame([("k1", "a"), ("k2", "b")], "object_key string, sha256 string")
    incoming = spark.createDataFrame(
        [("k1", "a", "u2"), ("k1", "a", "u1"), ("k2", "x", "u"), ("k3", "c", "u"), ("k4", "d", "u"), ("k4", "e", "u")],
        LANDING,
    )
    found = {(r["object_key"], r["state"], r["url"]) for r in classify_artifacts(incoming, ledger).collect()}
    assert found == {
        ("k1", "skipped", "u1"),
        ("k2", "conflict", "u"),
        ("k3", "new", "u"),
        ("k4", "conflict", "u"),
    }


def test_ledger_append_is_idempotent_and_refuses_changes(spark, tmp_path):
    path = str(tmp_path / "ledger")
    spark.createDataFrame([], LANDING).write.parquet(path)
    read = lambda: spark.read.parquet(path)
    batch = spark.createDataFrame([("k1", "a", "u"), ("k1", "a", "u"), ("k2", "b", "u")], LANDING)
    append_to_ledger(batch, read(), path)
    append_to_ledger(batch, read(), path)
    assert sorted(tuple(r) for r in read().collect()) == [("k1", "a", "u"), ("k2", "b", "u")]
    changed = spark.createDataFrame([("k1", "z", "u"), ("k3", "c", "u")], LANDING)
    with pytest.raises(ObjectConflictError, match="different content"):
        append_to_ledger(changed, read(), path)
    assert read().count() == 2


def landing_run(**changes) -> LandingRun:
    base = {
        "run_id": "run-1",
        "created_at": "2026-01-01 00:00:00",
        "filter_id": "f",
        "filter_output_id": "o",
        "source_id": "TS009",
        "source_edition": "2021",
        "source_version": 1,
        "filter_hash": "a" * 64,
    }
    return LandingRun(**{**base, **changes})


ARTIFACT = (
    "kind string, source_url string, object_key string, sha256 string, size_bytes long, "
    "content_type string, etag string"
)


def test_manifest_constraints(spark):
    artifacts = spark.createDataFrame(
        [
            ("csv", "https://example.org/a", "k1", "b" * 64, 0, None, None),
            ("pdf", "ftp://x", None, "B" * 64, -1, "t", "e"),
        ],
        ARTIFACT,
    )
    sound = build_manifest(artifacts, landing_run())
    found = constraint_violations(sound, ["kind"], manifest_constraints())
    assert {r["rule"] for r in found.collect()} == {
        "kind_is_known",
        "source_url_is_http",
        "object_key_is_present",
        "sha256_is_sha256",
        "size_bytes_is_not_negative",
    }
    assert {r["kind"] for r in found.collect()} == {"pdf"}
    broken = build_manifest(artifacts.limit(1), landing_run(source_version=0, filter_hash="x"))
    found = constraint_violations(broken, ["kind"], manifest_constraints())
    assert {r["rule"] for r in found.collect()} == {
        "source_version_is_positive",
        "filter_hash_is_sha256",
    }


def test_evidence_prefers_summary_then_manifest_then_default(spark):
    artifacts = spark.createDataFrame([("csv", "u", "k", "123", 3, None, None)], ARTIFACT)
    manifest = build_manifest(artifacts, landing_run())
    summary = spark.createDataFrame([(None, "DS", None, 2, 8, 7, 1)], SUMMARY_SCHEMA)
    results = spark.createDataFrame([("pass",), ("fail",)], "status string")
    assert rows(collect_evidence(summary, manifest, results)) == {
        ("run", "pipeline_run_id", "run-1"),
        ("run", "dataset_id", "DS"),
        ("run", "edition", "2021"),
        ("run", "version", "2"),
        ("run", "filter_hash", "a" * 64),
        ("gate", "input_rows", "8"),
        ("gate", "accepted_rows", "7"),
        ("gate", "quarantined_rows", "1"),
        ("artifact", "csv", "123"),
        ("checks", "executed", "2"),
        ("checks", "passed", "1"),
        ("checks", "failed", "1"),
    }


def test_evidence_without_any_input(spark):
    empty = spark.createDataFrame([], SUMMARY_SCHEMA)
    manifest = build_manifest(spark.createDataFrame([], ARTIFACT), landing_run())
    results = spark.createDataFrame([], "status string")
    found = rows(collect_evidence(empty, manifest, results))
    assert ("run", "pipeline_run_id", "not generated") in found
    assert ("run", "dataset_id", "unknown") in found
    assert ("gate", "input_rows", "not generated") in found
    assert ("checks", "executed", "0") in found
    assert not [r for r in found if r[0] == "artifact"]

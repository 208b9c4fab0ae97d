"""Land the artifacts of one extract: fingerprints, immutable keys, manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.errors import ArtifactError, SchemaContractError
from sievework.operators.checks import repeated_values
from sievework.operators.definitions import definition_identity, definition_violations
from sievework.operators.ledger import (
    LandingRun,
    append_to_ledger,
    build_manifest,
    with_object_key,
)
from sievework.schemas import declare
from sievework.session import fresh_folder
from sievework.sinks.parquet import save_layer
from sievework.sinks.reports import write_json
from sievework.sources.artifacts import scan_artifacts
from sievework.sources.documents import read_documents

LEDGER_SCHEMA = declare(
    "object_key string, sha256 string, size_bytes long, kind string, source_url string, "
    "content_type string"
)


def read_definition(spark: SparkSession, path: str) -> dict:
    """Identity of the one definition at ``path``; raises if it breaks a rule."""
    docs = read_documents(spark, path)
    broken = definition_violations(docs, "path", "content").first()
    if broken:
        raise SchemaContractError(f"{broken['path']}: {broken['rule']} does not hold")
    return definition_identity(docs, "content").drop("path", "content").first().asDict()


def open_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``, created empty on first use."""
    spark.createDataFrame([], LEDGER_SCHEMA).write.mode("ignore").parquet(path)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def _require_files(artifacts: DataFrame, found: DataFrame) -> None:
    missing = artifacts.join(found, "name", "left_anti").first()
    if missing:
        raise ArtifactError(f"there is no file {missing['name']}")
    twice = repeated_values(found.join(artifacts, "name", "left_semi"), "name").first()
    if twice:
        raise ArtifactError(f"there are {twice['n']} files {twice['name']}")


def land_artifacts(
    spark: SparkSession,
    artifacts: DataFrame,
    files: str | list[str],
    definition_path: str,
    ledger_path: str,
    manifest_path: str,
    run_id: str,
    filter_id: str,
    filter_output_id: str,
    created_at: str,
    name: Column | None = None,
) -> DataFrame:
    """Describe the files of an extract in the ledger and in a manifest; returns the manifest.

    ``artifacts`` has ``name`` (of a file, at any depth below ``files``), ``kind``, ``source_url``,
    ``content_type`` and ``etag``. Each must be there exactly once. Files are hashed where they are read; only their fingerprints
    meet the descriptions. Repeating a run changes nothing, other bytes for a known key are refused. ``name`` tells a file's
    name from its ``path`` where it is not the last part of it.
    """
    identity = read_definition(spark, definition_path)
    run = LandingRun(run_id, created_at, filter_id, filter_output_id, **identity)
    if name is None:
        name = F.regexp_extract("path", r"[^/]+$", 0)
    scanned = scan_artifacts(spark, files).withColumn("name", name).drop("path")
    # saved, so that the files are read once for all the steps below
    found = save_layer(scanned, fresh_folder(spark, "fingerprints"))
    _require_files(artifacts, found)
    described = with_object_key(
        artifacts.join(found, "name"),
        F.lit(run.source_id),
        F.lit(run.source_edition),
        F.lit(run.source_version),
        F.lit(run.filter_hash),
    )
    ledger = open_ledger(spark, ledger_path)
    append_to_ledger(described.select(*ledger.columns), ledger, ledger_path)
    manifest = build_manifest(described, run)
    write_json(manifest, manifest_path)
    return spark.read.schema(manifest.schema).json(manifest_path)

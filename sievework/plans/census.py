"""The census extract: its contract, its model and its checks."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sievework.errors import SchemaContractError
from sievework.operators.checks import (
    Check,
    Finds,
    NotNull,
    Related,
    Unique,
    layer_mismatch,
    negative_rows,
    run_checks,
    source_freshness,
    total_mismatches,
)
from sievework.operators.contracts import metadata_drift
from sievework.operators.gate import GateSpec, accepted_rows, quarantined_rows
from sievework.operators.model import rename_columns
from sievework.operators.provenance import PROVENANCE, RunMetadata
from sievework.operators.rules import OUTCOME
from sievework.plans.warehouse import Layers, ModelSpec, build_layers, gate_and_stamp, model_results
from sievework.schemas import declare
from sievework.sinks.jdbc import write_jdbc
from sievework.sinks.parquet import save_layer
from sievework.sources.artifacts import content_checksum
from sievework.sources.delimited import read_delimited
from sievework.sources.documents import read_documents

# The published header, the names used for it, and the grain.
RAW_HEADERS = (
    "Lower Tier Local Authorities Code",
    "Lower Tier Local Authorities",
    "Sex (2 categories) Code",
    "Sex (2 categories)",
    "Age (91 categories) Code",
    "Age (91 categories)",
    "Observation",
)
SOURCE_COLUMNS = (
    "geography_code",
    "geography_label",
    "sex_code",
    "sex_label",
    "age_code",
    "age_label",
    "observation",
)
BUSINESS_KEY = ("geography_code", "age_code", "sex_code")
DATASET = {"dataset_id": "TS009", "edition": "2021", "version": 1}
FRESHNESS_DAYS = {"warn_days": 3650, "error_days": 7300}

SEED_SCHEMA = declare(
    "geography_label string, geography_code string, age_label string, age_code string, "
    "sex_label string, sex_code string, observation long, dataset_id string, edition string, "
    "version int, source_checksum string, pipeline_run_id string, source_record_hash string, "
    "loaded_at timestamp"
)
STAGING_SCHEMA = declare(
    "dataset_id string, edition string, version int, geography_code string, "
    "geography_label string, age_code string, age_label string, sex_code string, "
    "sex_label string, observation long, source_checksum string, pipeline_run_id string, "
    "source_record_hash string, loaded_at timestamp"
)

MODEL = ModelSpec(
    gate=GateSpec(
        key=BUSINESS_KEY,
        measure="observation",
        dimensions=SOURCE_COLUMNS[:-1],
        order_by=("geography_label", "age_label", "sex_label"),
    ),
    hash_columns=SOURCE_COLUMNS,
    staging=STAGING_SCHEMA,
    dimensions={
        "geography": ("geography_code", "geography_label"),
        "age": ("age_code", "age_label"),
        "sex": ("sex_code", "sex_label"),
    },
    fact_key=(
        "dataset_id",
        "edition",
        "version",
        "geography_code",
        "age_code",
        "sex_code",
    ),
    fact_columns=(
        "dataset_id",
        "edition",
        "version",
        "observation",
        "source_checksum",
        "pipeline_run_id",
        "source_record_hash",
        "loaded_at",
    ),
    mart_dimension="geography",
    mart_group=("dataset_id", "edition", "version"),
    measure="observation",
    total="population",
)


def _typed(names: tuple[str, ...]) -> StructType:
    schema = StructType()
    for name in names[:-1]:
        schema = schema.add(name, "string")
    return schema.add(names[-1], "long")


def source_schema() -> StructType:
    """Six text columns and the measure under their internal names."""
    return _typed(SOURCE_COLUMNS)


def raw_source_schema() -> StructType:
    """The same under the published names."""
    return _typed(RAW_HEADERS)


def read_source(spark: SparkSession, path: str) -> DataFrame:
    """Typed scan of the extract, header checked, renamed to internal names."""
    raw = read_delimited(spark, path, raw_source_schema())
    return rename_columns(raw, RAW_HEADERS, SOURCE_COLUMNS)


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """Typed scan of an already stamped extract."""
    return read_delimited(spark, path, SEED_SCHEMA)


def validate_metadata(spark: SparkSession, path: str) -> None:
    """Raise when a metadata document (of a folder: any) departs from the contract."""
    drift = metadata_drift(
        read_documents(spark, path), "path", "content", RAW_HEADERS, RAW_HEADERS[-1]
    )
    first = drift.orderBy(F.col("problem") == "datatype", "path", "position").first()
    if first is None:
        return
    if first["problem"] == "datatype":
        raise SchemaContractError(f"{first['path']}: the measure must be an integer")
    raise SchemaContractError(
        f"{first['path']}: columns do not match the contract at {first['position']}: "
        f"expected {first['expected']}, got {first['actual']}"
    )


def transform(frame: DataFrame, run: RunMetadata) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined), both lazy, in the published column order."""
    gated = gate_and_stamp(frame, MODEL, run)
    return (
        accepted_rows(gated).select(*SOURCE_COLUMNS, *PROVENANCE),
        quarantined_rows(gated).select(*SOURCE_COLUMNS, OUTCOME, *PROVENANCE),
    )


def run_extract(
    spark: SparkSession,
    csv_path: str,
    metadata_path: str,
    out: str,
    run_id: str,
    jdbc: Mapping[str, object] | None = None,
    **run: object,
) -> Layers:
    """Check the metadata, gate the extract, save all layers below ``out``.

    The text is read once, into a saved columnar copy that all later passes read, the default checksum
    included (:func:`content_checksum`). ``run`` overrides fields of :class:`RunMetadata`, the time of
    loading (now, by default) among them; ``jdbc`` (arguments of :func:`write_jdbc`) also refills a
    database table with the accepted rows.
    """
    validate_metadata(spark, metadata_path)
    source = save_layer(read_source(spark, csv_path), f"{out}/source")
    if "source_checksum" not in run:
        run["source_checksum"] = content_checksum(source)
    now = datetime.now(timezone.utc).isoformat(sep=" ", timespec="seconds")
    identity = RunMetadata(**{**DATASET, "pipeline_run_id": run_id, "loaded_at": now, **run})
    layers = build_layers(source, MODEL, identity, out)
    if jdbc:
        write_jdbc(layers.accepted, mode="overwrite", **jdbc)
    return layers


def freshness(layers: Layers, now: datetime | str) -> DataFrame:
    """Age of the loaded rows against the declared limits."""
    return source_freshness(layers.accepted, "loaded_at", now, **FRESHNESS_DAYS)


def table_checks(expected_totals: Mapping[str, int] | None = None) -> list[Check]:
    """The declared checks over :meth:`Layers.tables`."""
    keys = ("geography", "age", "sex")
    checks: list[Check] = [
        NotNull("raw", ("geography_code", "age_code", "sex_code", "observation")),
        NotNull("raw", ("source_record_hash",)),
        Unique("raw", "source_record_hash"),
        NotNull("staging", STAGING_SCHEMA.names),
        Unique("staging", "source_record_hash"),
    ]
    for name in keys:
        dimension = f"dim_{name}"
        checks += [
            NotNull(dimension, (f"{name}_key", f"{name}_code", f"{name}_label")),
            Unique(dimension, f"{name}_key"),
            Unique(dimension, f"{name}_code"),
        ]
    checks += [
        NotNull("fact", ("observation_key", *(f"{name}_key" for name in keys))),
        NotNull("fact", ("observation", "source_record_hash")),
        Unique("fact", "observation_key"),
        Unique("fact", "source_record_hash"),
        *(Related("fact", f"{name}_key", f"dim_{name}", f"{name}_key") for name in keys),
        NotNull(
            "mart",
            ("geography_code", "geography_label", "dataset_id", "edition", "version", "population"),
        ),
        Finds("no_negative", "fact", lambda t: negative_rows(t["fact"], "observation")),
        Finds("layers_reconcile", "audit", lambda t: layer_mismatch(t["audit"])),
    ]
    if expected_totals:
        checks.append(Finds("expected_totals", "mart", lambda t: _off_totals(t, expected_totals)))
    return checks


def _off_totals(tables: Mapping[str, DataFrame], expected: Mapping[str, int]) -> DataFrame:
    mart = tables["mart"]
    wanted = mart.sparkSession.createDataFrame(
        list(expected.items()), "geography_code string, population long"
    )
    return total_mismatches(mart, wanted, ["geography_code"], "population")


def run_suite(layers: Layers, expected_totals: Mapping[str, int] | None = None) -> DataFrame:
    """Results of all models and checks."""
    results = run_checks(layers.tables(), table_checks(expected_totals))
    return model_results(layers).unionByName(results)

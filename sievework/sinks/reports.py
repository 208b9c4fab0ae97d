"""Run summaries and manifests as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.operators.checks import gate_balance
from sievework.operators.provenance import RunMetadata

SUMMARY_SCHEMA = (
    "pipeline_run_id string, dataset_id string, edition string, version int, "
    "input_rows long, accepted_rows long, quarantined_rows long"
)


def run_summary(counts: DataFrame, run: RunMetadata) -> DataFrame:
    """One row: run identity and the three counts of :func:`gate_balance`.

    Counts are best taken from the source and the saved layers, not from metrics of the writing
    job, which may count a task twice when it runs again after a lost executor. Over Parquet they
    need the footers only.
    """
    return gate_balance(counts).select(
        F.lit(run.pipeline_run_id).alias("pipeline_run_id"),
        F.lit(run.dataset_id).alias("dataset_id"),
        F.lit(run.edition).alias("edition"),
        F.lit(run.version).cast("int").alias("version"),
        "input_rows",
        "accepted_rows",
        "quarantined_rows",
    )


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per row; NULL fields are written."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)

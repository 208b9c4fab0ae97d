"""Partitioned Parquet layers."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sievework.operators.gate import accepted_rows, quarantined_rows
from sievework.operators.provenance import RunMetadata, with_provenance
from sievework.operators.rules import ACCEPTED, OUTCOME
from sievework.operators.skew import spread_rows
from sievework.session import fresh_folder
from sievework.sources.tables import read_layer

# characters that Spark and Hive write as %XX in partition folder names
_ESCAPED = re.compile(r"[\x00-\x1f\"#%'*/:=?\\\x7f{}\[\]^]")


def partition_folder(column: str, value: str | None) -> str:
    """Name of the folder that Spark writes for a value of a partition column."""
    if value is None or value == "":
        return f"{column}=__HIVE_DEFAULT_PARTITION__"
    return f"{column}={_ESCAPED.sub(lambda m: f'%{ord(m.group()):02X}', value)}"


def version_path(path: str, edition: str, version: int) -> str:
    """Partition folder of one dataset version."""
    return f"{path}/{partition_folder('edition', edition)}/version={version}"


def replace_version(
    df: DataFrame, path: str, edition: str, version: int, partition_by: Sequence[str] = ()
) -> None:
    """Write the rows of one dataset version as that version's partition, replacing only it.

    The layout is that of ``partitionBy("edition", "version", *partition_by)``. Overwriting the
    folder itself keeps other versions, and also removes partitions (say, a quality rule that no
    longer fires) which dynamic overwrite would leave behind. A row that says it belongs to another
    edition or version stops the write.
    """
    for name, value in (("edition", edition), ("version", version)):
        if name in df.columns:
            message = F.format_string(f"a row of {name} %s among those of {value}", F.col(name).cast("string"))
            ours = F.col(name).cast("string").eqNullSafe(F.lit(str(value)))
            df = df.filter(F.when(ours, True).otherwise(F.raise_error(message).cast("boolean")))
    (
        df.drop("edition", "version")
        .write.mode("overwrite")
        .partitionBy(*partition_by)
        .parquet(version_path(path, edition, version))
    )


def save_gated(gated: DataFrame, path: str, run: RunMetadata) -> tuple[DataFrame, DataFrame]:
    """Save a gate result once, partitioned by edition, version and rule; (accepted, quarantined).

    Accepted rows are the partition without a rule, so each part is read without the other and
    nothing is written twice.
    """
    replace_version(gated, path, run.edition, run.version, [OUTCOME])
    saved = _saved(gated.sparkSession, path, gated.schema, run)
    return accepted_rows(saved), quarantined_rows(saved)


def write_gate_result(
    gated: DataFrame,
    run: RunMetadata,
    curated_path: str,
    quarantine_path: str,
    stage_path: str | None = None,
    hash_columns: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Save accepted rows by edition and version, quarantined rows also by rule, in two places.

    For readers that need separate folders; :func:`save_gated` spares the extra copy. Returns both
    parts as read back. The gate runs once: its result is staged in a table partitioned by outcome
    (by default in the shared folder), and both layers are narrow copies of their part of it. The
    staged table is emptied once both are written.

    With ``hash_columns`` the gate result is one without provenance: it is staged and shuffled as it is, and the copies get
    the run's stamp and their fingerprints as they are written, which spares the staged table the widest columns.
    """

    def stamped(part: DataFrame) -> DataFrame:
        return part if hash_columns is None else with_provenance(part, run, hash_columns)

    spark: SparkSession = gated.sparkSession
    stage_path = stage_path or fresh_folder(spark, "gate")
    outcome = F.coalesce(F.col(OUTCOME), F.lit(ACCEPTED))
    staged_outcome = "_outcome"
    (
        gated.withColumn(staged_outcome, outcome)
        .write.mode("overwrite")
        .partitionBy(staged_outcome)
        .parquet(stage_path)
    )
    staged_schema = StructType([*gated.schema.fields]).add(staged_outcome, "string")
    staged = read_layer(spark, stage_path, staged_schema)
    passed = staged.filter(F.col(staged_outcome) == ACCEPTED).drop(staged_outcome)
    failed = staged.filter(F.col(staged_outcome) != ACCEPTED).drop(staged_outcome)
    accepted = stamped(accepted_rows(passed))
    # even files per rule, also when one rule holds most rows, and a bounded sort by rule in each task
    quarantined = stamped(spread_rows(quarantined_rows(failed)))
    replace_version(accepted, curated_path, run.edition, run.version)
    replace_version(quarantined, quarantine_path, run.edition, run.version, [OUTCOME])
    spark.createDataFrame([], gated.schema).write.mode("overwrite").parquet(stage_path)
    return (
        _saved(spark, curated_path, accepted.schema, run),
        _saved(spark, quarantine_path, quarantined.schema, run),
    )


def _saved(spark: SparkSession, path: str, schema: StructType, run: RunMetadata) -> DataFrame:
    # partition columns come back last; select restores the declared order
    saved = read_layer(spark, path, schema).select(*schema.names)
    return saved.filter((F.col("edition") == run.edition) & (F.col("version") == run.version))


def save_layer(df: DataFrame, path: str) -> DataFrame:
    """Write a layer and go on from the saved rows, which cuts the lineage."""
    df.write.mode("overwrite").parquet(path)
    return read_layer(df.sparkSession, path, df.schema)

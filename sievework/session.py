"""Session settings and the shared folder for data that must outlive an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE coalesces small shuffle partitions, splits skewed join partitions and picks broadcast joins
# from measured sizes; UTC keeps timestamps comparable between engines.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # of a repeated key in JSON the last value counts
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def create_session(app: str = "sievework", master: str | None = None, **conf: str) -> SparkSession:
    """Start a session with :data:`SETTINGS`; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a cluster a missing
    setting is an error, because a machine-local folder would be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if spark.conf.get("spark.master", "").startswith("local"):
        return tempfile.gettempdir()
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/sievework/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, computed once."""
    folder = fresh_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)

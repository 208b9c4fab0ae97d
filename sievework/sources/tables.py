"""Saved layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or view."""
    return spark.table(name)


def read_layer(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A Parquet layer with a declared schema.

    The schema keeps partition values such as ``edition`` text, and lets a layer without a single
    row (an empty quarantine) be read at all.
    """
    return spark.read.schema(schema).parquet(path)

"""JSON evidence documents."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_json_objects(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row per file that holds a JSON object; a missing path or another JSON value gives none.

    Malformed JSON fails the read.
    """
    try:
        texts = spark.read.text(path, wholetext=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    objects = texts.filter(F.ltrim(F.regexp_replace("value", r"^\s+", "")).startswith("{"))
    parsed = F.from_json("value", schema, {"mode": "FAILFAST"})
    return objects.select(parsed.alias("d")).select("d.*")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``path, content`` of every text file below ``path``, one row per file."""
    return spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("content")
    )

"""Materialise a model as a view or as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def materialize(df: DataFrame, name: str, kind: str = "view", path: str | None = None) -> DataFrame:
    """Register ``df`` as a temporary view or save it as a catalog table; returns the relation.

    A table is stored at ``path`` if given. A rerun replaces either.
    """
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        writer = df.write.mode("overwrite").format("parquet")
        (writer.option("path", path) if path else writer).saveAsTable(name)
    else:
        raise ValueError(f"kind must be view or table, not {kind!r}")
    return df.sparkSession.table(name)


def register_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Catalog table over an already saved Parquet layer; nothing is copied.

    A rerun points the name at the new place; dropping such a table leaves its files alone.
    """
    spark.sql(f"drop table if exists {name}")
    return spark.catalog.createTable(name, path=path, source="parquet")

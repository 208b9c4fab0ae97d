"""Relational databases through Spark's JDBC writer."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    user: str,
    password: str,
    mode: str = "append",
    driver: str = "org.postgresql.Driver",
    connections: int = 16,
    batch_rows: int = 10_000,
) -> None:
    """Append to a table, or with ``mode="overwrite"`` truncate and refill it.

    Truncation keeps the table and the views on it. ``connections`` bounds the parallel writers,
    whatever the number of partitions. Partitions commit on their own, so after a failed append the
    table should be refilled with ``overwrite``.
    """
    settings = {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
        "truncate": True,
        "numPartitions": connections,
        "batchsize": batch_rows,
    }
    df.write.format("jdbc").options(**settings).mode(mode).save()

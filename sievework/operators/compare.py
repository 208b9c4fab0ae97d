"""Compare two results as multisets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that differ in number, with ``left_rows`` and ``right_rows``.

    One shuffle for both directions, and copies are counted map-side instead of being replayed.
    """
    columns = left.columns
    both = left.select("*", F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select("*", F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    return (
        both.groupBy(*columns)
        .agg(F.sum("_l").alias("left_rows"), F.sum("_r").alias("right_rows"))
        .filter(F.col("left_rows") != F.col("right_rows"))
    )


def compare_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: rows of either side, rows without a counterpart on the other, and whether there are none."""
    columns = left.columns
    counted = (
        left.select("*", F.lit(1).alias("_l"), F.lit(0).alias("_r"))
        .unionByName(right.select("*", F.lit(0).alias("_l"), F.lit(1).alias("_r")))
        .groupBy(*columns)
        .agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    )

    def total(column) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).cast("long")

    sums = counted.agg(
        total(F.col("_l")).alias("left_rows"),
        total(F.col("_r")).alias("right_rows"),
        total(F.abs(F.col("_l") - F.col("_r"))).alias("different_rows"),
    )
    return sums.withColumn("same", F.col("different_rows") == 0)


def same_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: ``different_rows`` and ``same``."""
    return compare_rows(left, right).select("different_rows", "same")

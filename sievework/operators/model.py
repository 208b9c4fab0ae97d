"""Staging, dimensions, facts, marts and layer counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sievework.functions.keys import composite_key, surrogate_key


def rename_columns(df: DataFrame, old: Sequence[str], new: Sequence[str]) -> DataFrame:
    """Positional rename; both lists must have the same length."""
    return df.select(*[F.col(f"`{o}`").alias(n) for o, n in zip(old, new, strict=True)])


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Typed projection onto a declared schema; keeps the grain."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def build_dimension(df: DataFrame, name: str, code: str, label: str) -> DataFrame:
    """One row per code with its surrogate key and the largest label."""
    return (
        df.groupBy(code)
        .agg(F.max(label).alias(label))
        .select(surrogate_key(code).alias(f"{name}_key"), code, label)
    )


def build_fact(
    df: DataFrame,
    key_parts: Sequence[str],
    dimensions: Mapping[str, str],
    keep: Sequence[str],
    key_name: str = "observation_key",
) -> DataFrame:
    """Fact at the grain of ``df``: composite key, one surrogate key per ``{name: code}``, ``keep``.

    Dimension keys are computed, so no join is needed.
    """
    return df.select(
        composite_key(key_parts).alias(key_name),
        *[surrogate_key(code).alias(f"{name}_key") for name, code in dimensions.items()],
        *keep,
    )


def build_mart(
    fact: DataFrame,
    dimension: DataFrame,
    on: str,
    group_by: Sequence[str],
    measure: str,
    total: str,
) -> DataFrame:
    """Sum of ``measure`` per dimension attributes and ``group_by`` columns of the fact.

    The fact is summed per key first (combined map-side), so the join sees one row per key and
    group however skewed the fact is. Rows without a dimension member drop out (inner join).
    """
    attributes = [c for c in dimension.columns if c != on]
    per_key = fact.groupBy(on, *group_by).agg(F.sum(measure).alias(total))
    return (
        per_key.join(dimension, on)
        .groupBy(*attributes, *group_by)
        .agg(F.sum(total).alias(total))
    )


def layer_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """``(layer, row_count)`` for every named layer."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
        for name, df in layers.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionAll(other)
    return result


def layer_measures(layers: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """``(layer, row_count, total)`` for every named layer and its measure column.

    Unlike a bare count, the sum makes each layer produce its rows. All layers share one aggregation.
    """
    rows = None
    for name, (df, measure) in layers.items():
        part = df.select(F.lit(name).alias("layer"), F.col(measure).cast("decimal(28,0)").alias("_m"))
        rows = part if rows is None else rows.unionAll(part)
    return rows.groupBy("layer").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("_m").cast("long").alias("total")
    )

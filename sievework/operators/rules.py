"""Ordered row rules: the first one that holds names the row's problem."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.text import any_missing

# The outcome names readers of quarantined rows rely on.
OUTCOME = "quality_rule"
MISSING_DIMENSION = "missing_dimension"
INVALID_OBSERVATION = "invalid_observation"
NEGATIVE_OBSERVATION = "negative_observation"
CONFLICTING_DUPLICATE = "conflicting_duplicate"
EXACT_DUPLICATE = "exact_duplicate"
ACCEPTED = "accepted"


@dataclass(frozen=True)
class Rule:
    """A named condition; NULL counts as not violated."""

    name: str
    violated: Column


def standard_rules(dimensions: Sequence[str], measure: str | None) -> list[Rule]:
    """Missing dimension, then unusable measure, then negative measure."""
    rules = [Rule(MISSING_DIMENSION, any_missing(dimensions))] if dimensions else []
    if measure:
        rules += [
            Rule(INVALID_OBSERVATION, F.col(measure).isNull()),
            Rule(NEGATIVE_OBSERVATION, F.col(measure) < 0),
        ]
    return rules


def first_violation(rules: Sequence[Rule]) -> Column:
    """Name of the first violated rule, NULL for a valid row."""
    if not rules:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.when(rule.violated, F.lit(rule.name)) for rule in rules])


def classify(df: DataFrame, rules: Sequence[Rule], outcome: str = OUTCOME) -> DataFrame:
    """Add the outcome column."""
    return df.withColumn(outcome, first_violation(rules))


def split(df: DataFrame, outcome: str = OUTCOME) -> tuple[DataFrame, DataFrame]:
    """(valid rows without the outcome column, invalid rows with it)."""
    return df.filter(F.col(outcome).isNull()).drop(outcome), df.filter(F.col(outcome).isNotNull())


def count_by_outcome(df: DataFrame, outcome: str = OUTCOME) -> DataFrame:
    """Rows per outcome, valid rows as ``accepted``."""
    label = F.coalesce(F.col(outcome), F.lit(ACCEPTED))
    return df.groupBy(label.alias(outcome)).agg(F.count(F.lit(1)).alias("n"))

"""Table checks. Each returns the failing rows or a small result; none collects."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.operators.model import layer_counts
from sievework.operators.rules import OUTCOME

# Which result statuses count as healthy and which as broken.
PASSED_STATUSES = ("success", "pass")
FAILED_STATUSES = ("error", "fail", "runtime error")

RESULT_COLUMNS = ("check", "target", "column", "failures", "status")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, failures)`` for all columns in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column", "failures")


def repeated_values(df: DataFrame, column: str | Sequence[str]) -> DataFrame:
    """``(column, n)`` of the values, or combinations of several columns' values, that occur more than
    once; those with a NULL are ignored.

    Counting the columns gives NULL no count. A null filter would be pushed below a computed column
    (a digest of a long text, say) and compute it twice.
    """
    columns = [column] if isinstance(column, str) else list(column)
    return df.groupBy(*columns).agg(F.count_if(_all_present(columns)).alias("n")).filter(F.col("n") > 1)


def _all_present(columns: Sequence[str]) -> Column:
    return reduce(and_, (F.col(c).isNotNull() for c in columns))


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """``(column, n)`` of child keys without a parent; NULLs are ignored.

    Child rows are counted per key before the join, so a hot key is one row there.
    """
    keys = (
        child.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return keys.join(parent.select(F.col(field).alias(column)), column, "left_anti")


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """The child rows themselves. A plain anti join, whose hot partitions AQE splits."""
    present = child.filter(F.col(column).isNotNull())
    return present.join(parent.select(F.col(field).alias(column)), column, "left_anti")


def negative_rows(df: DataFrame, measure: str) -> DataFrame:
    """Rows whose measure is below zero."""
    return df.filter(F.col(measure) < 0)


def layer_mismatch(counts: DataFrame) -> DataFrame:
    """One row when the layers of :func:`layer_counts` differ in size, else none."""
    return counts.agg(
        F.min("row_count").alias("minimum_count"), F.max("row_count").alias("maximum_count")
    ).filter(F.col("minimum_count") != F.col("maximum_count"))


def gate_counts(source: DataFrame, gated: DataFrame) -> DataFrame:
    """``(layer, row_count)`` of the input and both parts of a gate result, from one gate run."""
    parts = gated.agg(
        F.count_if(F.col(OUTCOME).isNull()).alias("accepted"),
        F.count_if(F.col(OUTCOME).isNotNull()).alias("quarantined"),
    ).unpivot([], ["accepted", "quarantined"], "layer", "row_count")
    return layer_counts({"input": source}).unionAll(parts)


def gate_balance(counts: DataFrame) -> DataFrame:
    """One row: input, accepted and quarantined rows and whether they balance.

    ``counts`` comes from :func:`gate_counts`, or from :func:`layer_counts` over saved layers.
    """
    rows = {
        name: F.coalesce(F.sum(F.when(F.col("layer") == name, F.col("row_count"))), F.lit(0))
        for name in ("input", "accepted", "quarantined")
    }
    balanced = F.col("input_rows") == F.col("accepted_rows") + F.col("quarantined_rows")
    sums = counts.agg(*[total.alias(f"{name}_rows") for name, total in rows.items()])
    return sums.withColumn("balanced", balanced)


def total_mismatches(
    actual: DataFrame, expected: DataFrame, key: Sequence[str], total: str
) -> DataFrame:
    """Keys whose total differs, is unexpected or is missing.

    Both sides hold one row per key (they are aggregates), so the full outer join has no skew.
    """
    return (
        actual.select(*key, F.col(total).alias("actual"))
        .join(expected.select(*key, F.col(total).alias("expected")), list(key), "full_outer")
        .filter(~F.col("actual").eqNullSafe(F.col("expected")))
    )


def source_freshness(
    df: DataFrame, column: str, now: datetime | str, warn_days: float, error_days: float
) -> DataFrame:
    """One row: latest value, its age in days at ``now`` and pass / warn / error.

    An empty source has no age and is an error.
    """
    latest = df.agg(F.max(column).alias("latest"))
    clock = F.lit(now) if isinstance(now, datetime) else F.to_timestamp(F.lit(now))
    seconds = F.unix_micros(clock.cast("timestamp")) - F.unix_micros(
        F.col("latest").cast("timestamp")
    )
    age = (seconds / F.lit(86_400_000_000)).alias("age_days")
    status = (
        F.when(F.col("latest").isNull() | (F.col("age_days") > error_days), "error")
        .when(F.col("age_days") > warn_days, "warn")
        .otherwise("pass")
    )
    return latest.select("latest", age).withColumn("status", status)


@dataclass(frozen=True)
class NotNull:
    """No NULL in any of the columns."""

    table: str
    columns: Sequence[str]


@dataclass(frozen=True)
class Unique:
    """No value occurs twice; a failure is a repeated value."""

    table: str
    column: str


@dataclass(frozen=True)
class Related:
    """Every key of the table exists in ``field`` of another; a failure is a row."""

    table: str
    column: str
    to: str
    field: str


@dataclass(frozen=True)
class Finds:
    """A query over the tables that must return no row."""

    name: str
    table: str
    failing: Callable[[Mapping[str, DataFrame]], DataFrame]


Check = NotNull | Unique | Related | Finds


def _result(frame: DataFrame, check: str, target: str, column, failures) -> DataFrame:
    return frame.select(
        F.lit(check).alias("check"),
        F.lit(target).alias("target"),
        column.alias("column"),
        F.coalesce(failures, F.lit(0)).cast("long").alias("failures"),
    )


def _run(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    df = tables[check.table]
    if isinstance(check, NotNull):
        counts = null_counts(df, check.columns)
        return _result(counts, "not_null", check.table, F.col("column"), F.col("failures"))
    if isinstance(check, Unique):
        repeated = repeated_values(df, check.column).agg(F.count(F.lit(1)).alias("n"))
        return _result(repeated, "unique", check.table, F.lit(check.column), F.col("n"))
    if isinstance(check, Related):
        orphans = orphan_keys(df, check.column, tables[check.to], check.field)
        total = orphans.agg(F.sum("n").alias("n"))
        return _result(total, "relationships", check.table, F.lit(check.column), F.col("n"))
    found = check.failing(tables).agg(F.count(F.lit(1)).alias("n"))
    return _result(found, check.name, check.table, F.lit(None).cast("string"), F.col("n"))


def _one_pass_per_table(checks: Sequence[Check]) -> list[Check]:
    columns: dict[str, list[str]] = {}
    others: list[Check] = []
    for check in checks:
        if isinstance(check, NotNull):
            known = columns.setdefault(check.table, [])
            known += [c for c in check.columns if c not in known]
        else:
            others.append(check)
    return [NotNull(table, names) for table, names in columns.items()] + others


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row per check and column: ``check, target, column, failures, status``.

    All not-null checks of a table share one scan. Give saved tables: each check reads its input.
    """
    results = [_run(check, tables) for check in _one_pass_per_table(checks)]
    combined = results[0]
    for result in results[1:]:
        combined = combined.unionByName(result)
    return combined.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def summarize_results(results: DataFrame) -> DataFrame:
    """One row: executed, passed and failed. Other statuses (warn, skipped) count as neither."""
    return results.agg(
        F.count(F.lit(1)).alias("executed"),
        F.count_if(F.col("status").isin(*PASSED_STATUSES)).alias("passed"),
        F.count_if(F.col("status").isin(*FAILED_STATUSES)).alias("failed"),
    )

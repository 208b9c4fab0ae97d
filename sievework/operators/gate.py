"""Quality gate: every row gets an outcome, NULL meaning accepted.

Ordinary keys take one shuffle, one sort and one window. The rows of keys too large for one task
(:mod:`sievework.operators.skew`) are ranked in lanes, saved, and settled by a small summary per key that is
broadcast back to them. Either way the rows themselves pass through unchanged, and the order that
chooses among duplicates is total over their exact values.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.functions.text import trim_columns
from sievework.operators.rules import (
    ACCEPTED,
    CONFLICTING_DUPLICATE,
    EXACT_DUPLICATE,
    INVALID_OBSERVATION,
    OUTCOME,
    Rule,
    classify,
    standard_rules,
)
from sievework.operators.skew import HEAVY_ROWS, TASK_ROWS, heavy_keys, is_heavy, tasks_for
from sievework.session import saved

# Invalid rows spread over this many groups, and those of a heavy key in one input partition over 16.
_LANES = 1 << 20
_HEAVY_LANES = 16
# Summaries of heavy keys are broadcast up to this number of keys.
_BROADCAST_KEYS = 100_000


@dataclass(frozen=True)
class GateSpec:
    """What the gate checks.

    ``dimensions`` are text columns that are trimmed and must be present. Rows sharing ``key`` must
    agree on ``measure``; among agreeing rows one is kept, the first by ``order_by`` and then by
    all remaining columns. Without a measure all rows of a key agree.
    """

    key: Sequence[str]
    measure: str | None = None
    dimensions: Sequence[str] = ()
    order_by: Sequence[str] = ()
    rules: Sequence[Rule] | None = None
    all_whitespace: bool = False

    def row_rules(self) -> Sequence[Rule]:
        """Own or standard rules; a row without its measure is invalid in any case."""
        if self.rules is None:
            return standard_rules(self.dimensions, self.measure)
        if self.measure is None:
            return self.rules
        return [*self.rules, Rule(INVALID_OBSERVATION, F.col(self.measure).isNull())]

    def ranking(self, columns: Sequence[str]) -> list[str]:
        """Columns that order the rows of one key."""
        settled = {*self.key, *self.order_by, self.measure}
        return [*self.order_by, *(c for c in columns if c not in settled)]


def quality_gate(
    df: DataFrame,
    spec: GateSpec,
    heavy: Sequence[int] | None = None,
    heavy_rows: int = HEAVY_ROWS,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """All rows of ``df``, cleaned, with their outcome in ``quality_rule``.

    Invalid rows take no part in conflict or duplicate detection. ``heavy`` may pass a known result
    of :func:`heavy_keys`. With ``[]`` nothing runs until the result is used; by default one job over the key
    columns looks for heavy keys first. The rows of heavy keys are ranked and saved in the shared folder, and
    the input is read twice, so save a costly or random input before.

    As that job counts the rows, tables beyond four times ``task_rows`` are dealt out over tasks of about so many rows,
    whatever the session's number of shuffle partitions. Given ``heavy``, the session's number holds.
    """
    tagged = _apply_row_rules(df, spec)
    valid = F.col(OUTCOME).isNull()
    tasks = 1
    if heavy is None:
        rows = tagged.count()
        heavy = heavy_keys(tagged, spec.key, heavy_rows, among=valid, rows=rows)
        tasks = tasks_for(rows, task_rows) if rows > 4 * task_rows else 1
    if not heavy:
        return _settle_by_window(tagged, spec, df, tasks)
    large = valid & is_heavy(spec.key, heavy)
    by_window = _settle_by_window(tagged.filter(~large), spec, df, tasks)
    by_lanes = _settle_by_lanes(tagged.filter(large).drop(OUTCOME), spec, df, len(heavy))
    return by_window.unionByName(by_lanes)


def _apply_row_rules(df: DataFrame, spec: GateSpec) -> DataFrame:
    if OUTCOME in df.columns:
        raise ValueError(f"the input already has a column {OUTCOME}")
    return classify(trim_columns(df, spec.dimensions, spec.all_whitespace), spec.row_rules())


def _exact(field: T.StructField) -> Column | None:
    """Text that differs whenever values that compare equal differ; None if there are no such values."""
    text = field.dataType.simpleString()
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        binary = field.dataType == T.StringType()
        return None if binary else F.collate(column.cast("string"), "UTF8_BINARY")
    if "float" in text or "double" in text or "collate" in text:
        return F.collate(column.cast("string"), "UTF8_BINARY")
    return None


def _total_order(spec: GateSpec, df: DataFrame) -> list[Column]:
    """Order of the rows of one key, measure first: it ends with the exact forms of values that compare
    equal without being the same (signed zeros, collated text), so which copy comes first is repeatable."""
    measure = [spec.measure] if spec.measure else []
    exact = [e for e in map(_exact, df.schema.fields) if e is not None]
    return [*map(F.col, [*measure, *spec.ranking(df.columns)]), *exact]


def _settle_by_window(tagged: DataFrame, spec: GateSpec, df: DataFrame, tasks: int = 1) -> DataFrame:
    order = _total_order(spec, df)
    # Invalid rows share missing keys. They pass through in lanes by their content instead of in one
    # group, which spares a second scan and, being deterministic, leaves filters free to reach it.
    lane = F.pmod(F.xxhash64(F.lit(0), *order), F.lit(_LANES))
    lanes = tagged.withColumn("_lane", F.when(F.col(OUTCOME).isNotNull(), lane))
    if tasks > 1:  # the exchange that the window needs anyway, with a number of partitions that follows the rows
        lanes = lanes.repartition(tasks, *spec.key, "_lane")
    rows = Window.partitionBy(*spec.key, "_lane").orderBy(*order)
    # With the measure leading the order, its extremes are the first and last value of the group and the rank
    # within a conflict-free key is the rank within (key, measure): one window serves all.
    rank = F.row_number().over(rows)
    verdict = F.when(rank > 1, F.lit(EXACT_DUPLICATE))
    if spec.measure:
        group = rows.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        conflict = F.first(spec.measure).over(group) != F.last(spec.measure).over(group)
        verdict = F.when(conflict, F.lit(CONFLICTING_DUPLICATE)).otherwise(verdict)
    return lanes.select(*df.columns, F.coalesce(F.col(OUTCOME), verdict).alias(OUTCOME))


def _settle_by_lanes(rows: DataFrame, spec: GateSpec, df: DataFrame, keys: int) -> DataFrame:
    """Outcomes of keys too large for a task: a rank per lane, then one summary row per key."""
    order = _total_order(spec, df)
    slot = F.pmod(F.xxhash64(F.lit(0), *order), F.lit(_HEAVY_LANES))
    lane = F.spark_partition_id().cast("long") * _HEAVY_LANES + slot
    in_lane = Window.partitionBy(*spec.key, "_lane").orderBy(*order)
    # saved, so that a lane is the same for the summary and for the rows
    ranked = saved(
        rows.withColumn("_lane", lane).withColumn("_rank", F.row_number().over(in_lane)), "heavy-rows"
    )
    conflict: Column = F.lit(False)
    if spec.measure:
        conflict = F.min(spec.measure) != F.max(spec.measure)
    # the first rows of all lanes hold the first row of the key; identical ones differ by lane
    first = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], "_lane")
    summary = ranked.groupBy(*[F.col(c).alias(f"_k_{c}") for c in spec.key]).agg(
        conflict.alias("_conflict"),
        F.min_by("_lane", F.when(F.col("_rank") == 1, first)).alias("_first"),
    )
    if keys <= _BROADCAST_KEYS:
        summary = F.broadcast(summary)
    same_key = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in spec.key))
    kept = (F.col("_rank") == 1) & (F.col("_lane") == F.col("_first"))
    verdict = (
        F.when(F.col("_conflict"), F.lit(CONFLICTING_DUPLICATE)).when(~kept, F.lit(EXACT_DUPLICATE))
    )
    return ranked.join(summary, same_key).select(*df.columns, verdict.alias(OUTCOME))


def count_outcomes(df: DataFrame, spec: GateSpec) -> DataFrame:
    """``(quality_rule, n)`` of :func:`quality_gate` without making its rows.

    For a look at a source before a run: sums per key, combined map-side, instead of a window.
    """
    tagged = _apply_row_rules(df, spec)
    valid = F.col(OUTCOME).isNull()
    # invalid rows need no key, so they are one group per rule
    keys = [F.when(valid, F.col(c)).alias(f"_k{i}") for i, c in enumerate(spec.key)]
    conflict: Column = F.lit(False)
    if spec.measure:
        conflict = F.min(spec.measure) != F.max(spec.measure)
    per_key = tagged.groupBy(OUTCOME, *keys).agg(
        F.count(F.lit(1)).alias("_n"), conflict.alias("_conflict")
    )

    def share(rule: Column, n: Column) -> Column:
        return F.struct(rule.alias(OUTCOME), n.cast("long").alias("n"))

    accepted, rest = F.lit(ACCEPTED), F.lit(EXACT_DUPLICATE)
    shares = (
        F.when(F.col(OUTCOME).isNotNull(), F.array(share(F.col(OUTCOME), F.col("_n"))))
        .when(F.col("_conflict"), F.array(share(F.lit(CONFLICTING_DUPLICATE), F.col("_n"))))
        .otherwise(F.array(share(accepted, F.lit(1)), share(rest, F.col("_n") - 1)))
    )
    return (
        per_key.select(F.inline(shares))
        .filter(F.col("n") > 0)
        .groupBy(OUTCOME)
        .agg(F.sum("n").alias("n"))
    )


def accepted_rows(gated: DataFrame) -> DataFrame:
    """Rows that passed, without the outcome column."""
    return gated.filter(F.col(OUTCOME).isNull()).drop(OUTCOME)


def quarantined_rows(gated: DataFrame) -> DataFrame:
    """Rows that did not pass, with the reason."""
    return gated.filter(F.col(OUTCOME).isNotNull())


def conflicting_keys(df: DataFrame, key: Sequence[str], measure: str) -> DataFrame:
    """Keys with more than one measure value; partial aggregates keep hot keys small."""
    return (
        df.groupBy(*key)
        .agg(F.min(measure).alias("_lo"), F.max(measure).alias("_hi"))
        .filter(F.col("_lo") != F.col("_hi"))
        .select(*key)
    )


def mark_duplicates(
    df: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str] = (),
    heavy: Sequence[int] | None = None,
) -> DataFrame:
    """Deterministic de-duplication: all rows but the first of each key get ``exact_duplicate``.

    For long texts use a saved table of their digests as input.
    """
    return quality_gate(df, GateSpec(key=key, order_by=order_by, rules=()), heavy=heavy)

"""Versions of a table against each other: changes, revision marts, histories and as-of look-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ADDED, REMOVED, REVISED, UNCHANGED = "added", "removed", "revised", "unchanged"

# Versions of a dataset that are broadcast to a history at most.
MOST_VERSIONS = 100_000
# Pieces a validity window is cut into at most for an as-of look-up.
WINDOW_PIECES = 64


def version_changes(old: DataFrame, new: DataFrame, key: Sequence[str], values: Sequence[str] | None = None) -> DataFrame:
    """Every key of either version with ``change``, ``old`` and ``new`` (structs of ``values``, NULL where the key is absent).

    One aggregation over the union, no join: NULL keys match each other, and a key whose values are all NULL is
    still told from an absent one. ``values`` are by default all columns besides the key; they are compared
    null-safe. A key that one version holds twice stops the job (gate the versions before).
    """
    values = list(values or [c for c in old.columns if c not in key])
    held = F.struct(*values)

    def side(df: DataFrame, is_new: bool) -> DataFrame:
        absent = F.lit(None)
        return df.select(*key, (absent if is_new else held).alias("_old"), (held if is_new else absent).alias("_new"))

    grouped = side(old, False).unionByName(side(new, True)).groupBy(*key).agg(
        F.count("_old").alias("_n_old"),
        F.count("_new").alias("_n_new"),
        F.first("_old", ignorenulls=True).alias("old"),
        F.first("_new", ignorenulls=True).alias("new"),
    )
    twice = F.raise_error(F.concat(F.lit("key occurs twice in one version: "), F.to_json(F.struct(*key))))
    change = (
        F.when((F.col("_n_old") > 1) | (F.col("_n_new") > 1), twice.cast("string"))
        .when(F.col("_n_old") == 0, ADDED)
        .when(F.col("_n_new") == 0, REMOVED)
        .when(F.col("old").eqNullSafe(F.col("new")), UNCHANGED)
        .otherwise(REVISED)
    )
    return grouped.select(*key, change.alias("change"), "old", "new")


def with_deltas(changes: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Add ``<measure>_delta``, new minus old with an absent or NULL side counting as 0."""

    def value(side: str, name: str) -> Column:
        return F.coalesce(F.col(side)[name], F.lit(0))

    return changes.withColumns({f"{m}_delta": value("new", m) - value("old", m) for m in measures})


def revision_mart(
    old: DataFrame, new: DataFrame, key: Sequence[str], by: Sequence[str], measure: str
) -> DataFrame:
    """Per group and kind of change: ``n_keys``, ``old_total``, ``new_total``, ``delta``.

    A key counts in its new group; one that was removed in its old group. A key that moved between groups is a revision of its new
    group, so totals per group are those of the new version once removed keys are left out.
    """
    # a group of NULL is a value too: the side decides, not the value
    group = [F.when(F.col("change") == REMOVED, F.col("old")[c]).otherwise(F.col("new")[c]).alias(c) for c in by]
    changes = with_deltas(version_changes(old, new, key), [measure])
    sums = changes.select("change", *group, F.col("old")[measure].alias("_old"), F.col("new")[measure].alias("_new"), f"{measure}_delta")

    def total(column: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).cast("long")

    return sums.groupBy(*by, "change").agg(
        F.count(F.lit(1)).alias("n_keys"),
        total("_old").alias("old_total"),
        total("_new").alias("new_total"),
        total(f"{measure}_delta").alias("delta"),
    )


def validity_windows(
    observed: DataFrame,
    key: Sequence[str],
    values: Sequence[str],
    version: str,
    versions: DataFrame | None = None,
) -> DataFrame:
    """History of every key: its values with ``valid_from`` and ``valid_to`` (first version in which they no longer
    hold, NULL while they do).

    ``observed`` holds each published version in full, in whatever order the versions arrived; a key that a version lacks was
    removed by it and may return. Equal values of versions that follow each other are one window (gaps and
    islands); windows of a key never overlap. ``versions`` lists all versions, by default those that
    ``observed`` has; a version with no row at all has to be listed. A (key, version) that is observed several times with the same values counts
    once. The list of versions is one row each and is broadcast; keys are sorted within the shuffle by key,
    where a key has at most one row per version.
    """
    named = (versions or observed).select(F.col(version).alias("_version")).distinct()
    if named.limit(MOST_VERSIONS + 1).count() > MOST_VERSIONS:
        raise ValueError(f"more than {MOST_VERSIONS} versions")
    every = Window.orderBy("_version")  # one row per version
    places = named.select(
        "_version", F.row_number().over(every).alias("_place"), F.lead("_version").over(every).alias("_next")
    )
    rows = observed.select(*key, *values, F.col(version).alias("_version")).distinct()
    placed = rows.join(F.broadcast(places), "_version")
    of_key = Window.partitionBy(*key).orderBy("_place")
    held = F.struct(*values)
    continues = (F.lag("_place").over(of_key) == F.col("_place") - 1) & F.lag(held).over(of_key).eqNullSafe(held)
    # a window starts where the values do not go on; the same order serves all three passes
    starts = placed.withColumn("_island", F.sum(F.when(continues, 0).otherwise(1)).over(of_key))
    return starts.groupBy(*key, "_island").agg(
        *[F.min_by(v, "_place").alias(v) for v in values],
        F.min("_version").alias("valid_from"),
        F.max_by("_next", "_place").alias("valid_to"),
    ).drop("_island")


def as_of(history: DataFrame, probes: DataFrame, key: Sequence[str], at: str) -> DataFrame:
    """``probes`` with the values that held at their version ``at`` (an integer column), NULL where none did or a key is NULL.

    A window from ``valid_from`` up to ``valid_to`` is cut into pieces of equal width, and a probe lies in one piece, so the
    join is by key and piece: no comparison of a range with another one, and a key with very many probes
    spreads over its pieces. The width follows from the span of the probes, so that no window has
    more than ``WINDOW_PIECES`` + 1 pieces.
    """
    span = probes.agg(F.min(at).alias("lo"), F.max(at).alias("hi")).first()
    values = [c for c in history.columns if c not in (*key, "valid_from", "valid_to")]
    lo, hi = (span["lo"], span["hi"]) if span["lo"] is not None else (0, 0)
    width = max(1, -(-(hi - lo + 1) // WINDOW_PIECES))

    def piece(of: Column) -> Column:
        return F.floor((of - lo) / width).cast("int")

    # windows within the span of the probes
    first = F.greatest(F.col("valid_from"), F.lit(lo))
    last = F.least(F.coalesce(F.col("valid_to") - 1, F.lit(hi)), F.lit(hi))
    cut = (
        history.filter(first <= last)
        .withColumn("_piece", F.explode(F.sequence(piece(first), piece(last))))
        .select(*[F.col(c).alias(f"_k_{c}") for c in key], *values, "valid_from", "valid_to", "_piece")
    )
    asked = probes.withColumn("_at", F.col(at)).withColumn("_asked", piece(F.col("_at")))
    same = [asked[c] == cut[f"_k_{c}"] for c in key]
    holds = (
        (asked["_asked"] == cut["_piece"])
        & (cut["valid_from"] <= asked["_at"])
        & (cut["valid_to"].isNull() | (asked["_at"] < cut["valid_to"]))
    )
    for condition in same:
        holds = condition & holds
    return asked.join(cut, holds, "left").select(*[asked[c] for c in probes.columns], *values)

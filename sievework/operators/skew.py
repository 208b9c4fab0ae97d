"""Find the few keys that are too large for one task, share out rows among tasks, and join on keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# From so many rows a group is too much for one task.
HEAVY_ROWS = 1_000_000
# Rows that a task sorts or aggregates, about, and the most partitions of one exchange: beyond their product tasks grow.
TASK_ROWS = 250_000
MOST_TASKS = 20_000
# Keys fall into this many classes by hash, each with a sketch of its own for every task. A sketch's
# counts are off by at most about 3.5 / SKETCH_ITEMS of its class, which is 1/75,000 of all rows: beyond 75
# billion rows that, and no longer HEAVY_ROWS, is the smallest group found for certain. It also bounds
# the number of keys found.
CLASSES = 256
SKETCH_ITEMS = 1024
# Sketches are merged in this many tasks before the last ones merge the remaining.
_MERGE_LANES = 64


def tasks_for(rows: int, task_rows: int = TASK_ROWS) -> int:
    """Partitions of about ``task_rows`` rows each, so that a task's share does not grow with the table."""
    return min(max(1, -(-rows // task_rows)), MOST_TASKS)


def spread_rows(df: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """``df`` dealt out over tasks of about ``task_rows`` rows; unchanged if it has no more than one's share.

    For costly work on rows that a few large row groups of a file would leave to as many tasks. Rows are counted first.
    """
    n = tasks_for(df.count(), task_rows)
    return df.repartition(n) if n > 1 else df


def key_hash(key: Sequence[str]) -> Column:
    """64-bit routing hash of a key."""
    return F.xxhash64(*key)


def heavy_keys(
    df: DataFrame,
    key: Sequence[str],
    min_rows: int = HEAVY_ROWS,
    among: Column | None = None,
    rows: int | None = None,
) -> list[int]:
    """Routing hashes of the keys that hold at least ``min_rows`` rows, of those where ``among`` holds.

    Tables of fewer rows have none, which a bare count tells. Else the rows of each hash class are counted, and frequent-items
    sketches per task cover only the classes that are large enough: only sums and sketches are shuffled,
    never rows. The list only chooses between two exact ways to treat a key, so a missed or extra
    key (or a hash collision) costs time and never changes a result. ``rows`` may pass the known number of rows.
    """
    if (df.count() if rows is None else rows) < min_rows:
        return []
    chosen = df if among is None else df.filter(among)
    counts = chosen.groupBy(_hash_class(key_hash(key)).alias("class")).count()
    classes = [r["class"] for r in counts.filter(F.col("count") >= min_rows).collect()]  # at most 256
    if not classes:
        return []
    if len(classes) < CLASSES:
        chosen = chosen.filter(_hash_class(key_hash(key)).isin(classes))
    found = sketched_counts(chosen, key).filter(F.col("count") >= min_rows)
    return sorted(r["item"] for r in found.select("item").collect())  # at most 75,000


def _hash_class(key: Column) -> Column:
    return F.pmod(key, F.lit(CLASSES))


def sketched_counts(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """``item`` (routing hash) and ``count`` of the most frequent keys of each class."""
    hashed = rows.select(key_hash(key).alias("h"))
    kept = SKETCH_ITEMS // 4
    return (
        hashed.groupBy(
            _hash_class(F.col("h")).alias("class"),
            (F.spark_partition_id() % _MERGE_LANES).alias("lane"),
        )
        .agg(F.expr(f"approx_top_k_accumulate(h, {SKETCH_ITEMS})").alias("sketch"))
        .groupBy("class")
        .agg(
            F.expr(
                f"approx_top_k_estimate(approx_top_k_combine(sketch, {SKETCH_ITEMS}), {kept})"
            ).alias("top")
        )
        .select(F.inline("top"))
    )


def is_heavy(key: Sequence[str], heavy: Sequence[int]) -> Column:
    """Row test against a list from :func:`heavy_keys`."""
    return key_hash(key).isin(list(heavy)) if heavy else F.lit(False)


def rows_with_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys``; NULL keys never match.

    A plain semi join: the engine splits what is skewed on the side of ``df`` at run time.
    """
    return df.join(keys.select(*on), list(on), "left_semi")


def rows_without_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``keys``; rows with a NULL key are kept."""
    return df.join(keys.select(*on), list(on), "left_anti")

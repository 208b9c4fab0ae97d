"""Compare tables by trees of multiset digests, without moving or comparing rows.

Rows fall into leaves by the leading bits of their key's hash. A digest is the number of rows and the sums of two 64-bit row
hashes, so it does not depend on order or partitioning, partial sums combine, and the digest of a node is the sum of those below. Two
tables that agree have equal roots; otherwise the tree leads to the differing leaves, and only their rows are looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.operators.compare import multiset_difference

# Bits of a leaf's number, and bits by which each level above is shorter.
LEAF_BITS = 16
LEVEL_BITS = 4
_SUMS = ("n_rows", "sum_a", "sum_b")
_SEED = 0x5EED


def _leaf(key: Sequence[str], bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(_SEED), *key), 64 - bits)


def _hashes(columns: Sequence[str]) -> tuple[Column, Column]:
    """Two hashes of a row. NULLs are marked, since a hash passes over them; numbers of equal value and different type differ."""
    marks = F.concat(*[F.when(F.col(c).isNull(), F.lit("0")).otherwise(F.lit("1")) for c in columns])
    return F.xxhash64(F.lit(1), marks, *columns), F.xxhash64(F.lit(2), *columns, marks)


def leaf_digests(df: DataFrame, key: Sequence[str], columns: Sequence[str] | None = None, bits: int = LEAF_BITS) -> DataFrame:
    """``leaf``, ``n_rows``, ``sum_a``, ``sum_b`` of every leaf with rows; at most 2^bits rows, combined before the shuffle."""
    a, b = _hashes(list(columns or df.columns))
    hashed = df.select(_leaf(key, bits).alias("leaf"), a.alias("a"), b.alias("b"))
    exact = "decimal(38,0)"
    return hashed.groupBy("leaf").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("a").cast("decimal(19,0)")).cast(exact).alias("sum_a"),
        F.sum(F.col("b").cast("decimal(19,0)")).cast(exact).alias("sum_b"),
    )


def digest_tree(leaves: DataFrame, bits: int = LEAF_BITS) -> DataFrame:
    """All levels from the leaves (level ``bits``) to the root (level 0): ``level``, ``node`` and the sums.

    One aggregation: every leaf counts in each node above it.
    """
    levels = sorted({0, *range(bits, 0, -LEVEL_BITS)})
    above = F.array(*[F.struct(F.lit(n).alias("level"), F.shiftright("leaf", bits - n).alias("node")) for n in levels])
    spread = leaves.select(F.inline(above), *_SUMS)
    return spread.groupBy("level", "node").agg(*[F.sum(s).cast("decimal(38,0)").alias(s) for s in _SUMS])


def differing_nodes(left: DataFrame, right: DataFrame) -> DataFrame:
    """Nodes of two trees (or leaves of two tables) that differ, with the rows of both sides; ``right_rows`` is 0 where a node is absent."""
    named = [c for c in ("level", "node", "leaf") if c in left.columns]
    both = left.withColumn("_s", F.lit(1)).unionByName(right.withColumn("_s", F.lit(-1)))

    def rows(sign: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("_s") == sign, F.col("n_rows"))), F.lit(0)).cast("long")

    differs = [F.sum(F.col(s) * F.col("_s")) != 0 for s in _SUMS]
    return (
        both.groupBy(*named)
        .agg(rows(1).alias("left_rows"), rows(-1).alias("right_rows"), (differs[0] | differs[1] | differs[2]).alias("_d"))
        .filter("_d")
        .drop("_d")
    )


def same_content(left: DataFrame, right: DataFrame, key: Sequence[str], bits: int = LEAF_BITS) -> DataFrame:
    """One row: ``left_rows``, ``right_rows``, ``differing_leaves`` and ``same``. Rows are hashed where they are read."""
    columns = left.columns
    sides = [leaf_digests(df.select(*columns), key, columns, bits) for df in (left, right)]
    counted = sides[0].withColumn("_s", F.lit(1)).unionByName(sides[1].withColumn("_s", F.lit(-1)))
    per_leaf = counted.groupBy("leaf").agg(
        F.sum(F.when(F.col("_s") == 1, F.col("n_rows"))).alias("l"),
        F.sum(F.when(F.col("_s") == -1, F.col("n_rows"))).alias("r"),
        *[F.sum(F.col(s) * F.col("_s")).alias(s) for s in _SUMS],
    )
    unequal = (F.col("n_rows") != 0) | (F.col("sum_a") != 0) | (F.col("sum_b") != 0)
    return per_leaf.agg(
        F.coalesce(F.sum("l"), F.lit(0)).cast("long").alias("left_rows"),
        F.coalesce(F.sum("r"), F.lit(0)).cast("long").alias("right_rows"),
        F.count_if(unequal).alias("differing_leaves"),
    ).withColumn("same", F.col("differing_leaves") == 0)


def differing_rows(left: DataFrame, right: DataFrame, key: Sequence[str], bits: int = LEAF_BITS) -> DataFrame:
    """Rows whose numbers of copies differ (``left_rows``, ``right_rows``), looked for in differing leaves only.

    The list of differing leaves has at most 2^bits rows and is broadcast; both tables are then filtered where they are
    read, so what is shuffled are the rows of those leaves. Columns go by the names of ``left``.
    """
    columns = left.columns
    sides = [df.select(*columns) for df in (left, right)]
    leaves = differing_nodes(*[leaf_digests(df, key, columns, bits) for df in sides]).select("leaf")
    near = [
        df.withColumn("leaf", _leaf(key, bits)).join(F.broadcast(leaves), "leaf", "left_semi").drop("leaf") for df in sides
    ]
    return multiset_difference(*near)

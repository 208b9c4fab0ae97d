"""Distribution marts over several grouping levels at once, with mergeable quantile sketches.

A sketch is a histogram of whole numbers: numbers below 16 have a class each, and every power of two above is cut into eight
classes of equal width, so a class is at most an eighth of its numbers wide. Counts of classes add up, hence
sketches of groups merge to that of the group above, and quantiles come from any level alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOTAL = "total"


def value_class(value: Column) -> Column:
    """Number of the class of a whole number; negative ones mirror the positive ones, NULL stays NULL."""
    size = F.abs(value.cast("long"))
    power = F.length(F.bin(size)) - 1  # of the leading bit
    part = F.call_function("shiftright", size, power - 3) - 8
    upper = 16 + (power - 4) * 8 + part
    magnitude = F.when(size < 16, size).otherwise(upper)
    return F.when(value < 0, -magnitude).otherwise(magnitude).cast("int")


def class_floor(number: Column) -> Column:
    """The number of a class that is nearest to 0."""
    size = F.abs(number)
    power = F.floor((size - 16) / 8) + 4
    lower = F.call_function("shiftleft", (8 + (size - 16) % 8).cast("long"), (power - 3).cast("int"))
    magnitude = F.when(size < 16, size.cast("long")).otherwise(lower)
    return F.when(number < 0, -magnitude).otherwise(magnitude)


def with_bands(df: DataFrame, column: str, bands: Mapping[str, tuple[int | None, int | None]], name: str) -> DataFrame:
    """Add ``name``, the label of the first band (lowest and highest value, None for open) that holds the value, else NULL."""
    label = F.lit(None).cast("string")
    for text, (low, high) in reversed(list(bands.items())):
        inside = F.col(column).isNotNull()
        if low is not None:
            inside = inside & (F.col(column) >= low)
        if high is not None:
            inside = inside & (F.col(column) <= high)
        label = F.when(inside, F.lit(text)).otherwise(label)
    return df.withColumn(name, label)


def distribution_sketches(
    fact: DataFrame, levels: Mapping[str, Sequence[str]], measure: str
) -> DataFrame:
    """One row per level and group: ``level``, the grouping columns, ``n_rows``, ``total``, ``minimum``, ``maximum``, and the sketch as
    sorted ``classes`` (class, count).

    ``levels`` names each level and the columns it groups by. Rows are first summed per group of all columns and class, where they
    are read; only those sums are spread over the levels, so the data is scanned and shuffled once however many levels
    there are. A grouping column is NULL on levels without it; NULL is also a group of its own where a value is missing.
    """
    columns = list(dict.fromkeys(c for by in levels.values() for c in by))
    base = fact.groupBy(*columns, value_class(F.col(measure)).alias("_class")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.col(measure).cast("decimal(28,0)")).alias("_sum"),
        F.min(measure).alias("_min"),
        F.max(measure).alias("_max"),
    )
    types = {f.name: f.dataType for f in fact.schema.fields}
    sets = F.array(
        *[
            F.struct(
                F.lit(level).alias("level"),
                *[(F.col(c) if c in by else F.lit(None).cast(types[c])).alias(f"_g_{c}") for c in columns],
            )
            for level, by in levels.items()
        ]
    )
    spread = base.select(F.inline(sets), "_class", "_n", "_sum", "_min", "_max")
    group = ["level", *[f"_g_{c}" for c in columns]]
    per_class = spread.groupBy(*group, "_class").agg(
        F.sum("_n").alias("_n"), F.sum("_sum").alias("_sum"), F.min("_min").alias("_min"), F.max("_max").alias("_max")
    )
    classes = F.array_sort(F.collect_list(F.when(F.col("_class").isNotNull(), F.struct(F.col("_class").alias("class"), F.col("_n").alias("n")))))
    return per_class.groupBy(*group).agg(
        F.sum("_n").alias("n_rows"),
        F.sum("_sum").cast("decimal(38,0)").alias("total"),
        F.min("_min").alias("minimum"),
        F.max("_max").alias("maximum"),
        classes.alias("classes"),
    ).select("level", *[F.col(f"_g_{c}").alias(c) for c in columns], "n_rows", "total", "minimum", "maximum", "classes")


def quantile(classes: Column, share: float) -> Column:
    """The class floor of the value at ``share`` (0 to 1) of a sketch's values, NULL for an empty sketch."""
    total = F.aggregate(classes, F.lit(0).cast("long"), lambda acc, c: acc + c["n"])
    wanted = F.greatest(F.ceil(total * F.lit(share)), F.lit(1))
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("int").alias("found"))

    def step(acc: Column, c: Column) -> Column:
        seen = acc["seen"] + c["n"]
        return F.struct(seen.alias("seen"), F.when(acc["found"].isNull() & (seen >= wanted), c["class"]).otherwise(acc["found"]).alias("found"))

    return class_floor(F.aggregate(classes, start, step)["found"])


def distribution_mart(
    fact: DataFrame, levels: Mapping[str, Sequence[str]], measure: str, shares: Mapping[str, float]
) -> DataFrame:
    """:func:`distribution_sketches` with a column per named share (such as ``{"median": 0.5}``) in place of the sketch."""
    sketches = distribution_sketches(fact, levels, measure)
    return sketches.select("*", *[quantile(F.col("classes"), s).alias(n) for n, s in shares.items()]).drop("classes")


def rollup_mismatches(mart: DataFrame, parts: str, whole: str, by: Sequence[str]) -> DataFrame:
    """Groups of the level ``whole`` (by columns ``by``) whose ``n_rows`` or ``total`` is not the sum over the level ``parts``.

    One aggregation over both levels; a group that one of them lacks is a mismatch.
    """
    side = F.when(F.col("level") == parts, "parts").when(F.col("level") == whole, "whole")

    def total(name: str, of: str) -> Column:
        return F.sum(F.when(F.col("_side") == of, F.col(name)))

    sums = mart.withColumn("_side", side).filter(F.col("_side").isNotNull()).groupBy(*by).agg(
        total("n_rows", "parts").alias("parts_rows"), total("n_rows", "whole").alias("whole_rows"),
        total("total", "parts").alias("parts_total"), total("total", "whole").alias("whole_total"),
    )
    agree = F.col("parts_rows").eqNullSafe(F.col("whole_rows")) & F.col("parts_total").eqNullSafe(F.col("whole_total"))
    return sums.filter(~agree)

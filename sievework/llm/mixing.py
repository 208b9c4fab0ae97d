"""Mixing sources to target weights by entropy balancing.

Document rates r between 0 and ``most`` minimise the entropy distance from 1 under one word
constraint per source. The dual is convex with one multiplier t per source, and gives the tilted rates
``r = most / (1 + (most - 1) * exp(-t * size / mean size))``. Newton's method solves it: the
gradient and curvature of a step are sums over (source, size) classes, as documents of one class have
the same rate. Rates are rounded to copies class by class with the error carried on in order of
size, and the rest is made up by single copies of smaller documents.

DataFrame operations only; the driver sees nothing but whether a step changed something.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm.common import aside, restored, tasks, words, written

MOST = 3  # copies of a document, and multiple of its size that a source may reach
_STEPS = 100
_MENDS = 6
# Rows are dealt out by the leading bits of their draw, so that a rank never counts over more than
# about this share of a class.
_BUCKETS = 4096
# Classes are broadcast up to this many rows (some 100 MB); beyond, they are joined by a shuffle.
BROADCAST_CLASSES = 1_000_000


def source_targets(sizes: DataFrame, most: int = MOST) -> DataFrame:
    """``source``, ``source_size``, ``target`` from rows of ``source`` and ``size``.

    Sources by code point, NULL last, weigh 1, 2, 3, repeating. A target is the source's share of
    all words, at most ``most`` times its size; the excess goes to the others by weight. Ranges of
    sources are worked on apart, so no task holds them all.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    ranked = _with_sums_before(sums.withColumn("one", F.lit(1)), [F.col("source").asc_nulls_last()], ["one"])
    # Sharing again until none is above its cap ends at caps for the sources with the smallest cap
    # per weight and one common share per weight for the others.
    cap = (F.col("source_size") * most).cast("double")
    weighed = ranked.select(
        "source", "source_size", (F.col("one_before") % 3 + 1).cast("double").alias("weight"), cap.alias("cap")
    ).withColumn("ratio", F.col("cap") / F.col("weight"))
    steps = written(
        _with_sums_before(weighed, [F.col("ratio").asc(), F.col("source").asc_nulls_last()], ["cap", "weight"]),
        "mix-shares",
    )
    whole = steps.agg(F.sum("source_size").cast("double").alias("total"), F.sum("weight").alias("weights"))
    # the share per weight if all sources before this one are at their caps
    share = (F.col("total") - F.col("cap_before")) / (F.col("weights") - F.col("weight_before"))
    held = F.when(share <= F.col("ratio"), share)
    # It falls from the first that is not above its ratio on, also among equal ratios.
    common = steps.crossJoin(F.broadcast(whole)).agg(F.max(held).alias("common"))
    target = F.least(F.col("cap"), F.col("common") * F.col("weight"))
    return steps.crossJoin(F.broadcast(common)).select(
        "source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target")
    )


def _with_sums_before(rows: DataFrame, order: list[Column], names: list[str]) -> DataFrame:
    """``rows`` with the sums ``<name>_before`` over all rows that come before in this order, without ties.

    Tasks hold ranges of the order. Each sums up its own, and only the totals of the ranges, as many as
    the exchange has partitions, meet in one task.
    """
    ranges = written(
        rows.repartitionByRange(tasks(rows.sparkSession), *order).withColumn("_range", F.spark_partition_id()),
        "mix-ranges",
    )
    totals = ranges.groupBy("_range").agg(*[F.sum(n).alias(f"_{n}") for n in names])
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("_range").alias("_of"), *[F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}") for n in names]
    )
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = {f"{n}_before": F.coalesce(F.sum(n).over(within), F.lit(0)) + F.col(f"_{n}") for n in names}
    joined = ranges.join(F.broadcast(offsets), F.col("_range") == F.col("_of"))
    return joined.withColumns(before).select(*rows.columns, *before)


def _rate(tilt: Column, x: Column, most: int) -> Column:
    return F.lit(float(most)) / (1 + (most - 1) * F.exp(-tilt * x))


class NotConverged(RuntimeError):
    """The dual was not solved: rates would be off their targets."""


def document_rates(classes: DataFrame, targets: DataFrame, most: int = MOST) -> DataFrame:
    """``classes`` (source, size, n) with the ``rate`` of their documents.

    Newton steps on one multiplier per source, each a sum over the classes; a step that leaves the
    interval known to hold the root is replaced by its middle. Sources at their cap or without
    target or words need no step.
    """
    per_source = classes.groupBy("source").agg(
        (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"), F.max("size").alias("top")
    )
    state = written(
        targets.join(per_source, targets["source"].eqNullSafe(per_source["source"]))
        .select(targets["source"], "source_size", "target", "mean")
        .withColumns(
            {
                "tilt": F.lit(0.0),
                "low": F.lit(None).cast("double"),
                "high": F.lit(None).cast("double"),
                "done": (F.col("target") <= 0) | (F.col("target") >= F.col("source_size") * most),
            }
        ),
        "mix-tilts",
    )
    for step in range(_STEPS + 1):
        open_sources = state.filter(~F.col("done"))
        if open_sources.isEmpty():
            break
        if step == _STEPS:
            raise NotConverged(f"{open_sources.count()} sources are off their targets after {_STEPS} steps")
        state = written(_newton_step(classes, state, most), "mix-tilts")
    rate = (
        F.when((F.col("target") <= 0) | (F.col("size") <= 0), F.lit(0.0))
        .when(F.col("target") >= F.col("source_size") * most, F.lit(float(most)))
        .otherwise(_rate(F.col("tilt"), F.col("size") / F.col("mean"), most))
    )
    return _with_source(classes, state).select("source", "size", "n", rate.alias("rate"), "target")


def _with_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with the columns of their source; sources are few, so the engine may broadcast them."""
    renamed = sources.withColumnRenamed("source", "_source")
    return rows.join(renamed, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def _newton_step(classes: DataFrame, state: DataFrame, most: int) -> DataFrame:
    x = F.col("size") / F.col("mean")
    rate = _rate(F.col("tilt"), x, most)
    weight = F.col("size") * F.col("n")
    sums = (
        _with_source(classes, state.filter(~F.col("done")))
        .filter("size > 0")
        .groupBy("source")
        .agg(
            F.sum(weight * rate).alias("taken"),
            F.sum(weight * x * rate * (1 - rate / most)).alias("slope"),
        )
        .withColumnRenamed("source", "_source")
    )
    joined = state.join(sums, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    gap = F.col("taken") - F.col("target")
    low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
    high = F.when(gap >= 0, F.col("tilt")).otherwise(F.col("high"))
    newton = F.col("tilt") - gap / F.col("slope")
    inside = (newton > F.coalesce("low", F.lit(-1e18))) & (newton < F.coalesce("high", F.lit(1e18)))
    # before the root is enclosed: a step of bounded length
    reach = 1 + 2 * F.abs(F.col("tilt"))
    free = F.greatest(F.least(newton, F.col("tilt") + reach), F.col("tilt") - reach)
    outward = F.col("tilt") - F.signum(gap) * reach
    enclosed = F.col("low").isNotNull() & F.col("high").isNotNull()
    step = (
        F.when(enclosed & inside, newton)
        .when(enclosed, (F.col("low") + F.col("high")) / 2)
        .otherwise(F.when(inside & (F.col("slope") > 0), free).otherwise(outward))
    )
    close = F.col("taken").isNull() | (F.abs(gap) <= F.greatest(F.col("target") * 1e-6, F.lit(0.5)))
    return joined.withColumns({"low": low, "high": high}).select(
        "source",
        "source_size",
        "target",
        "mean",
        F.when(F.col("done") | close, F.col("tilt")).otherwise(step).alias("tilt"),
        "low",
        "high",
        (F.col("done") | close).alias("done"),
    )


def class_copies(rated: DataFrame, most: int = MOST) -> DataFrame:
    """Whole copies for each class: ``source``, ``size``, ``n``, ``copies``.

    Expected copies are rounded cumulatively in order of size, so what a source takes is off by at
    most half its largest document; then a few rounds add or remove copies of the largest class that
    fits in what is left.
    """
    in_order = Window.partitionBy("source").orderBy("size")
    up_to = F.floor(F.sum(F.col("n") * F.col("rate")).over(in_order) + F.lit(0.5 - 1e-9))
    counted = rated.withColumn("_up", up_to.cast("long"))
    copies = F.col("_up") - F.coalesce(F.lag("_up").over(in_order), F.lit(0))
    whole = written(
        counted.withColumn("copies", F.greatest(F.least(copies, F.col("n") * most), F.lit(0).cast("long"))).drop("_up"),
        "mix-copies",
    )
    for _ in range(_MENDS):
        gaps = whole.groupBy("source").agg(
            (F.max("target") - F.sum(F.col("copies") * F.col("size"))).alias("gap")
        )
        room = F.when(F.col("gap") > 0, F.col("n") * most - F.col("copies")).otherwise(F.col("copies"))
        fits = (F.col("size") > 0) & (room > 0) & (F.col("size") <= F.abs("gap"))
        chosen = (
            _with_source(whole, gaps)
            .filter(fits)
            .groupBy("source")
            .agg(F.max(F.struct("size", "gap", room.alias("room"))).alias("c"))
            .select(F.col("source").alias("_source"), F.col("c.size").alias("_size"),
                    (F.signum("c.gap") * F.least(F.floor(F.abs("c.gap") / F.col("c.size")), F.col("c.room"))).cast("long").alias("_more"))
        )
        if chosen.isEmpty():
            break
        same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size"))
        whole = written(
            whole.join(chosen, same, "left").select(
                "source", "size", "n", "rate", "target",
                (F.col("copies") + F.coalesce("_more", F.lit(0))).alias("copies"),
            ),
            "mix-copies",
        )
    return whole


# Columns that a mix adds to documents for a while.
_WORKING = ("_source", "_size", "_draw", "_k_source", "_k_size", "_base", "_limit")


def mix(
    docs: DataFrame,
    most: int = MOST,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """``docs`` with ``size`` (words), ``source_size``, ``target`` and ``copies`` (0 to ``most``).

    A NULL or empty text has size 0 and no copy; NULL sources form one source of their own. Copies
    within a class of equal source and size go to the documents with the smallest draws, a hash of
    id and class, so reruns agree; rows repeated with the same id share one draw and one decision.
    Columns of these names are replaced; no rows give no rows.
    """
    docs, moved = aside(docs, _WORKING)
    doc_id, text, source = (moved.get(c, c) for c in (doc_id, text, source))
    names = {"_source": F.col(source), "_size": words(F.col(text)), "_draw": F.xxhash64(F.lit("mix"), doc_id, source)}
    base = docs.drop("size", "source_size", "target", "copies").withColumns(names)
    rows = written(
        base.select(F.col("_source").alias("source"), F.col("_size").alias("size"), "_draw"), "mix-sizes"
    )
    classes = written(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-classes")
    targets = written(
        source_targets(classes.select("source", (F.col("size") * F.col("n")).alias("size")), most),
        "mix-targets",
    )
    copies = class_copies(document_rates(classes, targets, most), most)
    known = _with_source(_with_draw_limits(rows, copies), targets).select(
        F.col("source").alias("_k_source"), F.col("size").alias("_k_size"),
        "_base", "_limit", "source_size", "target",
    )
    known = written(known, "mix-verdicts")
    if known.count() <= BROADCAST_CLASSES:
        known = F.broadcast(known)
    same = F.col("_source").eqNullSafe(F.col("_k_source")) & (F.col("_size") == F.col("_k_size"))
    more = F.when(F.col("_draw") <= F.col("_limit"), 1).otherwise(0)
    kept = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies")]
    mixed = base.join(known, same).select(
        *kept,
        F.col("_size").alias("size"),
        "source_size",
        "target",
        (F.col("_base") + more).cast("int").alias("copies"),
    )
    return restored(mixed, moved)


def _with_draw_limits(rows: DataFrame, copies: DataFrame) -> DataFrame:
    """Each class with copies for all its documents and the largest draw that gets one more.

    The limit is the k-th smallest draw of the class. Counts per leading bits of the draw tell where
    it lies; only the documents of that one bucket are ranked.
    """
    wanted = copies.select(
        "source", "size",
        F.floor(F.col("copies") / F.col("n")).alias("_base"),
        (F.col("copies") % F.col("n")).alias("_k"),
    )
    bucket = F.shiftright("_draw", 52)  # signed, so buckets are ordered as the draws are
    some = wanted.filter("_k > 0")
    drawn = rows.withColumn("_bucket", bucket)
    up_to = Window.partitionBy("source", "size").orderBy("_bucket")
    counts = drawn.groupBy("source", "size", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    places = (
        _by_class(counts.withColumn("_until", F.sum("_n").over(up_to)), some)
        .filter("_until >= _k and _until - _n < _k")
        .select("source", "size", "_bucket", (F.col("_k") - F.col("_until") + F.col("_n")).alias("_rank"))
    )
    spot = places.select(
        F.col("source").alias("_ps"), F.col("size").alias("_pz"), F.col("_bucket").alias("_pb"), "_rank"
    )
    same = (
        F.col("source").eqNullSafe(F.col("_ps"))
        & (F.col("size") == F.col("_pz"))
        & (F.col("_bucket") == F.col("_pb"))
    )
    ranked = Window.partitionBy("source", "size", "_bucket").orderBy("_draw")
    limits = (
        drawn.join(spot, same)
        .withColumn("_at", F.row_number().over(ranked))
        .filter("_at = _rank")
        .select(F.col("source").alias("_ls"), F.col("size").alias("_lz"), F.col("_draw").alias("_limit"))
    )
    met = F.col("source").eqNullSafe(F.col("_ls")) & (F.col("size") == F.col("_lz"))
    return wanted.join(limits, met, "left").select("source", "size", "_base", "_limit")


def _by_class(rows: DataFrame, classes: DataFrame) -> DataFrame:
    other = classes.select(F.col("source").alias("_cs"), F.col("size").alias("_cz"), "_k")
    same = F.col("source").eqNullSafe(F.col("_cs")) & (F.col("size") == F.col("_cz"))
    return rows.join(other, same).drop("_cs", "_cz")

"""Rebuild the partitions of a layer whose source versions have changed, and no others.

A layer partition depends on the source versions that have rows for it. Each build leaves the digest of every (partition, version)
pair it read; a later look at the sources tells which pairs are new, gone or different. All stale partitions are
rebuilt in one job and replaced by dynamic overwrite, the others are neither read nor written.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.operators.digests import _hashes
from sievework.session import saved
from sievework.sinks.commits import NONE, CommitLog
from sievework.sinks.parquet import partition_folder

# Stale partitions that are listed in a filter; more are joined.
LISTED_PARTITIONS = 1000


def source_digests(source: DataFrame, partition: str, version: str) -> DataFrame:
    """``partition``, ``version``, ``n_rows``, ``digest`` for every pair that has rows; sums, combined before the shuffle."""
    a, b = _hashes(source.columns)
    sums = source.select(partition, version, a.alias("_a"), b.alias("_b")).groupBy(
        F.col(partition).cast("string").alias("partition"), F.col(version).cast("string").alias("version")
    )
    totals = [F.sum(F.col(c).cast("decimal(19,0)")).cast("decimal(38,0)").cast("string") for c in ("_a", "_b")]
    return sums.agg(F.count(F.lit(1)).alias("n_rows"), F.concat_ws("|", *totals).alias("digest"))


def stale_partitions(now: DataFrame, built: DataFrame) -> DataFrame:
    """``partition`` and ``versions`` (sorted, the source versions for which it is stale) of partitions whose sources differ.

    One aggregation over both lists of digests; a partition whose sources are all gone is stale too.
    """
    both = now.select("partition", "version", "n_rows", "digest", F.lit(1).alias("_now")).unionByName(
        built.select("partition", "version", "n_rows", "digest", F.lit(0).alias("_now"))
    )
    pairs = both.groupBy("partition", "version").agg(
        F.count_distinct("n_rows", "digest").alias("_kinds"), F.count(F.lit(1)).alias("_sides")
    )
    stale = pairs.filter((F.col("_kinds") > 1) | (F.col("_sides") == 1))
    return stale.groupBy("partition").agg(F.array_sort(F.collect_set("version")).alias("versions"))


_DIGESTS = "partition string, version string, n_rows long, digest string"


class BackfilledLayer:
    """A Parquet layer partitioned by ``partition``, with the digests of what it was built from.

    ``build`` makes the layer's rows, with the column ``partition``, from source rows; it must treat each partition by itself.
    """

    def __init__(
        self, spark, path: str, partition: str, version: str, build: Callable[[DataFrame], DataFrame], schema
    ) -> None:
        self.spark, self.path, self.partition, self.version = spark, path.rstrip("/"), partition, version
        self.build, self.schema = build, schema
        self.log = CommitLog(spark, f"{self.path}/_builds")

    def read(self) -> DataFrame:
        if self.log.latest() == NONE:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/layer").select(*self.schema.names)

    def _built(self) -> DataFrame:
        latest = self.log.latest()
        if latest == NONE:
            return self.spark.createDataFrame([], _DIGESTS)
        return self.spark.read.schema(_DIGESTS).parquet(f"{self.path}/{self.log.read(latest)['digests']}")

    def _emptied(self, stale: DataFrame, built: DataFrame) -> list[str | None]:
        held = built.select(F.col(self.partition).cast("string").alias("_p")).distinct()
        gone = stale.join(held, F.col("partition").eqNullSafe(F.col("_p")), "left_anti")
        return [r["partition"] for r in gone.select("partition").collect()]  # names of stale partitions

    def refresh(self, source: DataFrame, run_id: str, only: Sequence[str] | None = None) -> DataFrame:
        """Rebuild what is stale (of the partitions ``only``, if given) and return ``partition`` and ``versions`` of it.

        The digests are committed after the rows: a run that dies in between leaves its partitions stale, and the next one
        rebuilds them.
        """
        number = self.log.latest() + 1
        now = saved(source_digests(source, self.partition, self.version), "digests")
        stale = saved(stale_partitions(now, self._built()), "stale")
        if only is not None:
            stale = stale.filter(F.col("partition").isin(list(only)))
        if stale.isEmpty():
            return stale
        key = F.col(self.partition).cast("string")
        if stale.count() <= LISTED_PARTITIONS:
            names = stale.agg(F.collect_set("partition").alias("p")).first()["p"]
            # a list of values reaches the scan, so fresh partitions of a partitioned source are not read
            rows = source.filter(key.isin(names) | (key.isNull() if stale.filter("partition is null").count() else F.lit(False)))
        else:
            rows = source.join(stale.select(F.col("partition").alias("_p")), key.eqNullSafe(F.col("_p")), "left_semi")
        layer = f"{self.path}/layer"
        built = saved(self.build(rows).select(*self.schema.names), "rebuilt")
        (
            built.hint("rebalance", F.col(self.partition))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(self.partition)
            .parquet(layer)
        )
        # a partition without rows any more is not part of what overwrites
        for name in self._emptied(stale, built):
            self.log.remove(f"{layer}/{partition_folder(self.partition, name)}")
        names = stale.select(F.col("partition").alias("_p"))
        same = F.col("partition").eqNullSafe(F.col("_p"))
        kept, fresh = self._built().join(names, same, "left_anti"), now.join(names, same, "left_semi")
        digests = f"digests/{number:020d}-{run_id}"
        kept.unionByName(fresh).write.parquet(f"{self.path}/{digests}")
        self.log.put(number, {"run_id": run_id, "digests": digests})
        return stale

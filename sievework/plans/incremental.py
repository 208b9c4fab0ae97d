"""A table by business key that arriving versions change, and that is read as of any commit.

Rows lie in hash buckets of their key. A commit (:mod:`sievework.sinks.commits`) names for every bucket the folder that holds it;
folders are written once and never changed. Loading a batch classifies its keys against the current rows, rewrites only the
buckets in which something changed, and swaps the names in one commit. Readers see the state before or after, never between.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sievework.operators.revisions import ADDED, REMOVED, REVISED, UNCHANGED, version_changes
from sievework.session import saved
from sievework.sinks.commits import NONE, CommitLog

BUCKETS = 256


@dataclass(frozen=True)
class LoadResult:
    """What a load did: the commit that now holds the state, and the number of keys by kind of change."""

    commit: int
    changes: dict[str, int] = field(default_factory=dict)
    rewritten_buckets: int = 0


class KeyedTable:
    """``key`` identifies a row, the other columns of ``schema`` are its values.

    ``buckets`` is fixed at the first load. As many rows share a bucket as its number says, so choose it by the table's
    size: a bucket is rewritten as a whole, by as many tasks as it needs.
    """

    def __init__(
        self, spark: SparkSession, path: str, key: Sequence[str], schema: StructType, buckets: int = BUCKETS
    ) -> None:
        self.spark, self.path, self.key, self.schema = spark, path.rstrip("/"), list(key), schema
        self.values = [n for n in schema.names if n not in key]
        self.log = CommitLog(spark, f"{self.path}/_commits")
        self._buckets = buckets

    def state(self, commit: int | None = None) -> dict:
        """Content of a commit, by default of the last one; an empty one before the first load."""
        number = self.log.latest() if commit is None else commit
        if number == NONE:
            return {"folders": {}, "n_buckets": self._buckets, "version": None, "number": NONE}
        return {**self.log.read(number), "number": number}

    def read(self, commit: int | None = None) -> DataFrame:
        """The rows as of a commit, by default of the last one."""
        return self._rows(self.state(commit)["folders"])

    def _rows(self, folders: dict[str, str]) -> DataFrame:
        paths = [f"{self.path}/{folder}/bucket={bucket}" for bucket, folder in sorted(folders.items())]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def changes(self, commit: int) -> DataFrame:
        """Keys that a commit changed: ``change``, ``old`` and ``new``."""
        folder = self.log.read(commit).get("changes")
        if not folder:
            return version_changes(self._rows({}), self._rows({}), self.key)
        return self.spark.read.parquet(f"{self.path}/{folder}")

    def _bucket(self, n: int) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(n)).cast("int")

    def load(self, batch: DataFrame, version: int, run_id: str, complete: bool = True, removed: str | None = None) -> LoadResult:
        """Load a batch as ``version`` and commit it; raises CommitConflictError if another load came in between.

        A ``complete`` batch holds every key of the version, so keys it lacks are removed (``removed`` has no meaning then). Otherwise it holds changed keys only, and
        those where the boolean column ``removed`` is true are removed; only the buckets it touches are read. A batch that changes nothing
        commits nothing, unless it is a new version. The key must be unique within the batch.
        """
        base = self.state()
        n = base["n_buckets"]
        folders = dict(base["folders"])
        removed = None if complete else removed
        flag = [F.coalesce(F.col(removed), F.lit(False)).alias(removed)] if removed else []
        rows = batch.select(*self.schema.names, *flag)
        if complete:
            current = self._rows(folders)
            gone: Column = F.lit(False)
        else:
            rows = saved(rows, "batch")
            touched = self._numbers(rows.select(self._bucket(n).alias("bucket")))
            current = self._rows({b: f for b, f in folders.items() if int(b) in touched})
            gone = F.coalesce(F.col("new")[removed], F.lit(False)) if removed else F.lit(False)  # no new side: not named
        if removed:
            current = current.withColumn(removed, F.lit(False))
        found = version_changes(current, rows, self.key)
        kind = F.col("change")
        if not complete:
            absent = F.col("old").isNull()
            # keys that the batch does not name stay as they are; removing an unknown key changes nothing
            kind = F.when(kind == REMOVED, UNCHANGED).when(gone & ~absent, REMOVED).when(gone, "ignored").otherwise(kind)
        changes = saved(
            found.select(*self.key, kind.alias("change"), *[F.struct(*[F.col(s)[v].alias(v) for v in self.values]).alias(f"_{s}") for s in ("old", "new")],
                         F.col("old").isNull().alias("_no_old"), F.col("new").isNull().alias("_no_new"), self._bucket(n).alias("bucket")),
            "changes",
        )
        alters = F.col("change").isin(ADDED, REMOVED, REVISED)
        stays = ~F.col("change").isin(REMOVED, "ignored")
        per_bucket = changes.groupBy("bucket").agg(
            *[F.count_if(F.col("change") == c).alias(c) for c in (ADDED, REMOVED, REVISED, UNCHANGED)],
            F.count_if(stays).alias("stays"), F.count_if(alters).alias("alters"),
        )
        summary = per_bucket.collect()  # a row per bucket
        totals = {c: sum(r[c] for r in summary) for c in (ADDED, REMOVED, REVISED, UNCHANGED)}
        rewritten = {r["bucket"]: r["stays"] for r in summary if r["alters"]}
        if not rewritten and base["version"] == version:
            return LoadResult(base["number"], totals, 0)
        name = uuid.uuid4().hex
        if rewritten:
            chosen = changes.filter(F.col("bucket").isin(list(rewritten)))
            value = [F.when(F.col("_no_new"), F.col("_old")[v]).otherwise(F.col("_new")[v]).alias(v) for v in self.values]
            ordered = chosen.filter(stays).select("bucket", *self.key, *value).select("bucket", *self.schema.names)
            # a bucket goes to as many tasks as its size needs
            ordered.hint("rebalance", F.col("bucket")).write.partitionBy("bucket").parquet(f"{self.path}/data/{name}")
            shown = [F.when(~F.col(f"_no_{s}"), F.col(f"_{s}")).alias(s) for s in ("old", "new")]
            chosen.filter(alters).select(*self.key, "change", *shown).write.parquet(f"{self.path}/changes/{name}")
        for bucket, left in rewritten.items():
            folders.pop(str(bucket), None)
            if left:
                folders[str(bucket)] = f"data/{name}"
        content = {
            "run_id": run_id, "version": version, "parent": base["number"], "n_buckets": n, "folders": folders,
            "changes": f"changes/{name}" if rewritten else None, "counts": totals,
        }
        self.log.put(base["number"] + 1, content)
        return LoadResult(base["number"] + 1, totals, len(rewritten))

    @staticmethod
    def _numbers(buckets: DataFrame) -> set[int]:
        return {r["bucket"] for r in buckets.distinct().collect()}  # at most the number of buckets

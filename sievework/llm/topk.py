"""Exact top-k inner products by a uniform threshold in three phases.

A vector's components are dealt into ``slices`` score lists; its score is the sum of what the lists
say. Phase 1 gathers the k best entries of each list and adds up what is known, which bounds the k-th
score from below: the cutoff. Phase 2 collects from every list the entries that reach the
cutoff's uniform share, as a score that reaches the cutoff has at least one of these. Phase 3 works out the
missing entries of the vectors so found, exactly. Equal vectors are one entry with their ids.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm.common import record_batches, written

K = 20
SLICES = 2
# Distinct queries answered by one pass over all vectors; this bounds what is broadcast.
QUERY_BLOCK = 8192
_CHUNK = 4096
_LARGEST = 2**63 - 1


def scaled(vector: Column, factor: int = 64) -> Column:
    """floor(factor * x) of each component; NULL for a NULL vector or component, or one that is not
    finite."""
    x = F.transform(vector, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(~F.coalesce(bad, F.lit(True)), F.transform(x, lambda v: F.floor(v * factor).cast("long")))


def vector_classes(vectors: DataFrame, k: int, vec_id: str, vector: str) -> DataFrame:
    """Distinct scaled vectors with the k + 1 smallest ids of each: more are never in a result."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v")).filter(
        "vec_id is not null and v is not null"
    )
    rank = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = rows.distinct().withColumn("_r", rank).filter(F.col("_r") <= k + 1)
    return few.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))


def _matrix(values: list, width: int) -> np.ndarray:
    out = np.zeros((len(values), width), np.float64)
    for row, v in zip(out, values):
        row[: len(v)] = v
    return out


class _Block:
    """A bounded block of queries, cut into slices."""

    def __init__(self, vectors: list[list[int]], slices: int) -> None:
        self.width = max(map(len, vectors), default=0)
        self.matrix = _matrix(vectors, self.width)
        edges = np.linspace(0, self.width, slices + 1).astype(int)
        self.cuts = [slice(a, b) for a, b in zip(edges, edges[1:])]
        self.top = np.abs(self.matrix).max(initial=0)

    def partial(self, values: list) -> np.ndarray:
        """(slice, query, vector): what each list says; 0 beyond the shorter vector's end."""
        other = _matrix([v[: self.width] for v in values], self.width)
        reach = self.top * np.abs(other).max(initial=0) * max(self.width, 1)
        if reach >= 2**53:  # not exact in floating point
            whole = [[int(c) for c in row] for row in other]
            mine = np.array(self.matrix, dtype=object)
            other = np.array(whole, dtype=object).reshape(other.shape)
            return np.stack([mine[:, c] @ other[:, c].T for c in self.cuts])
        kind = np.float32 if reach < 2**24 else np.float64
        a, b = self.matrix.astype(kind), other.astype(kind)
        return np.stack([a[:, c] @ b[:, c].T for c in self.cuts]).astype(np.int64)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    for batch in batches:
        for at in range(0, batch.num_rows, _CHUNK):
            part = batch.slice(at, _CHUNK)
            yield part.column("v").to_pylist(), part.column("ids").to_pylist()


def _sums(partial: np.ndarray) -> np.ndarray:
    """What all lists say together, within 64 bits."""
    total = partial.sum(axis=0)
    return np.clip(total, -_LARGEST, _LARGEST).astype(np.int64) if total.dtype == object else total


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Per query, the places of its k best entries (any order)."""
    if scores.shape[1] <= k:
        return np.tile(np.arange(scores.shape[1]), (len(scores), 1))
    return np.argpartition(scores, scores.shape[1] - k, axis=1)[:, -k:]


def _answer_block(classes: DataFrame, vectors: list[list[int]], k: int, slices: int) -> DataFrame:
    """Classes with the scores that matter for each query of the block: ``q``, ``ids``, ``score``."""
    spark = classes.sparkSession
    block = spark.sparkContext.broadcast(vectors)
    queries = len(vectors)

    # Phase 1: the k best entries of each list in each task, with the score known from that list
    # completed by the others, so that the bound is a real score.
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[int, int]] = [{} for _ in range(queries)]
        asked = _Block(block.value, slices)
        for values, ids in _chunks(batches):
            partial = asked.partial(values)
            total = _sums(partial)
            for s in range(len(partial)):
                at = _best(partial[s], k)
                for q in range(queries):
                    for i in at[q]:
                        held[q][ids[i][0]] = int(total[q, i])
            for q in range(queries):
                if len(held[q]) > 4 * k:
                    held[q] = dict(heapq.nlargest(k, held[q].items(), key=lambda e: e[1]))
        for q, found in enumerate(held):
            best = heapq.nlargest(k, found.values())
            if best:
                yield pa.RecordBatch.from_pydict({"q": np.full(len(best), q, np.int32), "score": np.array(best, np.int64)})

    known = classes.mapInArrow(gather, "q int, score long")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc()))
    kth = known.withColumn("_r", rank).filter(F.col("_r") == k).select("q", "score")
    # one number per query of a bounded block: the safe cutoff
    cutoff = np.full(queries, np.iinfo(np.int64).min // 4)
    for row in kth.collect():
        cutoff[row["q"]] = row["score"]
    safe = spark.sparkContext.broadcast(cutoff)
    schema = pa.schema([("q", pa.int32()), ("ids", pa.list_(pa.int64())), ("score", pa.int64())])

    # Phases 2 and 3: entries that reach the share of the cutoff name the candidates; what the other
    # lists say of them is added, and scores below the cutoff are let go.
    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            asked = _Block(block.value, slices)
            for values, ids in _chunks(batches):
                partial = asked.partial(values)
                share = -((-safe.value) // len(partial))  # rounded up: some list reaches it
                reached = np.zeros(partial.shape[1:], bool)
                for s in range(len(partial)):
                    reached |= partial[s] >= share[:, None]
                q, i = np.nonzero(reached)
                score = _sums(partial[:, q, i])
                for a, b, c in zip(q, i, score):
                    if c >= safe.value[a]:
                        yield int(a), ids[b], int(c)

        yield from record_batches(rows(), schema)

    return classes.mapInArrow(resolve, "q int, ids array<long>, score long")


def exact_top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = K,
    slices: int = SLICES,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` best of all other rows for each query.

    Both frames hold integer vectors in ``vector`` (:func:`scaled`). Ties go to the smaller ``vec_id``; a query
    with fewer than ``k`` others gets them all. Rows are told apart by id: rows repeated with id and
    vector count once, a row with the query's id is never in its result. Rows with a NULL id or
    vector take no part; a shorter vector counts as 0 beyond its end; a score beyond 64 bits is the
    largest number of its sign. Columns besides these two are
    ignored; no rows give no rows.

    Queries are grouped by vector, and answered in blocks of a bounded number by one pass each.
    """
    classes = written(vector_classes(vectors, k, vec_id, vector), "vector-classes")
    asked = queries.select(F.col(vec_id).cast("long").alias("query_id"), F.col(vector).alias("v")).filter(
        "query_id is not null and v is not null"
    )
    asked = written(asked.distinct(), "queries")
    forms = written(
        asked.groupBy("v").agg(F.min("query_id").alias("first"))
        .withColumn("_p", F.pmod(F.xxhash64("v"), F.lit(1 << 20))), "query-forms",
    )
    blocks = -(-forms.count() // block)
    results = []
    # k + 1, as the query itself is among the candidates; ties at the cutoff are all collected
    for n in range(max(blocks, 1)):
        lo, hi = n * (1 << 20) // max(blocks, 1), (n + 1) * (1 << 20) // max(blocks, 1)
        part = forms.filter((F.col("_p") >= lo) & (F.col("_p") < hi)).orderBy("first").collect()
        if part:
            found = _answer_block(classes, [r["v"] for r in part], k + 1, slices)
            offsets = classes.sparkSession.createDataFrame(
                [(i, r["first"]) for i, r in enumerate(part)], "q int, first long"
            )
            results.append(written(_ranked(found, k + 1).join(F.broadcast(offsets), "q"), "top-k"))
    if not results:
        return asked.select(
            "query_id", F.lit(0).alias("rank"), F.col("query_id").alias("vec_id"), F.lit(0).cast("long").alias("score")
        ).filter("false")
    found = results[0]
    for other in results[1:]:
        found = found.unionByName(other)
    mine = asked.join(forms.select("v", "first"), "v").select("query_id", "first")
    pairs = (
        mine.join(found, "first")
        .select("query_id", F.explode("ids").alias("vec_id"), "score")
        .filter("vec_id <> query_id")
        .distinct()
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best classes of each query, by score and smallest id."""
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.element_at("ids", 1))
    return found.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k).drop("_r")

"""Benchmark passages inside documents, by SimHash of item-sized windows.

Every window of a document that is as long as an item gets a 64-bit SimHash of its runs of five words,
where each occurrence of a run within the window counts as a shingle of its own, with bits of its own.
Fingerprints are cut into five blocks. Two fingerprints that differ in at most ``RADIUS`` = 24 bits differ in at
most four bits of some block, so an index of every block value within four bits of an item's
finds all pairs within the radius. The pairs found are compared exactly: the sum of the smaller over
the sum of the larger weights of all shingles, where a shingle weighs as often as it occurs.

Windows without any shingle of the benchmark have similarity 0 and need no fingerprint. The similarity is
that of the sets of (shingle, occurrence), whose bits are independent, however often a shingle repeats: windows
at 0.8 differ in about 10 of 64 bits (deviation 2.9). By the binomial distribution at most 3 in a million windows
of full length lie beyond 24; of texts shorter than the item at most 9 in a million, but 1 in 8,000 of those
of 8 words that are the most of an item of 9.

An item of n < 5 words is one run of n words, and so is each window of its size: it is found wherever exactly
these words stand in a row, so an item of one word in every text with that word. Such runs are looked up as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.common import as_bytes, record_batches, release_memory, written
from sievework.llm.shingles import WIDTH, mixed, shingle_hashes, word_hashes

SIMILARITY = 0.8
RADIUS = 24
# Fixed by the above: bits of the blocks, and errors that some block stays within.
_BLOCKS = (12, 13, 13, 13, 13)
_ERRORS = RADIUS // len(_BLOCKS)
# Items, and bytes of their texts, that one pass over the documents compares with.
ITEM_BLOCK, ITEM_BYTES = 1000, 16 << 20
_SIEVE = 20  # bits of the first test whether a shingle is one of the benchmark's
_OCCURRENCE = np.uint64(0xD6E8FEB86659FD93)


def occurrences(shingles: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of (shingle, occurrence) that each place brings into the run of ``width`` shingles ending
    there, and of the one that the run starting there loses when it moves on."""
    order = np.argsort(shingles, kind="stable")
    owner = np.concatenate(([0], (shingles[order][1:] != shingles[order][:-1]).cumsum()))
    # places in order within each shingle, those of different shingles further apart than a run
    places = owner * (len(shingles) + width) + order
    rank = np.arange(len(shingles))
    before, behind = np.empty((2, len(shingles)), np.uint64)
    before[order] = rank - np.searchsorted(places, places - width, side="right")
    behind[order] = np.searchsorted(places, places + width) - rank - 1
    return tuple(np.where(n > 0, mixed(shingles + n * _OCCURRENCE), shingles) for n in (before, behind))


def fingerprints(shingles: np.ndarray, width: int, starts: np.ndarray) -> np.ndarray:
    """SimHash of the runs of ``width`` shingles at the given starts, as sets of (shingle, occurrence)."""
    gained, lost = occurrences(shingles, width)
    same = np.array_equal(gained, lost)  # nothing repeats
    out = np.zeros(len(starts), np.uint64)
    for bit in range(64):
        sums = _votes(gained, bit)
        less = sums if same else _votes(lost, bit)
        out |= (sums[starts + width] > less[starts]).astype(np.uint64) << np.uint64(bit)
    return out


def _votes(hashes: np.ndarray, bit: int) -> np.ndarray:
    votes = ((hashes >> np.uint64(bit)) & np.uint64(1)).astype(np.int32) * 2 - 1
    return np.concatenate(([0], votes.cumsum()))


def _near_values(bits: int) -> np.ndarray:
    """All differences of at most ``_ERRORS`` bits."""
    return np.array(
        [sum(1 << i for i in some) for n in range(_ERRORS + 1) for some in combinations(range(bits), n)],
        np.uint64,
    )


class Benchmark:
    """A bounded block of items with the index of their fingerprints."""

    def __init__(self, items: list[tuple[int, bytes]]) -> None:
        kept = [(i, w) for (i, _), w in zip(items, word_hashes([t for _, t in items])) if len(w)]
        # items below the width of a shingle: their run and id, by number of words
        self.short: dict[int, dict[int, list[int]]] = {}
        for i, w in kept:
            if len(w) < WIDTH:
                self.short.setdefault(len(w), {}).setdefault(int(shingle_hashes(w)[0]), []).append(i)
        kept = [(i, w) for i, w in kept if len(w) >= WIDTH]
        self.ids = [i for i, _ in kept]
        self.words = np.array([len(w) for _, w in kept], np.int64)
        self.shingles = [shingle_hashes(w) for _, w in kept]
        self.weights = [np.unique(s, return_counts=True) for s in self.shingles]
        self.known = np.unique(np.concatenate(self.shingles)) if kept else np.zeros(0, np.uint64)
        self.sieve = np.zeros(1 << _SIEVE, bool)
        self.sieve[(self.known & np.uint64((1 << _SIEVE) - 1)).astype(np.int64)] = True
        # which sizes of item a shingle may belong to
        sizes = [np.full(len(s), n) for s, n in zip(self.shingles, self.words)]
        pairs = np.unique(
            np.stack([np.concatenate(self.shingles).view(np.int64), np.concatenate(sizes)]), axis=1
        ) if kept else np.zeros((2, 0), np.int64)
        self.size_owner, self.size_of = pairs[0].view(np.uint64), pairs[1]
        order = np.argsort(self.size_owner, kind="stable")
        self.size_owner, self.size_of = self.size_owner[order], self.size_of[order]
        zero = np.zeros(1, np.int64)
        self.prints = np.array([fingerprints(s, len(s), zero)[0] for s in self.shingles], np.uint64)
        self._build_index()

    def _build_index(self) -> None:
        self.index = []
        at = 0
        for bits in _BLOCKS:
            value = (self.prints >> np.uint64(at)) & np.uint64((1 << bits) - 1)
            near = (value[:, None] ^ _near_values(bits)[None, :]).astype(np.int64)
            keys = ((self.words[:, None] << 16) | near).ravel()
            owners = np.repeat(np.arange(len(self.ids)), near.shape[1])
            order = np.argsort(keys, kind="stable")
            self.index.append((at, bits, keys[order], owners[order]))
            at += bits

    def hits(self, shingles: np.ndarray) -> np.ndarray:
        """Places of shingles that some item has."""
        at = np.flatnonzero(self.sieve[(shingles & np.uint64((1 << _SIEVE) - 1)).astype(np.int64)])
        if len(at) == 0:
            return at
        spot = np.searchsorted(self.known, shingles[at])
        return at[self.known[np.minimum(spot, len(self.known) - 1)] == shingles[at]]

    def candidates(self, prints: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs within the radius, among items of this size."""
        found = []
        for at, bits, keys, owners in self.index:
            value = ((prints >> np.uint64(at)) & np.uint64((1 << bits) - 1)).astype(np.int64)
            wanted = (words << 16) | value
            lo, hi = np.searchsorted(keys, wanted), np.searchsorted(keys, wanted, side="right")
            n = hi - lo
            window = np.repeat(np.arange(len(prints)), n)
            place = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
            found.append(window * len(self.ids) + owners[place])
        pairs = np.unique(np.concatenate(found))
        window, item = pairs // len(self.ids), pairs % len(self.ids)
        close = np.bitwise_count(prints[window] ^ self.prints[item]) <= RADIUS
        return window[close], item[close]

    def matches(self, words: np.ndarray) -> list[tuple[int, int, int, float]]:
        """(item, first word, words, similarity) of the best window for each item that has one of
        at least ``SIMILARITY``; the first of equally good ones."""
        return self._long_matches(words) + self._short_matches(words)

    def _short_matches(self, words: np.ndarray) -> list[tuple[int, int, int, float]]:
        found = []
        for size, items in self.short.items():
            if len(words) < size:
                continue
            runs, first = np.unique(shingle_hashes(words, size), return_index=True)
            known = np.isin(runs, np.fromiter(items, np.uint64, len(items)))
            for run, start in zip(runs[known].tolist(), first[known].tolist()):
                found += [(i, start, size, 1.0) for i in items[run]]
        return found

    def _long_matches(self, words: np.ndarray) -> list[tuple[int, int, int, float]]:
        shingles = shingle_hashes(words)
        hits = self.hits(shingles)
        if len(hits) == 0:
            return []
        lo = np.searchsorted(self.size_owner, shingles[hits])
        hi = np.searchsorted(self.size_owner, shingles[hits], side="right")
        place = np.repeat(lo - np.cumsum(hi - lo) + hi - lo, hi - lo) + np.arange((hi - lo).sum())
        sizes, owner = self.size_of[place], np.repeat(hits, hi - lo)
        best: dict[int, tuple[float, int, int]] = {}
        for size in np.unique(sizes):
            width = max(int(size) - WIDTH + 1, 1)
            width = min(width, len(shingles))
            last = len(shingles) - width
            # the windows around each hit of an item of this size
            near = owner[sizes == size][:, None] - np.arange(width)[None, :]
            starts = np.unique(np.clip(near, 0, last))
            lo_at = starts[0]
            prints = fingerprints(shingles[lo_at : starts[-1] + width], width, starts - lo_at)
            for w, item in zip(*self.candidates(prints, int(size))):
                start = int(starts[w])
                similarity = self._similarity(shingles[start : start + width], int(item))
                if similarity >= SIMILARITY and similarity > best.get(int(item), (0.0,))[0]:
                    best[int(item)] = (similarity, start, min(int(size), len(words)))
        return [(self.ids[i], start, n, s) for i, (s, start, n) in sorted(best.items())]

    def _similarity(self, window: np.ndarray, item: int) -> float:
        kinds, often = np.unique(window, return_counts=True)
        others, theirs = self.weights[item]
        at = np.minimum(np.searchsorted(others, kinds), len(others) - 1)
        both = others[at] == kinds
        shared = np.minimum(often[both], theirs[at[both]]).sum()
        return float(shared / (often.sum() + theirs.sum() - shared))


def benchmark_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[Broadcast]:
    """The items in broadcast blocks of bounded number and, but for single long items, bytes."""
    items = written(
        benchmark.select(F.col(item_id).alias("id"), F.col(text).alias("text"))
        .filter("length(text) > 0")
        .withColumn("p", F.pmod(F.xxhash64("id", "text"), F.lit(1 << 20))),
        "benchmark",
    )
    size = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    blocks = max(1, -(-size["n"] // ITEM_BLOCK), -(-size["b"] // ITEM_BYTES))
    for k in range(blocks):
        part = items.filter(F.floor(F.col("p") * blocks / (1 << 20)) == k).orderBy("id", "text")
        rows = [(r["id"], r["text"].encode()) for r in part.collect()]
        yield benchmark.sparkSession.sparkContext.broadcast(rows)


def _prepared(cache: dict, shared: Broadcast) -> Benchmark:
    if "b" not in cache:
        cache["b"] = Benchmark(shared.value)
    return cache["b"]


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document and benchmark item found in it: ``doc_id``, ``item_id``, ``window_start`` and
    ``window_words`` (in words), ``similarity``.

    Words are split at ASCII white space, A-Z lower-cased. Items and texts that are NULL or have no word
    match nothing; a text shorter than an item is one window. Rows repeated in full are reported
    once each, items repeated under one id once. Columns besides id and text are ignored.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("item_id", pa.int64()), ("window_start", pa.int64()),
         ("window_words", pa.int64()), ("similarity", pa.float64())]
    )

    def finder(shared: Broadcast):
        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            release_memory()
            cache: dict = {}

            def rows() -> Iterator[tuple]:
                for batch in batches:
                    bench = _prepared(cache, shared)
                    ids = batch.column("doc_id").to_pylist()
                    for key, words in zip(ids, word_hashes(as_bytes(batch, "text"))):
                        for item, start, n, similarity in bench.matches(words):
                            yield key, item, start, n, similarity

            yield from record_batches(rows(), schema)

        return find

    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ddl = "doc_id long, item_id long, window_start long, window_words long, similarity double"
    parts = [texts.mapInArrow(finder(b), ddl) for b in benchmark_blocks(benchmark)]
    return reduce(DataFrame.unionByName, parts)


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """Rows of ``docs`` in which :func:`find_leaks` finds no item, with all their columns."""

    def cleaner(shared: Broadcast):
        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            release_memory()
            cache: dict = {}
            for batch in batches:
                bench = _prepared(cache, shared)
                leaks = [bool(bench.matches(w)) for w in word_hashes(as_bytes(batch, text))]
                yield batch.filter(pa.array([not x for x in leaks], pa.bool_()))

        return clean

    for shared in benchmark_blocks(benchmark):
        docs = docs.mapInArrow(cleaner(shared), docs.schema)
    return docs

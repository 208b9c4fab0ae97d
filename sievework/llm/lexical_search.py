"""Exact ranked search for many items at once, by two trees.

Documents score for an item by the sum over its terms of w * ((10^9 * tf) div (1000 * tf + 8 * m)), all in
whole numbers. The second factor is a document's coordinate for the term, w times the term's occurrences in the
item is the item's; the score is their inner product.

Both sides get a hierarchy whose nodes hold, for every term, the largest coordinate below them. The inner
product of two nodes bounds every score between what is below them, so a pair of nodes is dropped as a whole when its bound is below
the weakest kth score of the node's items: no document there can reach any of their lists. Pairs that stay are
opened on both sides, the best bounds first, until single items meet single documents, whose bound is the score.

The documents' side is built per piece of a partition, of bounded size. The items' side is broadcast in blocks
of bounded size. A first search over a part of the documents gives each item a safe cutoff (the kth score of a part is never above the kth of
all), with which the search over all documents starts everywhere.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm.common import as_bytes, record_batches, written

# The terms are runs of ASCII letters, digits and all other characters beyond ASCII.
_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
# Terms of the items of one broadcast block (repeats included).
BLOCK_TERMS = 1 << 21
# Coordinates, and documents, that one documents' tree holds.
PIECE_ENTRIES, PIECE_DOCS = 1 << 20, 8192
# Children of a node, on the items' and on the documents' side.
ITEM_FAN, DOC_FAN = 4, 4
# Levels by which the items' side is ahead: single items meet nodes of documents before single documents.
AHEAD = 2
# Items below one item tree: its dense weights take this many times its terms.
TREE_ITEMS = 256
# One in so many documents takes part in the first search.
PART = 64
# Entries of documents' nodes that are multiplied at once.
_STEP = 1 << 20


def terms_of(text: bytes | None) -> list[bytes]:
    """Terms of a text in UTF-8, A-Z lower-cased."""
    return _TERM.findall(text.translate(_LOWER)) if text else []


def term_weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


# --- sparse rows -------------------------------------------------------------------------------


class Rows:
    """Sparse rows: the entries of row i are ``terms[starts[i]:starts[i + 1]]``, ascending, with ``values``."""

    def __init__(self, starts: np.ndarray, terms: np.ndarray, values: np.ndarray) -> None:
        self.starts, self.terms, self.values = starts, terms, values

    def __len__(self) -> int:
        return len(self.starts) - 1

    def taken(self, order: np.ndarray) -> Rows:
        places, sizes = self.places(order)
        return Rows(np.concatenate(([0], sizes.cumsum())), self.terms[places], self.values[places])

    def places(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of all entries of the given rows, one row after the other, and the rows' numbers of entries."""
        sizes = self.starts[rows + 1] - self.starts[rows]
        shift = np.repeat(self.starts[rows] - np.concatenate(([0], sizes.cumsum()[:-1])), sizes)
        return shift + np.arange(len(shift)), sizes

    def maxima(self, fan: int) -> Rows:
        """A row for every ``fan`` rows, with the largest value of each term."""
        sizes = np.diff(self.starts)
        parent = np.repeat(np.arange(len(self)) // fan, sizes)
        order = np.lexsort((self.terms, parent))
        parent, terms, values = parent[order], self.terms[order], self.values[order]
        first = np.flatnonzero(np.concatenate(([True], (parent[1:] != parent[:-1]) | (terms[1:] != terms[:-1]))))
        n = -(-len(self) // fan)
        starts = np.concatenate(([0], np.bincount(parent[first], minlength=n).cumsum()))
        return Rows(starts, terms[first], np.maximum.reduceat(values, first))

    def by_weightiest(self, weight: np.ndarray) -> np.ndarray:
        """An order in which rows with the same two weightiest entries are neighbours."""
        row = np.repeat(np.arange(len(self)), np.diff(self.starts))
        order = np.lexsort((-weight[self.terms] * self.values, row))
        sizes, terms = np.diff(self.starts), self.terms[order]
        best = np.full((2, len(self)), -1, np.int64)
        for k in (0, 1):
            some = sizes > k
            best[k][some] = terms[self.starts[:-1][some] + k]
        return np.lexsort((best[1], best[0]))


def levels(rows: Rows, fan: int) -> list[Rows]:
    """The rows, of which some have entries, and the levels above them up to a single node."""
    out = [rows]
    while len(out[-1]) > 1:
        out.append(out[-1].maxima(fan))
    return out


class ItemTree:
    """Items with their coordinates (weight times occurrences) and the levels above; dense over the terms they have."""

    def __init__(self, keys: np.ndarray, rows: Rows, weight: np.ndarray) -> None:
        order = rows.by_weightiest(weight)
        self.keys = keys[order]
        rows = rows.taken(order)
        self.terms = np.unique(rows.terms)
        self.levels = []
        for level in levels(Rows(rows.starts, rows.terms, rows.values * weight[rows.terms]), ITEM_FAN):
            dense = np.zeros((len(level), len(self.terms)), np.int64)
            owner = np.repeat(np.arange(len(level)), np.diff(level.starts))
            dense[owner, np.searchsorted(self.terms, level.terms)] = level.values
            self.levels.append(dense)


class Best:
    """The k best (score, document) of each item, higher scores first, equal ones by document."""

    def __init__(self, items: int, k: int, least: np.ndarray) -> None:
        self.k, self.least = k, least  # scores below ``least`` are in no list
        self.item = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.doc = np.zeros(0, np.int64)
        self.cutoff = least.copy()

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        """``doc`` rises with the document's rank among equal scores."""
        item = np.concatenate((self.item, item))
        score, doc = np.concatenate((self.score, score)), np.concatenate((self.doc, doc))
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        first = np.searchsorted(item, item)
        kept = np.arange(len(item)) - first < self.k
        self.item, self.score, self.doc = item[kept], score[kept], doc[kept]
        full, n = np.unique(self.item, return_counts=True)
        ends = n.cumsum() - 1
        full, ends = full[n == self.k], ends[n == self.k]
        self.cutoff[full] = np.maximum(self.cutoff[full], self.score[ends])


class Search:
    """Searches one documents' tree after the other for the items of a tree."""

    def __init__(self, items: ItemTree, k: int, least: np.ndarray) -> None:
        self.items, self.best = items, Best(len(items.keys), k, least)
        self.scored = self.bounded = 0

    def weakest(self, level: int) -> np.ndarray:
        """The weakest kth score of each node's items."""
        out = self.best.cutoff
        for _ in range(level):
            pad = -len(out) % ITEM_FAN
            out = np.pad(out, (0, pad), constant_values=np.iinfo(np.int64).max).reshape(-1, ITEM_FAN).min(axis=1)
        return out

    def bounds(self, item: np.ndarray, node: np.ndarray, level: np.ndarray, rows: Rows) -> np.ndarray:
        """Inner products of the pairs' coordinates."""
        out = np.empty(len(item), np.int64)
        sizes = rows.starts[node + 1] - rows.starts[node]
        ends = sizes.cumsum()
        at = 0
        while at < len(item):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _STEP, side="right")))
            places, n = rows.places(node[at:to])
            products = level[np.repeat(item[at:to], n), rows.terms[places]] * rows.values[places]
            total = np.concatenate(([0], products.cumsum()))
            stops = n.cumsum()
            out[at:to] = total[stops] - total[stops - n]
            at = to
        return out

    def add_documents(self, rows: Rows, docs: np.ndarray) -> None:
        """``rows``: coordinates over the tree's own terms; ``docs``: a rising number of each."""
        if len(rows.terms) == 0:
            return
        tree = levels(rows, DOC_FAN)
        depth = max(len(self.items.levels) + AHEAD, len(tree))
        # every pair is opened on both sides until both are at the bottom
        self._open(tree, depth - 1, np.zeros(1, np.int64), np.zeros(1, np.int64), docs)

    def _open(self, tree: list[Rows], depth: int, item: np.ndarray, node: np.ndarray, docs: np.ndarray) -> None:
        i_level, d_level = min(max(depth - AHEAD, 0), len(self.items.levels) - 1), min(depth, len(tree) - 1)
        bound = self.bounds(item, node, self.items.levels[i_level], tree[d_level])
        self.bounded += len(item)
        live = np.flatnonzero((bound > 0) & (bound >= self.weakest(i_level)[item]))
        if depth == 0:
            self.scored += len(live)
            if len(live):
                self.best.add(item[live], bound[live], docs[node[live]])
            return
        # the best bounds first, in doubling portions: what they yield raises the cutoffs for the others
        live = live[np.argsort(-bound[live], kind="stable")]
        item, node, bound = item[live], node[live], bound[live]
        at, portion = 0, 16
        while at < len(item):
            part = slice(at, at + portion)
            live = bound[part] >= self.weakest(i_level)[item[part]]
            pair = self._children(item[part][live], depth - AHEAD, ITEM_FAN, self.items.levels)
            other = self._children(node[part][live], depth, DOC_FAN, tree)
            self._open(tree, depth - 1, *_products(pair, other), docs)
            at, portion = at + portion, portion * 2

    @staticmethod
    def _children(nodes: np.ndarray, depth: int, fan: int, tree: list) -> np.ndarray:
        """Children of each node, a row each, -1 for none; the node itself where its side has no level at this depth."""
        if not 0 < depth < len(tree):
            return nodes[:, None]
        out = nodes[:, None] * fan + np.arange(fan)
        out[out >= len(tree[depth - 1])] = -1
        return out


def _products(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a child of each left node with a child of the right node beside it."""
    a = np.repeat(left, right.shape[1], axis=1).ravel()
    b = np.tile(right, (1, left.shape[1])).ravel()
    real = (a >= 0) & (b >= 0)
    return a[real], b[real]


# --- over DataFrames ---------------------------------------------------------------------------


def item_blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int, int | None, dict[bytes, int]]]]:
    """Items with terms as (number, id, occurrences of terms), in blocks of at most ``BLOCK_TERMS`` terms unless a single item has more.

    Items are read from a saved table one block's rows at a time, so the driver never holds all of them.
    """
    rows = items.select(F.col(item_id).cast("long").alias("id"), F.col(text).alias("text")).filter("length(text) > 0")
    held: list[tuple] = []
    size = number = 0
    for row in written(rows, "items").toLocalIterator():
        terms = Counter(terms_of(row["text"].encode()))
        if not terms:
            continue
        n = sum(terms.values())
        if held and size + n > BLOCK_TERMS:
            yield held
            held, size = [], 0
        held.append((number, row["id"], terms))
        number, size = number + 1, size + n
    if held:
        yield held


_FOUND = "doc_id long, n long, terms array<int>, tfs array<int>"


def occurrences(docs: DataFrame, vocabulary: Broadcast, doc_id: str, text: str) -> DataFrame:
    """Of every document with a term: ``n`` (its terms with repeats), and the vocabulary's terms in it with their times."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32()))]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                number = vocabulary.value
                for key, value in zip(batch.column("doc_id").to_pylist(), as_bytes(batch, "text")):
                    found = terms_of(value)
                    if found:
                        known = Counter(filter(lambda i: i is not None, map(number.get, found)))
                        terms = sorted(known)
                        yield key, len(found), terms, [known[t] for t in terms]

        yield from record_batches(rows(), schema, 1024)

    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return texts.mapInArrow(count, _FOUND)


class _Corpus:
    """What the tasks need besides the items: N, L and the weight of each term."""

    def __init__(self, n_docs: int, n_terms: int, weight: np.ndarray) -> None:
        self.n_docs, self.n_terms, self.weight = n_docs, n_terms, weight

    def measure(self, n: list[int]) -> np.ndarray:
        """m of documents with n terms; in exact whole numbers of any size."""
        return np.array([100 - 75 + (75 * x * self.n_docs) // self.n_terms for x in n], np.int64)


def _search(found: DataFrame, shared: Broadcast, k: int) -> DataFrame:
    """Rows (item number, document, score) with all of the k best of every item, and more."""
    schema = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus, trees, least = None, [], None
        searches: list[Search] = []
        keys: list[int | None] = []
        held: list[pa.RecordBatch] = []
        entries = docs = 0
        some = max(1, PIECE_DOCS // 8)

        def piece() -> None:
            nonlocal held, entries, docs
            _search_piece(pa.Table.from_batches(held), corpus, searches, keys)
            held, entries, docs = [], 0, 0

        for batch in batches:
            if corpus is None:
                corpus, trees, least = shared.value
                searches = [Search(t, k, least[t.keys].copy()) for t in trees]
            for at in range(0, batch.num_rows, some):
                part = batch.slice(at, some)
                held.append(part)
                docs += part.num_rows
                entries += len(part.column("terms").flatten())
                if docs >= PIECE_DOCS or entries >= PIECE_ENTRIES:
                    piece()
        if held:
            piece()

        def rows() -> Iterator[tuple]:
            for s in searches:
                for item, score, doc in zip(s.best.item.tolist(), s.best.score.tolist(), s.best.doc.tolist()):
                    yield int(s.items.keys[item]), keys[doc], score

        yield from record_batches(rows(), schema)

    return found.mapInArrow(search, "item long, doc_id long, score long")


def _search_piece(table: pa.Table, corpus: _Corpus, searches: list[Search], keys: list[int | None]) -> None:
    table = table.combine_chunks()
    ids = table.column("doc_id").to_pylist()
    # equal scores go to the smaller id, a missing id comes last; numbers of earlier pieces stand for their ids in
    # the lists, so all that was kept is numbered anew
    kept = sorted({int(d) for s in searches for d in s.best.doc})
    joined = [keys[d] for d in kept] + ids
    order = sorted(range(len(joined)), key=lambda i: (joined[i] is None, joined[i] or 0, i))
    place = np.empty(len(joined), np.int64)
    place[order] = np.arange(len(joined))
    for s in searches:
        s.best.doc = place[np.searchsorted(kept, s.best.doc)] if kept else s.best.doc
    keys[:] = [joined[i] for i in order]

    def flat(name: str) -> np.ndarray:
        return table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)

    sizes = np.diff(table.column("terms").combine_chunks().offsets.to_numpy()).astype(np.int64)
    terms, tf = flat("terms"), flat("tfs")
    m = np.repeat(corpus.measure(table.column("n").to_pylist()), sizes)
    rows = Rows(np.concatenate(([0], sizes.cumsum())), terms, 1_000_000_000 * tf // (1000 * tf + 8 * m))
    order = rows.by_weightiest(corpus.weight)
    rows, numbers = rows.taken(order), place[len(kept) :][order]
    owner = np.repeat(np.arange(len(rows)), np.diff(rows.starts))
    for s in searches:
        # only the terms of the tree's items count
        spot = np.minimum(np.searchsorted(s.items.terms, rows.terms), len(s.items.terms) - 1)
        ours = s.items.terms[spot] == rows.terms
        starts = np.concatenate(([0], np.bincount(owner[ours], minlength=len(rows)).cumsum()))
        s.add_documents(Rows(starts, spot[ours], rows.values[ours]), numbers)


def _item_trees(block: list[tuple], numbers: dict[bytes, int], weight: np.ndarray) -> list[ItemTree]:
    """Trees of at most ``TREE_ITEMS`` items, neighbours by their weightiest terms."""
    counts = [sorted((numbers[t], n) for t, n in terms.items()) for _, _, terms in block]
    starts = np.concatenate(([0], np.cumsum([len(c) for c in counts])))
    flat = np.array([pair for c in counts for pair in c], np.int64).reshape(-1, 2)
    rows = Rows(starts, flat[:, 0], flat[:, 1])
    order = rows.by_weightiest(weight)
    return [
        ItemTree(part, rows.taken(part), weight)
        for part in np.array_split(order, max(1, -(-len(order) // TREE_ITEMS)))
    ]


def best_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id`` and ``score`` of the k best documents of every item with a score above 0.

    N, L, n, df and tf are those of all documents. Equal scores go to the smaller ``doc_id``, one that is NULL comes last. A NULL text has no
    terms, an item without terms no rows. Documents that are repeated in full are ranked one by one; items that share an
    id are searched one by one, each with ranks of its own. Other columns are ignored. The vocabulary of a block
    of items (at most ``BLOCK_TERMS`` terms) is all that the driver holds; each block reads the documents once.
    """
    spark = docs.sparkSession
    found = [_block(spark, docs, block, k, doc_id, text) for block in item_blocks(items, item_id, text)]
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, found)


def _block(spark, docs: DataFrame, block: list[tuple], k: int, doc_id: str, text: str) -> DataFrame:
    numbers = {t: i for i, t in enumerate(sorted({t for _, _, terms in block for t in terms}))}
    found = written(occurrences(docs, spark.sparkContext.broadcast(numbers), doc_id, text), "occurrences")
    size = found.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = np.zeros(len(numbers), np.int64)
    for term, n in found.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        df[term] = n
    weight = np.array([term_weight(size["docs"], int(d)) for d in df], np.int64)
    corpus = _Corpus(size["docs"], size["terms"], weight)
    trees = _item_trees(block, numbers, weight)

    def searched(rows: DataFrame, least: np.ndarray) -> DataFrame:
        hits = _search(rows, spark.sparkContext.broadcast((corpus, trees, least)), k)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    # the kth score of a part of the documents is no more than the kth of all
    least = np.ones(len(block), np.int64)
    part = found.filter(F.pmod(F.xxhash64("doc_id", "n"), F.lit(PART)) == 0)
    for row in searched(part, least.copy()).filter(F.col("rank") == k).toLocalIterator():
        least[row["item"]] = row["score"]
    ids = spark.createDataFrame([(i, key) for i, (_, key, _) in enumerate(block)], "item long, item_id long")
    return searched(found, least).join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")

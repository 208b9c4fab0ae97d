"""Documents joined on the Jaccard similarity of their word n-grams, by prefix trees.

A document is the set of its distinct five-word shingles, in one global order. Documents that link
share, among the first (1 - t) n + l shingles of either, at least l: those prefixes are exchanged, and
a document stays only if l of its prefix shingles occur elsewhere. Ordering those by frequency and dropping the
last l - 1, two that link still have one in common, which puts them into one candidate group.
A group's whole sets are stored in a trie; a set walks the trie with its overlap so far, which
all sets below a node share, and leaves subtrees that the remaining lengths put out of reach.

Only those members are visited that the rarest shingles of the walking set leave possible.

Sets that are equal are one. Members of larger groups are compared with some pivots first, and those that are
then outside the group's largest connected part with all, in blocks; groups too large for a task deal
these blocks out to many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from sievework.llm.common import as_bytes, record_batches, release_memory, tasks, written
from sievework.llm.components import components
from sievework.llm.shingles import mixed, shingle_hashes, word_hashes

# Similarity of at least 80 per 100.
PART, WHOLE = 80, 100
# Documents sampled for the list of frequent shingles, and the share and number from which one is on it.
# The list only moves shingles to the end of the order: any list gives the same links.
HOT_SAMPLE, HOT_SHARE, HOT_LEAST = 4000, 0.005, 20
# A task flushes its prefix shingles when it holds so many.
_HELD = 1 << 19
# Members, and shingles of all of them, that one task compares with each other; pivots of a larger group.
GROUP, GROUP_SHINGLES, PIVOTS = 20_000, 4_000_000, 256
# Shingles of the sets that one tree holds, and of those that one task of a larger group compares with them.
BLOCK_SHINGLES = 1_000_000
# Ids of documents whose sets are needed; broadcast up to this number, else shuffled.
BROADCAST_IDS = 500_000
# Rank of a frequent shingle among a document's: after all that were counted.
_FREQUENT = 1 << 40
_LOW40 = np.uint64((1 << 40) - 1)


def shingle_sets(texts: list[bytes | None]) -> Iterator[np.ndarray]:
    for words in word_hashes(texts):
        yield np.unique(shingle_hashes(words))


def needed(n: int) -> int:
    """Least overlap with a set that is not smaller."""
    return -(-PART * n // WHOLE)


def extra(n: int) -> int:
    """Shingles by which a prefix is longer than one common shingle would need, and a bit more: half of a
    small set, a tenth of a large one."""
    return max(1, min(n // 2, max(n // 10, 20)))


def promised(n: int) -> int:
    """Prefix shingles shared with any linked set, which has at least ``needed(n)`` shingles; the
    prefixes of both are at least so much longer, as ``extra`` does not fall."""
    return extra(needed(n))


def prefix(shingles: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """The first shingles in global order: frequent ones last, else by value."""
    n = len(shingles)
    late = hot[np.minimum(np.searchsorted(hot, shingles), len(hot) - 1)] == shingles if len(hot) else np.zeros(n, bool)
    ordered = np.concatenate((shingles[~late], shingles[late])) if late.any() else shingles
    return ordered[: n - needed(n) + extra(n)]


def set_key(shingles: np.ndarray) -> tuple[int, int]:
    """128-bit key of a set as two signed numbers."""
    with np.errstate(over="ignore"):
        a = mixed(shingles).sum(dtype=np.uint64)
        b = mixed(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


# --- sets and frequent shingles --------------------------------------------------------------------


def frequent_shingles(texts: DataFrame) -> np.ndarray:
    """Shingles of at least ``HOT_SHARE`` of a bounded sample of documents, sorted.

    At most sample size times shingles per document / ``HOT_LEAST`` of them.
    """
    total = max(texts.count(), 1)
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < min(1.0, HOT_SAMPLE / total) * (1 << 30)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        for batch in batches:
            for s in shingle_sets(as_bytes(batch, "text")):
                yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64))], names=["s"])

    least = max(HOT_LEAST, int(HOT_SHARE * min(HOT_SAMPLE, total)))
    counts = texts.filter(part).mapInArrow(spread, "s long").groupBy("s").agg(F.count("*").alias("n"))
    rows = counts.filter(F.col("n") >= least).select("s").collect()
    return np.sort(np.array([r["s"] for r in rows], np.int64).view(np.uint64))


# --- exchange of prefixes --------------------------------------------------------------------------


def _five(values: np.ndarray) -> bytes:
    """The low 40 bits of each number."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _wide(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


def _sets_and_runs(texts: DataFrame, hot: np.ndarray) -> DataFrame:
    """Texts are hashed once: rows of ``doc_id``, size ``n`` and key (``a``, ``b``) of every document's set, and
    rows of ``bucket`` and ``run`` with prefix shingles.

    Shingles and keys travel as 40 bits each (a shingle also by its bucket), packed and sorted:
    shortened numbers can only add candidates. Shingles of the frequent list are known to be shared
    and stay out of the exchange by shingle, so no bucket is large because of one of them.
    """
    spark = texts.sparkSession
    buckets = tasks(spark, 2)
    shared = spark.sparkContext.broadcast(hot)
    digests = [("doc_id", pa.int64()), ("n", pa.int64()), ("a", pa.int64()), ("b", pa.int64())]
    blobs = pa.schema([("bucket", pa.int64()), ("run", pa.binary())])
    both = pa.schema([*digests, *blobs])

    def filled(batch: pa.RecordBatch) -> pa.RecordBatch:
        names = batch.schema.names
        columns = [batch.column(f.name) if f.name in names else pa.nulls(len(batch), f.type) for f in both]
        return pa.RecordBatch.from_arrays(columns, schema=both)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        frequent = shared.value
        held: list[np.ndarray] = []
        keys: list[np.ndarray] = []
        seen: set[tuple[int, int]] = set()

        def runs() -> Iterator[tuple]:
            token, key = np.concatenate(held), np.concatenate(keys)
            at = np.searchsorted(frequent, token)
            late = frequent[np.minimum(at, len(frequent) - 1)] == token if len(frequent) else np.zeros(len(token), bool)
            if late.any():
                # negative buckets pass through, spread by document
                which = -1 - (key[late] % np.uint64(buckets)).astype(np.int64)
                yield from _cut(which, token[late], key[late])
            token, key = token[~late], key[~late]
            # prefixes hold small hashes, so their own leading bits are mostly 0
            yield from _cut(((mixed(token) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64), token, key)

        size = 0
        for batch in batches:
            digest: list[tuple] = []
            for s in shingle_sets(as_bytes(batch, "text")):
                which = set_key(s)
                digest.append((len(s), *which))
                if len(s) == 0 or which in seen:
                    continue
                if len(seen) < 1 << 20:
                    seen.add(which)
                p = prefix(s, frequent)
                held.append(p)
                keys.append(np.full(len(p), which[0] & int(_LOW40), np.uint64))
                size += len(p)
            if digest:
                arrays = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in zip(*digest))]
                yield filled(pa.RecordBatch.from_arrays(arrays, schema=pa.schema(digests)))
            if size >= _HELD:
                yield from map(filled, record_batches(runs(), blobs, most_bytes=1 << 20))
                held, keys, size = [], [], 0
                seen.clear()
        if size:
            yield from map(filled, record_batches(runs(), blobs, most_bytes=1 << 20))

    return texts.mapInArrow(pack, "doc_id long, n long, a long, b long, bucket long, run binary")


def _shared_prefixes(packed: DataFrame) -> DataFrame:
    """``key`` (40 bits of a set's key), ``token``, ``seen`` for prefix shingles of several sets, from ``bucket``
    and ``run``."""

    hits = pa.schema([("key", pa.int64()), ("token", pa.int64()), ("seen", pa.int64())])

    def find(group: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        bucket = group[0].as_py()
        runs = [r for batch in batches for r in batch.column("run").to_pylist()]
        token = np.concatenate([_wide(r[: len(r) // 2]) for r in runs])
        key = np.concatenate([_wide(r[len(r) // 2 :]) for r in runs])
        del runs
        order = np.lexsort((key, token))
        token, key = token[order], key[order]
        new = np.ones(len(token), bool)  # a set that several tasks had counts once
        new[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1])
        token, key = token[new], key[new]
        if bucket < 0:
            count, mark = np.full(len(token), _FREQUENT, np.int64), 2**64 - 1
        else:
            first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
            sizes = np.diff(np.append(first, len(token)))
            count = np.repeat(sizes, sizes)
            some = count > 1
            token, key, count, mark = token[some], key[some], count[some], bucket
        # a shingle's name: its 40 bits and its bucket
        named = mixed(token ^ np.uint64(mark * 0x9E3779B97F4A7C15 % 2**64)).view(np.int64)
        for at in range(0, len(token), 1 << 16):
            part = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[part].view(np.int64)), pa.array(named[part]), pa.array(count[part])], schema=hits
            )

    return packed.groupBy("bucket").applyInArrow(find, "key long, token long, seen long")


def _cut(which: np.ndarray, token: np.ndarray, key: np.ndarray) -> Iterator[tuple]:
    order = np.lexsort((token, which))
    which, token, key = which[order], token[order], key[order]
    edges = np.flatnonzero(np.concatenate(([True], which[1:] != which[:-1]))) if len(which) else []
    for a, b in zip(edges, [*edges[1:], len(which)]):
        yield int(which[a]), _five(token[a:b]) + _five(key[a:b])


def _candidate_groups(sets: DataFrame, hits: DataFrame) -> DataFrame:
    """``key`` and ``root`` for the sets that may have a partner."""
    sizes = sets.groupBy("key").agg(F.min("n").alias("n"))
    least = F.ceil(F.col("n") * PART / WHOLE)
    tenth = F.greatest(F.floor(least / 10), F.lit(20))
    promise = F.greatest(F.least(F.floor(least / 2), tenth), F.lit(1))
    listed = hits.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("seen", "token"))).alias("hits"))
    kept = F.slice("hits", F.lit(1), (F.size("hits") - promise + 1).cast("int"))
    strong = written(
        listed.join(sizes, "key").filter(F.size("hits") >= promise)
        .select("key", F.explode(F.transform(kept, lambda h: h["token"])).alias("token")), "prefix-hits",
    )
    pivots = strong.groupBy("token").agg(F.min("key").alias("pivot"), F.count("*").alias("n")).filter("n > 1")
    links = strong.join(pivots.select("token", "pivot"), "token").select(
        F.col("key").alias("u"), F.col("pivot").alias("v")
    )
    return components(links).withColumnRenamed("node", "key")


# --- prefix tree -----------------------------------------------------------------------------------


class Trie:
    """Sets of ranks in one order; a node holds a run of ranks that the sets below it share."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        order = sorted(range(len(sets)), key=lambda i: sets[i].tobytes())
        self.runs: list[np.ndarray] = []
        self.below: list[list[int]] = []
        self.ends: list[list[int]] = []  # members that end at a node
        self.spans: list[list[int]] = []  # smallest and largest set below
        self.depth: list[int] = []  # ranks down to and with the node
        self.roots: list[int] = []
        path: list[int] = []  # nodes from the root to the last set inserted
        self.members = len(sets)
        last = np.zeros(0, np.uint32)
        for i in order:
            s = sets[i]
            n = min(len(s), len(last))
            differ = np.flatnonzero(s[:n] != last[:n])
            common = int(differ[0]) if len(differ) else n
            while path and self.depth[path[-1]] - len(self.runs[path[-1]]) >= common:
                path.pop()
            if path and self.depth[path[-1]] > common:
                self._split(path[-1], common)
            if common < len(s):
                node = self._node(s[common:], len(s))
                (self.below[path[-1]] if path else self.roots).append(node)
                path.append(node)
            self.ends[path[-1]].append(i)
            for node in path:
                span = self.spans[node]
                span[0], span[1] = min(span[0], len(s)), max(span[1], len(s))
            last = s

    def _node(self, run: np.ndarray, depth: int) -> int:
        self.runs.append(run)
        self.below.append([])
        self.ends.append([])
        self.spans.append([depth, depth])
        self.depth.append(depth)
        return len(self.runs) - 1

    def _split(self, node: int, common: int) -> None:
        """Ends the node at depth ``common``; the rest of its run becomes its only child."""
        keep = len(self.runs[node]) - (self.depth[node] - common)
        child = self._node(self.runs[node][keep:], self.depth[node])
        self.below[child], self.ends[child] = self.below[node], self.ends[node]
        self.spans[child] = list(self.spans[node])
        self.runs[node], self.below[node], self.ends[node] = self.runs[node][:keep], [child], []
        self.depth[node] = common

    def _levels(self) -> list[tuple[np.ndarray, ...]]:
        """Nodes by their number of ancestors: place of the parent one level up, where the run starts
        in all runs one after the other, its length, and depth and span."""
        sizes = np.array([len(r) for r in self.runs], np.int64)
        starts = np.cumsum(sizes) - sizes
        spans, depth = np.array(self.spans, np.int64).reshape(-1, 2), np.array(self.depth, np.int64)
        self.flat = np.concatenate(self.runs).astype(np.int64)
        self.parent = np.full(len(self.runs), -1, np.int64)
        self.end = np.zeros(self.members, np.int64)
        for node, (below, ends) in enumerate(zip(self.below, self.ends)):
            self.parent[below] = node
            self.end[ends] = node
        out, nodes = [], np.array(self.roots, np.int64)
        parents = np.zeros(len(nodes), np.int64)
        while len(nodes):
            out.append((nodes, parents, starts[nodes], sizes[nodes], depth[nodes], spans[nodes, 0], spans[nodes, 1]))
            below = [self.below[n] for n in nodes.tolist()]
            parents = np.repeat(np.arange(len(nodes)), [len(b) for b in below])
            nodes = np.array([c for b in below for c in b], np.int64)
        return out

    def _towards(self, members: np.ndarray) -> np.ndarray:
        """Flag per node: whether one of ``members`` ends there or below."""
        flags = np.zeros(len(self.runs), bool)
        at = np.unique(self.end[members])
        while len(at):
            flags[at] = True
            at = np.unique(self.parent[at])
            at = at[at >= 0]
            at = at[~flags[at]]
        return flags

    def partners(self, present: np.ndarray, n: int, among: np.ndarray | None = None) -> Iterator[int]:
        """Members that link with a set of ``n`` shingles, given as a flag per rank; where ``among`` is
        given, at least those of its members that do.

        All nodes of a level are visited together; those out of reach are left with all below them.
        """
        if not hasattr(self, "levels"):
            self.levels = self._levels()
        towards = None if among is None else self._towards(among)
        above = np.zeros(1, np.int64)
        for nodes, parents, starts, sizes, depth, low, high in self.levels:
            overlap = above[parents]
            visited = (overlap >= 0) & _reachable(overlap, depth - sizes, n, low, high)
            alive = np.flatnonzero(visited if towards is None else visited & towards[nodes])
            if len(alive) == 0:
                return
            length = sizes[alive]
            begins = np.cumsum(length) - length
            at = np.repeat(starts[alive] - begins, length) + np.arange(length.sum())
            found = overlap[alive] + np.add.reduceat(present[self.flat[at]], begins, dtype=np.int64)
            for k in np.flatnonzero(WHOLE * found >= PART * (n + depth[alive] - found)).tolist():
                yield from self.ends[nodes[alive[k]]]
            above = np.full(len(nodes), -1, np.int64)
            still = _reachable(found, depth[alive], n, low[alive], high[alive])
            above[alive[still]] = found[still]


def _reachable(overlap, depth, n: int, low, high) -> np.ndarray:
    """Whether a set of ``low`` to ``high`` ranks, ``depth`` of them passed, can still link."""
    size = np.clip(n - overlap + depth, low, high)
    most = np.minimum(overlap + size - depth, n)
    return WHOLE * most >= PART * (n + size - most)


class _Ranks:
    """Ranks of the shingles of some sets, in the global order of their values. That order is random, so
    similar sets share the upper nodes of a trie without making it deep."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.kinds = np.unique(np.concatenate(sets))

    def of(self, s: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.kinds, s), len(self.kinds) - 1)
        return at[self.kinds[at] == s].astype(">u4")  # big-endian, so bytes sort as numbers

    def flags(self, ranks: np.ndarray) -> np.ndarray:
        present = np.zeros(len(self.kinds), bool)
        present[ranks] = True
        return present


class _Lists:
    """Which of some sets, given by their ranks, have a rank."""

    def __init__(self, sets: list[np.ndarray], kinds: int) -> None:
        self.sizes = np.array([len(s) for s in sets], np.int64)
        ranks = np.concatenate(sets).astype(np.int64)
        self.members = np.repeat(np.arange(len(sets), dtype=np.int32), self.sizes)[np.argsort(ranks, kind="stable")]
        self.often = np.bincount(ranks, minlength=kinds)
        self.starts = np.cumsum(self.often) - self.often

    def possible(self, ranks: np.ndarray, n: int) -> np.ndarray:
        """Sets that can link with one of ``n`` shingles, of which these occur here: all that do, and few others.

        A partner lacks at most ``len(ranks) - needed(n)`` of them, so it has one of the rarest. Those are
        counted; the others are taken as shared.
        """
        counted = len(ranks) - needed(n) + 1
        if counted < 1:
            return np.zeros(0, np.int64)
        often = self.often[ranks]
        rare = np.argpartition(often, counted - 1)[:counted]
        length = often[rare]
        begins = np.cumsum(length) - length
        at = np.repeat(self.starts[ranks[rare]] - begins, length) + np.arange(length.sum())
        shared = np.bincount(self.members[at], minlength=len(self.sizes))
        most = shared + len(ranks) - counted
        return np.flatnonzero((shared > 0) & ((WHOLE + PART) * most >= PART * (n + self.sizes)))


def _root(parent: dict[int, int], i: int) -> int:
    while parent.get(i, i) != i:
        parent[i] = parent.get(parent[i], parent[i])
        i = parent[i]
    return i


def joined(sets: list[np.ndarray], pivots: list[np.ndarray] | None = None) -> list[tuple[int, int]]:
    """Links between sets (or from sets to pivots) that connect what all links connect.

    Without pivots a link is a pair of set numbers. With pivots it is (set, pivot), or
    (-1 - pivot, pivot) for pivots that some set connects.
    """
    held = sets if pivots is None else pivots
    ranks = _Ranks(held)
    own = [ranks.of(s) for s in held]
    trie, lists = Trie(own), _Lists(own, len(ranks.kinds))
    links: list[tuple[int, int]] = []
    parent: dict[int, int] = {}
    for i, s in enumerate(sets):
        known = own[i] if pivots is None else ranks.of(s)
        possible = lists.possible(known, len(s))
        if pivots is None:
            possible = possible[possible < i]
        if len(possible) == 0:
            continue
        found = list(trie.partners(ranks.flags(known), len(s), possible))
        if pivots is None:
            for j in found:
                if j < i and _root(parent, i) != _root(parent, j):
                    parent[_root(parent, i)] = _root(parent, j)
                    links.append((i, j))
        elif found:
            links.append((i, found[0]))
            for j in found[1:]:
                if _root(parent, j) != _root(parent, found[0]):
                    parent[_root(parent, j)] = _root(parent, found[0])
                    links.append((-1 - j, found[0]))
    return links


def joined_group(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect what all links within a group connect.

    Members known to be connected need no comparison: all are compared with some pivots, and what is then
    outside the largest connected part is compared with all, in blocks.
    """
    if len(sets) <= PIVOTS:
        return joined(sets)
    links: list[tuple[int, int]] = []
    parent: dict[int, int] = {}

    def compare(some: list[int], held: list[int]) -> None:
        for i, j in joined([sets[m] for m in some], [sets[m] for m in held]):
            u, v = some[i] if i >= 0 else held[-1 - i], held[j]
            if _root(parent, u) != _root(parent, v):
                parent[_root(parent, u)] = _root(parent, v)
                links.append((u, v))

    every = list(range(len(sets)))
    pivots = every[:: -(-len(sets) // PIVOTS)]
    compare(every, pivots)
    labels = [_root(parent, i) for i in every]
    kinds, often = np.unique(labels, return_counts=True)
    anchor = int(kinds[often.argmax()])  # a member of the part that counts as settled from now on
    done = set(pivots)
    for block in _blocks(sets):
        main = _root(parent, anchor)
        open_members = [i for i in every if i not in done and _root(parent, i) != main]
        if not open_members:
            break
        compare(open_members, block)
    return links


def _blocks(sets: list[np.ndarray]) -> Iterator[list[int]]:
    """Numbers of the sets, in runs of at most ``BLOCK_SHINGLES`` or one set."""
    held: list[int] = []
    size = 0
    for i, s in enumerate(sets):
        if held and size + len(s) > BLOCK_SHINGLES:
            yield held
            held, size = [], 0
        held.append(i)
        size += len(s)
    if held:
        yield held


# --- groups ----------------------------------------------------------------------------------------


def _group_sets(texts: DataFrame, sets: DataFrame, groups: DataFrame) -> DataFrame:
    """Whole sets of the candidate groups: ``root``, ``a``, ``b``, ``n``, ``shingles``, and whether the group ``fits`` a task."""
    grouped = sets.join(groups, "key").select("root", "a", "b", "n", "doc_id")
    grouped = written(grouped, "candidates")
    fits = (F.count("*") <= GROUP) & (F.sum("n") <= GROUP_SHINGLES)
    counts = grouped.groupBy("root").agg(F.count("*").alias("size"), fits.alias("fits")).filter("size > 1").drop("size")
    ids = grouped.select(F.col("doc_id").alias("_id")).distinct()
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    else:
        ids = ids.hint("shuffle_hash")
    chosen = texts.join(ids, F.col("doc_id").eqNullSafe(F.col("_id"))).select("text")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("shingles", pa.binary())])

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for s in shingle_sets(as_bytes(batch, "text")):
                    if len(s):
                        yield *set_key(s), s.astype("<u8").tobytes()

        yield from record_batches(rows(), schema)

    # ids may be repeated with other texts: the key decides
    whole = chosen.mapInArrow(collect, "a long, b long, shingles binary").dropDuplicates(["a", "b"])
    return written(grouped.drop("doc_id").join(counts, "root").join(whole, ["a", "b"]), "candidate-sets")


_LINK = "ua long, ub long, va long, vb long"
_LINKS = pa.schema([(n, pa.int64()) for n in ("ua", "ub", "va", "vb")])


def _small_links(members: DataFrame) -> DataFrame:
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in batch.to_pylist()]
        sets = [np.frombuffer(r["shingles"], "<u8") for r in rows]
        found = [
            (rows[i]["a"], rows[i]["b"], rows[j]["a"], rows[j]["b"]) for i, j in joined_group(sets)
        ]
        yield from record_batches(found, _LINKS)

    return members.groupBy("root").applyInArrow(link, _LINK)


def _pieces(sets: DataFrame, number: str) -> DataFrame:
    """``root`` and into how many pieces of bounded size a group's sets are dealt."""
    most = F.greatest(F.count("*") / GROUP, F.sum("n") / BLOCK_SHINGLES)
    return sets.groupBy("root").agg(F.ceil(most).alias(number))


def _block_links(sets: DataFrame, held: DataFrame) -> DataFrame:
    """Every set against the held ones of its group, piece by piece in tasks of bounded size."""
    numbers = _pieces(sets, "rows").join(_pieces(held, "columns"), "root")

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        piece = F.pmod(F.xxhash64("a", "b"), own).alias(f"{own}_at")
        copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(f"{other}_at")
        return side.join(numbers, "root").select("root", "a", "b", "shingles", piece, copies)

    def link(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, others = left.to_pylist(), right.to_pylist()
        found: list[tuple] = []
        if rows and others:
            wanted = [np.frombuffer(r["shingles"], "<u8") for r in rows]
            for i, j in joined(wanted, [np.frombuffer(r["shingles"], "<u8") for r in others]):
                u = rows[i] if i >= 0 else others[-1 - i]
                found.append((u["a"], u["b"], others[j]["a"], others[j]["b"]))
        columns = zip(*found) if found else [[]] * 4
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_LINKS)

    by = ["root", "rows_at", "columns_at"]
    left, right = dealt(sets, "rows", "columns"), dealt(held, "columns", "rows")
    return left.groupBy(by).cogroup(right.groupBy(by)).applyInArrow(link, _LINK)


def _node(a: str, b: str):
    return F.concat(F.hex(a), F.lit("-"), F.hex(b))


def _large_links(members: DataFrame) -> DataFrame | None:
    """Links of groups beyond ``GROUP`` members, by a number of jobs that does not follow their sizes.

    Members connected to one another need no comparison. Pivots are compared with the whole group, and what
    is outside the group's largest connected part afterwards is too, in blocks of both sides.
    """
    left = written(members, "large-groups")
    if left.isEmpty():
        return None
    rank = F.row_number().over(_by_hash())
    pivots = written(left.withColumn("_r", rank).filter(F.col("_r") <= PIVOTS).drop("_r"), "pivots")
    links = written(_block_links(left, pivots), "group-links")
    parts = written(
        components(links.select(_node("ua", "ub").alias("u"), _node("va", "vb").alias("v"))), "group-parts"
    )
    labelled = left.select("root", "a", "b", _node("a", "b").alias("node")).join(
        parts.withColumnRenamed("root", "part"), "node"
    )
    counts = labelled.groupBy("root", "part").agg(F.count("*").alias("size"))
    largest = counts.groupBy("root").agg(F.max(F.struct("size", "part"))["part"].alias("part"))
    settled = labelled.join(largest, ["root", "part"]).select("a", "b").unionByName(pivots.select("a", "b"))
    open_members = written(left.join(settled, ["a", "b"], "left_anti"), "open-members")
    return links.unionByName(written(_block_links(open_members, left), "open-links"))


def _by_hash() -> WindowSpec:
    return Window.partitionBy("root").orderBy(F.xxhash64("a", "b"), "a", "b")


def similar_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable by links) for every row.

    Words are split at ASCII white space, A-Z lower-cased. A text of fewer than five words is one
    shingle; one that is NULL or has no word has none and links with nothing. Rows with a NULL id count as
    documents; a component without any id has NULL. Rows repeated in full or with equal sets are one
    set, and linked. A document that links with nothing, or without shingles, is its own component.
    Other columns are ignored.
    """
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # hashes do not shrink, and compressing such large values takes memory beside the heap
    hashed = written(_sets_and_runs(texts, frequent_shingles(texts)), "sets-and-runs", compression="none")
    digests = hashed.filter("bucket is null").select("doc_id", "n", "a", "b")
    sets = written(
        digests.filter("n > 0").groupBy("a", "b").agg(F.max("n").alias("n"), F.min("doc_id").alias("doc_id"))
        .withColumn("key", F.col("a").bitwiseAND(F.lit((1 << 40) - 1))), "sets",
    )
    hits = _shared_prefixes(hashed.filter("bucket is not null").select("bucket", "run"))
    groups = written(_candidate_groups(sets, hits), "candidate-groups")
    whole = _group_sets(texts, sets, groups)
    links = _small_links(whole.filter("fits").drop("fits"))
    large = _large_links(whole.filter("not fits").drop("fits"))
    links = links if large is None else links.unionByName(large)
    parts = components(links.select(_node("ua", "ub").alias("u"), _node("va", "vb").alias("v")))
    labelled = sets.join(parts, _node("a", "b") == F.col("node"), "left").select("a", "b", "doc_id", "root")
    labelled = written(labelled, "set-components")
    least = labelled.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    named = labelled.join(least, "root", "left").select(
        "a", "b", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component")
    )
    some = digests.filter("n > 0").join(named, ["a", "b"], "left")
    none = digests.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component"))
    found = some.select("doc_id", "n", "component").unionByName(none)
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))

"""Repeated byte strings removed by merging sorted suffixes.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else. Equal strings of that
length have the same smallest hashed 40-byte gram at the same place, their anchor, and windows next to each
other mostly share it. So the unit is a run of windows around one anchor: the suffix from the anchor on,
and the bytes before it read backwards.

1. Anchors are exchanged as packed hashes; a window whose anchor occurs once in the corpus is unique.
2. For the others, every task sorts its suffixes, keeps equal ones once and writes them front-coded
   (length of the prefix shared with the one before, and the rest).
3. Tasks merge the sorted runs with a loser tree that carries common-prefix lengths, so a known prefix is
   never compared again. Neighbours and their common prefixes tell which windows are equal, exactly.

Anchors that very many documents share are cut into single windows, which hash apart unless they are
really equal, and equal ones collapse within each task. Texts that are equal take part once.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.common import as_bytes, record_batches, tasks, written
from sievework.llm.shingles import PIECE, mixed, powers

LENGTH = 200
GRAM = 40
# Documents sampled for the list of very common anchors, and the share and number from which one is on it.
# The list only chooses between two exact ways.
HOT_SAMPLE, HOT_SHARE, HOT_LEAST = 4000, 0.01, 40
# Entries, and bytes of suffixes, that a task holds before it writes its runs.
_HELD, _HELD_BYTES = 1 << 20, 64 << 20
# Groups up to this size are compared pair by pair.
_FEW = 6
# Keys of texts are broadcast up to this number (some 10 MB), else joined by a shuffle.
BROADCAST_KEYS = 500_000

_RANDOM = np.random.Generator(np.random.PCG64(77))
_BYTES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = 20  # bits of a place within a piece
_LOW40 = (1 << 40) - 1
_SINGLE = 255  # instead of an anchor's distance: a window on its own
_ENTRY = np.dtype([("h", "<u8"), ("key", "<u8"), ("start", "<u8"), ("n", "u1"), ("off", "u1")])


# --- anchors ---------------------------------------------------------------------------------------


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` values in a row."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


class _Piece:
    """Bytes of some texts in a row, with the anchors of all windows that lie within one text."""

    def __init__(self, data: bytes, ends: np.ndarray) -> None:
        raw = np.frombuffer(data, np.uint8)
        self.h = self.start = self.n = self.off = np.zeros(0, np.int64)
        if len(raw) < LENGTH:
            return
        up, down = powers(len(raw) + 1)
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTES[raw] * up[: len(raw)], out=total[1:])
        self._total, self._down = total, down
        grams = mixed((total[GRAM:] - total[:-GRAM]) * down[: len(raw) - GRAM + 1])
        # the place breaks ties, so the first of equal grams counts
        places = np.arange(len(grams), dtype=np.uint64)
        keyed = (grams >> np.uint64(_PLACE) << np.uint64(_PLACE)) | places
        least = _sliding_min(keyed, LENGTH - GRAM + 1) & np.uint64((1 << _PLACE) - 1)
        anchor = least.astype(np.int64)
        valid = np.ones(len(anchor), bool)
        crossing = (ends[:, None] - np.arange(1, LENGTH)[None, :]).ravel()
        valid[crossing[(crossing >= 0) & (crossing < len(valid))]] = False
        new = np.ones(len(anchor), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1])
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(anchor)))
        kept = valid[first]
        self.start, self.n = first[kept], n[kept]
        self.off = anchor[self.start] - self.start
        self.h = grams[anchor[self.start]]

    def windows(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the single windows of the chosen runs."""
        n = self.n[chosen]
        starts = np.repeat(self.start[chosen] - np.cumsum(n) + n, n) + np.arange(n.sum())
        whole = (self._total[starts + LENGTH] - self._total[starts]) * self._down[starts]
        return starts, mixed(whole ^ np.uint64(0xD6E8FEB86659FD93))


def _pieces(texts: list[tuple[int, bytes]]) -> Iterator[tuple[_Piece, np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of bounded size, with the key of each text, where it starts in the piece, and what to
    add to a place to get the place in the text. Long texts come in overlapping pieces."""
    held: list[tuple[int, bytes]] = []
    size = 0

    def flush() -> Iterator[tuple]:
        ends = np.cumsum([len(t) for _, t in held])
        starts = ends - [len(t) for _, t in held]
        keys = np.array([k for k, _ in held], np.uint64)
        yield _Piece(b"".join(t for _, t in held), ends), keys, starts, -starts

    for key, text in texts:
        if len(text) < LENGTH:
            continue
        if len(text) > PIECE:
            for at in range(0, len(text) - LENGTH + 1, PIECE):
                part = text[at : at + PIECE + LENGTH - 1]
                one = np.zeros(1, np.int64)
                yield _Piece(part, np.array([len(part)])), np.array([key], np.uint64), one, one + at
            continue
        if size + len(text) > PIECE:
            yield from flush()
            held, size = [], 0
        held.append((key, text))
        size += len(text)
    if held:
        yield from flush()


def _entries(texts: list[tuple[int, bytes]], hot: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Packed runs of windows with ordinary anchors, and single windows of those with common ones."""
    for piece, keys, starts, shift in _pieces(texts):
        if len(piece.h) == 0:
            continue
        late = _among(piece.h, hot)
        runs = ~late
        owner = np.searchsorted(starts, piece.start[runs], side="right") - 1
        ordinary = _packed(
            piece.h[runs], keys[owner], piece.start[runs] + shift[owner], piece.n[runs], piece.off[runs]
        )
        single = np.zeros(0, _ENTRY)
        if late.any():
            at, h = piece.windows(np.flatnonzero(late))
            owner = np.searchsorted(starts, at, side="right") - 1
            single = _packed(h, keys[owner], at + shift[owner], np.ones(len(at)), np.full(len(at), _SINGLE))
        yield ordinary, single


def _among(values: np.ndarray, hot: np.ndarray) -> np.ndarray:
    if len(hot) == 0:
        return np.zeros(len(values), bool)
    return hot[np.minimum(np.searchsorted(hot, values), len(hot) - 1)] == values


def _packed(h, key, start, n, off) -> np.ndarray:
    out = np.empty(len(h), _ENTRY)
    out["h"], out["key"], out["start"], out["n"], out["off"] = h, key, start, n, off
    return out


_WIDTHS = (("h", 5), ("key", 5), ("start", 5), ("n", 1), ("off", 1))


def _to_bytes(entries: np.ndarray) -> bytes:
    parts = []
    for name, width in _WIDTHS:
        values = np.ascontiguousarray(entries[name].astype("<u8")).view(np.uint8).reshape(-1, 8)
        parts.append(np.ascontiguousarray(values[:, :width]).tobytes())
    return b"".join(parts)


def _from_bytes(data: bytes) -> np.ndarray:
    n = len(data) // sum(w for _, w in _WIDTHS)
    out, at = np.empty(n, _ENTRY), 0
    for name, width in _WIDTHS:
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(n, width)
        out[name] = wide.view("<u8").ravel()
        at += n * width
    return out


def _bucketed(entries: np.ndarray, buckets: int, first: int) -> Iterator[tuple[int, bytes]]:
    # an anchor is the smallest of many hashes, so its own leading bits are mostly 0
    which = ((mixed(entries["h"]) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    order = np.lexsort((entries["h"], which))
    entries, which = entries[order], which[order]
    edges = np.flatnonzero(np.diff(which)) + 1
    for part, w in zip(np.split(entries, edges), np.split(which, edges)):
        if len(part):
            yield first + int(w[0]), _to_bytes(part)


_BLOBS = pa.schema([("bucket", pa.int64()), ("run", pa.binary())])
_BLOB = "bucket long, run binary"


def _common_anchors(texts: DataFrame) -> np.ndarray:
    """Anchors in a share of a bounded sample of texts, sorted; bounded with the sample."""
    total = max(texts.count(), 1)
    part = F.pmod(F.col("a"), F.lit(1 << 30)) < min(1.0, HOT_SAMPLE / total) * (1 << 30)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in as_bytes(batch, "text"):
                for ordinary, _ in _entries([(0, text)], np.zeros(0, np.uint64)):
                    h = np.unique(ordinary["h"]).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(h)], names=["h"])

    least = max(HOT_LEAST, int(HOT_SHARE * min(HOT_SAMPLE, total)))
    sample = texts.filter(part).dropDuplicates(["a", "b"]).select("text")
    counts = sample.mapInArrow(spread, "h long").groupBy("h").agg(F.count("*").alias("n"))
    rows = counts.filter(F.col("n") >= least).select("h").collect()
    return np.sort(np.array([r["h"] for r in rows], np.int64).view(np.uint64))


def _candidates(texts: DataFrame, hot: np.ndarray) -> DataFrame:
    """``key`` (40 bits of a text's key) and packed runs of windows whose anchor, or hash, is not unique.

    Shortened hashes and keys can only add candidates.
    """
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(hot)
    buckets = tasks(spark, 2)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        singles: list[np.ndarray] = []
        seen: set[tuple[int, int]] = set()

        def blobs() -> Iterator[tuple]:
            yield from _bucketed(np.concatenate(held), buckets, 0)
            single = np.concatenate(singles)
            # windows met several times here are candidates at once; one witness tells the others
            order = np.argsort(single["h"], kind="stable")
            single = single[order]
            same = np.zeros(len(single), bool)
            equal = single["h"][1:] == single["h"][:-1]
            same[1:] |= equal
            same[:-1] |= equal
            known = single[same]
            if len(known):
                yield -1 - int(known["key"][0]) % buckets, _to_bytes(known)
                witness = known[np.concatenate(([True], known["h"][1:] != known["h"][:-1]))]
                witness["n"] = 0
                yield from _bucketed(witness, buckets, buckets)
            yield from _bucketed(single[~same], buckets, buckets)

        size = 0
        for batch in batches:
            rows = []
            for a, b, text in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), as_bytes(batch, "text")):
                if (a, b) not in seen:
                    seen.add((a, b))
                    rows.append((a & _LOW40, text))
            for ordinary, single in _entries(rows, shared.value):
                held.append(ordinary)
                singles.append(single)
                size += len(ordinary) + len(single)
                if size >= _HELD:
                    yield from record_batches(blobs(), _BLOBS)
                    held, singles, size = [], [], 0
            if len(seen) > 1 << 20:
                seen.clear()
        if size:
            yield from record_batches(blobs(), _BLOBS)

    ranges = pa.schema([("key", pa.int64()), ("windows", pa.binary())])

    def find(group: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = group[0].as_py()
        found = np.concatenate([_from_bytes(r) for batch in batches for r in batch.column("run").to_pylist()])
        if bucket >= 0:
            found = _repeated(found)
        found = found[np.lexsort((found["start"], found["key"]))]
        edges = np.flatnonzero(np.diff(found["key"])) + 1
        rows = (
            (int(part["key"][0]), _to_bytes(part)) for part in np.split(found, edges) if len(part)
        )
        yield from record_batches(rows, ranges)

    packed = texts.mapInArrow(pack, _BLOB).groupBy("bucket")
    return packed.applyInArrow(find, "key long, windows binary")


def _repeated(found: np.ndarray) -> np.ndarray:
    """Entries whose hash occurs at several places, or that a witness vouches for."""
    found = found[np.lexsort((found["n"], found["start"], found["key"], found["h"]))]
    new = np.ones(len(found), bool)  # a text that several tasks had counts once
    for i, name in enumerate(("h", "key", "start", "n")):
        differs = found[name][1:] != found[name][:-1]
        new[1:] = differs if i == 0 else new[1:] | differs
    found = found[new]
    first = np.flatnonzero(np.concatenate(([True], found["h"][1:] != found["h"][:-1]))) if len(found) else np.zeros(0, int)
    sizes = np.diff(np.append(first, len(found)))
    vouched = np.add.reduceat(found["n"] == 0, first) > 0 if len(found) else np.zeros(0, bool)
    kept = np.repeat((sizes > 1) | vouched, sizes) & (found["n"] > 0)
    return found[kept]


# --- sorted runs -----------------------------------------------------------------------------------


def _shared_prefix(x: bytes, y: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes are known and not looked at."""
    n = min(len(x), len(y))
    differ = int.from_bytes(x[known:n]) ^ int.from_bytes(y[known:n])
    return n - (differ.bit_length() + 7) // 8


_REF = np.dtype([("a", "<i8"), ("b", "<i8"), ("start", "<i8"), ("right", "<u2"), ("shared", "<u2"), ("rest", "<u2"), ("many", "u1")])


def encode_run(records: list[tuple[bytes, int, int, int, int, int]]) -> bytes:
    """Front-coded run of sorted (suffix, right, a, b, start, many)."""
    refs = np.empty(len(records), _REF)
    rests, last = [], b""
    for i, (z, right, a, b, start, many) in enumerate(records):
        shared = _shared_prefix(last, z)
        rests.append(z[shared:])
        refs[i] = (a, b, start, right, shared, len(z) - shared, many)
        last = z
    return len(records).to_bytes(8) + refs.tobytes() + b"".join(rests)


class Run:
    """Reads a front-coded run: the suffix, and what it shares with the one before."""

    def __init__(self, data: bytes) -> None:
        n = int.from_bytes(data[:8])
        self.refs = np.frombuffer(data, _REF, n, 8).tolist()
        self.data, self.at, self.next = data, 8 + n * _REF.itemsize, 0
        self.z = b""
        self.shared = 0

    def step(self) -> bool:
        if self.next >= len(self.refs):
            return False
        self.ref = self.refs[self.next]
        self.next += 1
        shared, rest = self.ref[4], self.ref[5]
        self.z = self.z[:shared] + self.data[self.at : self.at + rest]
        self.at += rest
        self.shared = shared
        return True


def merge_runs(runs: list[Run]) -> Iterator[tuple[bytes, tuple, int]]:
    """Suffixes of all runs in order, with the prefix each shares with the one before.

    A loser tree: an inner node keeps the run that lost there and the prefix it shares with the run that
    won. Of two contenders for the same last winner the one that shares more with it is smaller; only
    if both share the same are bytes compared, from that place on.
    """
    k = 1
    while k < len(runs):
        k *= 2
    alive = [run.step() for run in runs] + [False] * (k - len(runs))
    shared = [0] * k
    loser = [-1] * k

    def smaller(x: int, y: int) -> bool:
        """Whether x comes before y; the loser then knows what it shares with the winner."""
        if not alive[y]:
            return True
        if not alive[x]:
            return False
        if shared[x] != shared[y]:
            return shared[x] > shared[y]
        a, b = runs[x].z, runs[y].z
        known = shared[x]
        common = _shared_prefix(a, b, known)
        if common == len(a) or common == len(b):
            first = (len(a), runs[x].ref[3]) <= (len(b), runs[y].ref[3])
        else:
            first = a[common] < b[common]
        shared[y if first else x] = common
        return first

    def play(node: int) -> int:
        if node >= k:
            return node - k
        x, y = play(2 * node), play(2 * node + 1)
        if smaller(x, y):
            loser[node] = y
            return x
        loser[node] = x
        return y

    winner = play(1)
    while alive[winner]:
        run = runs[winner]
        yield run.z, run.ref, shared[winner]
        alive[winner] = run.step()
        shared[winner] = run.shared
        node = (winner + k) // 2
        while node:
            other = loser[node]
            if smaller(other, winner):
                loser[node], winner = winner, other
            node //= 2


class _Spans:
    """Removed ranges of bytes by text."""

    def __init__(self) -> None:
        self.of: dict[tuple[int, int], list[int]] = {}

    def add(self, a: int, b: int, start: int, end: int) -> None:
        known = self.of.setdefault((a, b), [])
        if known and known[-2] <= start <= known[-1]:
            known[-1] = max(known[-1], end)
        else:
            known += (start, end)

    def rows(self) -> Iterator[tuple[int, int, bytes]]:
        for (a, b), flat in self.of.items():
            yield a, b, _united(np.array(flat, np.int64).reshape(-1, 2)).tobytes()


def _united(spans: np.ndarray) -> np.ndarray:
    """Maximal ranges covering the same bytes."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate(([True], spans[1:, 0] > reach[:-1]))
    first = np.flatnonzero(new)
    return np.stack([spans[first, 0], np.append(reach[first[1:] - 1], reach[-1])], axis=1)


_SPAN = "a long, b long, spans binary"
_SPANS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("spans", pa.binary())])
_PASSED = pa.schema([("bucket", pa.int64()), ("run", pa.binary()), ("a", pa.int64()), ("b", pa.int64())])


def _sorted_runs(rows: list[tuple], buckets: int) -> Iterator[tuple]:
    """Front-coded runs by bucket, and ranges settled within the task (bucket below 0).

    Equal suffixes are settled here: one of them travels, marked as met several times.
    """
    by_bucket: dict[int, list] = {}
    for record in rows:
        single = record[5]
        # suffixes with the same gram meet; single windows only when equal as a whole
        spot = zlib.crc32(record[0] if single else record[0][:GRAM]) % buckets
        by_bucket.setdefault(spot + (buckets if single else 0), []).append(record)
    spans = _Spans()
    for bucket, records in by_bucket.items():
        records.sort()
        kept: list[tuple] = []
        for z, right, a, b, start, _ in records:
            if kept and kept[-1][0] == z and kept[-1][1] == right:
                if not kept[-1][5]:
                    spans.add(*kept[-1][2:4], kept[-1][4], kept[-1][4] + len(z))
                    kept[-1] = (*kept[-1][:5], 1)
                spans.add(a, b, start, start + len(z))
            else:
                kept.append((z, right, a, b, start, 0))
        yield bucket, encode_run(kept), None, None
    for a, b, found in spans.rows():
        yield -1 - (a & _LOW40) % buckets, found, a, b


def _write_runs(joined: DataFrame, hot: np.ndarray) -> DataFrame:
    spark = joined.sparkSession
    buckets = tasks(spark, 2)
    shared = spark.sparkContext.broadcast(hot)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            keys = list(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()))
            texts, given = [], []
            rows = zip(keys, as_bytes(batch, "text"), batch.column("windows").to_pylist())
            for i, (key, text, windows) in enumerate(rows):
                if key in seen:
                    continue
                seen.add(key)
                texts.append((i, text))
                given += [(i << 40) + _from_bytes(w)["start"].astype(np.int64) for w in windows]
            if not texts:
                continue
            wanted = np.unique(np.concatenate(given))
            by_row = dict(texts)
            for pair in _entries(texts, shared.value):
                for entries in pair:
                    # a text's own runs only, whatever a shortened key has brought along
                    code = (entries["key"].astype(np.int64) << 40) + entries["start"].astype(np.int64)
                    entries = entries[_among(code, wanted)]
                    fields = [entries[c].tolist() for c in ("key", "start", "n", "off")]
                    for i, start, n, off in zip(*fields):
                        at = start if off == _SINGLE else start + off
                        end = start + n + LENGTH - 1
                        text = by_row[i]
                        z = text[at:end] + text[start:at][::-1]
                        held.append((z, end - at, *keys[i], start, off == _SINGLE))
                        size += end - start + 100
                    if size >= _HELD_BYTES:
                        yield from record_batches(_sorted_runs(held, buckets), _PASSED)
                        held, size = [], 0
        if held:
            yield from record_batches(_sorted_runs(held, buckets), _PASSED)

    return joined.mapInArrow(write, "bucket long, run binary, a long, b long")


# --- merge -----------------------------------------------------------------------------------------


def _merge(runs: DataFrame) -> DataFrame:
    """Removed ranges per text, several rows for one text."""
    buckets = tasks(runs.sparkSession, 2)

    def merge(group: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = group[0].as_py()
        if bucket < 0:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("a", "b", "run")], schema=_SPANS)
            return
        found = [Run(r) for batch in batches for r in batch.column("run").to_pylist()]
        spans = _Spans()
        settle_runs(merge_runs(found), spans, single=bucket >= buckets)
        yield from record_batches(spans.rows(), _SPANS)

    return runs.groupBy("bucket").applyInArrow(merge, _SPAN)


class _Content:
    """One distinct suffix of a group."""

    __slots__ = ("z", "right", "shared", "many", "refs")

    def __init__(self, z: bytes, ref: tuple, shared: int) -> None:
        self.z, self.right, self.shared, self.many = z, ref[3], shared, False
        self.refs: list[tuple[int, int, int]] = []

    def add(self, ref: tuple) -> None:
        if ref[6]:
            self.many = True  # its places were settled where the run was written
        else:
            self.refs.append(ref[:3])


def settle_runs(merged: Iterator[tuple[bytes, tuple, int]], spans: _Spans, single: bool) -> None:
    group: list[_Content] = []
    for z, ref, shared in merged:
        if group and shared == len(z) == len(group[-1].z) and ref[3] == group[-1].right:
            group[-1].add(ref)
            continue
        if group and (single or shared < GRAM):
            _settle(group, spans, single)
            group = []
        group.append(_Content(z, ref, shared))
        group[-1].add(ref)
    if group:
        _settle(group, spans, single)


def _settle(group: list[_Content], spans: _Spans, single: bool) -> None:
    for content in group:
        if content.many or len(content.refs) > 1:
            for a, b, start in content.refs:
                spans.add(a, b, start, start + len(content.z))
    if single or len(group) == 1:
        return
    if len(group) <= _FEW:
        for j in range(1, len(group)):
            shared = LENGTH
            for i in range(j - 1, -1, -1):
                shared = min(shared, group[i + 1].shared)
                _settle_pair(group[i], group[j], shared, spans)
        return
    _settle_many(group, spans)


def _settle_pair(x: _Content, y: _Content, shared: int, spans: _Spans) -> None:
    """Windows that begin ``off`` bytes before the anchor are equal if the bytes before it agree that
    far, and those from the anchor on for the rest of the window."""
    least = LENGTH - min(shared, x.right, y.right)
    if least > min(len(x.z) - x.right, len(y.z) - y.right):
        return
    most = _shared_prefix(x.z[x.right :], y.z[y.right :])
    if least <= most:
        _remove(x, least, most, spans)
        _remove(y, least, most, spans)


def _remove(content: _Content, least: int, most: int, spans: _Spans) -> None:
    if content.many or len(content.refs) > 1:
        return  # wholly removed
    for a, b, start in content.refs:
        at = start + len(content.z) - content.right
        spans.add(a, b, at - most, at - least + LENGTH)


def _settle_many(group: list[_Content], spans: _Spans) -> None:
    """The same for a large group, one distance from the anchor at a time: suffixes that share enough are
    neighbours, and among those equal bytes before the anchor make equal windows."""
    lefts = [c.z[c.right :] for c in group]
    shared = np.array([c.shared for c in group])
    rights = np.array([c.right for c in group])
    sizes = np.array([len(x) for x in lefts])
    for off in range(int(sizes.max()) + 1):
        able = np.flatnonzero((sizes >= off) & (rights >= LENGTH - off))
        if len(able) < 2:
            continue
        # a break between neighbours lies between all on its two sides
        block = np.cumsum(shared < LENGTH - off)
        first: dict[tuple[int, bytes], int] = {}
        for i in able.tolist():
            key = (int(block[i]), lefts[i][:off])
            j = first.setdefault(key, i)
            if j >= 0 and j != i:
                _remove(group[j], off, off, spans)
                first[key] = -1 - j
            if j != i:
                _remove(group[i], off, off, spans)


# --- the operator ----------------------------------------------------------------------------------


def _keys(text: Column) -> dict[str, Column]:
    return {"a": F.xxhash64(text), "b": F.xxhash64(F.lit("second"), text)}


def _chosen(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """Texts with one of the keys (``key``), about once each."""
    wanted = keys.select("key").distinct()
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_KEYS else wanted.hint("shuffle_hash")

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            new = []
            for pair in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                new.append(pair not in seen)
                seen.add(pair)
            yield batch.filter(pa.array(new, pa.bool_()))
            if len(seen) > 1 << 20:
                seen.clear()

    found = texts.withColumn("key", F.col("a").bitwiseAND(F.lit(_LOW40))).join(wanted, "key", "left_semi")
    return found.mapInArrow(once, found.schema)


def repeated_spans(docs: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Keys of all rows' texts (``a``, ``b``, ``n``: rows) and removed ranges of texts (``a``, ``b``, ``spans``:
    list of packed ranges), but for texts that occur several times, which go as a whole."""
    content = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(content.alias("text")).withColumns(_keys(F.col("text"))).filter(
        F.octet_length("text") >= LENGTH
    )
    hot = _common_anchors(texts)
    packed = written(_candidates(texts, hot), "suffix-candidates")
    windows = packed.groupBy("key").agg(F.collect_list("windows").alias("windows"))
    joined = _chosen(texts, packed).join(windows.hint("shuffle_hash"), "key")
    copies = texts.groupBy("a", "b").agg(F.count("*").alias("n"))
    spans = _merge(_write_runs(joined.select("a", "b", "text", "windows"), hot))
    return copies, written(spans, "suffix-spans")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``kept_sha256`` (of what
    remains) for every row.

    Texts are judged as given, not as what is left of others; a NULL text is empty. A text shorter than
    200 bytes keeps everything. Rows with equal texts of at least 200 bytes, whatever their ids, lose
    everything. Ids may be NULL or repeated; other columns are ignored; no rows give no rows.
    """
    copies, spans = repeated_spans(docs, text)
    several = copies.filter("n > 1").select("a", "b")
    grouped = spans.join(several, ["a", "b"], "left_anti").groupBy("a", "b").agg(F.collect_list("spans").alias("spans"))
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), content.alias("text")).withColumns(_keys(F.col("text")))
    keyed = written(grouped, "suffix-ranges")
    parts = _chosen(rows.select("a", "b", "text"), keyed.select(F.col("a").bitwiseAND(F.lit(_LOW40)).alias("key")))
    cut = _cut(parts.drop("key").join(keyed.hint("shuffle_hash"), ["a", "b"])).dropDuplicates(["a", "b"])
    empty = F.sha2(F.lit(""), 256)
    whole = several.select("a", "b", F.lit(-1).cast("long").alias("removed"), F.lit(1).cast("long").alias("found"), empty.alias("sha"))
    verdicts = written(cut.unionByName(whole), "suffix-verdicts")
    sized = rows.select(
        "doc_id", "a", "b", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("full")
    )
    return sized.join(verdicts, ["a", "b"], "left").select(
        "doc_id",
        "n_bytes",
        F.when(F.col("removed") < 0, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.coalesce("found", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("sha", "full").alias("kept_sha256"),
    )


def _cut(joined: DataFrame) -> DataFrame:
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("removed", pa.int64()), ("found", pa.int64()), ("sha", pa.string())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                columns = (batch.column(c).to_pylist() for c in ("a", "b", "spans"))
                for a, b, packed, text in zip(*columns, as_bytes(batch, "text")):
                    spans = _united(np.frombuffer(b"".join(packed), np.int64).reshape(-1, 2))
                    kept, at = hashlib.sha256(), 0
                    for start, end in spans.tolist():
                        kept.update(text[at:start])
                        at = end
                    kept.update(text[at:])
                    yield a, b, int((spans[:, 1] - spans[:, 0]).sum()), len(spans), kept.hexdigest()

        yield from record_batches(rows(), schema)

    return joined.mapInArrow(cut, "a long, b long, removed long, found long, sha string")

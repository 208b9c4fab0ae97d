"""Alignment of the tokens of two tokenizers, and how often their tokens meet.

Both see a text with one space in front: a byte-level tokenizer of the tokenizers library (A) and a merge-type piece
model of the sentencepiece library (B), which adds the space itself. Their spans are the coarse cuts: A's
character offsets and the byte spans of B's proto end at the same places wherever a character ends in both.
Spans say nothing inside a character: A gives every token of a split character the whole of it, B's byte-fallback
tokens are empty but for the last. Only groups in which both split characters are cut again, by the lengths
of their tokens' decoded bytes.

A space after another character than white space begins a token in both, so a text falls into chunks there that are
aligned on their own. A chunk falls into parts between a letter and a sign, and around a single newline, wherever the two
characters stand side by side in no piece of B: A's words end there too. Recurring parts are aligned once.

Links are counted over the corpus as (A id, B id) pairs per document. Pairs beyond the most frequent ones, whose
number is bounded, are looked up by a shuffle; no such pair is frequent enough to make a hot key.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import string
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate, chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.binary_records import _is_byte_level, byte_of_sign
from sievework.llm.common import collector_off, of_worker, record_batches, written
from sievework.llm.memo import Memo
from sievework.llm.piece_codec import SPACE, PieceModel

# Place before a space that follows another character than white space and is not the last character.
_CHUNK = re.compile(r"(?<=\S)(?= .)", re.DOTALL)
_SPACES = [chr(c) + " " for c in range(0x3001) if chr(c).isspace() and c != 32]
# Letters of every Unicode version, and places around a single newline between other characters than white space.
_LETTERS = "[A-Za-zÀ-ÖØ-öø-ɏ]"
_LINES = r"(?<=\S)(?=\n\S)|(?<=\S\n)(?=\S)"
# Pairs whose counts are broadcast at most (about 24 bytes each).
HOT_PAIRS = 1 << 20
# Characters of new chunks that are encoded together.
ENCODE_CHARS = 1 << 18
# Alignments of parts that a task holds, about.
MEMO_BYTES = 160 << 20
# Groups of more links are multiplied by distinct ids rather than link by link.
_LARGE = 64


def chunks_of(text: str) -> list[str]:
    """A text, which begins with the added space, cut before each such space."""
    parts = text[1:].split(" ")
    if "" in parts or any(space in text for space in _SPACES):
        return _CHUNK.split(text)
    return [" " + part for part in parts]


class Chunk(NamedTuple):
    """Alignment of a chunk or a part of one: tokens of A and B, groups, groups as text, links as pairs, and each pair's times (None:
    once each), both as packed 64-bit numbers."""

    n_a: int
    n_b: int
    n_groups: int
    groups: str
    pairs: bytes
    times: bytes | None


class Aligner:
    """``tokenizer``: content of A's file; ``model``: B's file as bytes."""

    def __init__(self, tokenizer: str, model: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(tokenizer)
        self.a.encode_special_tokens = True
        content = json.loads(tokenizer)
        if not _is_byte_level(content):
            raise ValueError("the first tokenizer is not byte-level")
        self.b = PieceModel(model)
        if not self.b.prefix:
            raise ValueError("the second tokenizer adds no space")
        size = self.a.get_vocab_size(with_added_tokens=True)
        added = {t["id"]: t["content"].encode() for t in content.get("added_tokens") or ()}
        self.a_bytes = [
            added[i] if i in added else bytes(byte_of_sign(c) for c in self.a.id_to_token(i) or "") for i in range(size)
        ]
        self.a_names, self.b_names = [str(i) for i in range(size)], self.b.names
        # A's names within and at the end of their side of a group, then B's, and the lengths of all
        self.listed = [name + sign for names, signs in ((self.a_names, ",|"), (self.b_names, ",;")) for sign in signs for name in names]
        self.listed_sizes = np.array([len(x) for x in self.listed])
        self.a_sizes, self.b_sizes = np.array([len(x) for x in self.a_bytes]), np.array([len(x) for x in self.b.said])
        self.width = pair_width(model)
        self.memo = Memo(MEMO_BYTES)
        # unknown neighbours would be one token of B, and added tokens of A may stand anywhere
        self.places = None
        if self.b.bytes and all(t.get("special") for t in content.get("added_tokens") or ()):
            joined = {p[1] for p in self.b.pairs if re.match(_LETTERS, p)}
            signs = "".join(c for c in string.punctuation if c not in joined)
            places = [f"(?<={_LETTERS})(?=[{re.escape(signs)}])"] if signs else []
            if self.b.lines:
                places.append(_LINES)
            self.places = re.compile("|".join(places)) if places else None

    def chunks(self, texts: list[str]) -> dict[str, Chunk | None]:
        """Alignment of each chunk of the texts; None where the joined bytes of A or B are not the chunk's."""
        return self.aligned([chunks_of(text) for text in texts])

    def aligned(self, texts: list[list[str]]) -> dict[str, Chunk | None]:
        """What :meth:`chunks` gives for texts that are cut into chunks already."""
        found: dict[str, Chunk | None] = {}
        new: list[list[str]] = []
        held = 0
        memo = self.memo
        for chunk in dict.fromkeys(chain.from_iterable(texts)):
            known = memo.newer.get(chunk)
            if known is None:
                parts = self.parts(chunk)
                if len(parts) > 1:
                    known = _joined([memo.newer.get(p) or memo.get(p) for p in parts])
                known = known or memo.get(chunk)
                if known is None:
                    new.append(parts)
                    held += len(chunk)
            found[chunk] = known
            if held >= ENCODE_CHARS:
                self._align_all(new, found)
                new, held = [], 0
        self._align_all(new, found)
        return found

    def parts(self, chunk: str) -> list[str]:
        """A chunk cut where a token of A and one of B end, whatever stands before and behind."""
        if self.places is None or chunk[1:].isalpha():
            return [chunk]
        return self.places.split(chunk)

    def _align_all(self, new: list[list[str]], found: dict[str, Chunk | None]) -> None:
        """``new``: chunks as their parts."""
        # one after the other, chunks are a text that falls into them again, but for those that end in white space
        plain = [parts for parts in new if not parts[-1][-1].isspace() and not any([SPACE in p for p in parts])]
        settled = self._align_joined(list(chain.from_iterable(plain))) if plain else {}
        memo = self.memo
        for parts in new:
            chunk = "".join(parts)
            aligned = found[chunk] = _joined([settled.get(p) for p in parts])
            if aligned is None:
                aligned = found[chunk] = self._align_one(chunk)
                if aligned:
                    memo.put(chunk, aligned, 250 + len(aligned.pairs) + len(aligned.groups))
                continue
            for part in parts:
                if part not in memo.newer:
                    one = settled[part]
                    memo.put(part, one, 250 + len(one.pairs) + len(one.groups))

    def _align_one(self, chunk: str) -> Chunk | None:
        a = self.a.encode(chunk, add_special_tokens=False)
        # every chunk begins with the space that B adds by itself
        b = self.b.library.encode(chunk[1:], return_type="proto").pieces
        return self.align(chunk, a.ids, a.offsets, [p.id for p in b], [p.end for p in b])

    def _align_joined(self, parts: list[str]) -> dict[str, Chunk]:
        """Alignments of parts that are encoded as one text, as :meth:`align` gives them, without those that have a large group; none
        at all if the joined bytes of A or B are not the text's, or a part does not end with a token of both."""
        text = "".join(parts)
        data = text.encode()
        first = self.a.encode(text, add_special_tokens=False)
        second = self.b.library.encode(text[1:], return_type="proto").pieces
        a, b = first.ids, [p.id for p in second]
        if b"".join(map(self.a_bytes.__getitem__, a)) != data or b"".join(map(self.b.said.__getitem__, b)) != data:
            return {}
        ids_a, ids_b = np.array(a, np.int64), np.array(b, np.int64)
        spans = np.fromiter(chain.from_iterable(first.offsets), np.int64, 2 * len(a)).reshape(-1, 2)
        ends_b = np.fromiter((p.end for p in second), np.int64, len(b)) + 1
        raw = np.frombuffer(data, np.uint8)
        places = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
        # spans end where their token does, unless the next token has bytes of the same character (A), or if they are empty (B)
        inner_a = np.append(spans[1:, 0] < spans[:-1, 1], False)
        inner_b = np.concatenate(([False], ends_b[1:] == ends_b[:-1]))
        ends_a = places[spans[:, 1]]
        if inner_a.any():  # only then can both end inside a character: where they do, by the tokens' bytes
            ends_a[inner_a] = self.a_sizes[ids_a].cumsum()[inner_a]
            ends_b[inner_b] = self.b_sizes[ids_b].cumsum()[inner_b]
        else:
            ends_b[inner_b] = 0
        at = np.zeros(len(raw) + 1, np.uint8)
        at[ends_a] = 1
        at[ends_b] |= 2
        at[0] = 0
        part_ends = places[np.fromiter(map(len, parts), np.int64, len(parts)).cumsum()]
        if (at[part_ends] != 3).any():
            return {}
        cut_a = np.concatenate(([0], np.flatnonzero(at[ends_a] == 3) + 1))
        cut_b = np.concatenate(([0], np.flatnonzero(at[ends_b] == 3) + 1))
        n_a, n_b = np.diff(cut_a), np.diff(cut_b)
        n_links = n_a * n_b
        # every part ends with a group
        last = np.searchsorted(ends_a[cut_a[1:] - 1], part_ends) + 1
        large = np.flatnonzero(n_links > _LARGE)
        small = np.where(n_links > _LARGE, 0, n_links)
        group = np.repeat(np.arange(len(small)), small)
        place = np.arange(len(group)) - np.repeat(small.cumsum() - small, small)
        pairs = ids_a[cut_a[group] + place // n_b[group]] * self.width + ids_b[cut_b[group] + place % n_b[group]]
        link_ends = small.cumsum()
        packed = pairs.astype(np.int64).tobytes()
        # a group's tokens of A and then those of B, each side with another sign at its end
        names = np.empty(len(a) + len(b), np.int64)
        names[np.arange(len(a)) + np.repeat(cut_b[:-1], n_a)] = ids_a
        names[np.arange(len(b)) + np.repeat(cut_a[1:], n_b)] = ids_b + 2 * len(self.a_names)
        names[cut_a[1:] + cut_b[:-1] - 1] += len(self.a_names)
        names[cut_a[1:] + cut_b[1:] - 1] += len(self.b_names)
        groups = "".join(map(self.listed.__getitem__, names.tolist()))
        to_a, to_b = cut_a[last], cut_b[last]
        sign_ends = self.listed_sizes[names].cumsum()[to_a + to_b - 1]
        ends = zip(parts, *[x.tolist() for x in (last, to_a, to_b, sign_ends, link_ends[last - 1])])
        out: dict[str, Chunk] = {}
        i = x = y = s = z = 0
        for part, j, k, l, t, to in ends:
            if part not in out:
                out[part] = Chunk(k - x, l - y, j - i, groups[s : t - 1], packed[8 * z : 8 * to], None)
            i, x, y, s, z = j, k, l, t, to
        for n in set(np.searchsorted(last, large, side="right").tolist()):
            out.pop(parts[n], None)
        return out

    def align(
        self, text: str, a: list[int], a_spans: list[tuple[int, int]], b: list[int], b_ends: list[int]
    ) -> Chunk | None:
        """``a_spans`` count characters of the text, ``b_ends`` bytes of the text behind its first space."""
        data = text.encode()
        a_bytes, b_bytes = self.a_bytes, self.b.said
        if b"".join(map(a_bytes.__getitem__, a)) != data or b"".join(map(b_bytes.__getitem__, b)) != data:
            return None
        # A: a token ends where its span does, unless the next one has bytes of the same character
        ends = [e for _, e in a_spans]
        inner = False
        if len(data) != len(text):
            places = list(accumulate((len(c.encode()) for c in text), initial=0))
            starts = [s for s, _ in a_spans[1:]] + [len(text)]
            ends = [places[e] if s >= e else -1 for s, e in zip(starts, ends)]
            inner = -1 in ends
        # B: the first token with an end ends there, later ones are bytes of the next character
        b_ends = [e + 1 if e != before else -1 for before, e in zip([-1, *b_ends], b_ends)]
        if inner:
            self._refine(ends, a, b_ends, b)
        groups: list[str] = []
        links: list[int] = []
        large: list[tuple[list[int], list[int]]] = []
        i = j = k = 0
        for to, end in enumerate(ends, 1):
            if end < 0:
                continue
            while b_ends[k] < end:
                k += 1
            if b_ends[k] != end:
                continue
            k += 1
            ours, theirs = a[i:to], b[j:k]
            i, j = to, k
            groups.append(
                ",".join([self.a_names[x] for x in ours]) + "|" + ",".join([self.b_names[y] for y in theirs])
            )
            if len(ours) * len(theirs) > _LARGE:
                large.append((ours, theirs))
                continue
            for x in ours:
                x *= self.width
                for y in theirs:
                    links.append(x + y)
        times = None
        if large:
            often = Counter(links)
            for ours, theirs in large:
                theirs = Counter(theirs).items()
                for x, n in Counter(ours).items():
                    for y, m in theirs:
                        often[x * self.width + y] += n * m
            links, times = list(often), np.array(list(often.values()), np.int64).tobytes()
        return Chunk(len(a), len(b), len(groups), ";".join(groups), np.array(links, np.int64).tobytes(), times)

    def _refine(self, ends: list[int], a: list[int], b_ends: list[int], b: list[int]) -> None:
        """Put in the ends that lie inside characters, where both tokenizers have some, from the tokens' bytes."""
        for at, ids, said in ((ends, a, self.a_bytes), (b_ends, b, self.b.said)):
            for n, (i, end) in enumerate(zip(ids, at)):
                if end < 0:
                    at[n] = (at[n - 1] if n else 0) + len(said[i])


def pair_width(model: bytes) -> int:
    """Factor of an A id in the number of a pair, which is A id x width + B id."""
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_proto=model).get_piece_size()


_ALIGNED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<long>, times array<long>"
)


def align_documents(
    docs: DataFrame, tokenizer: str, model: bytes, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document, saved in the shared folder: ``row`` (a number of its own), ``doc_id``, ``n_a``, ``n_b``, ``n_groups``,
    ``n_links``, ``groups_sha256`` and the document's distinct ``pairs`` with their ``times``.

    A NULL or empty text, and one whose tokens do not give back its bytes (such as one with U+2581), has no tokens: zeros, an empty
    digest and no pairs. Rows repeated in full are documents of their own, a NULL id stays NULL, other columns are ignored.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((tokenizer, model))
    schema = pa.schema(
        [(n, pa.int64()) for n in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links")]
        + [("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))]
    )

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner = None
        row = TaskContext.get().partitionId() << 40

        def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
            nonlocal row
            keys = batch.column("doc_id").to_pylist()
            texts = [" " + t if t else "" for t in batch.column("text").to_pylist()]
            at = 0
            while at < len(texts):  # as many texts as are encoded together
                to, size = at + 1, len(texts[at])
                while to < len(texts) and size + len(texts[to]) <= ENCODE_CHARS:
                    size += len(texts[to])
                    to += 1
                cut = [chunks_of(t) if t else [] for t in texts[at:to]]
                found = aligner.aligned(cut)
                for key, chunks in zip(keys[at:to], cut):
                    yield (row, key, *_document(list(map(found.__getitem__, chunks)) if chunks else [None]))
                    row += 1
                at = to

        with collector_off():
            for batch in batches:
                aligner = aligner or of_worker("aligner", shared.value, lambda: Aligner(*shared.value))
                yield from record_batches(rows(batch), schema, 512)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return written(rows.mapInArrow(align, _ALIGNED), "aligned")


def _joined(parts: list[Chunk | None]) -> Chunk | None:
    """Alignment of a chunk from those of its parts, if all are known and none has a large group."""
    if len(parts) == 1:
        return parts[0]
    n_a = n_b = n_groups = 0
    for part in parts:
        if part is None or part[5] is not None:
            return None
        n_a += part[0]
        n_b += part[1]
        n_groups += part[2]
    return Chunk(n_a, n_b, n_groups, ";".join([p[3] for p in parts]), b"".join([p[4] for p in parts]), None)


def _document(chunks: list[Chunk | None]) -> tuple:
    if None in chunks:
        return 0, 0, 0, 0, "", [], []
    n_a, n_b, n_groups, groups, packed, often = zip(*chunks)
    counts = sum(n_a), sum(n_b), sum(n_groups)
    digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
    pairs = np.frombuffer(b"".join(packed), np.int64)
    if not any(often):
        pairs, times = np.unique(pairs, return_counts=True)
    else:
        often = np.frombuffer(b"".join([c.times or np.ones(len(c.pairs) // 8, np.int64).tobytes() for c in chunks]), np.int64)
        pairs, place = np.unique(pairs, return_inverse=True)
        times = np.zeros(len(pairs), np.int64)
        np.add.at(times, place, often)
    return *counts, int(times.sum()), digest, pairs, times


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """``pair``, ``n`` (documents that hold it) and ``best`` (1 where no pair of that A id has more), saved."""
    counted = written(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pairs")
    counted = counted.withColumn("a", F.expr(f"pair div {width}"))
    most = counted.groupBy("a").agg(F.max("n").alias("most"))
    best = (F.col("n") == F.col("most")).cast("long").alias("best")
    return written(counted.join(most, "a").select("pair", "n", best), "pair-counts")


def token_translations(aligned: DataFrame, width: int) -> DataFrame:
    """``a_id``, ``b_id``, ``n`` of the pairs that are best for their A id: a map from one vocabulary to the other."""
    return pair_counts(aligned, width).filter("best = 1").select(
        F.expr(f"pair div {width}").cast("int").alias("a_id"), F.expr(f"pair % {width}").cast("int").alias("b_id"), "n"
    )


def link_statistics(aligned: DataFrame, width: int, hot_pairs: int | None = None) -> DataFrame:
    """The documents of :func:`align_documents` with ``n_best`` (links whose pair is best for its A id) and ``count_sum`` (the pairs'
    numbers of documents, summed over the links)."""
    counts = pair_counts(aligned, width)
    # pairs by the power of two in their count: the classes from the top that fit the broadcast
    power = F.floor(F.log2("n")).cast("int")
    classes = counts.groupBy(power.alias("power")).agg(F.count("*").alias("pairs")).collect()  # 63 rows at most
    least, held = 64, 0
    for power_of, pairs in sorted(((r["power"], r["pairs"]) for r in classes), reverse=True):
        if held + pairs > (HOT_PAIRS if hot_pairs is None else hot_pairs):
            break
        least, held = power_of, held + pairs
    links = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select(
        "row", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times")
    )
    sums = (F.sum(F.expr("times * best")).alias("n_best"), F.sum(F.expr("times * n")).alias("count_sum"))
    hot = F.broadcast(counts.filter(power >= least))
    if held == sum(r["pairs"] for r in classes):
        total = links.join(hot, "pair").groupBy("row").agg(*sums)
    else:
        known = links.join(hot, "pair", "left")
        ours = known.filter("n is not null").groupBy("row").agg(*sums)
        rest = known.filter("n is null").select("row", "pair", "times").join(counts.filter(power < least), "pair")
        both = ours.unionByName(rest.groupBy("row").agg(*sums))
        total = both.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return aligned.drop("pairs", "times").join(total, "row", "left").na.fill(0, ["n_best", "count_sum"]).drop("row")

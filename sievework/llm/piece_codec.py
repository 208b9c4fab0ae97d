"""Encoding and decoding with merge-type piece vocabularies.

A text is a row of symbols, at first its characters with the space written as U+2581. An agenda holds the
adjacent pairs whose joined text is a piece, best score first, the leftmost of equal ones; the top pair
becomes one symbol, and the pairs it forms with its neighbours join the agenda. What is left in the end are
the tokens; a symbol that is no piece is written as its UTF-8 bytes, or as unknown where the vocabulary has no bytes.

No piece of such a vocabulary has U+2581 after another character (checked when a model is loaded), so
no pair ever crosses the place before a U+2581 that follows another character. Texts are cut there, and
recurring cuts are encoded once; a new cut is cut again around lines and before signs at its end, where the two
characters stand side by side in no piece.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.common import collector_off, of_worker, record_batches
from sievework.llm.memo import Made

SPACE = "▁"
# A cut of a text: leading spaces and what follows them.
_CUT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_LINE = re.compile("(\n)")
# Up to so many characters an agenda is a plain list.
_SHORT = 40
_NO_PIECE = float("inf")
# Encodings of cuts that a worker holds, about; more where it holds nothing else.
MEMO_BYTES, CODER_MEMO_BYTES = 192 << 20, 384 << 20
# Characters of texts that are encoded and checked together.
CHECK_CHARS = 1 << 18
# New cuts that the library encodes in a row, and what stands before those of spaces alone.
_ROW = 256
_LETTER = f"{SPACE}a"

# each byte that is not UTF-8 comes back as one replacement character
codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


class PieceModel:
    """A model file's pieces; ``content`` is the file as bytes.

    Only merge-type models without a rewriting of the text, extra white-space rules, unused or user-defined pieces
    are taken, others raise ValueError.
    """

    def __init__(self, content: bytes, memo_bytes: int = MEMO_BYTES) -> None:
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(content)
        kinds = model.SentencePiece
        rules = model.normalizer_spec
        if model.trainer_spec.model_type != model.trainer_spec.BPE:
            raise ValueError("the model is not of the merge type")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("the model rewrites texts")
        if model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("the model has spaces at the end of words")
        self.prefix = SPACE if rules.add_dummy_prefix else ""
        self.library = SentencePieceProcessor(model_proto=content)
        self.unknown, self.end = self.library.unk_id(), self.library.eos_id()
        self.rank: dict[str, tuple[float, int]] = {}  # minus score, and id
        self.bytes: dict[int, int] = {}
        self.said: list[bytes] = []  # what each id is decoded to
        for i, piece in enumerate(model.pieces):
            said = b""
            if piece.type == kinds.NORMAL:
                self.rank[piece.piece] = (-piece.score, i)
                said = piece.piece.replace(SPACE, " ").encode()
            elif piece.type == kinds.BYTE:
                value = int(piece.piece[3:5], 16)
                self.bytes[value] = i
                said = bytes([value])
            elif piece.type == kinds.UNKNOWN:
                said = model.trainer_spec.unk_surface.encode()
            elif piece.type != kinds.CONTROL:
                raise ValueError(f"the model has a piece that is unused or user-defined: {piece.piece}")
            self.said.append(said)
        if any(SPACE in piece.lstrip(SPACE) for piece in self.rank):
            raise ValueError("a piece has a space after another character")
        self.pairs = {piece[i : i + 2] for piece in self.rank for i in range(len(piece) - 1)}
        self.lines = not any("\n" in pair for pair in self.pairs)
        self.ids = {piece: i for piece, (_, i) in self.rank.items()}
        self.score = {piece: score for piece, (score, _) in self.rank.items()}
        self.names = [str(i) for i in range(len(self.said))]
        self.byte_ids = set(self.bytes.values())
        self.spaced = {i for i, said in enumerate(self.said) if said[:1] == b" " and i not in self.byte_ids}
        self.spaced.discard(self.unknown)
        self.silent = {i for i, said in enumerate(self.said) if not said}
        self.cuts = Made(self._made, memo_bytes)
        # cuts can be checked apart from their texts; new ones are noted where that is asked for
        self.by_cuts = bool(self.prefix and self.bytes)
        self.fresh: list[tuple[str, tuple[int, ...]]] | None = None

    def _made(self, cut: str) -> tuple[int, ...]:
        ids = self._parts(cut)
        if self.fresh is not None and cut[0] == SPACE:
            self.fresh.append((cut, ids))
        return ids

    def _parts(self, cut: str) -> tuple[int, ...]:
        if not self.bytes:
            return self.agenda(cut)  # unknown neighbours are one token, wherever they meet
        if self.lines and "\n" in cut and len(cut) > 1:
            return tuple(chain.from_iterable(map(self.cuts.__getitem__, filter(None, _LINE.split(cut)))))
        end = len(cut)
        while end > 1 and cut[end - 2 : end] not in self.pairs:
            end -= 1
        if end == len(cut):
            return self.agenda(cut)
        return self.cuts[cut[:end]] + tuple(chain.from_iterable(map(self.cuts.__getitem__, cut[end:])))

    def agenda(self, text: str) -> tuple[int, ...]:
        """Ids of a text as it stands (spaces already U+2581)."""
        symbols = self._in_list(text) if len(text) <= _SHORT else list(self._in_heap(text))
        try:
            return tuple([self.ids[symbol] for symbol in symbols])
        except KeyError:  # a symbol is no piece
            pass
        ids: list[int] = []
        for symbol in symbols:
            found = self.rank.get(symbol)
            if found:
                ids.append(found[1])
            elif self.bytes:
                ids += [self.bytes[b] for b in symbol.encode()]
            elif ids[-1:] != [self.unknown]:  # neighbours that are unknown are one
                ids.append(self.unknown)
        return tuple(ids)

    def _in_list(self, text: str) -> list[str]:
        """Symbols of a short text: the agenda is the list of all pairs' scores, whose best is looked for each time."""
        symbols = list(text)
        score, none = self.score.get, _NO_PIECE
        agenda = [score(text[i : i + 2], none) for i in range(len(text) - 1)]
        while agenda:
            best = min(agenda)
            if best == none:
                break
            i = agenda.index(best)
            merged = symbols[i] = symbols[i] + symbols.pop(i + 1)
            del agenda[i]
            if i < len(agenda):
                agenda[i] = score(merged + symbols[i + 1], none)
            if i:
                agenda[i - 1] = score(symbols[i - 1] + merged, none)
        return symbols

    def _in_heap(self, text: str) -> Iterator[str]:
        """Symbols of a text of any length: the agenda is a heap, and pairs that are no more are passed over."""
        symbols = list(text)
        rank = self.rank
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = []
        for i in range(n - 1):
            found = rank.get(symbols[i] + symbols[i + 1])
            if found:
                agenda.append((found[0], i, i + 1, 2))
        heapify(agenda)
        while agenda:
            _, left, right, size = heappop(agenda)
            # stale: one of the two has merged with another symbol since
            if not symbols[left] or not symbols[right] or len(symbols[left]) + len(symbols[right]) != size:
                continue
            symbols[left] += symbols[right]
            symbols[right] = ""
            far = after[left] = after[right]
            if far < n:
                before[far] = left
                found = rank.get(symbols[left] + symbols[far])
                if found:
                    heappush(agenda, (found[0], left, far, len(symbols[left]) + len(symbols[far])))
            near = before[left]
            if near >= 0:
                found = rank.get(symbols[near] + symbols[left])
                if found:
                    heappush(agenda, (found[0], near, left, len(symbols[near]) + len(symbols[left])))
        return filter(None, symbols)

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text, without an end id."""
        if not text:
            return []
        cuts = _CUT.findall(self.prefix + text.replace(" ", SPACE))
        return list(chain.from_iterable(map(self.cuts.__getitem__, cuts)))

    def decode(self, ids: list[int]) -> str:
        """Text of the ids: pieces joined, runs of bytes read as UTF-8, control ids silent, and without the
        space that encoding puts first."""
        at = 0
        if self.prefix:
            while at < len(ids) and ids[at] in self.silent:
                at += 1
        rest = ids[at:]
        joined = b"".join(map(self.said.__getitem__, rest))
        if rest and self.prefix and rest[0] in self.spaced:
            joined = joined[1:]
        if self.silent.isdisjoint(rest):
            try:
                return joined.decode()
            except UnicodeDecodeError:
                pass
        return "".join(self._runs(rest, bool(self.prefix)))

    def _runs(self, ids: list[int], first: bool) -> Iterator[str]:
        run = bytearray()
        for i in ids:
            if i in self.byte_ids:
                run += self.said[i]
            else:  # control ids end a run of bytes too
                yield run.decode(errors="each_byte")
                run.clear()
                said = self.said[i].decode()
                yield said[1:] if first and i in self.spaced else said
            first = False
        yield run.decode(errors="each_byte")


def model_file(path: str) -> bytes:
    """Content of a model file, to be sent to the tasks (some MB)."""
    return Path(path).read_bytes()


class LibraryDiffers(ValueError):
    """The library's ids of a document differ from the agenda's."""


def checked(model: PieceModel, keys: list[int | None], texts: list[str], ids: list[list[int]]) -> list[str]:
    """The library's decoded texts, once its ids of the texts are found to be the given ones."""
    theirs = model.library.encode(texts, num_threads=1)
    if theirs != ids:
        wrong = next(key for key, a, b in zip(keys, ids, theirs) if a != b)
        raise LibraryDiffers(f"document {wrong}: the library's ids differ")
    return model.library.decode(ids, num_threads=1)


def checked_by_cuts(model: PieceModel, keys: list[int | None], texts: list[str], ids: list[list[int]]) -> list[str]:
    """The library's decoded texts, once its ids of all cuts that are new since the last call are found to be the given ones.

    A text's ids are those of its cuts one after the other, so cuts that recur need no second look. New ones go to the
    library in a row, as in a text; those of spaces alone, which would run into the next one, after a letter each.
    """
    fresh, model.fresh = model.fresh or [], []
    words = [f for f in fresh if f[0][-1] != SPACE]
    rows = [words[i : i + _ROW] for i in range(0, len(words), _ROW)]
    letter = (_LETTER, model.agenda(_LETTER))
    rows += [[letter, f] for f in fresh if f[0][-1] == SPACE]
    mine = [list(chain.from_iterable(found for _, found in row)) for row in rows]
    # the library puts the first space itself
    if rows and model.library.encode(["".join(cut for cut, _ in row)[1:] for row in rows], num_threads=1) != mine:
        model.cuts.forget()
        checked(model, keys, texts, ids)
        raise LibraryDiffers("the library's ids of new cuts differ")
    return model.library.decode(ids, num_threads=1)


_OUT = "doc_id long, ids array<int>, decoded string"


def encode_pieces(
    docs: DataFrame, model: bytes, end: bool = True, check: bool = True, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``ids`` (with the end id last, if ``end``) and ``decoded`` (their text) of every document.

    A NULL text counts as empty: the end id alone, and an empty decoded text. Rows repeated in full give as many rows, a
    NULL id stays NULL, other columns are ignored, no rows give none. With ``check`` every cut that a
    worker meets for the first time goes through the sentencepiece library too (whole texts, if the model has no bytes or puts no
    space first): other ids raise :class:`LibraryDiffers` rather than being returned, and the library decodes all ids.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def out(code: PieceModel, key: int | None, ids: list[int], decoded: str) -> tuple:
        return key, [*ids, code.end] if end else ids, decoded

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        _coder(docs, model, check, out, schema), _OUT
    )


_DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def digest_pieces(
    docs: DataFrame, model: bytes, check: bool = True, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """What :func:`encode_pieces` gives, in short: ``n_tokens`` (with the end id), ``ids_sha256`` (of the decimal ids joined by
    a space) and ``decoded_sha256`` (of the decoded text in UTF-8), both in lowercase hex."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    )

    def out(code: PieceModel, key: int | None, ids: list[int], decoded: str) -> tuple:
        listed = " ".join([*map(code.names.__getitem__, ids), code.names[code.end]])
        digests = [hashlib.sha256(t.encode()).hexdigest() for t in (listed, decoded)]
        return key, len(ids) + 1, *digests

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        _coder(docs, model, check, out, schema), _DIGESTS
    )


def _coder(docs: DataFrame, model: bytes, check: bool, out, schema: pa.Schema):
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # checked cuts and others are not held together
        kind = "checked-pieces" if check else "pieces"
        pieces = of_worker(kind, (shared.value,), lambda: PieceModel(shared.value, CODER_MEMO_BYTES))
        if check and pieces.by_cuts and pieces.fresh is None:
            pieces.fresh = []

        def rows() -> Iterator[tuple]:
            for keys, texts in _portions(batches):
                ids = [pieces.encode(text) for text in texts]
                if not check:
                    decoded = list(map(pieces.decode, ids))
                elif pieces.by_cuts:
                    decoded = checked_by_cuts(pieces, keys, texts, ids)
                else:
                    decoded = checked(pieces, keys, texts, ids)
                for one in zip(keys, ids, decoded):
                    yield out(pieces, *one)

        with collector_off():
            yield from record_batches(rows(), schema)

    return code


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int | None], list[str]]]:
    """Ids and texts of about ``CHECK_CHARS`` characters, but for single long texts."""
    for batch in batches:
        keys: list[int | None] = []
        texts: list[str] = []
        size = 0
        for key, value in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            keys.append(key)
            texts.append(value.as_py() or "")
            size += len(texts[-1])
            if size >= CHECK_CHARS:
                yield keys, texts
                keys, texts, size = [], [], 0
        if keys:
            yield keys, texts

"""Token files of length-delimited binary records with checksums and an offset index.

A record file is a run of frames::

    length   8 bytes, little-endian, of the payload
    check    4 bytes, masked checksum of the length bytes
    payload  8 bytes document id (signed), 1 byte bytes-per-id, then the ids, little-endian
    check    4 bytes, masked checksum of the payload

``<file>.index`` holds one entry of 16 bytes per frame, its offset and its number of ids, so that
records can be fetched in any order. The masked checksum is CRC-32 rotated right by 15 bits plus a
constant, as a checksum over data that itself holds checksums is weak.

Files are written through ``pyarrow.fs``, so the folder may be any store it knows. A file counts only
if the manifest that Spark returns names it; what a lost or repeated task leaves is never read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
import sys
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm.common import collector_off, record_batches, release_memory, tasks, worker_cache, written
from sievework.session import fresh_folder

# Constant and rotation of the mask.
_MASK, _TURN = 0xA282EAD8, 15
_INDEX = np.dtype([("offset", "<u8"), ("ids", "<u8")])
# A file is closed beyond this size and the task starts another one.
FILE_BYTES = 256 << 20
# Encodings kept by a worker, about so many bytes for each of two generations: of first parts, lines and signs,
# which are few, and of words after a space.
_FIRST_BYTES, _REST_BYTES = 12 << 20, 52 << 20


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> _TURN) | (crc << (32 - _TURN))) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join(
        (length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload)))
    )


def payload_of(data: bytes, at: int = 0) -> tuple[bytes, int]:
    """The payload of the frame at an offset, and the next frame's offset."""
    if at + 12 > len(data):
        raise ValueError(f"frame at {at} is cut off")
    length, check = struct.unpack_from("<QI", data, at)
    if check != masked(data[at : at + 8]):
        raise ValueError(f"length at {at} fails its checksum")
    end = at + 12 + length
    if end + 4 > len(data):
        raise ValueError(f"frame at {at} is cut off")
    payload = data[at + 12 : end]
    if struct.unpack_from("<I", data, end)[0] != masked(payload):
        raise ValueError(f"payload at {at} fails its checksum")
    return payload, end + 4


class WordCache(dict):
    """Ids, as bytes, of text between two word boundaries, encoded when first met. A generation ends at
    ``most_bytes``; the entries of the one before are kept until they are met again or replaced."""

    def __init__(self, encode: Callable[[str], bytes], most_bytes: int) -> None:
        super().__init__()
        self.encode, self.most_bytes = encode, most_bytes
        self.older: dict[str, bytes] = {}
        self.size = 0

    def __missing__(self, part: str) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            ids = self.encode(part)
        if len(part) < 64:
            if self.size >= self.most_bytes:
                self.older = dict(self)
                self.clear()
                self.size = 0
            self[part] = ids
            self.size += 180 + len(part) + len(ids)
        return ids


class Encoder:
    """Ids of whole texts by the tokenizers library.

    Byte-level pre-tokenisation always ends a piece before a space that follows a character other than white
    space, around a single newline between such characters, and between letters and the
    signs after them. A text's ids are those of its parts between these places, and words recur, so
    parts are encoded once. With any other kind of tokenizer texts are encoded whole.
    """

    def __init__(self, content: str, end_id: int | None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        largest = max(self.tokenizer.get_vocab_size(with_added_tokens=True) - 1, end_id or 0)
        self.dtype = np.dtype("<u2" if largest < 1 << 16 else "<u4")
        self.end = b"" if end_id is None else np.array([end_id], self.dtype).tobytes()
        self.in_parts = _is_byte_level(json.loads(content))
        self.model = self.tokenizer.model
        self.first = WordCache(self._part, _FIRST_BYTES)
        self.rest = WordCache(lambda part: self._part(part, " "), _REST_BYTES)

    def _packed(self, ids: list[int]) -> bytes:
        packed = array("H" if self.dtype.itemsize == 2 else "I", ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _encoded(self, text: str) -> bytes:
        return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _part(self, part: str, lead: str = "") -> bytes:
        if part.isalpha():
            piece = lead + part
            if part.isascii():
                piece = _BYTE_SIGNS[32] + part if lead else part
            else:
                piece = "".join(map(_BYTE_SIGNS.__getitem__, piece.encode()))
            return self._packed([t.id for t in self.model.tokenize(piece)])
        if "\n" in part:
            head, *lines = _LINES.split(part)
            if lines:
                before = self.rest[head] if lead else self.first[head]
                return before + b"".join(map(self.first.__getitem__, lines))
        found = _WORD_AND_SIGNS.fullmatch(part)
        if not found or not found[1].isalpha():
            return self._encoded(lead + part)
        word = self.rest[found[1]] if lead else self.first[found[1]]
        return word + self.first[found[2]]

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return self.end
        if not self.in_parts:
            return self._encoded(text) + self.end
        parts = text.split(" ")
        spaces = _BEFORE_SPACE if text.isascii() else _ANY_BEFORE_SPACE
        # white space before a space, or two spaces: those parts stay together
        if "" in parts or any(c in text for c in spaces):
            parts = _joined(parts)
        return b"".join((self.first[parts[0]], *map(self.rest.__getitem__, parts[1:]), self.end))


def worker_encoder(content: str, end_id: int | None) -> Encoder:
    """The encoder of this Python worker, which Spark reuses: later tasks know the words of earlier ones."""
    held = worker_cache()
    key = f"{hashlib.sha256(content.encode()).hexdigest()}-{end_id}"
    if held.get("key") != key:
        held["key"], held["encoder"] = key, Encoder(content, end_id)
    return held["encoder"]


def _is_byte_level(content: dict) -> bool:
    kind = content.get("pre_tokenizer") or {}
    return (
        kind.get("type") == "ByteLevel"
        and not kind.get("add_prefix_space")
        and kind.get("use_regex", True)
        and not content.get("normalizer")
        and (content.get("model") or {}).get("type", "BPE") == "BPE"
        and not (content.get("model") or {}).get("dropout")
        and not any(t.get("lstrip") or t.get("rstrip") for t in content.get("added_tokens") or ())
    )


def _byte_signs() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


_BYTE_SIGNS = _byte_signs()
_SIGN_BYTES = {sign: b for b, sign in enumerate(_BYTE_SIGNS)}


def byte_of_sign(sign: str) -> int:
    """The byte that a character of a byte-level vocabulary stands for."""
    return _SIGN_BYTES[sign]


# Places around a single newline between other characters than white space.
_LINES = re.compile(r"(?<=\S)(?=\n\S)|(?<=\S\n)(?=\S)")
_WORD_AND_SIGNS = re.compile(r"([^\W\d_]+)([^\w\s']+)")
# white space other than the space itself, before a space
_SPACES = [chr(c) for c in range(0x3001) if chr(c).isspace() and c != 32]
_ANY_BEFORE_SPACE = [c + " " for c in _SPACES]
_BEFORE_SPACE = [c + " " for c in _SPACES if c.isascii()]


def _joined(parts: list[str]) -> list[str]:
    out = [parts[0]]
    for part in parts[1:]:
        last = out[-1]
        if not last or last[-1].isspace():
            out[-1] = f"{last} {part}"
        else:
            out.append(part)
    return out


def tokenizer_file(path: str) -> str:
    """Content of a tokenizer file, to be sent to the tasks (a few MB)."""
    return Path(path).read_text(encoding="utf-8")


_MANIFEST = "file string, part int, number int, records long, ids long, bytes long"


def write_records(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int | None = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    parts: int | None = None,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Encode every text, write the records in ascending id order and return the manifest.

    ``tokenizer`` is the content of a tokenizers file. A NULL or empty text is a sequence of the
    end id alone. Rows of equal id follow each other by their text's hash and then by text; rows repeated in full
    give as many records. A NULL id comes first and is written as the smallest number. Other
    columns are ignored. No rows give an empty manifest.

    Texts are dealt out by ranges of ids and sorted within a task; a task writes one file after the
    other, so its memory does not grow with its share. The manifest has a row per file: ``part`` and
    ``number`` give the order of the files.
    """
    spark = docs.sparkSession
    folder = qualified(spark, folder)
    shared = spark.sparkContext.broadcast(tokenizer)
    schema = pa.schema(
        [("file", pa.string()), ("part", pa.int32()), ("number", pa.int32())]
        + [(n, pa.int64()) for n in ("records", "ids", "bytes")]
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encode, out, number = None, None, 0
        release_memory(keep=True)
        with collector_off():
            for batch in batches:
                encode = encode or worker_encoder(shared.value, end_id)
                width = bytes([encode.dtype.itemsize])
                for key, value in zip(batch.column("id").to_pylist(), batch.column("text")):
                    if out is None:
                        out = _RecordFile(folder, f"{part:06d}-{number:05d}")
                    out.add(struct.pack("<q", key) + width + encode(value.as_py()), encode.dtype.itemsize)
                    if out.size >= file_bytes:
                        yield out.close(part, number, schema)
                        out, number = None, number + 1
        if out is not None:
            yield out.close(part, number, schema)

    rows = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))).alias("id"),
        F.col(text).alias("text"),
    )
    rows = rows.withColumn("hash", F.xxhash64("text"))
    # ranges by id and hash: the driver samples keys, so they hold no text
    ranged = rows.repartitionByRange(parts or tasks(spark), "id", "hash").sortWithinPartitions("id", "hash", "text")
    return written(ranged.select("id", "text").mapInArrow(write, _MANIFEST), "record-manifest")


class _RecordFile:
    def __init__(self, folder: str, name: str) -> None:
        # a name of its own for each attempt: repeated tasks never write the same file
        self.uri = f"{folder}/{name}-{uuid.uuid4().hex[:12]}.records"
        self.store, self.path = _opened(self.uri)
        self.store.create_dir(os.path.dirname(self.path), recursive=True)
        self.stream = self.store.open_output_stream(self.path)
        self.size = self.ids = 0
        self.entries: list[tuple[int, int]] = []

    def add(self, payload: bytes, width: int) -> None:
        n = (len(payload) - 9) // width
        self.entries.append((self.size, n))
        data = frame(payload)
        self.stream.write(data)
        self.size += len(data)
        self.ids += n

    def close(self, part: int, number: int, schema: pa.Schema) -> pa.RecordBatch:
        self.stream.close()
        with self.store.open_output_stream(f"{self.path}.index") as index:
            index.write(np.array(self.entries, _INDEX).tobytes())
        row = (self.uri, part, number, len(self.entries), self.ids, self.size)
        return next(record_batches([row], schema))


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    # Hadoop writes a local file as file:/path
    return fs.FileSystem.from_uri(f"file://{uri[5:]}" if uri.startswith("file:/") and "://" not in uri else uri)


def read_index(uri: str) -> np.ndarray:
    """``offset`` and ``ids`` of each record of a file."""
    store, path = _opened(f"{uri}.index")
    with store.open_input_stream(path) as stream:
        return np.frombuffer(stream.read(), _INDEX)


def read_frames(uri: str, places: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """Id and token ids of the records at the given places of the index, in that order (all, in
    file order, by default). One record is in memory at a time."""
    index = read_index(uri)
    store, path = _opened(uri)
    with store.open_input_file(path) as data:
        end = data.size()
        stops = np.append(index["offset"][1:], np.uint64(end))
        for i in range(len(index)) if places is None else places:
            at = int(index["offset"][i])
            data.seek(at)
            payload, _ = payload_of(data.read(int(stops[i]) - at))
            ids = np.frombuffer(payload, f"<u{payload[8]}", offset=9)
            if len(ids) != index["ids"][i]:
                raise ValueError(f"{uri}: record {i} does not match its index entry")
            yield struct.unpack_from("<q", payload)[0], ids


_READ = "doc_id long, n_tokens long, ids_crc32 long, part int, number int, place long, local long"


def read_records(manifest: DataFrame) -> DataFrame:
    """Every record of the files: ``doc_id``, ``start`` (ids of all records before it), ``n_tokens``
    and ``ids_crc32`` (of the ids as unsigned 32-bit little-endian integers).

    The starts of the files come from the manifest, which has one row per file.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
        + [("part", pa.int32()), ("number", pa.int32()), ("place", pa.int64()), ("local", pa.int64())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for f in batch.to_pylist():
                    local = 0
                    for place, (key, ids) in enumerate(read_frames(f["file"])):
                        crc = zlib.crc32(ids.astype("<u4").tobytes())
                        yield key, len(ids), crc, f["part"], f["number"], place, local
                        local += len(ids)

        yield from record_batches(rows(), schema)

    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    starts = manifest.select(
        "part", "number", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base")
    )
    files = max(1, manifest.count())
    # one task per file, whatever their number
    found = manifest.repartitionByRange(files, "part", "number").mapInArrow(read, _READ)
    null = F.col("doc_id") == F.lit(-(2**63))
    return found.join(starts, ["part", "number"]).select(
        F.when(~null, F.col("doc_id")).alias("doc_id"),
        (F.col("base") + F.col("local")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


def record_folder(spark) -> str:
    return fresh_folder(spark, "records")


def qualified(spark, folder: str) -> str:
    """``folder`` with its scheme: for Spark, a path without one lies on the session's default file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store.makeQualified(path).toString()

"""Delimited text with a declared header and declared types."""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from itertools import zip_longest
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructType

from sievework.errors import SchemaContractError

CORRUPT = "_corrupt_record"


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a file (of the first file of a folder)."""
    return spark.read.option("header", True).csv(path).columns


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: StructType,
    expected_header: Sequence[str] | None = None,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Typed scan; header names and order must be exactly the declared ones.

    The header is probed up front; while scanning, Spark also checks it in every file of a folder
    (``enforceSchema`` off) and fails on the first that differs, instead of shifting values. A value
    its type cannot hold becomes NULL. ``keep_corrupt`` adds the raw text of such lines, and of
    lines with too many or too few fields, as ``_corrupt_record``.
    """
    expected = list(expected_header or schema.names)
    observed = header(spark, path)
    if observed != expected:
        raise SchemaContractError(f"header differs: expected {expected}, got {observed}")
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if keep_corrupt:
        schema = StructType([*schema.fields]).add(CORRUPT, StringType())
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).csv(path)


# Bytes of a file in which its first line has to end.
_HEADER_BYTES = 1 << 20


def header_drift(spark: SparkSession, path: str | list[str], expected: Sequence[str], separator: str = ",") -> DataFrame:
    """``file``, ``position``, ``expected``, ``actual`` for every place at which a file's header is not the expected one.

    Every file below ``path`` counts, one with an empty first line as having no columns; Spark does not list files without a byte. Only the
    first line of each is read, where Spark puts the file's task; files are opened through ``pyarrow.fs``. A header longer
    than 1 MiB stops the job.
    """
    names = list(expected)

    def first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                # Spark names files without escapes
                if path.startswith("file:"):
                    store, name = fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
                else:
                    store, name = fs.FileSystem.from_uri(quote(path, safe=":/@"))
                with store.open_input_stream(name) as stream:
                    start = stream.read(_HEADER_BYTES)
                line = start.splitlines()[0] if start else b""
                if len(line) == _HEADER_BYTES:
                    raise ValueError(f"{path}: no line ends in the first {_HEADER_BYTES} bytes")
                found = next(csv.reader([line.decode("utf-8-sig")], delimiter=separator), [])
                rows = [
                    (i, want, have)
                    for i, (want, have) in enumerate(zip_longest(names, found))
                    if want != have
                ]
                columns = [
                    pa.array([path] * len(rows), pa.string()), pa.array([r[0] for r in rows], pa.int32()),
                    pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["file", "position", "expected", "actual"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    return files.mapInArrow(first_lines, "file string, position int, expected string, actual string")

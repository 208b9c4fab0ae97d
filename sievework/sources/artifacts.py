"""Files as binary artifacts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.operators.ledger import with_fingerprint


# Spark holds a file's content as one value, which ends at 2 GiB; larger files are streamed.
STREAM_ABOVE = (1 << 31) - (1 << 20)
_CHUNK_BYTES = 8 << 20


def scan_artifacts(
    spark: SparkSession, path: str | list[str], glob: str | None = None, stream_above: int = STREAM_ABOVE
) -> DataFrame:
    """``path, sha256, size_bytes`` of every file below ``path``, of any size.

    One row per file and hashed where it is read; Spark does not list files without a byte. Files above ``stream_above`` bytes go through
    SHA-256 in chunks, so a task's memory does not grow with them; that needs a store that ``pyarrow.fs`` can open.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path)
    # a filter on the length keeps the content of the others from being read
    whole = with_fingerprint(files.filter(F.col("length") <= stream_above).select("path", "content"), "content")
    large = files.filter(F.col("length") > stream_above).select("path")
    return whole.unionByName(_streamed(large))


def _streamed(files: DataFrame) -> DataFrame:
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                # Spark names files without escapes
                if path.startswith("file:"):
                    store, name = fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
                else:
                    store, name = fs.FileSystem.from_uri(quote(path, safe=":/@"))
                total, size = hashlib.sha256(), 0
                with store.open_input_stream(name) as stream:
                    while chunk := stream.read(_CHUNK_BYTES):
                        total.update(chunk)
                        size += len(chunk)
                columns = [pa.array([path]), pa.array([total.hexdigest()]), pa.array([size], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["path", "sha256", "size_bytes"])

    return files.mapInArrow(digest, "path string, sha256 string, size_bytes long")


def content_checksum(rows: DataFrame) -> str:
    """SHA-256 of the rows of a table as a multiset, whatever their order and partitioning.

    Each row's own SHA-256 is cut into four numbers, and their sums over all rows are hashed: partial
    sums combine, so there is no limit on the size and no list of digests.
    """
    row = F.sha2(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}), 256)
    parts = [
        F.sum(F.conv(F.substring("h", 16 * i + 1, 16), 16, 10).cast("decimal(28,0)")) for i in range(4)
    ]
    sums = rows.select(row.alias("h")).agg(F.count(F.lit(1)).alias("n"), *parts)
    values = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("0")) for c in sums.columns]
    return sums.select(F.sha2(F.concat_ws("|", *values), 256)).first()[0]


def source_checksum(spark: SparkSession, path: str) -> str:
    """SHA-256 of a file; of a folder, SHA-256 over its file checksums in order.

    Checksums of a folder are combined in two levels: a task of the first holds one 4096th of them,
    64 bytes each. One file is limited to 2 GiB; see :func:`content_checksum` for what is not.
    """
    files = scan_artifacts(spark, path).select("sha256")
    branch = F.sha2(F.array_join(F.array_sort(F.collect_list("sha256")), ""), 256)
    branches = files.groupBy(F.substring("sha256", 1, 3).alias("b")).agg(
        branch.alias("digest"), F.count(F.lit(1)).alias("n"), F.min("sha256").alias("single")
    )
    total = branches.agg(
        F.sum("n").alias("n"),
        F.min("single").alias("single"),
        F.sha2(F.array_join(F.array_sort(F.collect_list("digest")), ""), 256).alias("digest"),
    ).first()
    return total["single"] if total["n"] == 1 else total["digest"]

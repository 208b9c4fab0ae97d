"""Tables, columns and intermediate results shared by the operators."""

from __future__ import annotations

import ctypes
import gc
import hashlib
import sys
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from types import ModuleType
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.session import fresh_folder

# ASCII whitespace separates words, everything else is part of one.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and safe when an executor is lost."""
    folder = fresh_folder(df.sparkSession, name)
    df.write.options(**options).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def aside(df: DataFrame, names: Iterable[str]) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with the columns that bear one of ``names``, in whatever case, under names of their own, and these by the old ones."""
    working = {n.lower() for n in names}
    moved = {c: f"_aside_{i}_{c}" for i, c in enumerate(df.columns) if c.lower() in working}
    return df.withColumnsRenamed(moved), moved


def restored(df: DataFrame, moved: dict[str, str]) -> DataFrame:
    """``df`` with the columns of :func:`aside` under their old names again."""
    return df.withColumnsRenamed({new: old for old, new in moved.items()})


def tasks(spark: SparkSession, times: int = 1) -> int:
    """Partitions (or buckets) of an exchange, in proportion to the session's setting."""
    return max(1, times * int(spark.conf.get("spark.sql.shuffle.partitions")))


def remainder(doc_id: Column | str, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; NULL for a NULL id."""
    value = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(value.cast("string").cast("binary")) % by


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Number of words, 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


@contextmanager
def collector_off() -> Iterator[None]:
    """For tasks with large caches and no reference cycles: Python's collector would walk the caches again and again."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def release_memory(keep: bool = False) -> None:
    """Give memory that earlier tasks have freed back to the system: Spark reuses workers, and a C library keeps
    what it once had. Caches that another operator's tasks have left in this worker go too, unless ``keep``."""
    if not keep:
        worker_cache().clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def worker_cache() -> dict[str, Any]:
    """What lasts in this Python worker from task to task."""
    return sys.modules.setdefault("_sievework_worker", ModuleType("_sievework_worker")).__dict__.setdefault("held", {})


def of_worker(kind: str, content: tuple[bytes | str, ...], make: Callable[[], Any]) -> Any:
    """What ``make`` gave for this content in this Python worker, which Spark reuses: later tasks go on with the caches of earlier
    ones. A worker holds one value of a kind."""
    held = worker_cache()
    digest = hashlib.sha256()
    for part in content:
        digest.update(part.encode() if isinstance(part, str) else part)
    key = digest.hexdigest()
    if held.get(kind, ("",))[0] != key:
        held[kind] = (key, make())
    return held[kind][1]


def as_bytes(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """UTF-8 bytes of a text column."""
    return batch.column(name).cast(pa.binary()).to_pylist()


def record_batches(
    rows: Iterable[tuple], schema: pa.Schema, size: int = 4096, most_bytes: int = 1 << 24
) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded length and bounded binary content."""
    held: list[tuple] = []
    content = 0
    for row in rows:
        held.append(row)
        content += sum(len(v) for v in row if isinstance(v, (bytes, str)))
        if len(held) >= size or content >= most_bytes:
            yield _batch(held, schema)
            held, content = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)

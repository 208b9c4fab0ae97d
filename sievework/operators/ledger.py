"""Landing artifacts: fingerprints, immutable keys and manifests."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.errors import ObjectConflictError
from sievework.functions.keys import LANDING_PREFIX, content_key
from sievework.operators.contracts import ARTIFACT_KINDS, SHA256_PATTERN, at_least, matches, one_of, unknown_fields

NEW, SKIPPED, CONFLICT = "new", "skipped", "conflict"

# Manifest layout, one row per artifact.
MANIFEST_VERSION = 1
MANIFEST_COLUMNS = (
    "manifest_version",
    "run_id",
    "created_at",
    "filter_hash",
    "filter_id",
    "filter_output_id",
    "source_id",
    "source_edition",
    "source_version",
    "kind",
    "source_url",
    "object_key",
    "sha256",
    "size_bytes",
    "content_type",
    "etag",
)


@dataclass(frozen=True)
class LandingRun:
    """Identity of one landing run."""

    run_id: str
    created_at: str
    filter_id: str
    filter_output_id: str
    source_id: str
    source_edition: str
    source_version: int
    filter_hash: str


def with_fingerprint(df: DataFrame, content: str) -> DataFrame:
    """Replace the content column by ``sha256`` and ``size_bytes`` (bytes, not characters)."""
    return df.withColumns(
        {
            "sha256": F.sha2(F.col(content).cast("binary"), 256),
            "size_bytes": F.octet_length(F.col(content)).cast("long"),
        }
    ).drop(content)


def with_object_key(
    df: DataFrame,
    dataset_id: Column,
    edition: Column,
    version: Column,
    filter_hash: Column,
    prefix: str = LANDING_PREFIX,
) -> DataFrame:
    """Add the content-addressed ``object_key`` from ``kind`` and ``sha256``."""
    key = content_key(
        dataset_id, edition, version, filter_hash, F.col("kind"), F.col("sha256"), prefix
    )
    return df.withColumn("object_key", key)


def classify_artifacts(
    incoming: DataFrame, ledger: DataFrame, key: str = "object_key", checksum: str = "sha256"
) -> DataFrame:
    """One row per incoming key with ``state``: new, skipped (same content) or conflict.

    Copies of a key are aggregated first (map-side), so the join with the ledger, which holds each
    key once, has one row per key on both sides. Two contents for one key within the batch conflict
    as well. Of equal copies the smallest remaining values are kept.
    """
    rest = [c for c in incoming.columns if c not in (key, checksum)]
    kept = F.struct(F.lit(0).alias("_"), *rest)
    batch = incoming.groupBy(key).agg(
        F.min(checksum).alias(checksum),
        F.max(checksum).alias("_other"),
        F.min(kept).alias("_kept"),
    )
    known = ledger.select(F.col(key), F.col(checksum).alias("_known"))
    agrees = F.col(checksum).eqNullSafe(F.col("_other"))
    state = (
        F.when(~agrees, CONFLICT)
        .when(F.col("_known").isNull(), NEW)
        .when(F.col("_known") == F.col(checksum), SKIPPED)
        .otherwise(CONFLICT)
    )
    return batch.join(known, key, "left").select(
        key, checksum, *[F.col(f"_kept.{c}").alias(c) for c in rest], state.alias("state")
    )


def new_artifacts(classified: DataFrame) -> DataFrame:
    """Rows to append to the ledger."""
    return classified.filter(F.col("state") == NEW).drop("state")


def conflicting_artifacts(classified: DataFrame) -> DataFrame:
    """Keys whose content would have changed."""
    return classified.filter(F.col("state") == CONFLICT).drop("state")


def append_to_ledger(
    incoming: DataFrame, ledger: DataFrame, path: str, key: str = "object_key"
) -> None:
    """Append new keys to the Parquet ledger at ``path``; refuse the batch if any key conflicts.

    Repeating a batch adds nothing, because its keys are then known. ``incoming`` is read twice and
    should be saved if it is costly.
    """
    classified = classify_artifacts(incoming, ledger, key)
    example = conflicting_artifacts(classified).select(key).first()
    if example:
        raise ObjectConflictError(f"key already contains different content: {example[0]}")
    new_artifacts(classified).select(*ledger.columns).write.mode("append").parquet(path)


def build_manifest(artifacts: DataFrame, run: LandingRun) -> DataFrame:
    """Manifest table: the run's identity on each artifact row.

    ``artifacts`` has kind, source_url, object_key, sha256, size_bytes, content_type and etag. One
    row per artifact instead of one document with a list keeps a large run out of a single row.
    """
    identity = {
        "manifest_version": F.lit(MANIFEST_VERSION),
        "run_id": F.lit(run.run_id),
        "created_at": F.to_timestamp(F.lit(run.created_at)),
        "filter_hash": F.lit(run.filter_hash),
        "filter_id": F.lit(run.filter_id),
        "filter_output_id": F.lit(run.filter_output_id),
        "source_id": F.lit(run.source_id),
        "source_edition": F.lit(run.source_edition),
        "source_version": F.lit(run.source_version),
    }
    return artifacts.withColumns(identity).select(*MANIFEST_COLUMNS)


def manifest_constraints() -> dict[str, Column]:
    """Row constraints of a manifest."""
    required: Sequence[str] = ("run_id", "filter_id", "filter_output_id", "object_key")
    return {
        "manifest_version_is_known": one_of("manifest_version", [MANIFEST_VERSION]),
        "source_version_is_positive": at_least("source_version", 1),
        "filter_hash_is_sha256": matches("filter_hash", SHA256_PATTERN),
        "sha256_is_sha256": matches("sha256", SHA256_PATTERN),
        "size_bytes_is_not_negative": at_least("size_bytes", 0),
        "kind_is_known": one_of("kind", ARTIFACT_KINDS),
        "source_url_is_http": matches("source_url", "^https?://[^/]+"),
        **{f"{name}_is_present": F.col(name).isNotNull() for name in required},
    }


# The fields that a manifest document, its source and its artifacts may have.
MANIFEST_FIELDS = (
    "manifest_version", "run_id", "created_at", "filter_hash", "filter_id", "filter_output_id", "source", "artifacts",
)
SOURCE_FIELDS = ("id", "edition", "version")
ARTIFACT_FIELDS = ("kind", "source_url", "object_key", "sha256", "size_bytes", "content_type", "etag")


def unknown_manifest_fields(docs: DataFrame, doc_id: str, content: str) -> DataFrame:
    """``doc_id``, ``part`` (manifest, source, or artifact and its place), ``field`` of every field that a manifest document must not have.

    Row-local. A part that is missing or no object has no fields here; that it must be there is for the constraints to say.
    """
    text = F.col(content)
    artifacts = F.coalesce(
        F.from_json(text, "artifacts array<string>")["artifacts"], F.array().cast("array<string>")
    )

    def unknown(part: Column, document: Column, allowed: Sequence[str]) -> Column:
        extra = F.coalesce(unknown_fields(document, allowed), F.array().cast("array<string>"))
        return F.transform(extra, lambda f: F.struct(part.alias("part"), f.alias("field")))

    parts = [
        unknown(F.lit("manifest"), text, MANIFEST_FIELDS),
        unknown(F.lit("source"), F.get_json_object(text, "$.source"), SOURCE_FIELDS),
        F.flatten(
            F.transform(artifacts, lambda a, i: unknown(F.concat(F.lit("artifact "), i.cast("string")), a, ARTIFACT_FIELDS))
        ),
    ]
    return docs.select(doc_id, F.inline(F.concat(*parts)))

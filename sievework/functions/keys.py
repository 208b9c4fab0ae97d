"""Surrogate keys, row fingerprints and content addresses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hashes only agree with published ones when these texts do.
FINGERPRINT_SEPARATOR = "||"
FINGERPRINT_NULL = "<null>"
COMPOSITE_SEPARATOR = "|"
CONTENT_KEY_FORMAT = "%s/%s/edition=%s/version=%d/filter=%s/%s/%s"
LANDING_PREFIX = "landing/ons"


def surrogate_key(code: str) -> Column:
    """md5 of a natural code; NULL stays NULL."""
    return F.md5(F.col(code).cast("string"))


def composite_key(parts: Sequence[str], separator: str = COMPOSITE_SEPARATOR) -> Column:
    """md5 of the joined parts; NULL as soon as one part is NULL."""
    texts: list[Column] = []
    for part in parts:
        texts += [F.lit(separator), F.col(part).cast("string")]
    return F.md5(F.concat(*texts[1:]))


def row_fingerprint(columns: Sequence[str]) -> Column:
    """SHA-256 over the columns in order, NULL written as a visible token.

    Floating-point columns should be cast to a decimal or integer first: their text form is an
    engine detail. That of timestamps follows the session time zone.
    """
    texts = [F.coalesce(F.col(c).cast("string"), F.lit(FINGERPRINT_NULL)) for c in columns]
    return F.sha2(F.concat_ws(FINGERPRINT_SEPARATOR, *texts), 256)


def strict_fingerprint(columns: Sequence[str]) -> Column:
    """Like :func:`row_fingerprint`, but each value carries its length.

    The plain form cannot tell ``('a||b', 'c')`` from ``('a', 'b||c')``; this one can.
    """
    texts = [F.col(c).cast("string") for c in columns]
    return F.sha2(
        F.concat(*[F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("-")) for t in texts]),
        256,
    )


def content_key(
    dataset_id: Column,
    edition: Column,
    version: Column,
    filter_hash: Column,
    kind: Column,
    checksum: Column,
    prefix: str = LANDING_PREFIX,
) -> Column:
    """Readable, content-addressed landing key; NULL when any part is NULL."""
    parts = [dataset_id, edition, version.cast("int"), filter_hash, kind, checksum]
    # format_string would print a NULL as the word "null"
    complete = ~F.array_contains(F.array(*[p.isNull() for p in parts]), True)
    return F.when(complete, F.format_string(CONTENT_KEY_FORMAT, F.lit(prefix), *parts))

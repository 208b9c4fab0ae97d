"""Extract definitions: JSON documents that say which extract was asked for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.canonical import canonical_hash
from sievework.operators.contracts import constraint_violations

# The fields a definition may have.
FIELDS = ("dataset", "population_type", "dimensions")
DATASET_FIELDS = ("id", "edition", "version")


def _kind(document: Column, path: str) -> Column:
    """JSON type at a path; NULL where there is nothing."""
    return F.schema_of_variant(F.try_variant_get(document, path, "variant"))


def _is_object(document: Column) -> Column:
    return F.coalesce(F.schema_of_variant(document).startswith("OBJECT"), F.lit(False))


def _only(document: Column, allowed: tuple[str, ...]) -> Column:
    known = F.array(*map(F.lit, allowed))
    return F.size(F.array_except(F.json_object_keys(document), known)) == 0


def definition_violations(docs: DataFrame, doc_id: str, content: str) -> DataFrame:
    """``(doc_id, rule)`` for every rule a definition breaks; row-local."""
    text = F.col(content)
    # a column of its own, so that each document is parsed once and not once per rule
    docs = docs.withColumn("_parsed", F.try_parse_json(text))
    parsed = F.col("_parsed")
    dimensions = F.try_variant_get(parsed, "$.dimensions", "array<variant>")
    version = F.try_variant_get(parsed, "$.dataset.version", "bigint")
    return constraint_violations(
        docs,
        [doc_id],
        {
            "no_unknown_field": _only(text, FIELDS),
            "no_unknown_dataset_field": _only(F.get_json_object(text, "$.dataset"), DATASET_FIELDS),
            "dataset_id_is_text": _kind(parsed, "$.dataset.id") == "STRING",
            "edition_is_text": _kind(parsed, "$.dataset.edition") == "STRING",
            "version_is_positive": (_kind(parsed, "$.dataset.version") == "BIGINT")
            & (version >= 1),
            "population_type_is_text": _kind(parsed, "$.population_type") == "STRING",
            "dimensions_are_objects": F.forall(dimensions, _is_object),
        },
    )


def definition_identity(docs: DataFrame, content: str) -> DataFrame:
    """Add the definition's ``filter_hash`` and its dataset's id, edition and version."""
    text = F.col(content)
    return docs.withColumns(
        {
            "filter_hash": canonical_hash(text),
            "source_id": F.get_json_object(text, "$.dataset.id"),
            "source_edition": F.get_json_object(text, "$.dataset.edition"),
            "source_version": F.get_json_object(text, "$.dataset.version").cast("int"),
        }
    )

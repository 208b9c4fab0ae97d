"""Run identity and row fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.functions.keys import row_fingerprint

# Names, order and types of the provenance columns.
COLUMNS = {
    "dataset_id": "string",
    "edition": "string",
    "version": "int",
    "source_checksum": "string",
    "pipeline_run_id": "string",
    "source_record_hash": "string",
    "loaded_at": "timestamp",
}
PROVENANCE = tuple(COLUMNS)
_OF_THE_ROW = "source_record_hash"


class RunMetadata:
    """What every row of one run carries: a value for each provenance column but the row's own.

    All have to be given, the time of loading too, so that nothing is stamped by accident and
    reruns agree.
    """

    def __init__(self, *values: object, **named: object) -> None:
        names = [name for name in PROVENANCE if name != _OF_THE_ROW]
        given = dict(zip(names, values)) | named
        if len(values) > len(names) or len(given) != len(values) + len(named) or set(given) != set(names):
            raise TypeError(f"a run needs exactly {names}, got {sorted(given)}")
        self.values = {name: given[name] for name in names}

    def __getattr__(self, name: str) -> object:
        try:
            return self.__dict__["values"][name]
        except KeyError:
            raise AttributeError(name) from None

    def __eq__(self, other: object) -> bool:
        return isinstance(other, RunMetadata) and self.values == other.values

    def __hash__(self) -> int:
        return hash(tuple(self.values.values()))


def with_provenance(df: DataFrame, run: RunMetadata, hash_columns: Sequence[str]) -> DataFrame:
    """Append the provenance columns; the fingerprint covers ``hash_columns`` in that order."""
    stamp = {name: F.lit(value).cast(COLUMNS[name]) for name, value in run.values.items()}
    stamp[_OF_THE_ROW] = row_fingerprint(hash_columns)
    return df.select("*", *[stamp[name].alias(name) for name in PROVENANCE])

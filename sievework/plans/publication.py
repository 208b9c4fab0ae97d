"""Run ledger: which run publishes which dataset version, one at a time."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievework.errors import AlreadyPublishedError, CommitConflictError
from sievework.sinks.commits import CommitLog

CLAIMED, PUBLISHED, ABANDONED = "claimed", "published", "abandoned"
_SCHEMA = "dataset_id string, edition string, version int, run_id string, state string, checksum string, n_rows long"


@dataclass(frozen=True)
class Claim:
    """The right of a run to publish a version."""

    dataset_id: str
    edition: str
    version: int
    run_id: str
    checksum: str


class RunLedger:
    """Commits that say who claims, has published or has given up a dataset version.

    A run claims a version before it writes and publishes it afterwards. Each step is a numbered commit, so two runs never both
    get a version: the one whose number is taken looks again and finds the other's claim.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.log = CommitLog(spark, path)

    def history(self) -> DataFrame:
        """All steps, with their ``number``."""
        return self.log.table(_SCHEMA)

    def current(self) -> DataFrame:
        """The last step of every version."""
        latest = Window.partitionBy("dataset_id", "edition", "version").orderBy(F.desc("number"))
        return self.history().withColumn("_r", F.row_number().over(latest)).filter("_r = 1").drop("_r")

    def _last(self, dataset_id: str, edition: str, version: int):
        found = self.history().filter(
            (F.col("dataset_id") == dataset_id) & (F.col("edition") == edition) & (F.col("version") == version)
        )
        return found.orderBy(F.desc("number")).first()

    def claim(
        self, dataset_id: str, edition: str, version: int, run_id: str, checksum: str, attempts: int = 10
    ) -> Claim | None:
        """The claim, or None if the version is already published with this checksum (a repeated run).

        Raises AlreadyPublishedError if another run holds the version, or has published it with other content.
        A run that claims again what it holds goes on from there.
        """
        mine = Claim(dataset_id, edition, version, run_id, checksum)
        for _ in range(attempts):
            number = self.log.latest() + 1  # before the look: what comes in between is noticed by the commit
            last = self._last(dataset_id, edition, version)
            if last and last["state"] == PUBLISHED:
                if last["checksum"] == checksum:
                    return None
                raise AlreadyPublishedError(f"{dataset_id} {edition} version {version} is published by {last['run_id']}")
            if last and last["state"] == CLAIMED:
                if last["run_id"] == run_id and last["checksum"] == checksum:
                    return mine
                raise AlreadyPublishedError(f"{dataset_id} {edition} version {version} is claimed by {last['run_id']}")
            try:
                self._put(number, mine, CLAIMED, None)
                return mine
            except CommitConflictError:
                continue  # another run was faster; perhaps with another version
        raise CommitConflictError(f"no commit after {attempts} attempts")

    def publish(self, claim: Claim, n_rows: int, attempts: int = 10) -> None:
        """Mark a claimed version as published; raises AlreadyPublishedError if the claim was given up meanwhile."""
        self._advance(claim, PUBLISHED, n_rows, attempts)

    def abandon(self, claim: Claim, attempts: int = 10) -> None:
        """Give up a claim, one's own or that of a run known to be dead, so that another run may claim the version."""
        self._advance(claim, ABANDONED, None, attempts)

    def _advance(self, claim: Claim, state: str, n_rows: int | None, attempts: int) -> None:
        for _ in range(attempts):
            number = self.log.latest() + 1
            last = self._last(claim.dataset_id, claim.edition, claim.version)
            if not last or last["state"] != CLAIMED or last["run_id"] != claim.run_id:
                raise AlreadyPublishedError(f"{claim.run_id} no longer holds {claim.edition} version {claim.version}")
            try:
                return self._put(number, claim, state, n_rows)
            except CommitConflictError:
                continue
        raise CommitConflictError(f"no commit after {attempts} attempts")

    def _put(self, number: int, claim: Claim, state: str, n_rows: int | None) -> None:
        self.log.put(number, {**claim.__dict__, "state": state, "n_rows": n_rows})

"""Numbered commits: a file per commit, put in place by a rename that never replaces.

A commit is written under a name of its own first and then renamed to its number. The rename fails if the number is
taken, so of two runs that saw the same state one is refused, and what a run leaves when it dies before
its rename is no commit. The store has to rename atomically (HDFS does).
"""

from __future__ import annotations

import json
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from sievework.errors import CommitConflictError

NONE = -1  # the number before the first commit
_COMMIT = re.compile(r"^([0-9]{20})\.json$")


class CommitLog:
    """The commits below ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._folder = self._hadoop_path(self.path)
        self._store = self._folder.getFileSystem(self._conf)
        self._folder = self._store.makeQualified(self._folder)

    def _hadoop_path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def file_of(self, number: int) -> str:
        return f"{self.path}/{number:020d}.json"

    def numbers(self) -> list[int]:
        """Numbers of all commits, ascending."""
        if not self._store.exists(self._folder):
            return []
        names = (str(status.getPath().getName()) for status in self._store.listStatus(self._folder))
        return sorted(int(found[1]) for found in map(_COMMIT.match, names) if found)

    def latest(self) -> int:
        """Number of the last commit, or :data:`NONE`."""
        return max(self.numbers(), default=NONE)

    def read(self, number: int) -> dict:
        """Content of a commit."""
        stream = self._store.open(self._hadoop_path(self.file_of(number)))
        try:
            return json.loads(bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def put(self, number: int, content: dict) -> None:
        """Commit ``content`` under ``number``; raises CommitConflictError if the number is taken."""
        if number in self.numbers():
            raise CommitConflictError(f"commit {number} exists in {self.path}")
        temporary = self._hadoop_path(f"{self.path}/.{number:020d}-{uuid.uuid4().hex}")
        stream = self._store.create(temporary, False)
        try:
            stream.write(bytearray(json.dumps(content, sort_keys=True).encode()))
        finally:
            stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._folder.toUri(), self._conf)
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        target = self._store.makeQualified(self._hadoop_path(self.file_of(number)))
        try:
            context.rename(self._store.makeQualified(temporary), target, options)
        except Py4JJavaError as error:
            self._store.delete(temporary, False)
            if "FileAlreadyExists" in str(error):
                raise CommitConflictError(f"commit {number} exists in {self.path}") from error
            raise

    def remove(self, folder: str) -> None:
        """Delete a folder of the same store, if it is there."""
        self._store.delete(self._hadoop_path(folder), True)

    def table(self, schema: str) -> DataFrame:
        """All commits as rows: ``number`` and the given fields."""
        numbers = self.numbers()
        if not numbers:
            return self.spark.createDataFrame([], f"number long, {schema}")
        found = self.spark.read.schema(schema).json([self.file_of(n) for n in numbers])
        number = r"regexp_extract(_metadata.file_name, '^([0-9]+)', 1)"
        return found.selectExpr(f"cast({number} as long) as number", "*")

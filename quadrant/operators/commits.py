"""Run state as a log of numbered commits.

Each commit is one small JSON file that holds the whole state, so the newest one is
enough to read. A commit is made only if its number is still free (compare and swap):
of two runs that started from the same state one wins, and the other is told. Files
older than the last few are removed, so listing and reading cost the same after a
thousand runs as after one.

`publish` ties results to a commit: they are written to a folder of the attempt, the
commit names that folder, and only then it is renamed to its place. A run that dies
before the commit leaves nothing that counts; one that dies after it is completed by
the next (`recover`), which repeats a rename and nothing else.
"""

from __future__ import annotations

import json
import os
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession


class CommitConflict(RuntimeError):
    """Another run has made this commit."""


class CommitLog:
    KEPT = 10

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._at(self.path).getFileSystem(self._conf)

    def _at(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _numbers(self) -> list[int]:
        if not self._fs.exists(self._at(self.path)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._at(self.path))]
        foreign = [n for n in names if not n.startswith((".", "_")) and not n.removesuffix(".json").isdigit()]
        if foreign:
            raise ValueError(f"{self.path} is no commit log: {foreign[0]}")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] not in "._")

    def _name(self, number: int) -> str:
        return f"{self.path}/{number:012d}.json"

    def latest(self) -> tuple[int, dict[str, Any]]:
        """Number and state of the newest commit; (-1, {}) before the first."""
        numbers = self._numbers()
        if not numbers:
            return -1, {}
        stream = self._fs.open(self._at(self._name(numbers[-1])))
        try:
            raw = bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()
        return numbers[-1], json.loads(raw)

    def commit(self, number: int, state: dict[str, Any]) -> None:
        """Make commit `number`, or raise CommitConflict if it is there. The file appears
        whole: it is written under a hidden name and gets its own by an operation that
        fails where the name is taken."""
        numbers = self._numbers()
        if numbers and number <= numbers[-1]:
            raise CommitConflict(f"commit {number} of {self.path} is there")
        target = self._name(number)
        hidden = f"{self.path}/.{uuid.uuid4().hex}"
        stream = self._fs.create(self._at(hidden), False)
        stream.write(bytearray(json.dumps(state).encode()))
        stream.close()
        try:
            if self._fs.getScheme() == "file":
                os.link(*(self._jvm.java.net.URI(self._fs.makeQualified(self._at(x)).toString()).getPath() for x in (hidden, target)))
            else:  # fails if the target exists
                context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at(target).toUri(), self._conf)
                none = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
                context.rename(self._at(hidden), self._at(target), none)
        except Exception as e:
            if isinstance(e, FileExistsError) or self._fs.exists(self._at(target)):
                raise CommitConflict(f"commit {number} of {self.path} is there") from e
            raise
        finally:
            self._fs.delete(self._at(hidden), False)
        for old in numbers[:-self.KEPT]:
            self._fs.delete(self._at(self._name(old)), False)

    # ------------------------------------------------------------ results with a commit
    def recover(self) -> tuple[int, dict[str, Any]]:
        """The newest commit, with its results in their place."""
        number, state = self.latest()
        if state.get("attempt"):
            self._promote(state["attempt"], state["place"])
        return number, state

    def _promote(self, attempt: str, place: str) -> None:
        source, target = self._at(attempt), self._at(place)
        if not self._fs.exists(source):
            return  # done before
        self._fs.delete(target, True)
        self._fs.mkdirs(target.getParent())
        if not self._fs.rename(source, target) and self._fs.exists(source):
            raise OSError(f"can't rename {attempt} to {place}")

    def attempt_path(self) -> str:
        return f"{self.path}.attempts/{uuid.uuid4().hex}"

    def discard(self, attempt: str) -> None:
        self._fs.delete(self._at(attempt), True)

    def publish(self, number: int, state: dict[str, Any], attempt: str, place: str) -> None:
        """Commit a state whose results lie in `attempt`, and put them in place; on a
        conflict the attempt is removed and the conflict raised."""
        try:
            self.commit(number, {**state, "attempt": attempt, "place": place})
        except CommitConflict:
            self.discard(attempt)
            raise
        self._promote(attempt, place)


def write_attempt(df: DataFrame, log: CommitLog, *partitions: str) -> str:
    path = log.attempt_path()
    df.write.partitionBy(*partitions).parquet(path)
    return path

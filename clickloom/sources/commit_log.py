"""A commit log: numbered versions of a small state, each a file that appears whole or not at all.

Tables keep their data in folders with names of their own and say in the state which of them count.
So a folder that was half written, or half copied by a store without atomic renames, is never read,
and a reader sees the version it has found, not a mix of two.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import SparkSession

from clickloom.sources import storage


class Conflict(RuntimeError):
    """Another writer has committed this version."""


@dataclass(frozen=True)
class CommitLog:
    path: str
    # Versions that stay for readers that have listed them.
    keep: int = 20

    @staticmethod
    def _name(version: int) -> str:
        return f"v{version:015d}"

    def latest(self, spark: SparkSession) -> tuple[int, dict]:
        """The newest version and its state; -1 and nothing if there is none."""
        names = storage.child_files(spark, self.path)
        if not names:
            return -1, {}
        return int(names[-1][1:]), json.loads(storage.read_text(spark, f"{self.path}/{names[-1]}"))

    def commit(self, spark: SparkSession, version: int, state: dict) -> None:
        """Add the version after the one that ``state`` was made from."""
        if not storage.put_new(spark, f"{self.path}/{self._name(version)}", json.dumps(state)):
            raise Conflict(f"{self.path} has a version {version} by another writer")
        if version >= self.keep:
            storage.remove(spark, f"{self.path}/{self._name(version - self.keep)}")

"""Tables whose groups are replaced as a whole while others read them.

The rows of a day are in one folder, and the commit log says for each day which folder that is.
Replacing groups writes the days they are in anew, beside the old ones, and commits all of them at
once: a reader has the old state or the new one, never a mix.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from clickloom.sources import storage
from clickloom.streaming.batch_log import KEEP_SECONDS, drop_retired, refuse_others, sweep
from clickloom.sources.commit_log import CommitLog


@dataclass(frozen=True)
class Published:
    path: str
    schema: StructType
    # Columns of a group; the first one is the day.
    groups: tuple[str, ...]
    keep_seconds: int = KEEP_SECONDS

    @property
    def _log(self) -> CommitLog:
        return CommitLog(f"{self.path}/_commits")

    def _state(self, spark: SparkSession) -> tuple[int, dict]:
        version, state = self._log.latest(spark)
        return version, {"last": -1, "owner": None, "days": {}, "retired": [], "note": None} | state

    def create(self, spark: SparkSession) -> Published:
        storage.make_dir(spark, self.path)
        return self

    def note(self, spark: SparkSession) -> object:
        """What the last batch has noted about how the rows were made."""
        return self._state(spark)[1]["note"]

    def replace(self, rows: DataFrame, batch_id: int, note: object = None) -> bool:
        """Replace the groups that ``rows`` has rows of, once; false if the batch is a replay."""
        spark, day = rows.sparkSession, self.groups[0]
        version, state = self._state(spark)
        state["owner"] = refuse_others(spark, self.path, state["owner"])
        if batch_id <= state["last"]:
            return False
        run = f"run={uuid.uuid4().hex}"
        folder = f"{self.path}/{run}"

        def write(part: DataFrame) -> None:
            (part.select(self.schema.names).hint("rebalance", day)
             .write.mode("append").partitionBy(day).parquet(folder))

        write(rows)
        days = [d.split("=", 1)[1] for d in storage.child_dirs(spark, folder)]
        # The other groups of these days go along.
        if known := [d for d in days if d in state["days"]]:
            fresh = (spark.read.schema(self.schema).parquet(folder)
                     .select(*self.groups).distinct())
            write(self._of(spark, state, known).join(fresh, list(self.groups), "left_anti"))
        at = {**state["days"], **dict.fromkeys(days, run)}
        unused = set(state["days"].values()) - set(at.values())
        self._log.commit(spark, version + 1, state | {
            "last": batch_id, "days": at, "note": note,
            "retired": [*drop_retired(spark, self.path, state["retired"], self.keep_seconds),
                        *([r, time.time()] for r in sorted(unused))]})
        return True

    def sweep(self, spark: SparkSession, keep_seconds: int = KEEP_SECONDS) -> list[str]:
        """Upkeep: remove what batches have written that were killed before their commit."""
        folders = storage.child_dirs(spark, self.path)
        state = self._state(spark)[1]
        named = set(state["days"].values()) | {folder for folder, _ in state["retired"]}
        return sweep(spark, self.path, folders, named, keep_seconds)

    def _of(self, spark: SparkSession, state: dict, days: Iterable[str] | None) -> DataFrame:
        wanted = state["days"] if days is None else set(days) & set(state["days"])
        folders = [f"{self.path}/{state['days'][d]}/{self.groups[0]}={d}" for d in sorted(wanted)]
        if not folders:
            return spark.createDataFrame([], self.schema)
        return (spark.read.schema(self.schema).option("basePath", self.path).parquet(*folders)
                .select(self.schema.names))

    def read(self, spark: SparkSession, days: Iterable[str] | None = None) -> DataFrame:
        """The newest published rows, all or of some days."""
        return self._of(spark, self._state(spark)[1], days)

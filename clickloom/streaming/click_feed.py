"""The admitted clicks, between the admission query and the queries that count them.

A batch of the admission is a folder of Parquet files and, once that is whole, an entry: one small
file that names it, in the folder of the day it arrived on. Entries are what the other queries
stream, so they never see half a batch, and what they list is the days that are open.

A day that is over and that every reader is sure to have done with is closed: its clicks are written
once more, as one folder of larger files, the manifest names it, and its entries go. A reader is sure
of an entry once a later batch of its own has begun, as its checkpoint has then committed the one
before. So a restart at any point finds the entries it still needs, and none twice.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from clickloom import schemas
from clickloom.sources import storage
from clickloom.streaming.batch_log import KEEP_SECONDS, drop_retired, refuse_others, sweep
from clickloom.sources.commit_log import CommitLog

OPEN = "open"


def utc_day() -> dt.date:
    return dt.datetime.now(dt.timezone.utc).date()


def read_entries(texts: Iterable[str]) -> list[dict]:
    return [json.loads(text) for text in texts]


@dataclass(frozen=True)
class ReaderProgress:
    """How many entries of each day a reader has done with."""

    path: str

    def done(self, spark: SparkSession, batch_id: int, days: Iterable[str]) -> None:
        """The entries of a batch are done; those of the batch before are surely done."""
        log = CommitLog(self.path)
        version, state = log.latest(spark)
        last, sure, new = (state.get(k, v) for k, v in (("last", -1), ("sure", {}), ("new", {})))
        if batch_id > last:
            log.commit(spark, version + 1, {"last": batch_id, "sure": Counter(sure) + Counter(new),
                                            "new": Counter(days)})

    def sure(self, spark: SparkSession) -> dict[str, int]:
        return CommitLog(self.path).latest(spark)[1].get("sure", {})


@dataclass(frozen=True)
class ClickFeed:
    path: str
    keep_seconds: int = KEEP_SECONDS

    @property
    def _manifest(self) -> CommitLog:
        return CommitLog(f"{self.path}/_commits")

    def _state(self, spark: SparkSession) -> tuple[int, dict]:
        version, state = self._manifest.latest(spark)
        return version, {"last": -1, "owner": None, "days": {}, "retired": []} | state

    def create(self, spark: SparkSession) -> ClickFeed:
        storage.make_dir(spark, f"{self.path}/{OPEN}")
        return self

    def open_days(self, spark: SparkSession) -> list[str]:
        return [d.split("=", 1)[1] for d in storage.child_dirs(spark, f"{self.path}/{OPEN}")]

    def append(self, clicks: DataFrame, batch_id: int, today: dt.date) -> bool:
        """Store a batch of admitted clicks, once, among those that arrive ``today``."""
        spark = clicks.sparkSession
        version, state = self._state(spark)
        owner = refuse_others(spark, self.path, state["owner"])
        if owner != state["owner"]:
            self._manifest.commit(spark, version + 1, state | {"owner": owner})
        name = f"{batch_id:015d}"
        if batch_id <= state["last"] or any(
                storage.exists(spark, f"{self.path}/{OPEN}/day={day}/{name}")
                for day in self.open_days(spark)):
            return False
        folder = f"data/day={today}/batch_id={batch_id}/run={uuid.uuid4().hex}"
        clicks.select(schemas.AD_CLICKS.names).write.parquet(f"{self.path}/{folder}")
        storage.make_dir(spark, f"{self.path}/{OPEN}/day={today}")
        storage.put_new(spark, f"{self.path}/{OPEN}/day={today}/{name}", json.dumps(
            {"batch": batch_id, "day": str(today), "folder": folder}))
        return True

    def stream(self, spark: SparkSession, entries_per_trigger: int | None = None) -> DataFrame:
        """The entries as a stream of JSON lines."""
        reader = (spark.readStream.format("text").schema("value string")
                  .option("recursiveFileLookup", "true"))
        if entries_per_trigger:
            reader = reader.option("maxFilesPerTrigger", entries_per_trigger)
        return reader.load(f"{self.path}/{OPEN}")

    def clicks(self, spark: SparkSession, entries: list[dict]) -> DataFrame:
        """The clicks that entries name."""
        return self._read(spark, [e["folder"] for e in entries])

    def _read(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        if not folders:
            return spark.createDataFrame([], schemas.AD_CLICKS)
        return spark.read.schema(schemas.AD_CLICKS).parquet(*(f"{self.path}/{f}" for f in folders))

    def entries(self, spark: SparkSession, days: list[str]) -> list[dict]:
        """The entries of open days; there is one for each batch of these days."""
        folders = [f"{self.path}/{OPEN}/day={day}" for day in days]
        texts = spark.read.text(folders).collect() if folders else []
        return read_entries(row["value"] for row in texts)

    def rows(self, spark: SparkSession) -> DataFrame:
        """All admitted clicks, of closed and open days."""
        # Open days first: a day that is closed in between is then in both, not in neither.
        open_entries = self.entries(spark, self.open_days(spark))
        closed = self._state(spark)[1]["days"]
        return self._read(spark, [*closed.values(), *(e["folder"] for e in open_entries
                                                      if e["day"] not in closed)])

    def sweep(self, spark: SparkSession, keep_seconds: int = KEEP_SECONDS) -> list[str]:
        """Upkeep: remove what batches have written that were killed before their entry."""
        folders = [f"{parent}/{run}" for day in self._children(spark, "data")
                   for parent in self._children(spark, day)
                   for run in storage.child_dirs(spark, f"{self.path}/{parent}")]
        folders += [f"{day}/{run}" for day in self._children(spark, "closed")
                    for run in storage.child_dirs(spark, f"{self.path}/{day}")]
        entries = self.entries(spark, self.open_days(spark))
        state = self._state(spark)[1]
        retired = tuple(f"{folder}/" for folder, _ in state["retired"])
        named = {e["folder"] for e in entries} | set(state["days"].values())
        named |= {folder for folder in folders if retired and folder.startswith(retired)}
        return sweep(spark, self.path, folders, named, keep_seconds)

    def _children(self, spark: SparkSession, folder: str) -> list[str]:
        if not storage.exists(spark, f"{self.path}/{folder}"):
            return []
        return [f"{folder}/{name}" for name in storage.child_dirs(spark, f"{self.path}/{folder}")]

    def close_days(self, spark: SparkSession, readers: list[ReaderProgress],
                   today: dt.date) -> list[str]:
        """Close the days before ``today`` that all readers are sure of; returns them.

        For the admission query, which alone writes here.
        """
        over = [day for day in self.open_days(spark) if day < str(today)]
        if not over:
            return []
        version, state = self._state(spark)
        done = [reader.sure(spark) for reader in readers]
        closed = []
        for day in over:
            entries = self.entries(spark, [day])
            if day not in state["days"]:
                if any(sure.get(day, 0) < len(entries) for sure in done):
                    continue
                folder = f"closed/day={day}/run={uuid.uuid4().hex}"
                (self.clicks(spark, entries).hint("rebalance")
                 .write.parquet(f"{self.path}/{folder}"))
                state |= {"days": {**state["days"], day: folder},
                          "last": max([state["last"], *(e["batch"] for e in entries)]),
                          "retired": [*drop_retired(spark, self.path, state["retired"],
                                                    self.keep_seconds),
                                      [f"data/day={day}", time.time()]]}
                version += 1
                self._manifest.commit(spark, version, state)
            # Also after a failure between the commit and this.
            storage.remove(spark, f"{self.path}/{OPEN}/day={day}")
            closed.append(day)
        return closed

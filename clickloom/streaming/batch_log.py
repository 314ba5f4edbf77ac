"""Result tables of ``foreachBatch`` queries, kept as runs of rows behind a commit log.

A micro-batch writes what it changed into a folder of its own, a run, and commits it; a batch that
is replayed after a failure finds itself committed and leaves the table as it is. Readers ask the
log which runs count. Before a batch is added, runs are merged level by level: ``fan`` runs of one
level become one of the next, with their rows resolved. So after n batches a key is in
O(fan * log n) runs, and every row has been rewritten O(log n) times. The views at the end resolve
the runs to the current rows.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from clickloom.sources import storage
from clickloom.sources.commit_log import CommitLog

BATCH = "batch_id"
# Replaced folders stay so long, for readers that have begun with them.
KEEP_SECONDS = 3600


def refuse_others(spark: SparkSession, path: str, owner: str | None) -> str | None:
    """The owner of a table from now on; an error if the running query is another one.

    Batch numbers come from a checkpoint, so only the query that has it may add batches. A query
    with a new checkpoint counts from 0 again; its batches would be taken for replays of those that
    are here, and be lost.
    """
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if owner and query and owner != query:
        raise RuntimeError(f"{path} belongs to a query with another checkpoint")
    return owner or query


def drop_retired(spark: SparkSession, path: str, retired: list, keep_seconds: int) -> list:
    """Removes replaced folders that are old enough; returns the others. ``[folder, time]`` each."""
    now = time.time()
    for folder, since in retired:
        if now - since > keep_seconds:
            storage.remove(spark, f"{path}/{folder}")
            if "/" in folder:
                storage.remove_if_empty(spark, f"{path}/{folder.rsplit('/', 1)[0]}")
    return [[folder, since] for folder, since in retired if now - since <= keep_seconds]


def sweep(spark: SparkSession, path: str, folders: Iterable[str], named: set[str],
          keep_seconds: int) -> list[str]:
    """Removes folders that no commit names and that nobody has written to for a while."""
    swept = [folder for folder in folders if folder not in named
             and storage.seconds_unchanged(spark, f"{path}/{folder}") > keep_seconds]
    for folder in swept:
        storage.remove(spark, f"{path}/{folder}")
        if "/" in folder:
            storage.remove_if_empty(spark, f"{path}/{folder.rsplit('/', 1)[0]}")
    return swept


def due(levels: list[int], fan: int) -> int | None:
    """The lowest level that has ``fan`` runs."""
    return min((level for level in set(levels) if levels.count(level) >= fan), default=None)


@dataclass(frozen=True)
class BatchLog:
    path: str
    schema: StructType
    # The day column, if days are folders within a run, so that readers can leave days out.
    by: tuple[str, ...] = ()
    # Makes the rows of several runs (with ``batch_id``) those of one; without it runs stay apart.
    resolve: Callable[[DataFrame], DataFrame] | None = None
    fan: int = 8
    keep_seconds: int = KEEP_SECONDS

    @property
    def _log(self) -> CommitLog:
        return CommitLog(f"{self.path}/_commits")

    def _state(self, spark: SparkSession) -> tuple[int, dict]:
        version, state = self._log.latest(spark)
        return version, {"last": -1, "owner": None, "runs": [], "retired": [],
                         "note": None} | state

    def create(self, spark: SparkSession) -> BatchLog:
        storage.make_dir(spark, self.path)
        return self

    def append(self, rows: DataFrame, batch_id: int, keep_empty: bool = True,
               note: object = None) -> bool:
        """Add the rows of a batch, once; false if it is a replay.

        ``note`` says how the rows were made, for the batches to come.
        """
        spark = rows.sparkSession
        version, state = self._state(spark)
        state["owner"] = refuse_others(spark, self.path, state["owner"])
        if batch_id <= state["last"]:
            return False
        version, state = self._merged(spark, version, state)
        run, n = self._write(rows, batch_id, 0)
        if n or keep_empty:
            self._log.commit(spark, version + 1, state | {
                "last": batch_id, "runs": [*state["runs"], run], "note": note,
                "retired": drop_retired(spark, self.path, state["retired"], self.keep_seconds)})
        else:
            storage.remove(spark, f"{self.path}/{run['folder']}")
        return True

    def note(self, spark: SparkSession) -> object:
        """The note of the last batch."""
        return self._state(spark)[1]["note"]

    def _write(self, rows: DataFrame, batch_id: int, level: int) -> tuple[dict, int]:
        """A run that nobody reads yet, and how many rows it has."""
        folder = f"{BATCH}={batch_id}/run={uuid.uuid4().hex}"
        rows, written = rows.select(self.schema.names), Observation()
        if self.by:
            # Files cost time, so a day goes to one task unless it is large, and many days to many.
            rows = rows.hint("rebalance", rows.sparkSession.sparkContext.defaultParallelism,
                             *self.by)
        writer = rows.observe(written, F.count(F.lit(1)).alias("rows")).write
        (writer.partitionBy(*self.by) if self.by else writer).parquet(f"{self.path}/{folder}")
        days = [d.split("=", 1)[1] for d in storage.child_dirs(rows.sparkSession,
                                                               f"{self.path}/{folder}")]
        return ({"folder": folder, "level": level, "last": batch_id, "days": days},
                written.get["rows"])

    def _merged(self, spark: SparkSession, version: int, state: dict) -> tuple[int, dict]:
        """The state after all merges that are due; each is a version of its own."""
        while self.resolve and (level := due([r["level"] for r in state["runs"]],
                                             self.fan)) is not None:
            old = [r for r in state["runs"] if r["level"] == level]
            rows = self.resolve(self._of(spark, old))
            run, _ = self._write(rows, max(r["last"] for r in old), level + 1)
            version, state = version + 1, state | {
                "runs": [*(r for r in state["runs"] if r["level"] != level), run],
                "retired": [*state["retired"], *([r["folder"], time.time()] for r in old)]}
            self._log.commit(spark, version, state)
        return version, state

    def sweep(self, spark: SparkSession, keep_seconds: int = KEEP_SECONDS) -> list[str]:
        """Upkeep: remove what batches have written that were killed before their commit."""
        folders = [f"{batch}/{run}" for batch in storage.child_dirs(spark, self.path)
                   for run in storage.child_dirs(spark, f"{self.path}/{batch}")]
        # Listed first: a run that is committed in between is then named.
        state = self._state(spark)[1]
        named = {r["folder"] for r in state["runs"]} | {folder for folder, _ in state["retired"]}
        return sweep(spark, self.path, folders, named, keep_seconds)

    def start_with(self, rows: DataFrame, batch_id: int, owner: str | None) -> None:
        """The first run of a new table, with batches up to one that another table has had."""
        version, state = self._state(rows.sparkSession)
        run, _ = self._write(rows, batch_id, 0)
        self._log.commit(rows.sparkSession, version + 1,
                         state | {"last": batch_id, "owner": owner, "runs": [run]})

    def owner(self, spark: SparkSession) -> str | None:
        return self._state(spark)[1]["owner"]

    def last_batch(self, spark: SparkSession) -> int | None:
        """The highest number of a batch; none if there is no batch."""
        last = self._state(spark)[1]["last"]
        return last if last >= 0 else None

    def _of(self, spark: SparkSession, runs: list[dict],
            days: Iterable[str] | None = None) -> DataFrame:
        schema = StructType([*self.schema.fields, StructField(BATCH, LongType())])
        folders = [f"{self.path}/{r['folder']}" for r in runs]
        if days is not None:
            wanted = set(days)
            folders = [f"{folder}/{self.by[0]}={d}" for folder, r in zip(folders, runs)
                       for d in r["days"] if d in wanted]
        if not folders:
            return spark.createDataFrame([], schema)
        return (spark.read.schema(schema).option("basePath", self.path).parquet(*folders)
                .select(schema.names))

    def read(self, spark: SparkSession, days: Iterable[str] | None = None) -> DataFrame:
        """All runs, with the number of their last batch in ``batch_id``; of some days if given.

        Only the folders of these days are listed.
        """
        return self._of(spark, self._state(spark)[1]["runs"], days)

    def rows(self, spark: SparkSession) -> DataFrame:
        """The current rows: all of them, resolved if the table says how."""
        held = self.read(spark)
        return (self.resolve(held) if self.resolve else held).select(self.schema.names)

    def _runs_of(self, spark: SparkSession, batch_id: int) -> list[dict]:
        return [r for r in self._state(spark)[1]["runs"]
                if r["last"] == batch_id and r["level"] == 0]

    def batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The rows that the last batch added; none if it added nothing."""
        return self._of(spark, self._runs_of(spark, batch_id)).select(self.schema.names)

    def days_of(self, spark: SparkSession, batch_id: int) -> list[str]:
        """The days that the last batch has rows of."""
        return sorted({d for r in self._runs_of(spark, batch_id) for d in r["days"]})


def current_sum(log: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows of an adding table: each batch holds increments."""
    return log.groupBy(keys).agg(F.sum(value).alias(value))


def current_last(log: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows of a replacing table: the newest batch that names a key has its value."""
    return log.groupBy(keys).agg(F.max_by(value, BATCH).alias(value))


def adding(path: str, schema: StructType, keys: list[str], value: str, by: tuple[str, ...] = (),
           **settings) -> BatchLog:
    """A table whose batches hold increments."""
    return BatchLog(path, schema, by, lambda log: current_sum(log, keys, value), **settings)


def replacing(path: str, schema: StructType, keys: list[str], value: str,
              by: tuple[str, ...] = (), **settings) -> BatchLog:
    """A table whose batches hold new values."""
    return BatchLog(path, schema, by, lambda log: current_last(log, keys, value), **settings)


def insert_new(rows: DataFrame, log: BatchLog, keys: list[str], batch_id: int) -> None:
    """Add the rows whose keys no earlier batch has added."""
    earlier = log.read(rows.sparkSession).where(F.col(BATCH) < batch_id).select(keys)
    fresh = rows.dropDuplicates(keys).join(earlier, keys, "left_anti")
    log.append(fresh, batch_id, keep_empty=False)


def compact(log: BatchLog, resolved: DataFrame, target: BatchLog,
            last_batch: int | None) -> None:
    """Maintenance: start a new table with the current rows of an old one.

    Run it between two runs of a query and go on with ``target``; batch numbers keep rising, as
    they come from the query's checkpoint. The query that adds batches stays the same.
    """
    spark = resolved.sparkSession
    target.create(spark)
    if last_batch is not None:
        days = [c for c in target.by if c in resolved.columns]
        target.start_with(resolved.hint("rebalance", *days) if days else resolved, last_batch,
                          log.owner(spark))

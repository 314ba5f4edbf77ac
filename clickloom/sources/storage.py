"""Shared-folder helpers: where staged tables go, and the few file-system calls they need."""

from __future__ import annotations

import contextlib
import tempfile
import time
import uuid
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession

_local_dirs: dict[str, str] = {}
# Folders of the scopes that are open, the innermost last.
_scopes: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    A local-mode session that has none (a test, a notebook) gets a temporary one. On a cluster a
    machine-local folder would not be readable by the other machines, so there it is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="clickloom-")
    return _local_dirs[context.applicationId]


def new_run_dir(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/clickloom/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Several results that share an expensive input then read a columnar table, each only the
    columns it needs, and a lost executor costs a re-read instead of a recomputation.
    """
    folder = new_run_dir(df.sparkSession, "staged")
    if _scopes:
        _scopes[-1].append(folder)
    path = f"{folder}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_counted(df: DataFrame, name: str, *counts: Column) -> tuple[DataFrame, DataFrame]:
    """Like :func:`materialize`, with aggregates of the rows as a second table of one row.

    They are observed while the rows are written, so the rows are not read again for them. Every
    partition is written, and counted, by one successful task, also if others failed before.
    """
    seen = Observation()
    stored = materialize(df.observe(seen, *counts), name)
    # Where Spark finds out on the way that there are no rows, nothing may be observed.
    row = seen.get or stored.agg(*counts).first().asDict()
    schema = stored.agg(*counts).schema
    return stored, df.sparkSession.createDataFrame([tuple(row[c] for c in schema.names)], schema)


@contextlib.contextmanager
def staged_until_done(spark: SparkSession) -> Iterator[None]:
    """Removes, at the end, what :func:`materialize` has written inside.

    Results that read it must be stored by then.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for folder in _scopes.pop():
            remove(spark, folder)


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _path(spark, path)
    return fs.exists(hadoop_path)


def make_dir(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _path(spark, path)
    fs.mkdirs(hadoop_path)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, source_path = _path(spark, source)
    _, target_path = _path(spark, target)
    if not fs.rename(source_path, target_path):
        raise OSError(f"cannot rename {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds; nothing happens if there is none."""
    fs, hadoop_path = _path(spark, path)
    fs.delete(hadoop_path, True)


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file, whole or not at all; false if there already is one of this name.

    It is written under a hidden name and renamed without replacing: nobody reads half of it, and
    of two writers one gets false. The rename of one file is atomic on HDFS, and on an object store
    its target appears at once, whole.
    """
    context = spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs
    fs, target = _path(spark, path)
    target = fs.makeQualified(target)
    hidden = hadoop.Path(target.getParent(), f".{target.getName()}-{uuid.uuid4().hex}")
    stream = fs.create(hidden, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    files = hadoop.FileContext.getFileContext(
        target.toUri(), context._jsc.hadoopConfiguration())
    rename = getattr(hadoop, "Options$Rename")
    options = context._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        files.rename(hidden, target, options)
    except Py4JJavaError:
        fs.delete(hidden, False)
        if not fs.exists(target):
            raise
        return False
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    fs, hadoop_path = _path(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def child_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the visible files directly below ``path``, sorted; none if there is no folder."""
    fs, hadoop_path = _path(spark, path)
    if not fs.exists(hadoop_path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isFile()]
    return sorted(name for name in names if not name.startswith(("_", ".")))


def remove_if_empty(spark: SparkSession, path: str) -> None:
    """Delete a folder that holds nothing."""
    fs, hadoop_path = _path(spark, path)
    if fs.exists(hadoop_path) and not fs.listStatus(hadoop_path):
        fs.delete(hadoop_path, False)


def seconds_unchanged(spark: SparkSession, path: str) -> float:
    """How long ago a folder was last added to, by the file system's clock and this machine's."""
    fs, hadoop_path = _path(spark, path)
    return time.time() - fs.getFileStatus(hadoop_path).getModificationTime() / 1000


def child_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the visible folders directly below ``path``, sorted."""
    fs, hadoop_path = _path(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isDirectory()]
    return sorted(name for name in names if not name.startswith(("_", ".")))

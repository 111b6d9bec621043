"""Durable intermediate tables.

A job that reads one intermediate result several times, or that needs a result to be
*the same* each time it is read, writes it once to the shared folder the cluster names in
``spark.checkpoint.dir``. Losing an executor then costs a re-read, not a recomputation.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Whether Spark deletes a query's shuffle files as soon as the query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_dir: str | None = None
_staged: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    global _local_dir
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="ledgerlens-")
        atexit.register(shutil.rmtree, _local_dir, ignore_errors=True)
    return _local_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return a DataFrame that reads it back."""
    path = scratch_path(df.sparkSession, name)
    _staged.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def lean(spark: SparkSession) -> Iterator[None]:
    """Of queries that are made and run inside, Spark deletes what they have shuffled as soon as they end."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


class Scratch:
    """The intermediate tables of one job, in a folder of their own, so that each can go as soon as nothing reads it."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = scratch_path(spark, name)
        self._count = 0
        self._paths: dict[str, str] = {}
        _staged.append(self.folder)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return a DataFrame that reads it back."""
        self._count += 1
        path = self._paths[name] = f"{self.folder}/{self._count}-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep_lean(self, df: DataFrame, name: str) -> DataFrame:
        """``keep``, after which Spark deletes what the write has shuffled. ``df`` should be written only here: a second
        action on it would shuffle again."""
        with lean(self.spark):
            return self.keep(df, name)

    def drop(self, *names: str) -> None:
        """Delete tables by the names they were last kept under."""
        for name in names:
            delete(self.spark, self._paths.pop(name))


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a finished write."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(jvm_path)


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies directly in a folder; none if it is not there. Hidden names are left out."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(jvm_path)] if fs.exists(jvm_path) else []
    return sorted(n for n in names if not n.startswith((".", "_")))


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).open(jvm_path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that appears whole or not at all; a name that is taken is an error."""
    folder, _, name = path.rpartition("/")
    target, hidden = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{folder}/_{name}.{uuid.uuid4().hex}"))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = fs.create(hidden)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    if fs.exists(target) or not fs.rename(hidden, target):
        fs.delete(hidden, False)
        raise FileExistsError(path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder, if it is there."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def release(spark: SparkSession) -> int:
    """Delete the intermediate tables this process has written; returns how many there were.

    Results that still read them must have been written or collected before.
    """
    count = len(_staged)
    while _staged:
        delete(spark, _staged.pop())
    return count

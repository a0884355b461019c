"""Intermediate results that outlive lost executors."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

#: Folders of the open scopes, the innermost last.
_scopes: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the session (``spark.checkpoint.dir``).

    Where the session names none, one is made for a local master only: a folder of
    one machine is not seen by the executors of a cluster.
    """
    named = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_dir()


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="basketloom-")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, inside the scope that is open, if any."""
    return f"{_scopes[-1] if _scopes else shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str) -> tuple:
    """The file system of a path, whichever Spark knows it is, and a maker of its paths."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder; nothing happens where there is none."""
    files, make = _file_system(spark, path)
    files.delete(make(path), True)


def publish(spark: SparkSession, made: str, target: str) -> None:
    """Let the folders in ``made`` take the places of those of the same names in ``target``.

    By renaming only: the older ones are set aside, and come back if one cannot be
    renamed. Both are in one file system, which should not copy what it renames.
    """
    files, make = _file_system(spark, target)
    aside = f"{target}/replaced-{uuid.uuid4().hex}"
    files.mkdirs(make(aside))
    moved: list[tuple[str, str]] = []

    def move(source: str, goal: str) -> None:
        if not files.rename(make(source), make(goal)):
            raise OSError(f"{source} cannot be renamed to {goal}")
        moved.append((source, goal))

    try:
        for entry in files.listStatus(make(made)):
            name = entry.getPath().getName()
            if files.exists(make(f"{target}/{name}")):
                move(f"{target}/{name}", f"{aside}/{name}")
            move(f"{made}/{name}", f"{target}/{name}")
    except BaseException:
        for source, goal in reversed(moved):
            files.rename(make(goal), make(source))
        raise
    finally:
        files.delete(make(aside), True)


@contextlib.contextmanager
def scope(spark: SparkSession) -> Iterator[str]:
    """Everything made durable inside is deleted at the end, after an error too.

    For jobs that write their results: what they return must not read the
    intermediate tables any more.
    """
    path = fresh_path(spark, "scope")
    _scopes.append(path)
    try:
        yield path
    finally:
        _scopes.remove(path)
        delete(spark, path)


def durable(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` computed once, as a Parquet table in the shared folder, without its lineage.

    For what several jobs or iterations read: neither they nor a lost executor
    repeat the joins behind it, and each reads only the columns it uses.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

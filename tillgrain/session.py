"""Session defaults and the shared folder for written intermediate tables."""

from __future__ import annotations

import contextlib
import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tillgrain", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution and UTC timestamps; `conf` overrides."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tillgrain-")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: `spark.checkpoint.dir`.

    Only a local session may go without it; there a temporary folder is made.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        folder = _local_folder()
    return os.path.join(folder, "tillgrain", spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return os.path.join(shared_folder(spark), f"{label}-{uuid.uuid4().hex[:12]}")


class Scratch:
    """Stored tables that go when their work is done; `keep` stores a result that stays."""

    def __init__(self):
        self.paths: list[str] = []

    def keep(self, df: DataFrame, label: str = "result") -> DataFrame:
        """Store `df` for the surrounding scope."""
        at = _scopes.open.index(self)
        inner, _scopes.open[at:] = _scopes.open[at:], []
        try:
            return materialize(df, label)
        finally:
            _scopes.open.extend(inner)

    def drop(self, *tables: DataFrame) -> None:
        """Delete stored tables of this scope that nothing reads any more."""
        gone = {f for t in tables for f in t.inputFiles()}
        for path in [p for p in self.paths if any(p in f for f in gone)]:
            delete_path(tables[0].sparkSession, path)
            self.paths.remove(path)


class _Scopes(threading.local):
    """Open scopes of a thread, the innermost last."""

    def __init__(self):
        self.open: list[Scratch] = []


_scopes = _Scopes()


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """What `materialize` stores inside is deleted at the end.

    A result has to be stored by `keep` before, since Spark reads tables only when they are asked for.
    """
    scope = Scratch()
    _scopes.open.append(scope)
    try:
        yield scope
    finally:
        _scopes.open.remove(scope)
        for path in scope.paths:
            delete_path(spark, path)


@contextlib.contextmanager
def session_setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting that holds inside, and is as it was afterwards."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a stored table wherever it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Cuts the lineage in a way that outlives lost executors, and gives the
    optimizer the true size of the table for its join choice.  Inside `scratch` the table
    is deleted with its scope.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if _scopes.open:
        _scopes.open[-1].paths.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

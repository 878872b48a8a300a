"""Session helpers: a local session for tests and benches, the checkpoint folder and temporary data in it."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JError
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "starload") -> SparkSession:
    """A local session configured as the tests and the bench expect (UI off, AQE on, UTC)."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("STARLOAD_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def job_session(master: str | None = None, app: str = "starload") -> SparkSession:
    """A session for loads: the cluster's own settings, and its master unless one is named."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    builder = builder.config("spark.sql.session.timeZone", "UTC")
    return (builder.master(master) if master else builder).getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, reading ``spark.checkpoint.dir`` from the session.

    On a cluster the folder is the shared one the cluster names; a cluster session
    that names none is an error (a machine-local folder would not survive the loss
    of that machine). Only a local-mode session without one (tests) gets a private
    scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder for reliable checkpoints")
        named = tempfile.mkdtemp(prefix="starload-ckpt-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir() or named


# ---- temporary data ----------------------------------------------------------------------------

def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any file system Spark can write; a missing one is no error."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jvm.org.apache.hadoop.conf.Configuration()
                        if spark._jsc.sc().isStopped() else spark._jsc.hadoopConfiguration()).delete(where, True)


class Scratch:
    """Temporary paths below the shared checkpoint folder, and the deletion of all of them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def path(self, name: str) -> str:
        return self.own(f"{ensure_checkpoint_dir(self.spark)}/{name}-{uuid.uuid4().hex}")

    def own(self, path: str) -> str:
        """Delete ``path``, too, when this scope ends."""
        self.paths.append(path)
        return path

    def remove(self) -> None:
        while self.paths:
            remove_path(self.spark, self.paths.pop())


_scopes: list[Scratch] = []  # the open ones, the innermost last; the first is the application's own


def scratch(spark: SparkSession) -> Scratch:
    """The innermost open scope of temporary data; outside of all, the application's own, removed at its exit."""
    if not _scopes:
        _scopes.append(Scratch(spark))
    _scopes[-1].spark = spark  # the session at hand: an earlier one may have been stopped
    return _scopes[-1]


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[Scratch]:
    """Temporary data made inside is deleted at the end: results must be written or collected by then."""
    scratch(spark)
    scope = Scratch(spark)
    _scopes.append(scope)
    try:
        yield scope
    finally:
        _scopes.remove(scope)
        scope.remove()


def written(df: DataFrame, name: str = "rows") -> DataFrame:
    """``df`` written once as Parquet in the scratch folder and read again, so that the planner knows its size."""
    path = scratch(df.sparkSession).path(name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` computed once for every frame built on it inside, kept on the executors' disks with its partitioning.

    What is returned from inside must not read ``df`` any more: it would be computed again.
    """
    df.persist(StorageLevel.DISK_ONLY)
    try:
        df.count()  # now: only a plan that has run tells its partitioning to the joins planned on it
        yield df
    finally:
        df.unpersist()


@atexit.register
def _remove_all() -> None:
    try:
        for scope in _scopes:
            scope.remove()
    except (Py4JError, OSError):
        pass  # the JVM went first: nothing more can be deleted through it

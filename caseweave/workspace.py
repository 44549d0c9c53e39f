"""Intermediate tables written to the shared folder of the cluster.

A written table cuts the lineage, survives lost executors, and comes back with
column pruning and real size statistics, which the join planner needs to decide
between broadcast and shuffle.

Written tables stay, as lazy results read them. Within a ``Scope`` they are recorded and go
when it is closed, once its results are written.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_open: ContextVar[Scope | None] = ContextVar("scope", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session; in local mode without one, a folder below the
    warehouse."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/caseweave-work"


def file_system(spark: SparkSession, path: str):
    """(file system, path) as Spark's own readers and writers see them."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


class Scope:
    """The folders of the tables written while it is in use."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folders: list[str] = []

    @contextmanager
    def use(self):
        """Record what is written here; scopes nest, the innermost one records."""
        token = _open.set(self)
        try:
            yield self
        finally:
            _open.reset(token)

    def close(self) -> None:
        """Remove the recorded folders; nothing may read them any more."""
        while self.folders:
            files, place = file_system(self.spark, self.folders.pop())
            files.delete(place, True)


@contextmanager
def scope(spark: SparkSession):
    """A scope that is closed at the end, whether or not the work in it succeeded."""
    own = Scope(spark)
    try:
        with own.use():
            yield own
    finally:
        own.close()


def new_folder(spark: SparkSession, name: str) -> str:
    """A place in the shared folder that nothing else uses."""
    folder = f"{shared_folder(spark).rstrip('/')}/caseweave/{uuid.uuid4().hex}"
    if recording := _open.get():
        recording.folders.append(folder)
    return f"{folder}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return a scan of it."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Shared staging of tables that several sheets read."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


def shared_folder(spark: SparkSession, folder: str | None = None) -> str:
    """Folder every executor can reach: ``folder``, or that of :func:`scratch`, or else ``spark.checkpoint.dir`` of the session."""
    folder = folder or _SCRATCH.get() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("give a folder shared by all executors, or set spark.checkpoint.dir to one")
    return folder.rstrip("/")


def remove(spark: SparkSession, folder: str) -> None:
    """Remove a folder, if it is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path)


def _is_empty(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.exists(path) and len(fs.listStatus(path)) == 0


#: Setting under which Spark removes the shuffle files of an execution when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is executed inside of the ``with`` leaves no shuffle files behind.

    Otherwise they stay until the driver collects their plan as garbage, so that the disk fills with the shuffles of all that a query
    wrote. For results that are written once: a plan that is executed again shuffles again.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


class Staging:
    """Tables written once under the shared folder, and removed together or, where they are done with, one by one."""

    def __init__(self, spark: SparkSession, folder: str | None = None) -> None:
        self._spark = spark
        self._root = f"{shared_folder(spark, folder)}/sheetloom-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self._root}/{name}"

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as parquet and read it back.

        Later reads are columnar, take only the columns a sheet needs, and survive the loss of executors. The shuffles it took are
        removed with the write.
        """
        with passing_shuffles(self._spark):
            df.write.option("compression", "zstd").parquet(self.path(name))
        return self._spark.read.parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Remove what stands at :meth:`path` of ``name``; nothing may read it any more."""
        remove(self._spark, self.path(name))

    def release(self) -> None:
        """Remove the staged tables."""
        remove(self._spark, self._root)


#: Setting of a session that parts of the library lower for the work at hand.
_LENT = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def scratch(spark: SparkSession, folder: str | None = None) -> Iterator[str]:
    """A folder of its own for all that is staged and checkpointed inside of the ``with``, removed at its end.

    Also after a failure, and settings that were changed meanwhile are put back. Results have to be used, or written
    somewhere else, before it ends::

        with scratch(spark):
            queries()["analyte_sheet"](spark, folder).write.parquet(target)
    """
    sc, lent = spark.sparkContext, spark.conf.get(_LENT)
    own = f"{shared_folder(spark, folder)}/scratch-{uuid.uuid4().hex}"
    held, token = sc.getCheckpointDir(), _SCRATCH.set(own)
    sc.setCheckpointDir(own)
    try:
        yield own
    finally:
        _SCRATCH.reset(token)
        spark.conf.set(_LENT, lent)
        if held is not None:
            sc.setCheckpointDir(held.rpartition("/")[0])  # Spark adds a name of its own to what it is given
            if _is_empty(spark, held):
                remove(spark, held)
        remove(spark, own)


class Sheets(dict):
    """Sheets by name, in order. They read staged tables until :meth:`release` is called.

    ``parts`` tells where their rows go in the output, see :func:`sheetloom.sources.sinks.block_parts`.
    """

    def __init__(self, sheets: Mapping[str, DataFrame], staging: Staging | None = None, parts: DataFrame | None = None) -> None:
        super().__init__(sheets)
        self._staging = staging
        self.parts = parts

    def release(self) -> None:
        if self._staging is not None:
            self._staging.release()

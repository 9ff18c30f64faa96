"""Session settings and the shared folder for cut lineage."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("caseflow")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CASEFLOW_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


# Folders of sessions that name none, by application.
_LOCAL_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.

    A cluster names a folder that every executor sees. Only a local master, where all
    tasks share one machine, may fall back to a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="caseflow-checkpoint-")
    return _LOCAL_ROOTS[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{checkpoint_root(spark).rstrip('/')}/caseflow/{name}-{uuid.uuid4().hex}"


_SCOPE: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what ``materialize`` wrote inside it: for work whose result is written elsewhere by then."""
    token = _SCOPE.set([])
    try:
        yield
    finally:
        context = spark.sparkContext
        for path in _SCOPE.get():
            place = context._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
        _SCOPE.reset(token)


def materialize(df: DataFrame, name: str, by: tuple[str, ...] = (), codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder, in a folder for each value of ``by``, and read it back.

    This cuts the lineage: a lost executor re-reads the table and computes nothing
    again. It also makes a result that is read more than once cost one job.
    """
    path = scratch_path(df.sparkSession, name)
    if (written := _SCOPE.get()) is not None:
        written.append(path)
    df.write.partitionBy(*by).parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)

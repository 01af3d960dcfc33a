"""Session settings and reliable materialisation."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join input even when that costs one more exchange above it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles methods above 8,000 bytes; such stages run faster as separate operators.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings every plan in this package assumes."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; scratch space only in local mode."""
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if shared is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="salesmart-checkpoint-"))
        shared = context.getCheckpointDir()
    return shared


_SCOPE: ContextVar[str | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A scope that owns what ``materialise`` writes inside it and removes it at the end, also after a failure.

    Jobs that end in a write run in one; frames derived from its tables are of no use afterwards.
    """
    from .sources import storage

    folder = f"{shared_dir(spark)}/salesmart-job-{uuid.uuid4().hex}"
    token = _SCOPE.set(folder)
    try:
        yield folder
    finally:
        _SCOPE.reset(token)
        storage.remove(spark, folder)


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and continue from the written copy.

    Used where a result is read several times or where row positions must not
    change if an executor is lost and tasks are run again. Unlike a cached copy
    it survives lost executors, is pruned by column, and its size is known to
    the optimiser. Inside ``scratch`` the copy is removed with its scope; queries
    that return a frame leave theirs to the owner of the shared folder.
    """
    path = f"{_SCOPE.get() or shared_dir(df.sparkSession)}/salesmart-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

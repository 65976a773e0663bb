"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every plan here assumes. ANSI mode stays on: dirty text is handled by try_* casts.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Let AQE split a hot join key even when a later step would have reused the partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str = "stowage", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings above; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and shared tables: the cluster's ``spark.checkpoint.dir``.

    Only where none is named, and only in local mode (tests, laptops), is a temporary folder used.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("name a folder all executors share in spark.checkpoint.dir")
        folder = tempfile.mkdtemp(prefix="stowage-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


_SHARED: dict[str, list[str]] = {}
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries run inside give their shuffle files back when they end, not when the driver next collects garbage."""
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEAN_UP) if before is None else spark.conf.set(CLEAN_UP, before)


def share(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    Used for tables that several reports read. The files outlive any executor, and their size is
    known to the optimizer when it chooses join strategies. ``clear_shared`` removes them. A table costs the disk its
    own files only: the shuffles that made it are removed as soon as it is written.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    _SHARED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_shared(spark: SparkSession) -> int:
    """Remove the tables that ``share`` wrote in this application, once nothing reads them any more; their number."""
    paths = _SHARED.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return len(paths)

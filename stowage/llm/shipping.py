"""The package's own sources on executors that don't have it installed, and the size of what goes to Python."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()
BATCH_BYTES = 4 << 20  # of rows handed to a Python worker at once
BATCH, DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def ship(spark: SparkSession) -> None:
    """Hand the package to Spark as a Python file, once per application; Spark brings it to every executor.

    Rows go to Python in batches of ``BATCH_BYTES`` unless the session says how large they may be, because texts of a
    fixed number of rows can be of any size.
    """
    context = spark.sparkContext
    if spark.conf.get(BATCH) == DEFAULT:
        spark.conf.set(BATCH, str(BATCH_BYTES))
    if context.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="stowage-"), "stowage.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(os.path.join(top, "stowage")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, top))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def let_go() -> None:
    """Give the memory that a task no longer uses back to the system; workers live on for other tasks."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass

"""Snapshots of intermediate and final tables, whole or month by month."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_snapshot(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Write ``df`` in parallel, replacing what was there; partition by month for later pruning."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def _files(spark: SparkSession, path: str):
    """The folder's file system and its Hadoop path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, at = _files(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


class MonthlySnapshot:
    """A table kept by month, of which a run replaces the months it brings and no others.

    A run writes its months under a name of its own, then a manifest that says for every month which run holds it.
    Only a finished manifest counts, so a run that is killed changes nothing that readers see; what it left, and what
    no kept manifest names any more, ``clean`` removes. Manifests have a row per month and are read by the driver.
    One run at a time may write.
    """

    def __init__(self, spark: SparkSession, path: str, month: str = "month"):
        self.spark, self.path, self.month = spark, path.rstrip("/"), month

    def _finished(self) -> list[str]:
        """Manifests by number, the newest last; Spark's marker tells which are whole."""
        found = _names(self.spark, f"{self.path}/manifests")
        return [n for n in found if "_SUCCESS" in _names(self.spark, f"{self.path}/manifests/{n}")]

    def versions(self, manifest: str | None = None) -> dict[str, str]:
        """The run that holds each month (as text), by the newest manifest or a named one."""
        finished = self._finished()
        if not finished:
            return {}
        rows = self.spark.read.schema("month string, run string").parquet(f"{self.path}/manifests/{manifest or finished[-1]}")
        return {r["month"]: r["run"] for r in rows.collect()}

    def write(self, df: DataFrame, months: Iterable[str] = ()) -> None:
        """Replace the months that ``df`` has rows of, and those named in ``months`` even if it has none.

        Months are dates' texts (``2024-01-01``) or whatever the column's values are as text; rows without a month are refused.
        """
        run = uuid.uuid4().hex
        place = f"{self.path}/runs/{run}"
        key = F.col(self.month).cast("string")
        stop = F.raise_error(F.lit("a row has no month")).cast("string")
        keyed = df.withColumn("_month", F.coalesce(key, stop))
        keyed.repartition("_month", F.pmod(F.xxhash64(*df.columns), F.lit(8))).write.partitionBy("_month").parquet(place)
        schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema)}, _month string"
        brought = [r["_month"] for r in self.spark.read.schema(schema).parquet(place).select("_month").distinct().collect()]
        held = {m: r for m, r in self.versions().items() if m not in set(months)} | dict.fromkeys(brought, run)
        number = int((self._finished() or ["0"])[-1].split("-")[0]) + 1
        rows = self.spark.createDataFrame(sorted(held.items()), "month string, run string")
        rows.coalesce(1).write.parquet(f"{self.path}/manifests/{number:010d}-{run}")

    def read(self, schema: str | None = None, manifest: str | None = None) -> DataFrame:
        """The table as the newest manifest has it, or an older one; ``schema`` where nothing was ever written."""
        by_run: dict[str, list[str]] = {}
        for month, run in self.versions(manifest).items():
            by_run.setdefault(run, []).append(month)
        parts = [self.spark.read.parquet(f"{self.path}/runs/{run}").filter(F.col("_month").isin(own)).drop("_month") for run, own in by_run.items()]
        if not parts:
            if schema is None:
                raise ValueError(f"{self.path} holds no months")
            return self.spark.createDataFrame([], schema)
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part, allowMissingColumns=True)
        return out

    def clean(self, keep: int = 1) -> list[str]:
        """Remove all but the newest ``keep`` manifests, and the runs that these don't name; their names are returned."""
        if keep < 1:
            raise ValueError("the newest manifest stays")
        finished = self._finished()
        kept = finished[-keep:]
        named = {run for n in kept for run in self.versions(n).values()}
        gone = [f"manifests/{n}" for n in _names(self.spark, f"{self.path}/manifests") if n not in kept]
        gone += [f"runs/{n}" for n in _names(self.spark, f"{self.path}/runs") if n not in named]
        for name in gone if finished else []:
            fs, at = _files(self.spark, f"{self.path}/{name}")
            fs.delete(at, True)
        return gone if finished else []

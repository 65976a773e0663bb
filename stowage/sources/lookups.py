"""Reference tables: product volume, pallet override, wages, tariffs, labour sheets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stowage.functions.dates import in_range, parse_day
from stowage.functions.text import norm
from stowage.sources.lines import cut_lines, positions
from stowage.tables import (
    LABOR_DELIVERY,
    LABOR_WAREHOUSE,
    OVERTIME_TARIFFS,
    PALLET_OVERRIDE,
    PRODUCT_VOLUME,
    WAGES,
)


def is_parquet(path: str, fmt: str | None) -> bool:
    """Whether a sheet is Parquet: by ``fmt`` ("parquet" or "csv"), or else by the path's ending."""
    if fmt not in (None, "parquet", "csv"):
        raise ValueError(f"fmt must be 'parquet' or 'csv', not {fmt!r}")
    return fmt == "parquet" or fmt is None and path.rstrip("/").endswith(".parquet")


def read_lookup(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str | None = None) -> DataFrame:
    """A reference sheet saved as Parquet or CSV; without a schema all CSV columns are text.

    No broadcast is asked for: the size of the file, or what AQE measures, decides.
    """
    if is_parquet(path, fmt):
        df = spark.read.parquet(path)
        return df if schema is None else df.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in schema])
    if schema is None:
        return spark.read.csv(path, header=True)
    names = spark.read.csv(path, header=True)
    return names.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema])


def read_product_volume(spark: SparkSession, path: str) -> DataFrame:
    return read_lookup(spark, path, PRODUCT_VOLUME)


def read_pallet_override(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Override sheet with each line's position, because of repeated products the first line counts.

    Positions follow files by path and lines or rows within them, whatever the splits they are read in.
    """
    casts = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in PALLET_OVERRIDE]
    if is_parquet(path, fmt):
        place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_line")]
        rows = spark.read.parquet(path).select(*casts, *place)
    else:
        _, cut = cut_lines(spark, path, "UTF-8")
        rows = cut.filter(F.col("_reason").isNull()).select(*casts, "_file", "_line")
    return positions(rows, "_file", "_line").select(*[f.name for f in PALLET_OVERRIDE], "position")


def read_client_tariffs(spark: SparkSession, path: str) -> DataFrame:
    return read_lookup(spark, path)


def read_wages(spark: SparkSession, path: str) -> DataFrame:
    return read_lookup(spark, path, WAGES)


def read_overtime_tariffs(spark: SparkSession, path: str) -> DataFrame:
    return read_lookup(spark, path, OVERTIME_TARIFFS)


def prepare_labor(df: DataFrame, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Labour sheet with its date parsed (day first, or ISO), warehouse normalised and range applied."""
    df = df.withColumn("Fecha", parse_day(F.col("Fecha").cast("string")))
    if "Bodega" in df.columns:
        df = df.withColumn("Bodega", norm(F.col("Bodega")))
    return df.filter(in_range(F.col("Fecha"), start, end))


def read_labor(
    spark: SparkSession, warehouse_path: str, delivery_path: str, start: dt.date | None = None, end: dt.date | None = None
) -> tuple[DataFrame, DataFrame]:
    """(warehouse, delivery) labour sheets within an optional date range."""
    return (
        prepare_labor(read_lookup(spark, warehouse_path, LABOR_WAREHOUSE), start, end),
        prepare_labor(read_lookup(spark, delivery_path, LABOR_DELIVERY), start, end),
    )

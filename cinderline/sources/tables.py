"""Readers and writers. A reader only names files and columns; filters on it reach the Parquet scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """folder/name.parquet as it stands, a file or a folder of files."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def one_record(df: DataFrame, key: str, loaded: str = "loaded_at") -> DataFrame:
    """One row for each key, that of the earliest load; rows with a null key stay as they are.

    Redelivered rows carry the same content, so partial aggregation before the shuffle drops most of them.
    """
    rest = [c for c in df.columns if c != key]
    row = F.struct(F.col(loaded).alias("__l"), *[F.col(f"`{c}`") for c in rest])
    first = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(row).alias("__r"))
    known = first.select(*[F.col(key) if c == key else F.col("__r").getField(c).alias(c) for c in df.columns])
    return known.unionByName(df.where(F.col(key).isNull()))


def one_delivery(df: DataFrame, key: str, loaded: str = "loaded_at") -> DataFrame:
    """Rows that differ in nothing but their load as one, that of the earliest; rows with a null key stay as they are.

    Cheaper than one_record, as all columns but one are keys of a hash aggregation; rows that repeat a key with other
    content are not joined.
    """
    rest = [c for c in df.columns if c != loaded]
    alone = F.when(F.col(key).isNull(), F.monotonically_increasing_id()).alias("__alone")
    return df.withColumn("__alone", alone).groupBy(*[F.col(f"`{c}`") for c in rest], "__alone").agg(F.min(loaded).alias(loaded)).select(*[F.col(f"`{c}`") for c in df.columns])


def date_range(ts: Column, start: str, end: str) -> Column:
    """Half-open [start, end) on a time column."""
    return (ts >= F.lit(start).cast("timestamp")) & (ts < F.lit(end).cast("timestamp"))


def bbox_overlap(xmin: float, ymin: float, xmax: float, ymax: float) -> Column:
    """Scenes whose rectangle (columns xmin, ymin, xmax, ymax) touches the given one."""
    return (F.col("xmin") <= xmax) & (F.col("xmax") >= xmin) & (F.col("ymin") <= ymax) & (F.col("ymax") >= ymin)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Parquet export, one folder for each value of partition_by (say fire_id)."""
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)

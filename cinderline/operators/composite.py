"""Composites over time: medians in windows, their differences, mosaics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def window_medians(obs: DataFrame, by: list[str], windows: dict[str, Column], bands: list[str]) -> DataFrame:
    """by, and the median of each band in each window (band_window), from one pass over obs.

    windows: conditions on a reading. Null values are skipped; a window without values gives null. The median of an even
    number of values is the mean of the middle two. One shuffle, on `by`, after partial aggregation. Medians are exact, so a group's
    distinct values are held together: meant for the readings of a pixel, not for groups of unbounded size.
    """
    aggregates = [F.median(F.when(cond, F.col(b).cast("double"))).alias(f"{b}_{name}") for name, cond in windows.items() for b in bands]
    return obs.groupBy(*by).agg(*aggregates)


def median_composite(obs: DataFrame, by: list[str], bands: list[str]) -> DataFrame:
    """by, and the exact median of each band, see window_medians."""
    return obs.groupBy(*by).agg(*[F.median(F.col(b).cast("double")).alias(b) for b in bands])


def dnbr(medians: DataFrame, pre: str, post: str, name: str = "dnbr") -> DataFrame:
    """Median before minus median after; null if either is."""
    return medians.withColumn(name, F.col(pre) - F.col(post))


def mosaic(obs: DataFrame, by: list[str], value: str, order: list[str]) -> DataFrame:
    """The last value that is not null, by `order` (the last column should break ties)."""
    rank = F.struct(*order)
    return obs.where(F.col(value).isNotNull()).groupBy(*by).agg(F.max_by(value, rank).alias(value))

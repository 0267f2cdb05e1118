"""Annual burned area from monthly burn dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .composite import mosaic

FIRST_YEAR, LAST_YEAR = 2001, 2025


def burned(burn_date: Column) -> Column:
    """1 where any positive day is given, else null."""
    return F.when(burn_date > 0, 1)


def _in_years(months: DataFrame, first: int, last: int) -> DataFrame:
    return months.where((F.col("ts") >= F.lit(f"{first}-01-01").cast("timestamp")) & (F.col("ts") < F.lit(f"{last + 1}-01-01").cast("timestamp")))


def burn_by_year(months: DataFrame, first: int = FIRST_YEAR, last: int = LAST_YEAR) -> DataFrame:
    """(pixel_id, burn_year): one row for each calendar year in which any month burned."""
    flagged = _in_years(months, first, last).where(burned(F.col("burn_date")) == 1)
    return flagged.select("pixel_id", F.year("ts").cast("smallint").alias("burn_year")).distinct()


def burn_year(months: DataFrame, first: int = FIRST_YEAR, last: int = LAST_YEAR) -> DataFrame:
    """(pixel_id, burn_year, first_burn_year): latest and earliest year that burned, in one aggregation; pixels that never
    burned have no row."""
    flagged = _in_years(months, first, last).where(burned(F.col("burn_date")) == 1)
    year = F.year("ts").cast("smallint")
    return flagged.groupBy("pixel_id").agg(F.max(year).alias("burn_year"), F.min(year).alias("first_burn_year"))


def annual_images(months: DataFrame) -> DataFrame:
    """(pixel_id, ts, burn_date): one image a year, with the last burn date of its months, as annual products come."""
    years = months.where(burned(F.col("burn_date")) == 1).groupBy("pixel_id", F.year("ts").alias("__y")).agg(F.max("burn_date").alias("burn_date"))
    return years.select("pixel_id", F.make_date("__y", F.lit(1), F.lit(1)).cast("timestamp").alias("ts"), "burn_date")


def product_mosaic(images: DataFrame, value: str, start: str | None = None, end: str | None = None, roi_pixels: DataFrame | None = None) -> DataFrame:
    """Last value of a burned-area product per pixel, of the images in [start, end), inside roi_pixels."""
    if start is not None:
        images = images.where((F.col("ts") >= F.lit(start).cast("timestamp")) & (F.col("ts") < F.lit(end).cast("timestamp")))
    if roi_pixels is not None:
        images = images.join(roi_pixels.select("pixel_id"), "pixel_id", "left_semi")
    return mosaic(images, ["pixel_id"], value, ["ts", value])

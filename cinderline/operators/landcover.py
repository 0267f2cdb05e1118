"""Annual land cover: wide and long form, reclassification, one year's band."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import LEGEND, SCHEME_A

BAND = "classification_"


def bands(wide: DataFrame) -> list[str]:
    return [c for c in wide.columns if c.startswith(BAND)]


def legend(spark: SparkSession) -> DataFrame:
    """The codes with their names and their classes in both schemes."""
    return spark.createDataFrame(LEGEND, "class int, name string, class_a int, class_b int")


def with_names(rows: DataFrame, code: str = "class") -> DataFrame:
    """rows with the legend's name of their code, null where it lists none."""
    names = legend(rows.sparkSession).select(F.col("class").alias(code), "name")
    return rows.join(F.broadcast(names), code, "left")  # fifteen rows


def remap(code: Column, scheme: dict[int, int]) -> Column:
    """The class of a code; null for codes that the scheme does not list."""
    table = F.create_map(*[F.lit(x) for pair in scheme.items() for x in pair])
    return table[code]


def reclass(wide: DataFrame, scheme: dict[int, int] = SCHEME_A) -> DataFrame:
    """Every annual band reclassified under its own name; other columns stay."""
    return wide.select(*[remap(F.col(c), scheme).alias(c) if c.startswith(BAND) else F.col(f"`{c}`") for c in wide.columns])


def to_long(wide: DataFrame, key: str = "pixel_id") -> DataFrame:
    """(key, year, class), one row per band, null classes included."""
    long = wide.unpivot([key], bands(wide), "__band", "class")
    return long.select(key, F.substring("__band", len(BAND) + 1, 4).cast("int").alias("year"), "class")


def to_wide(long: DataFrame, years: list[int], key: str = "pixel_id") -> DataFrame:
    wide = long.groupBy(key).pivot("year", years).agg(F.first("class"))
    return wide.select(key, *[F.col(str(y)).alias(f"{BAND}{y}") for y in years])


def year_band(wide: DataFrame, year: int, key: str = "pixel_id") -> DataFrame:
    """(key, class) of one year."""
    return wide.select(key, F.col(f"{BAND}{year}").alias("class"))


def class_at(wide: DataFrame, year: Column) -> Column:
    """The class of the band that each row's own year names; null for a year without a band. Nothing is joined or unpivoted."""
    out = F.lit(None).cast("int")
    for c in bands(wide):
        out = F.when(year == int(c[len(BAND) :]), F.col(c)).otherwise(out)
    return out

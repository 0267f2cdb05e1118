"""Fires, their windows and labelled points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import FIRE_COLUMNS, catalogue_rows
from .lookup import left_lookup


def fire_catalogue(spark: SparkSession) -> DataFrame:
    """The 30 catalogued fires with DATE columns."""
    raw = spark.createDataFrame(catalogue_rows(), ", ".join(f"{c} string" for c in FIRE_COLUMNS))
    return raw.select(*[F.col(c).cast("date").alias(c) if c.startswith(("pre_", "post_")) else F.col(c) for c in FIRE_COLUMNS])


def one_fire(fires: DataFrame, fire_id: str) -> dict:
    """The columns of one fire; an unknown id is an error."""
    row = fires.where(F.col("fire_id") == fire_id).first()
    if row is None:
        raise KeyError(f"no fire {fire_id!r}")
    return row.asDict()


def latest_revision(revisions: DataFrame, entity: Column, order: list[str]) -> DataFrame:
    """One row per entity (column `entity`): the greatest by `order`; rows without entity are left out."""
    rest = F.struct(*order, F.struct(*[F.col(f"`{c}`") for c in revisions.columns]).alias("__row"))
    best = revisions.withColumn("entity", entity).where("entity is not null").groupBy("entity").agg(F.max(rest).alias("__m"))
    return best.select("entity", "__m.__row.*")


def range_lookup(rows: DataFrame, day: Column, windows: DataFrame, start: str, end: str, keys: list[str] = ()) -> DataFrame:
    """rows with each window whose [start, end) holds their day, and whose `keys`, if any, equal theirs.

    Windows are cut into calendar months, so the join is on the month and the keys, with the range as the rest of the
    condition: never on the range alone.
    """
    months = F.sequence(F.trunc(start, "month"), F.trunc(F.date_sub(F.col(end), 1), "month"), F.expr("interval 1 month"))
    cut = windows.where(F.col(start) < F.col(end)).withColumn("__month", F.explode(months))
    left = rows.withColumn("__day", day).withColumn("__month", F.trunc("__day", "month"))
    return left.join(cut, ["__month", *keys]).where((F.col("__day") >= F.col(start)) & (F.col("__day") < F.col(end))).drop("__month", "__day")


def label_points(burned: DataFrame, unburned: DataFrame) -> DataFrame:
    """Bag union of both with their class; a class column of their own is replaced."""
    return burned.withColumn("class", F.lit("burned")).unionByName(unburned.withColumn("class", F.lit("unburned")))


def with_fire(points: DataFrame, fires: DataFrame, polygons: DataFrame | None = None) -> DataFrame:
    """points with their fire's columns as columns of each row, and whether its polygon is known; unknown fires give nulls.

    fires is unique by fire_id. polygons has the polygon id in fire_id; a null polygon_id matches none.
    """
    out = left_lookup(points, fires, "fire_id")
    if polygons is not None:
        known = polygons.select(F.col("fire_id").alias("polygon_id"), F.lit(True).alias("has_polygon")).distinct()
        out = left_lookup(out, known, "polygon_id").withColumn("has_polygon", F.coalesce("has_polygon", F.lit(False)))
    return out

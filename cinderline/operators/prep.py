"""From raw scenes to one table of clear, comparable reflectances."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import INTERCEPTS, OFFSET, OLI_BANDS, OPTICAL, QA_MASK, SCALE, SENSORS, SLOPES, TM_BANDS
from ..sources.tables import bbox_overlap, date_range
from .lookup import left_lookup

KEYS = ["pixel_id", "scene_id", "sensor", "ts"]


def rename_bands(raw: DataFrame, bands: list[str]) -> DataFrame:
    """Keys, the six optical bands under their names, and QA_PIXEL; other columns go."""
    return raw.select(*KEYS, *[F.col(b).alias(name) for b, name in zip(bands, OPTICAL)], "QA_PIXEL")


def rename_tm(raw: DataFrame) -> DataFrame:
    return rename_bands(raw, TM_BANDS)


def rename_oli(raw: DataFrame) -> DataFrame:
    return rename_bands(raw, OLI_BANDS)


def is_clear(qa: Column) -> Column:
    """No cloud, dilated cloud, shadow, snow or water bit; fill, cirrus and clear bits are not looked at."""
    return qa.bitwiseAND(F.lit(QA_MASK)) == 0


def mask_quality(raw: DataFrame) -> DataFrame:
    """The mask holds for all bands of a reading, so masked readings are left out as rows."""
    return raw.where(is_clear(F.col("QA_PIXEL")))


def reflectance(dn: Column) -> Column:
    return dn.cast("double") * F.lit(SCALE) + F.lit(OFFSET)


def scale_oli(obs: DataFrame) -> DataFrame:
    """Reflectances as FLOAT; the quality band is kept as it is."""
    return obs.withColumns({b: reflectance(F.col(b)).cast("float") for b in OPTICAL})


def harmonize_tm(obs: DataFrame) -> DataFrame:
    """Reflectances of TM and ETM+, brought to those of OLI band by band."""
    return obs.withColumns({b: (reflectance(F.col(b)) * F.lit(s) + F.lit(i)).cast("float") for b, s, i in zip(OPTICAL, SLOPES, INTERCEPTS)})


PATHS: dict[str, tuple[Callable[[DataFrame], DataFrame], Callable[[DataFrame], DataFrame]]] = {
    "LT05": (rename_tm, harmonize_tm),
    "LE07": (rename_tm, harmonize_tm),
    "LC08": (rename_oli, scale_oli),
    "LC09": (rename_oli, scale_oli),
}


def clip(obs: DataFrame, roi_pixels: DataFrame) -> DataFrame:
    """Readings of the pixels in roi_pixels (pixel_id)."""
    return obs.join(roi_pixels.select("pixel_id"), "pixel_id", "left_semi")


def scenes_over(scenes: DataFrame, roi: tuple[float, float, float, float]) -> DataFrame:
    return scenes.where(bbox_overlap(*roi))


def with_scene(obs: DataFrame, scenes: DataFrame, *columns: str) -> DataFrame:
    """obs with columns of its scene next to each pixel's values; unknown scenes give nulls. scenes is unique by scene_id."""
    return left_lookup(obs, scenes.select("scene_id", *columns), "scene_id", broadcast_rows=200_000)  # rows of an id and a few properties


def get_landsat(
    raw: dict[str, DataFrame],
    start: str,
    end: str,
    indices: Callable[[DataFrame], DataFrame],
    *,
    scenes: DataFrame | None = None,
    roi: tuple[float, float, float, float] | None = None,
    roi_pixels: DataFrame | None = None,
) -> DataFrame:
    """Readings of all sensors in [start, end), clear, harmonised, with indices: a bag union, repeated readings stay.

    raw has the table of each sensor. With scenes and roi only readings of scenes whose rectangle touches roi are taken,
    with roi_pixels only those pixels. Dates and masks are filters on raw columns and reach each Parquet scan; of bands and
    indices only those that are used later are read and computed.
    """
    parts = []
    for sensor in (s for s in SENSORS if s in raw):
        rename, bring = PATHS[sensor]
        one = raw[sensor].where(date_range(F.col("ts"), start, end))
        if scenes is not None and roi is not None:
            one = one.join(scenes_over(scenes, roi).select("scene_id"), "scene_id", "left_semi")
        if roi_pixels is not None:
            one = clip(one, roi_pixels)
        parts.append(bring(mask_quality(rename(one))).select(*KEYS, *OPTICAL))
    return reduce(DataFrame.unionByName, parts).transform(indices)

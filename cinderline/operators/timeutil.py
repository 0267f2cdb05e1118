"""Dates of fires and readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fire_number


def frac_year(day: Column) -> Column:
    """Year plus the share of it that has passed, by whole days, DOUBLE."""
    jan1 = lambda y: F.make_date(y, F.lit(1), F.lit(1))
    year = F.year(day)
    return year + (F.dayofyear(day) - 1).cast("double") / F.datediff(jan1(year + 1), jan1(year))


def fire_year(day: Column) -> Column:
    """Years run from July to June and are named after their end."""
    return F.year(day) + (F.month(day) >= 7).cast("int")


def period_tag(ts: Column, pre_lwr: Column, pre_upr: Column, post_lwr: Column, post_upr: Column) -> Column:
    """Both ends of either period belong to it; where they overlap it is Pre-fire. A null bound holds nothing."""
    return F.when(ts.between(pre_lwr, pre_upr), "Pre-fire").when(ts.between(post_lwr, post_upr), "Post-fire").otherwise("Background")


def is_forest(fire_id: Column) -> Column:
    number = fire_number(fire_id)
    return (number <= 10) | (number >= 26)


def calendar_window(year: Column, back: int = 1, forward: int = 1) -> tuple[Column, Column]:
    """[January of `back` years before, January after `forward` years) around a calendar year."""
    jan1 = lambda y: F.make_date(y, F.lit(1), F.lit(1))
    return jan1(year - back), jan1(year + forward + 1)


def with_windows(fires: DataFrame, *, pre_months: int = 12, inclusive_end: bool = True, back: int = 1, forward: int = 1) -> DataFrame:
    """fires with the half-open windows of their composites and of their series.

    pre_lwr and pre_end: pre_months back from the day after pre_upr, or, with inclusive_end off as in the catalogue's own check,
    from pre_upr itself. post_end_long, post_end_short: a day after the last post-fire day, or that day.
    fire_year, series_begin, series_end: July to July, `back` and `forward` years around the year of the shifted date.
    lulc_year: the calendar year before it. post_end: the long one in forest, else the short one.
    """
    shifted = F.date_add("pre_upr", 1)
    extra = 1 if inclusive_end else 0
    year = fire_year(shifted)
    july = lambda y: F.make_date(y, F.lit(7), F.lit(1))
    start = F.add_months(shifted if inclusive_end else F.col("pre_upr"), -pre_months)
    out = fires.withColumns(
        {
            "pre_lwr": start,
            "pre_end": shifted,
            "post_end_long": F.date_add("post_upr_long", extra),
            "post_end_short": F.date_add("post_upr_short", extra),
            "fire_year": year,
            "series_begin": july(year - 1 - back),
            "series_end": july(year + forward),
            "lulc_year": F.year(shifted) - 1,
            "is_forest": is_forest(F.col("fire_id")),
        }
    )
    return out.withColumn("post_end", F.when(F.col("is_forest"), F.col("post_end_long")).otherwise(F.col("post_end_short")))

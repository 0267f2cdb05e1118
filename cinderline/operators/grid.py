"""Irregular readings onto a regular monthly grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def monthly_grid(readings: DataFrame, *, source: str, day: Column, value: str, key: str | None = None, max_fill_months: int = 3, bounds: tuple[str, str] | None = None) -> DataFrame:
    """One row per source and calendar month: (source, month, value, n_readings, state).

    A reading has a source, a day and a value that is neither null nor NaN (infinite values are readings). Rows with the
    same key are one reading, rows with a null key one each. A month with readings has their mean, state 'read'. The months between two months with
    readings have n_readings 0: if at most max_fill_months lie in the gap, the value is interpolated in a straight line
    and the state is 'filled', else the value is null and the state is 'missing'. With bounds ('yyyy-MM', 'yyyy-MM') the
    grid of every source also reaches from the first to the last of these months; added months have no value and state
    'outside', and months beyond the bounds stay. Sources without a reading have no rows. month is STRING yyyy-MM.

    Readings are reduced to months before anything is ordered, so however many readings one source has, the window over
    it sees one row per month; only grid months between two consecutive rows (lead) are exploded.
    """
    rows = readings.select(F.col(source).alias("__s"), day.alias("__d"), F.col(value).cast("double").alias("__v"), (F.struct(F.col(key), F.when(F.col(key).isNull(), F.monotonically_increasing_id())) if key else F.lit(None)).alias("__k"))
    rows = rows.where("__s is not null and __d is not null and __v is not null and not isnan(__v)")
    rows = rows.select("__s", (F.year("__d") * 12 + F.month("__d") - 1).cast("int").alias("__m"), "__v", "__k")
    if key:
        rows = rows.groupBy("__s", "__m", "__k").agg(F.min("__v").alias("__v"))
    months = rows.groupBy("__s", "__m").agg(F.avg("__v").alias("__v"), F.count("*").alias("__n"))
    w = Window.partitionBy("__s").orderBy("__m")
    pairs = months.withColumns({"__m2": F.lead("__m").over(w), "__v2": F.lead("__v").over(w), "__prev": F.lag("__m").over(w)})
    gap = F.col("__m2") - F.col("__m") - 1
    step = F.struct(F.col("__m").alias("m"), F.col("__v").alias("v"), F.col("__n").alias("n"), F.lit("read").alias("state"))
    inner = F.when(
        gap > 0,
        F.transform(
            F.sequence(F.col("__m") + 1, F.col("__m2") - 1),
            lambda m: F.struct(
                m.alias("m"),
                F.when(gap <= max_fill_months, F.col("__v") + (F.col("__v2") - F.col("__v")) * (m - F.col("__m")) / (gap + 1)).alias("v"),
                F.lit(0).cast("bigint").alias("n"),
                F.when(gap <= max_fill_months, "filled").otherwise("missing").alias("state"),
            ),
        ),
    )
    empty = F.array().cast("array<struct<m:int,v:double,n:bigint,state:string>>")
    parts = [F.array(step), F.coalesce(inner, empty)]
    if bounds:
        first, last = (int(b[:4]) * 12 + int(b[5:7]) - 1 for b in bounds)
        blank = lambda m: F.struct(m.alias("m"), F.lit(None).cast("double").alias("v"), F.lit(0).cast("bigint").alias("n"), F.lit("outside").alias("state"))
        head = F.when(F.col("__prev").isNull() & (F.col("__m") > first), F.transform(F.sequence(F.lit(first), F.col("__m") - 1), blank))
        tail = F.when(F.col("__m2").isNull() & (F.col("__m") < last), F.transform(F.sequence(F.col("__m") + 1, F.lit(last)), blank))
        parts += [F.coalesce(head, empty), F.coalesce(tail, empty)]
    grid = pairs.select("__s", F.explode(F.concat(*parts)).alias("g"))
    label = F.format_string("%04d-%02d", F.floor(F.col("g.m") / 12).cast("int"), F.pmod(F.col("g.m"), F.lit(12)) + 1)
    return grid.select(F.col("__s").alias(source), label.alias("month"), F.col("g.v").alias("value"), F.col("g.n").alias("n_readings"), F.col("g.state").alias("state"))

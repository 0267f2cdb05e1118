"""Per-pixel time series: features of the largest drop, series of a point, chart data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

MIN_LENGTH = 5
MARGIN = 4


def ts_features(series: DataFrame, *, pixel: str, order: list[str], time: Column, nbr: str, key: str | None = None, counted: DataFrame | None = None, max_series: int = 1_000_000) -> DataFrame:
    """(pixel, max_drop, date_drop, dnbr) of each pixel with at least five readings that are not null.

    max_drop is the least difference between consecutive readings, the first of equal ones; date_drop the time of
    the reading after it; dnbr the median of up to four readings before that one minus the median of up to four after it,
    null where it is the last. The last column of `order` should break ties; null pixels or times are left out. With key,
    rows that are equal in order, key, time and value are one reading.

    One shuffle on pixel serves all windows and the aggregation; windows sort and spill, so no series is held in memory.
    Pixels with more than max_series rows, told by a count per pixel, are spread over many tasks instead (_long_features). The count
    is of `counted`, a table with at least the rows of series: give the table as it is read, and the count looks at one column alone.
    """
    columns = [f"__o{k}" for k in range(len(order))]
    rows = series.select(
        F.col(pixel).alias("__p"), *[F.col(c).alias(n) for c, n in zip(order, columns)], time.alias("__t"), F.col(nbr).cast("double").alias("__x"), (F.col(key) if key else F.lit(None)).alias("__k")
    )
    rows = rows.where("__p is not null and __t is not null and __x is not null and not isnan(__x)")
    sizes = (series if counted is None else counted).where(F.col(pixel).isNotNull()).groupBy(F.col(pixel).alias("__p")).count().where(F.col("count") > max_series).select("__p")
    if not sizes.limit(1).count():
        found = _short_features(rows, columns, key is not None)
    else:
        rows, sizes = cut_lineage(rows), cut_lineage(sizes)  # both are read more than once
        short, long = rows.join(sizes, "__p", "left_anti"), rows.join(sizes, "__p", "left_semi")
        found = _short_features(short, columns, key is not None).unionByName(_long_features(long, columns, key is not None))
    return found.select(F.col("__p").alias(pixel), "max_drop", "date_drop", "dnbr")


def _short_features(rows: DataFrame, order: list[str], keyed: bool) -> DataFrame:
    w = Window.partitionBy("__p").orderBy(*order)
    whole = Window.partitionBy("__p")
    if keyed:
        same = F.struct(*order, "__k", "__t", "__x")
        rows = rows.withColumn("__again", F.lag(same).over(w)).where(F.col("__k").isNull() | ~same.eqNullSafe(F.col("__again")))
    rows = rows.withColumns({"__i": F.row_number().over(w), "__d": F.col("__x") - F.lag("__x").over(w)})
    rows = rows.withColumn("__drop", F.min(F.when(F.col("__d").isNotNull(), F.struct("__d", "__i"))).over(whole))
    at = F.col("__drop.__i")
    found = rows.groupBy("__p").agg(
        F.count("*").alias("__n"),
        F.first("__drop").getField("__d").alias("max_drop"),
        F.max(F.when(F.col("__i") == at, F.col("__t"))).alias("date_drop"),
        (F.median(F.when(F.col("__i").between(at - MARGIN, at - 1), F.col("__x"))) - F.median(F.when(F.col("__i").between(at + 1, at + MARGIN), F.col("__x")))).alias("dnbr"),
    )
    return found.where(F.col("__n") >= MIN_LENGTH).drop("__n")


def _long_features(rows: DataFrame, order: list[str], keyed: bool) -> DataFrame:
    """The same for very long series: rows are range-partitioned in their order, so a series is cut into blocks anywhere;
    each block gets the last value before it, the least difference is a mergeable minimum, and the readings beside it are the
    first few of a ranking, which is cut before its shuffle."""
    if keyed:
        rows = rows.where("__k is null").unionByName(rows.where("__k is not null").distinct())
    # The cut points are sampled, so the blocks are written down before they are used twice.
    placed = cut_lineage(rows.drop("__k").repartitionByRange("__p", *order).withColumn("__block", F.spark_partition_id()))
    position = F.struct(*order)
    by_block = Window.partitionBy("__p").orderBy("__block")
    edges = placed.groupBy("__p", "__block").agg(F.max_by("__x", position).alias("__last")).withColumn("__before", F.lag("__last").over(by_block)).drop("__last")
    inside = Window.partitionBy("__p", "__block").orderBy(*order)
    steps = placed.join(edges, ["__p", "__block"]).withColumn("__d", F.col("__x") - F.coalesce(F.lag("__x").over(inside), F.col("__before")))
    best = steps.groupBy("__p").agg(F.count("*").alias("__n"), F.min(F.when(F.col("__d").isNotNull(), F.struct("__d", position.alias("__at"), "__t"))).alias("__drop")).where(F.col("__n") >= MIN_LENGTH)
    best = cut_lineage(best.select("__p", "__drop.*"))
    beside = placed.select("__p", "__x", position.alias("__o")).join(best.select("__p", "__at"), "__p")

    def side(cond: Column, nearest: Column, name: str) -> DataFrame:
        ranked = beside.where(cond).withColumn("__r", F.row_number().over(Window.partitionBy("__p").orderBy(nearest))).where(F.col("__r") <= MARGIN)
        return ranked.groupBy("__p").agg(F.median("__x").alias(name))

    out = best.join(side(F.col("__o") < F.col("__at"), F.desc("__o"), "__pre"), "__p", "left").join(side(F.col("__o") > F.col("__at"), F.asc("__o"), "__post"), "__p", "left")
    return out.select("__p", F.col("__d").alias("max_drop"), F.col("__t").alias("date_drop"), (F.col("__pre") - F.col("__post")).alias("dnbr"))


def _median_of(values: Column) -> Column:
    s = F.array_sort(values)
    n = F.size(s)
    middle = lambda k: F.get(s, k.cast("int"))
    return F.when(n > 0, (middle(F.floor((n - 1) / 2)) + middle(F.floor(n / 2))) / 2)


def ts_features_array(series: DataFrame, *, pixel: str, order: list[str], time: Column, nbr: str) -> DataFrame:
    """The same from one sorted array per pixel: faster for series known to be short, as an array is one value in memory."""
    rows = series.where(F.col(pixel).isNotNull() & time.isNotNull() & F.col(nbr).isNotNull() & ~F.isnan(F.col(nbr).cast("double")))
    key = F.struct(*[F.col(c).alias(f"o{k}") for k, c in enumerate(order)], time.alias("t"), F.col(nbr).cast("double").alias("x"))
    a = rows.groupBy(pixel).agg(F.array_sort(F.collect_list(key)).alias("a")).where(F.size("a") >= MIN_LENGTH)
    a = a.withColumn("x", F.transform("a", lambda r: r["x"]))
    a = a.withColumn("d", F.zip_with(F.slice("x", F.lit(2), F.size("x") - 1), F.slice("x", F.lit(1), F.size("x") - 1), lambda late, early: late - early))
    a = a.withColumn("drop", F.array_position("d", F.array_min("d")).cast("int"))  # 0-based place of the reading after the drop
    first = F.greatest(F.col("drop") - MARGIN, F.lit(0))
    before, after = F.slice("x", first + 1, F.col("drop") - first), F.slice("x", F.col("drop") + 2, F.lit(MARGIN))
    return a.select(pixel, F.array_min("d").alias("max_drop"), F.get("a", F.col("drop"))["t"].alias("date_drop"), (_median_of(before) - _median_of(after)).alias("dnbr"))


def of_points(obs: DataFrame, points: DataFrame, *, broadcast_rows: int = 1_000_000) -> DataFrame:
    """Readings of the pixels that hold a point, so that what follows sees no others. The pixels are broadcast if there are at most
    broadcast_rows of them."""
    pixels = points.where("pixel_id is not null").select("pixel_id").distinct()
    few = pixels.limit(broadcast_rows + 1).count() <= broadcast_rows
    return obs.join(F.broadcast(pixels) if few else pixels, "pixel_id", "left_semi")


def point_series(obs: DataFrame, points: DataFrame, *, day: Column, nbr: str, period: Column) -> DataFrame:
    """(point_id, date, nbr, period): the mean reading of each point's pixel by day, as charted; date is yyyy-MM-dd.

    day and period are made of columns of obs and points together. Points without a reading have no rows; days are grouped
    before they are written out.
    """
    rows = obs.join(points, "pixel_id").select("point_id", day.alias("__day"), period.alias("period"), F.col(nbr).alias("__x"))
    means = rows.groupBy("point_id", "__day", "period").agg(F.avg("__x").alias("nbr"))
    return means.select("point_id", F.date_format("__day", "yyyy-MM-dd").alias("date"), "nbr", "period")


def nearest_pixel(places: DataFrame, lon: float, lat: float) -> DataFrame:
    """(pixel_id) of the place (pixel_id, lon, lat) nearest to a position, the least id of equally near ones; no row without places."""
    off = (F.col("lon") - F.lit(lon)) ** 2 + (F.col("lat") - F.lit(lat)) ** 2
    near = places.where("pixel_id is not null and lon is not null and lat is not null").agg(F.min(F.struct(off.alias("d"), F.col("pixel_id"))).alias("m"))
    return near.where("m is not null").select(F.col("m.pixel_id").alias("pixel_id"))


def panel(chart: DataFrame) -> DataFrame:
    """A chart of points (see point_series) with the ends of each point's axis (see series_limits) on its rows."""
    return chart.join(series_limits(chart, ["point_id"], "nbr"), "point_id")


def point_means(obs: DataFrame, points: DataFrame, nbr: str) -> DataFrame:
    """(point_id, n, nbr): mean over the readings of the pixel that holds the point, n 0 and null without any.

    The pixels' sums are made first, so the join has one row per pixel and point.
    """
    sums = obs.where(F.col(nbr).isNotNull()).groupBy("pixel_id").agg(F.count("*").alias("n"), F.avg(nbr).alias("nbr"))
    return points.select("point_id", "pixel_id").join(sums, "pixel_id", "left").select("point_id", F.coalesce("n", F.lit(0)).alias("n"), "nbr")


def series_limits(obs: DataFrame, by: list[str], value: str) -> DataFrame:
    """by, and the ends of the chart axis: a fifth of the range beyond the least and the greatest value."""
    ends = obs.groupBy(*by).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    margin = (F.col("hi") - F.col("lo")) * F.lit(0.2)
    return ends.select(*by, (F.col("lo") - margin).alias("y_min"), (F.col("hi") + margin).alias("y_max"))


def chart_table(rows: DataFrame, x: str, series: str, names: list[str], y: str) -> DataFrame:
    """One row per x with a column for each series: the greatest y of that x and series."""
    return rows.groupBy(x).pivot(series, names).agg(F.max(y))

"""Queries of the imagery, land-cover and fire operators on the driver's tables, and their SQL.

There is no imagery among the tables: where an operator needs digital numbers or bands, columns of the right shape stand in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import fire_label, fire_number, parse_date, period_label
from ..operators import burned as B
from ..operators import composite as C
from ..operators import indices as I
from ..operators import landcover as L
from ..operators import prep as P
from ..operators import series as S
from ..operators import timeutil as D
from ..operators import training as Tr
from ..schema import BRIGHTNESS, FIRE_COLUMNS, GREENNESS, INTERCEPTS, LEGEND, OLI_BANDS, OPTICAL, SCHEME_A, SCHEME_B, SLOPES, TM_BANDS, WETNESS, catalogue_rows
from ..session import scratch_folder
from ..sources.tables import bbox_overlap, one_delivery, table, write_csv, write_table
from ..streaming.live import run_to_end, stream_table, windowed_summary
from .training_data import DAY_SQL, FIRE_SQL

ROUND = 12  # digits of results that sum in no fixed order


def _rows(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Readings of chart_rows with their day; redelivered ones are still repeated, which extremes do not mind."""
    rows = table(spark, folder, "chart_rows").select("obs_id", "pixel_id", "date", "nbr", *columns).where("nbr is not null and not isnan(nbr) and abs(nbr) <= 1")
    return rows.withColumn("day", parse_date("date")).where("day is not null").drop("date")


def _readings(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """One row per reading: redelivered rows differ in loaded_at alone. Every column is a key of the hash aggregation, so
    nothing is sorted and a pixel with very many readings is spread over all tasks."""
    return _rows(spark, folder, *columns).distinct()


READINGS_SQL = f"""
t AS (SELECT obs_id, pixel_id, fire_id, period, nbr, loaded_at, trim(date, ' \t\n\r' || chr(160)) AS s FROM chart_rows WHERE nbr IS NOT NULL AND NOT isnan(nbr) AND abs(nbr) <= 1),
u AS (SELECT *, {DAY_SQL} AS day FROM t),
readings AS (SELECT * FROM u WHERE day IS NOT NULL QUALIFY row_number() OVER (PARTITION BY obs_id ORDER BY loaded_at) = 1)
"""

FRAC_SQL = "year({0}) + CAST(dayofyear({0}) - 1 AS DOUBLE) / CAST(date_diff('day', make_date(year({0}), 1, 1), make_date(year({0}) + 1, 1, 1)) AS DOUBLE)"


def ts_features(spark: SparkSession, folder: str) -> DataFrame:
    found = S.ts_features(_rows(spark, folder), pixel="pixel_id", order=["day", "obs_id"], key="obs_id", counted=table(spark, folder, "chart_rows"), time=D.frac_year(F.col("day")).cast("float").cast("double"), nbr="nbr")
    return found.withColumns({c: F.round(c, ROUND) for c in ("max_drop", "dnbr")})


def ts_features_array(spark: SparkSession, folder: str) -> DataFrame:
    found = S.ts_features_array(_readings(spark, folder), pixel="pixel_id", order=["day", "obs_id"], time=D.frac_year(F.col("day")).cast("float").cast("double"), nbr="nbr")
    return found.withColumns({c: F.round(c, ROUND) for c in ("max_drop", "dnbr")})


FEATURES_SQL = f"""
WITH {READINGS_SQL},
o AS (SELECT pixel_id, nbr, CAST(CAST({FRAC_SQL.format("day")} AS FLOAT) AS DOUBLE) AS time,
        row_number() OVER w AS i, nbr - lag(nbr) OVER w AS d, count(*) OVER (PARTITION BY pixel_id) AS n
      FROM readings WHERE pixel_id IS NOT NULL WINDOW w AS (PARTITION BY pixel_id ORDER BY day, obs_id)),
k AS (SELECT pixel_id, i AS pos, d FROM o WHERE d IS NOT NULL AND n >= 5 QUALIFY row_number() OVER (PARTITION BY pixel_id ORDER BY d, i) = 1)
SELECT o.pixel_id, round(any_value(k.d), {ROUND}) AS max_drop, max(CASE WHEN i = pos THEN time END) AS date_drop,
  round(median(CASE WHEN i BETWEEN pos - 4 AND pos - 1 THEN nbr END) - median(CASE WHEN i BETWEEN pos + 1 AND pos + 4 THEN nbr END), {ROUND}) AS dnbr
FROM o JOIN k USING (pixel_id) GROUP BY o.pixel_id
"""


def qa_mask(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").where(P.is_clear(F.col("event_id"))).select("event_id")


# Digital numbers from lineitem: finished lines as of ETM+, open ones as of OLI.
NUMBERS = {
    "blue": "l_partkey % 9000 + 7000",
    "green": "l_suppkey % 5000 + 7500",
    "red": "CAST(floor(l_extendedprice) AS BIGINT) % 8000 + 7100",
    "nir": "l_orderkey % 20000 + 7200",
    "swir1": "CAST(floor(l_extendedprice * 7) AS BIGINT) % 12000 + 7300",
    "swir2": "CAST(floor(l_quantity) AS BIGINT) * 200 + 7000",
}


def _raw(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    lines = table(spark, folder, "lineitem")
    keys = [F.col("l_partkey").alias("pixel_id"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("scene_id"), F.col("l_shipdate").alias("ts"), (F.col("l_orderkey") % 256).alias("QA_PIXEL")]

    def of(status: str, sensor: str, names: list[str]) -> DataFrame:
        numbers = [F.expr(NUMBERS[b]).cast("int").alias(n) for b, n in zip(OPTICAL, names)]
        return lines.where(F.col("l_linestatus") == status).select(*keys, F.lit(sensor).alias("sensor"), *numbers)

    return {"LE07": of("F", "LE07", TM_BANDS), "LC08": of("O", "LC08", OLI_BANDS)}


BEGIN, END = "1995-06-01", "2001-06-01"


def _obs_sql() -> str:
    bands = []
    for b, slope, add in zip(OPTICAL, SLOPES, INTERCEPTS):
        dn = f"(CAST({NUMBERS[b]} AS DOUBLE) * CAST(0.0000275 AS DOUBLE) + CAST(-0.2 AS DOUBLE))"
        bands.append(f"CAST(CAST(CASE WHEN l_linestatus = 'F' THEN {dn} * CAST({slope} AS DOUBLE) + CAST({add} AS DOUBLE) ELSE {dn} END AS FLOAT) AS DOUBLE) AS {b}")
    return f"""obs AS (SELECT l_partkey AS pixel_id, concat_ws('-', l_orderkey, l_linenumber) AS scene_id,
  CASE WHEN l_linestatus = 'F' THEN 'LE07' ELSE 'LC08' END AS sensor, {", ".join(bands)}
  FROM lineitem WHERE l_linestatus IN ('F', 'O') AND (l_orderkey % 256) & 186 = 0 AND l_shipdate >= TIMESTAMP '{BEGIN}' AND l_shipdate < TIMESTAMP '{END}')"""


def _div(top: str, bottom: str) -> str:
    return f"CASE WHEN {bottom} = 0 THEN CAST(0 AS DOUBLE) ELSE ({top}) / ({bottom}) END"


def _nd(a: str, b: str) -> str:
    return f"CASE WHEN {a} >= 0 AND {b} >= 0 THEN {_div(f'{a} - {b}', f'({a} + {b})')} END"


def _dot(weights: list[float]) -> str:
    return " + ".join(f"CAST({w} AS DOUBLE) * {b}" for w, b in zip(weights, OPTICAL))


def _num(text: str) -> str:
    return f"CAST({text} AS DOUBLE)"


INDEX_SQL = {
    "nbr": _nd("nir", "swir2"),
    "nbr2": _nd("swir1", "swir2"),
    "ndvi": _nd("nir", "red"),
    "mirbi": f"{_num('10')} * swir2 - {_num('9.8')} * swir1 + {_num('2')}",
    "bai": _div(_num("1"), f"(({_num('0.1')} - red) * ({_num('0.1')} - red) + ({_num('0.06')} - nir) * ({_num('0.06')} - nir))"),
    "evi": _div(f"{_num('2.5')} * (nir - red)", f"(nir + {_num('6')} * red - {_num('7.5')} * blue + {_num('1')})"),
    "savi": _div(f"{_num('1.5')} * (nir - red)", f"(nir + red + {_num('0.5')})"),
    "msi": _div("swir1", "nir"),
    "ndsi": _nd("green", "swir1"),
    "ndmi": _nd("nir", "swir1"),
    "brightness": _dot(BRIGHTNESS),
    "greenness": _dot(GREENNESS),
    "wetness": _dot(WETNESS),
}


def _index_list(names: list[str]) -> str:
    return ", ".join(f"{INDEX_SQL[n]} AS {n}" for n in names)


def harmonize_union(spark: SparkSession, folder: str) -> DataFrame:
    out = P.get_landsat(_raw(spark, folder), BEGIN, END, I.add_nbr)
    return out.select("scene_id", "sensor", *[F.col(b).cast("double").alias(b) for b in OPTICAL], "nbr")


def landsat_indices(spark: SparkSession, folder: str) -> DataFrame:
    return P.get_landsat(_raw(spark, folder), BEGIN, END, I.add_fire_indices).select("scene_id", *INDEX_SQL)


def median_composite(spark: SparkSession, folder: str) -> DataFrame:
    """Median of each band and of nbr per pixel and sensor."""
    obs = P.get_landsat(_raw(spark, folder), BEGIN, END, I.add_nbr)
    out = C.median_composite(obs, ["pixel_id", "sensor"], [*OPTICAL, "nbr"])
    return out.select("pixel_id", "sensor", *[F.round(b, ROUND).alias(b) for b in [*OPTICAL, "nbr"]])


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "embeddings")
    return e.select("vec_id", *[F.col("embedding")[k].cast("double").alias(b) for k, b in enumerate(OPTICAL)])


VECTOR_SQL = "v AS (SELECT vec_id, " + ", ".join(f"CAST(embedding[{k + 1}] AS DOUBLE) AS {b}" for k, b in enumerate(OPTICAL)) + " FROM embeddings)"


def spectral_indices(spark: SparkSession, folder: str) -> DataFrame:
    return I.add_fire_indices(_vectors(spark, folder)).select("vec_id", *INDEX_SQL)


def index_select_fn(spark: SparkSession, folder: str) -> DataFrame:
    v = _vectors(spark, folder)
    return v.transform(I.add_nbr).select("vec_id", F.lit("nbr").alias("fn"), "nbr", F.lit(None).cast("double").alias("ndvi")).unionByName(v.transform(I.add_nbr_ndvi).select("vec_id", F.lit("nbr_ndvi").alias("fn"), "nbr", "ndvi"))


def ndfi(spark: SparkSession, folder: str) -> DataFrame:
    return I.add_ndfi(_vectors(spark, folder)).select("vec_id", F.round("gv_frac", ROUND).alias("gv_frac"), F.round("ndfi", 6).alias("ndfi"))


def _ndfi_sql() -> str:
    parts = {n: f"({_dot(w)})" for n, w in I.unmixing_weights().items()}
    top = f"({parts['gv']} - ({parts['soil']} + {parts['shade']} + {parts['npv']}))"
    bottom = f"({parts['gv']} + {parts['soil']} + {parts['shade']} + {parts['npv']} + {_num('0.0001')})"
    return f"WITH {VECTOR_SQL} SELECT vec_id, round(least(greatest({parts['gv']}, 0), 1), {ROUND}) AS gv_frac, round(least(greatest({_div(top, bottom)}, -1), 1), 6) AS ndfi FROM v"


def expression_index(spark: SparkSession, folder: str) -> DataFrame:
    """Two indices from arithmetic texts."""
    v = _vectors(spark, folder)
    v = I.expression(v, "mirbi", "10 * a - 9.8 * b + 2", {"a": "swir2", "b": "swir1"})
    return I.expression(v, "burn", "(0.1 - r) ** 2 + (0.06 - nir) ** 2", {"r": "red"}).select("vec_id", F.round("mirbi", ROUND).alias("mirbi"), F.round("burn", ROUND).alias("burn"))


PRE, POST = ("2024-01-05", "2024-01-12"), ("2024-01-12", "2024-01-20")


def period_tag(spark: SparkSession, folder: str) -> DataFrame:
    bounds = [F.lit(d).cast("timestamp") for d in (*PRE, *POST)]
    return table(spark, folder, "events").select("event_id", D.period_tag(F.col("ts"), *bounds).alias("period"))


def _fires(spark: SparkSession, folder: str) -> DataFrame:
    """The last revision of each fire, with its windows; fire_id as written in it."""
    last = Tr.latest_revision(table(spark, folder, "training_fires"), fire_number("fire_id"), ["valid_from", "recorded_at", "revision_id"])
    return D.with_windows(last)


FIRES_SQL = f"""
lr AS (SELECT *, {FIRE_SQL.format("fire_id")} AS entity FROM training_fires),
lf AS (SELECT * FROM lr WHERE entity IS NOT NULL QUALIFY row_number() OVER (PARTITION BY entity ORDER BY valid_from DESC NULLS LAST, recorded_at DESC NULLS LAST, revision_id DESC NULLS LAST) = 1),
fires AS (SELECT entity, polygon_id, description, pre_upr, post_lwr, CAST((pre_upr + 1) - INTERVAL 12 MONTH AS DATE) AS pre_lwr, pre_upr + 1 AS pre_end,
  CASE WHEN entity <= 10 OR entity >= 26 THEN post_upr_long + 1 ELSE post_upr_short + 1 END AS post_end, year(pre_upr + 1) - 1 AS lulc_year FROM lf)
"""


def fire_dnbr(spark: SparkSession, folder: str) -> DataFrame:
    """dNBR of each pixel in the windows of its fire."""
    obs = _readings(spark, folder, "fire_id").select("pixel_id", fire_number("fire_id").alias("entity"), "day", "nbr")
    fires = _fires(spark, folder).select("entity", "pre_lwr", "pre_end", "post_lwr", "post_end")
    rows = Tr.left_lookup(obs, fires, "entity")
    inside = {"pre": (F.col("day") >= F.col("pre_lwr")) & (F.col("day") < F.col("pre_end")), "post": (F.col("day") >= F.col("post_lwr")) & (F.col("day") < F.col("post_end"))}
    out = C.dnbr(C.window_medians(rows, ["pixel_id"], inside, ["nbr"]), "nbr_pre", "nbr_post")
    return out.select("pixel_id", *[F.round(c, ROUND).alias(c) for c in ("nbr_pre", "nbr_post", "dnbr")])


def dnbr_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Three fixed windows, two differences, one pass."""
    cond = {n: (F.col("ts") >= F.lit(a).cast("timestamp")) & (F.col("ts") < F.lit(b).cast("timestamp")) for n, a, b in WINDOWS}
    m = C.window_medians(table(spark, folder, "events"), ["user_id"], cond, ["value"])
    m = C.dnbr(C.dnbr(m, "value_pre", "value_post1", "dnbr1"), "value_pre", "value_post2", "dnbr2")
    return m.select("user_id", F.round("dnbr1", ROUND).alias("dnbr1"), F.round("dnbr2", ROUND).alias("dnbr2"))


WINDOWS = [("pre", "2024-01-03", "2024-01-10"), ("post1", "2024-01-12", "2024-01-20"), ("post2", "2024-01-20", "2024-01-29")]


def catalog_windows(spark: SparkSession, folder: str) -> DataFrame:
    f = Tr.fire_catalogue(spark)
    check = D.with_windows(f, pre_months=3, inclusive_end=False).select("fire_id", F.col("pre_lwr").alias("check_lwr"), F.col("post_end_long").alias("check_long"))
    out = D.with_windows(f).join(check, "fire_id")
    return out.select("fire_id", "pre_lwr", "pre_end", "post_lwr", "post_end", "fire_year", "series_begin", "series_end", "lulc_year", "is_forest", "check_lwr", "check_long")


def _values() -> str:
    text = lambda v: "NULL" if v is None else f"'{v}'"
    rows = ", ".join("(" + ", ".join(text(v) for v in r) + ")" for r in catalogue_rows())
    dates = ", ".join(f"CAST({c} AS DATE) AS {c}" if c.startswith(("pre_", "post_")) else c for c in FIRE_COLUMNS)
    return f"c AS (SELECT {dates} FROM (VALUES {rows}) AS x({', '.join(FIRE_COLUMNS)}))"


CATALOG_SQL = f"""WITH {_values()}, d AS (SELECT *, pre_upr + 1 AS s, CAST(substr(fire_id, 6) AS INT) AS k FROM c),
e AS (SELECT *, year(s) + CASE WHEN month(s) >= 7 THEN 1 ELSE 0 END AS fy, k <= 10 OR k >= 26 AS forest FROM d)
SELECT fire_id, CAST(s - INTERVAL 12 MONTH AS DATE) AS pre_lwr, s AS pre_end, post_lwr, CASE WHEN forest THEN post_upr_long + 1 ELSE post_upr_short + 1 END AS post_end, fy AS fire_year,
  make_date(fy - 2, 7, 1) AS series_begin, make_date(fy + 1, 7, 1) AS series_end, year(s) - 1 AS lulc_year, forest AS is_forest,
  CAST(pre_upr - INTERVAL 3 MONTH AS DATE) AS check_lwr, post_upr_long AS check_long FROM e"""


def fire_range_join(spark: SparkSession, folder: str) -> DataFrame:
    """Orders in the post-fire window of each catalogued fire."""
    fires = Tr.fire_catalogue(spark).select("fire_id", "post_lwr", "post_upr_long")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return Tr.range_lookup(orders, F.col("o_orderdate").cast("date"), fires, "post_lwr", "post_upr_long").select("o_orderkey", "fire_id")


def frac_year(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return table(spark, folder, "orders").select("o_orderkey", D.frac_year(day).alias("frac_year"), D.fire_year(day).alias("fire_year"))


def burn_year(spark: SparkSession, folder: str) -> DataFrame:
    return B.burn_year(table(spark, folder, "burn_month"))


def burn_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return B.burn_by_year(table(spark, folder, "burn_month"))


def burn_mosaic(spark: SparkSession, folder: str) -> DataFrame:
    """Last burn date that is not null, for the pixels of labelled points."""
    roi = table(spark, folder, "training_locations").where("class = 'burned'")
    return B.product_mosaic(table(spark, folder, "burn_month"), "burn_date", "2001-01-01", "2026-01-01", roi)


def mosaic_last_valid(spark: SparkSession, folder: str) -> DataFrame:
    valid = table(spark, folder, "events").withColumn("v", F.when(F.col("event_type") != "error", F.col("value")))
    return C.mosaic(valid, ["user_id"], "v", ["ts", "event_id"])


def _long(scheme: dict):
    return lambda spark, folder: L.to_long(L.reclass(table(spark, folder, "lulc_wide"), scheme))


def _case(column: str, scheme: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {a} THEN {b}" for a, b in scheme.items()) + " END"


LONG_SQL = "w AS (SELECT pixel_id, CAST(substr(name, 16) AS INT) AS year, code FROM lulc_wide UNPIVOT INCLUDE NULLS (code FOR name IN (COLUMNS('classification_.*'))))"


def lulc_unpivot_year(spark: SparkSession, folder: str) -> DataFrame:
    """Long form, and back to wide."""
    return L.to_wide(L.to_long(table(spark, folder, "lulc_wide")), list(range(2000, 2025)))


def lulc_year(spark: SparkSession, folder: str) -> DataFrame:
    """One year's band, in both schemes."""
    band = L.year_band(table(spark, folder, "lulc_wide"), 2014)
    return band.select("pixel_id", "class", L.remap(F.col("class"), SCHEME_A).alias("class_a"), L.remap(F.col("class"), SCHEME_B).alias("class_b"))


def veg_at_fire(spark: SparkSession, folder: str) -> DataFrame:
    """Class of each point's pixel in the year before its fire, and whether it could burn at all."""
    points = one_delivery(table(spark, folder, "training_locations").select("point_id", "pixel_id", "fire_id", "loaded_at"), "point_id").withColumn("entity", fire_number("fire_id"))
    points = Tr.left_lookup(points, _fires(spark, folder).select("entity", "lulc_year"), "entity")
    wide = L.reclass(table(spark, folder, "lulc_wide"))
    out = points.join(wide, "pixel_id", "left")
    veg = L.class_at(out, F.col("lulc_year"))
    return out.select("point_id", "lulc_year", veg.alias("class"), (veg == 0).alias("non_burnable"))


def series_limits(spark: SparkSession, folder: str) -> DataFrame:
    out = S.series_limits(_rows(spark, folder), ["pixel_id"], "nbr")
    return out.select("pixel_id", F.round("y_min", ROUND).alias("y_min"), F.round("y_max", ROUND).alias("y_max"))


def chart_pivot(spark: SparkSession, folder: str) -> DataFrame:
    rows = _rows(spark, folder, "period").select("day", period_label("period").alias("period"), "nbr")
    out = S.chart_table(rows, "day", "period", ["Background", "Pre-fire", "Post-fire"], "nbr")
    return out.select("day", F.col("Background").alias("background"), F.col("Pre-fire").alias("pre_fire"), F.col("Post-fire").alias("post_fire"))


def bbox_semijoin(spark: SparkSession, folder: str) -> DataFrame:
    """Points inside the rectangle of their fire, of fires whose rectangle touches one region."""
    fires = _fires(spark, folder).where(bbox_overlap(*REGION)).select("entity", "xmin", "ymin", "xmax", "ymax")
    points = one_delivery(table(spark, folder, "training_locations").select("point_id", "fire_id", "lon", "lat", "loaded_at"), "point_id").withColumn("n", fire_number("fire_id"))
    f = fires.alias("f")
    inside = (F.col("n") == F.col("f.entity")) & F.col("lon").between(F.col("f.xmin"), F.col("f.xmax")) & F.col("lat").between(F.col("f.ymin"), F.col("f.ymax"))
    return points.join(f, inside, "left_semi").select("point_id")


REGION = (-72.5, -44.0, -69.0, -40.0)


def point_lookup(spark: SparkSession, folder: str) -> DataFrame:
    points = one_delivery(table(spark, folder, "training_locations").select("point_id", "pixel_id", "loaded_at"), "point_id")
    return S.point_means(S.of_points(_rows(spark, folder), table(spark, folder, "training_locations")).distinct(), points, "nbr").select("point_id", "n", F.round("nbr", ROUND).alias("nbr"))


def point_chart(spark: SparkSession, folder: str) -> DataFrame:
    """Charted series of every labelled point: day, mean nbr, period by the windows of its fire."""
    points = one_delivery(table(spark, folder, "training_locations").select("point_id", "pixel_id", "fire_id", "loaded_at"), "point_id").withColumn("entity", fire_number("fire_id"))
    points = Tr.left_lookup(points, _fires(spark, folder).select("entity", "pre_lwr", "pre_upr", "post_lwr", "post_end"), "entity").drop("fire_id", "loaded_at")
    obs = S.of_points(_rows(spark, folder), table(spark, folder, "training_locations")).distinct()
    period = D.period_tag(F.col("day"), F.col("pre_lwr"), F.col("pre_upr"), F.col("post_lwr"), F.col("post_end"))
    chart = S.point_series(obs, points, day=F.col("day"), nbr="nbr", period=period)
    return chart.select("point_id", "date", "period", F.round("nbr", ROUND).alias("nbr"))


CLICK = (-71.5, -42.5)


def click_panel(spark: SparkSession, folder: str) -> DataFrame:
    """What a click on the map shows: the chart of the nearest labelled pixel, in its fire's periods, with its axis."""
    points = table(spark, folder, "training_locations").select("point_id", "pixel_id", "fire_id", "lon", "lat")
    pixel = S.nearest_pixel(points, *CLICK)
    place = points.join(F.broadcast(pixel), "pixel_id").groupBy("pixel_id").agg(F.min_by("fire_id", "point_id").alias("fire_id"))
    place = place.select(F.lit(0).alias("point_id"), "pixel_id", fire_number("fire_id").alias("entity"))
    place = Tr.left_lookup(place, _fires(spark, folder).select("entity", "pre_lwr", "pre_upr", "post_lwr", "post_end"), "entity")
    obs = _rows(spark, folder).join(F.broadcast(pixel), "pixel_id", "left_semi").distinct()
    period = D.period_tag(F.col("day"), F.col("pre_lwr"), F.col("pre_upr"), F.col("post_lwr"), F.col("post_end"))
    chart = S.panel(S.point_series(obs, place, day=F.col("day"), nbr="nbr", period=period))
    return chart.select("date", "period", *[F.round(c, ROUND).alias(c) for c in ("nbr", "y_min", "y_max")])


# Four sensors by order number, scenes and their rectangles from orders, a region of parts.
SENSOR_OF = ["LT05", "LE07", "LC08", "LC09"]
RECTANGLE = ["CAST(o_custkey % 97 AS DOUBLE) / 10 - 75", "CAST(o_custkey % 89 AS DOUBLE) / 10 - 48", "CAST(o_custkey % 97 AS DOUBLE) / 10 - 74", "CAST(o_custkey % 89 AS DOUBLE) / 10 - 47"]


def _scenes(spark: SparkSession, folder: str) -> DataFrame:
    corners = [F.expr(e).alias(c) for e, c in zip(RECTANGLE, ("xmin", "ymin", "xmax", "ymax"))]
    sensor = F.element_at(F.array(*[F.lit(s) for s in SENSOR_OF]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return table(spark, folder, "orders").select(F.col("o_orderkey").cast("string").alias("scene_id"), sensor.alias("sensor"), F.col("o_orderdate").cast("timestamp").alias("time_start"), *corners)


def landsat_region(spark: SparkSession, folder: str) -> DataFrame:
    """All four sensors in one region: scenes whose rectangle touches it, and of these the pixels inside."""
    lines = table(spark, folder, "lineitem")
    keys = [F.col("l_partkey").alias("pixel_id"), F.col("l_orderkey").cast("string").alias("scene_id"), F.col("l_shipdate").alias("ts"), (F.col("l_orderkey") % 256).alias("QA_PIXEL")]

    def of(k: int, sensor: str) -> DataFrame:
        names = TM_BANDS if sensor in ("LT05", "LE07") else OLI_BANDS
        numbers = [F.expr(NUMBERS[b]).cast("int").alias(n) for b, n in zip(OPTICAL, names)]
        return lines.where(F.col("l_orderkey") % 4 == k).select(*keys, F.lit(sensor).alias("sensor"), *numbers)

    pixels = table(spark, folder, "part").where("p_size <= 25").select(F.col("p_partkey").alias("pixel_id"))
    raw = {s: of(k, s) for k, s in enumerate(SENSOR_OF)}
    out = P.get_landsat(raw, BEGIN, END, I.add_nbr_ndvi, scenes=_scenes(spark, folder), roi=REGION, roi_pixels=pixels)
    return out.select("scene_id", "pixel_id", "sensor", *[F.col(b).cast("double").alias(b) for b in ("nir", "swir2")], "nbr", "ndvi")


def scene_period(spark: SparkSession, folder: str) -> DataFrame:
    """Each scene's period next to the values of its pixels."""
    bounds = [F.lit(d).cast("timestamp") for d in SCENE_PERIODS]
    scenes = _scenes(spark, folder).withColumn("period", D.period_tag(F.col("time_start"), *bounds))
    values = table(spark, folder, "lineitem").select(F.col("l_orderkey").cast("string").alias("scene_id"), F.col("l_partkey").alias("pixel_id"), "l_linenumber")
    return P.with_scene(values, scenes, "sensor", "period").select("scene_id", "pixel_id", "l_linenumber", "sensor", "period")


SCENE_PERIODS = ("1995-01-01", "1996-06-30", "1997-03-01", "1998-08-02")


def lulc_legend(spark: SparkSession, folder: str) -> DataFrame:
    """Every pixel's cover in each year by name, counted; codes that the legend lacks have a null name."""
    rows = L.to_long(table(spark, folder, "lulc_wide")).groupBy("year", "class").count()
    return L.with_names(rows).select("year", "class", "name", F.col("count").alias("n"))


def annual_mosaic(spark: SparkSession, folder: str) -> DataFrame:
    """Mosaic of an annual burned-area product in a region."""
    roi = table(spark, folder, "training_locations").where("class = 'unburned'")
    return B.product_mosaic(B.annual_images(table(spark, folder, "burn_month")), "burn_date", roi_pixels=roi)


def calendar_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Calendar years around the year of each catalogued fire, for its series."""
    begin, end = D.calendar_window(F.year("pre_upr"))
    return Tr.fire_catalogue(spark).select("fire_id", begin.alias("begin"), end.alias("end"))


def one_fire(spark: SparkSession, folder: str) -> DataFrame:
    """The metadata of one fire, from its id alone."""
    fires = D.with_windows(Tr.fire_catalogue(spark))
    found = Tr.one_fire(fires, "fire_07")
    return spark.createDataFrame([(found["fire_id"], found["description"], found["pre_lwr"], found["post_end"])], "fire_id string, description string, pre_lwr date, post_end date")


def export_points(spark: SparkSession, folder: str) -> DataFrame:
    """The points of each fire in a folder of its own, and as CSV; read back from both."""
    points = table(spark, folder, "training_locations").select("point_id", fire_label(fire_number("fire_id")).alias("fire_id"), "lon").distinct()
    place = scratch_folder(spark, "export_points")
    write_table(points, f"{place}/parquet", ["fire_id"])
    write_csv(points, f"{place}/csv")
    a = spark.read.parquet(f"{place}/parquet").select("point_id", F.col("fire_id").cast("string").alias("fire_id"), "lon", F.lit("parquet").alias("form"))
    b = spark.read.schema("point_id bigint, fire_id string, lon double").option("header", True).csv(f"{place}/csv").withColumn("form", F.lit("csv"))
    return a.unionByName(b)


def points_union_meta(spark: SparkSession, folder: str) -> DataFrame:
    """Burned and unburned points with the catalogue's columns of their fire on each row."""
    points = one_delivery(table(spark, folder, "training_locations").select("point_id", "class", "fire_id", "author", "loaded_at"), "point_id").withColumn("fire_id", fire_label(fire_number("fire_id"), 2))
    points = points.drop("loaded_at")
    both = Tr.label_points(points.where("class = 'burned'"), points.where("class = 'unburned'"))
    fires = D.with_windows(Tr.fire_catalogue(spark)).select("fire_id", "polygon_id", "description", "pre_lwr", "pre_upr", "post_lwr", "post_upr_long", "post_upr_short")
    polygons = Tr.fire_catalogue(spark).where("polygon_id is not null").select(F.col("polygon_id").alias("fire_id"))
    out = Tr.with_fire(both, fires, polygons)
    return out.select("point_id", "class", "fire_id", "polygon_id", "description", "pre_lwr", "pre_upr", "post_lwr", "post_upr_long", "post_upr_short", "has_polygon")


def stream_days(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a stream: days per kind that the watermark has closed, from the files that the stream wrote."""
    path = f"{folder}/events.parquet*"
    stream = stream_table(spark, path, spark.read.parquet(path).schema).withColumn("ts", F.col("ts").cast("timestamp"))
    days = windowed_summary(stream, ts="ts", by=["event_type"], value="value", width="1 day", lateness=f"{LATE_HOURS} hours")
    place = scratch_folder(spark, "stream_days")
    run_to_end(days, f"{place}/out", f"{place}/state")
    return spark.read.schema(days.schema).parquet(f"{place}/out").select("event_type", F.col("start").cast("date").alias("day"), "n", F.round("mean", 9).alias("mean"), "low", "high")


LATE_HOURS = 6

QUERIES = {
    "ts_features": ts_features,
    "ts_features_array": ts_features_array,
    "qa_mask": qa_mask,
    "harmonize_union": harmonize_union,
    "landsat_indices": landsat_indices,
    "median_composite": median_composite,
    "spectral_indices": spectral_indices,
    "index_select_fn": index_select_fn,
    "ndfi": ndfi,
    "expression_index": expression_index,
    "period_tag": period_tag,
    "fire_dnbr": fire_dnbr,
    "dnbr_windows": dnbr_windows,
    "catalog_windows": catalog_windows,
    "fire_range_join": fire_range_join,
    "frac_year": frac_year,
    "burn_year": burn_year,
    "burn_by_year": burn_by_year,
    "burn_mosaic": burn_mosaic,
    "mosaic_last_valid": mosaic_last_valid,
    "lulc_reclass_a": _long(SCHEME_A),
    "lulc_reclass_b": _long(SCHEME_B),
    "lulc_unpivot_year": lulc_unpivot_year,
    "lulc_year": lulc_year,
    "veg_at_fire": veg_at_fire,
    "series_limits": series_limits,
    "chart_pivot": chart_pivot,
    "bbox_semijoin": bbox_semijoin,
    "point_lookup": point_lookup,
    "point_chart": point_chart,
    "points_union_meta": points_union_meta,
    "click_panel": click_panel,
    "stream_days": stream_days,
    "landsat_region": landsat_region,
    "scene_period": scene_period,
    "lulc_legend": lulc_legend,
    "annual_mosaic": annual_mosaic,
    "calendar_windows": calendar_windows,
    "one_fire": one_fire,
    "export_points": export_points,
}


def _sensor_sql(number: str) -> str:
    return f"CASE {number} % 4 " + " ".join(f"WHEN {k} THEN '{s}'" for k, s in enumerate(SENSOR_OF)) + " END"


def _region_sql() -> str:
    bands = []
    for b, slope, add in zip(OPTICAL, SLOPES, INTERCEPTS):
        dn = f"(CAST({NUMBERS[b]} AS DOUBLE) * CAST(0.0000275 AS DOUBLE) + CAST(-0.2 AS DOUBLE))"
        bands.append(f"CAST(CAST(CASE WHEN l_orderkey % 4 < 2 THEN {dn} * CAST({slope} AS DOUBLE) + CAST({add} AS DOUBLE) ELSE {dn} END AS FLOAT) AS DOUBLE) AS {b}")
    x0, y0, x1, y1 = RECTANGLE
    return f"""WITH s AS (SELECT o_orderkey FROM orders WHERE {x0} <= {REGION[2]}::DOUBLE AND {x1} >= {REGION[0]}::DOUBLE AND {y0} <= {REGION[3]}::DOUBLE AND {y1} >= {REGION[1]}::DOUBLE),
o AS (SELECT CAST(l_orderkey AS VARCHAR) AS scene_id, l_partkey AS pixel_id, {_sensor_sql("l_orderkey")} AS sensor, {", ".join(bands)} FROM lineitem
  WHERE (l_orderkey % 256) & 186 = 0 AND l_shipdate >= TIMESTAMP '{BEGIN}' AND l_shipdate < TIMESTAMP '{END}' AND l_orderkey IN (SELECT o_orderkey FROM s) AND l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 25))
SELECT scene_id, pixel_id, sensor, nir, swir2, {_index_list(["nbr", "ndvi"])} FROM o"""


POINTS_SQL = f"points AS (SELECT *, {FIRE_SQL.format('fire_id')} AS k FROM training_locations QUALIFY row_number() OVER (PARTITION BY point_id ORDER BY loaded_at) = 1)"
BURN_SQL = "b AS (SELECT pixel_id, CAST(year(ts) AS SMALLINT) AS y FROM burn_month WHERE burn_date > 0 AND ts >= TIMESTAMP '2001-01-01' AND ts < TIMESTAMP '2026-01-01')"

SQL = {
    "ts_features": FEATURES_SQL,
    "ts_features_array": FEATURES_SQL,
    "qa_mask": "SELECT event_id FROM events WHERE event_id & 186 = 0",
    "harmonize_union": f"WITH {_obs_sql()} SELECT scene_id, sensor, {', '.join(OPTICAL)}, {INDEX_SQL['nbr']} AS nbr FROM obs",
    "landsat_indices": f"WITH {_obs_sql()} SELECT scene_id, {_index_list(list(INDEX_SQL))} FROM obs",
    "median_composite": f"WITH {_obs_sql()}, x AS (SELECT *, {INDEX_SQL['nbr']} AS nbr FROM obs) SELECT pixel_id, sensor, "
    + ", ".join(f"round(median({b}), {ROUND}) AS {b}" for b in [*OPTICAL, "nbr"])
    + " FROM x GROUP BY pixel_id, sensor",
    "spectral_indices": f"WITH {VECTOR_SQL} SELECT vec_id, {_index_list(list(INDEX_SQL))} FROM v",
    "index_select_fn": f"WITH {VECTOR_SQL} SELECT vec_id, 'nbr' AS fn, {_index_list(['nbr'])}, CAST(NULL AS DOUBLE) AS ndvi FROM v UNION ALL SELECT vec_id, 'nbr_ndvi', {_index_list(['nbr', 'ndvi'])} FROM v",
    "ndfi": _ndfi_sql(),
    "expression_index": f"WITH {VECTOR_SQL} SELECT vec_id, round({INDEX_SQL['mirbi']}, {ROUND}) AS mirbi, round(pow(0.1 - red, 2) + pow(0.06 - nir, 2), {ROUND}) AS burn FROM v",
    "period_tag": f"SELECT event_id, CASE WHEN ts BETWEEN TIMESTAMP '{PRE[0]}' AND TIMESTAMP '{PRE[1]}' THEN 'Pre-fire' WHEN ts BETWEEN TIMESTAMP '{POST[0]}' AND TIMESTAMP '{POST[1]}' THEN 'Post-fire' ELSE 'Background' END AS period FROM events",
    "fire_dnbr": f"""WITH {READINGS_SQL}, {FIRES_SQL},
m AS (SELECT r.pixel_id, median(CASE WHEN day >= pre_lwr AND day < pre_end THEN nbr END) AS a, median(CASE WHEN day >= post_lwr AND day < post_end THEN nbr END) AS b
  FROM (SELECT *, {FIRE_SQL.format("fire_id")} AS k FROM readings) r LEFT JOIN fires f ON r.k = f.entity GROUP BY r.pixel_id)
SELECT pixel_id, round(a, {ROUND}) AS nbr_pre, round(b, {ROUND}) AS nbr_post, round(a - b, {ROUND}) AS dnbr FROM m""",
    "dnbr_windows": "WITH m AS (SELECT user_id, "
    + ", ".join(f"median(CASE WHEN ts >= TIMESTAMP '{a}' AND ts < TIMESTAMP '{b}' THEN value END) AS {n}" for n, a, b in WINDOWS)
    + f" FROM events GROUP BY user_id) SELECT user_id, round(pre - post1, {ROUND}) AS dnbr1, round(pre - post2, {ROUND}) AS dnbr2 FROM m",
    "catalog_windows": CATALOG_SQL,
    "fire_range_join": f"WITH {_values()} SELECT o_orderkey, fire_id FROM orders JOIN c ON CAST(o_orderdate AS DATE) >= post_lwr AND CAST(o_orderdate AS DATE) < post_upr_long",
    "frac_year": f"WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders) SELECT o_orderkey, {FRAC_SQL.format('d')} AS frac_year, year(d) + CASE WHEN month(d) >= 7 THEN 1 ELSE 0 END AS fire_year FROM o",
    "burn_year": f"WITH {BURN_SQL} SELECT pixel_id, max(y) AS burn_year, min(y) AS first_burn_year FROM b GROUP BY pixel_id",
    "burn_by_year": f"WITH {BURN_SQL} SELECT DISTINCT pixel_id, y AS burn_year FROM b",
    "burn_mosaic": """SELECT pixel_id, arg_max(burn_date, row(ts, burn_date)) AS burn_date FROM burn_month WHERE burn_date IS NOT NULL AND ts >= TIMESTAMP '2001-01-01' AND ts < TIMESTAMP '2026-01-01'
AND pixel_id IN (SELECT pixel_id FROM training_locations WHERE class = 'burned') GROUP BY pixel_id""",
    "mosaic_last_valid": "SELECT user_id, arg_max(value, row(ts, event_id)) AS v FROM events WHERE event_type <> 'error' AND value IS NOT NULL GROUP BY user_id",
    "lulc_reclass_a": f"WITH {LONG_SQL} SELECT pixel_id, year, {_case('code', SCHEME_A)} AS class FROM w",
    "lulc_reclass_b": f"WITH {LONG_SQL} SELECT pixel_id, year, {_case('code', SCHEME_B)} AS class FROM w",
    "lulc_unpivot_year": "SELECT * FROM lulc_wide",
    "lulc_year": f"SELECT pixel_id, classification_2014 AS class, {_case('classification_2014', SCHEME_A)} AS class_a, {_case('classification_2014', SCHEME_B)} AS class_b FROM lulc_wide",
    "veg_at_fire": f"""WITH {POINTS_SQL}, {FIRES_SQL}, {LONG_SQL}, j AS (SELECT p.point_id, f.lulc_year, {_case('w.code', SCHEME_A)} AS class
FROM points p LEFT JOIN fires f ON p.k = f.entity LEFT JOIN w ON w.pixel_id = p.pixel_id AND w.year = f.lulc_year) SELECT point_id, lulc_year, class, class = 0 AS non_burnable FROM j""",
    "series_limits": f"WITH {READINGS_SQL}, m AS (SELECT pixel_id, min(nbr) AS lo, max(nbr) AS hi FROM readings GROUP BY pixel_id) SELECT pixel_id, round(lo - (hi - lo) * 0.2::DOUBLE, {ROUND}) AS y_min, round(hi + (hi - lo) * 0.2::DOUBLE, {ROUND}) AS y_max FROM m",
    "chart_pivot": f"""WITH {READINGS_SQL}, l AS (SELECT day, nbr, regexp_replace(lower(period), '[^a-z]', '', 'g') AS p FROM readings)
SELECT day, max(nbr) FILTER (p = 'background') AS background, max(nbr) FILTER (p = 'prefire') AS pre_fire, max(nbr) FILTER (p = 'postfire') AS post_fire FROM l GROUP BY day""",
    "bbox_semijoin": f"""WITH {POINTS_SQL}, {FIRES_SQL}, g AS (SELECT entity, xmin, ymin, xmax, ymax FROM lf WHERE xmin <= {REGION[2]} AND xmax >= {REGION[0]} AND ymin <= {REGION[3]} AND ymax >= {REGION[1]})
SELECT point_id FROM points p WHERE EXISTS (SELECT 1 FROM g WHERE g.entity = p.k AND p.lon BETWEEN xmin AND xmax AND p.lat BETWEEN ymin AND ymax)""",
    "point_lookup": f"""WITH {READINGS_SQL}, {POINTS_SQL}, m AS (SELECT pixel_id, count(*) AS n, avg(nbr) AS nbr FROM readings GROUP BY pixel_id)
SELECT point_id, coalesce(n, 0) AS n, round(nbr, {ROUND}) AS nbr FROM points LEFT JOIN m USING (pixel_id)""",
    "point_chart": f"""WITH {READINGS_SQL}, {POINTS_SQL}, {FIRES_SQL}, pf AS (SELECT p.point_id, p.pixel_id, f.* FROM points p LEFT JOIN fires f ON p.k = f.entity)
SELECT point_id, strftime(day, '%Y-%m-%d') AS date, CASE WHEN day BETWEEN pre_lwr AND pre_upr THEN 'Pre-fire' WHEN day BETWEEN post_lwr AND post_end THEN 'Post-fire' ELSE 'Background' END AS period,
  round(avg(nbr), {ROUND}) AS nbr FROM pf JOIN readings r ON r.pixel_id = pf.pixel_id GROUP BY ALL""",
    "points_union_meta": f"""WITH {POINTS_SQL}, {_values()} SELECT point_id, class, CASE WHEN k IS NULL THEN NULL ELSE printf('fire_%02d', k) END AS fire_id, c.polygon_id, c.description,
CAST(c.pre_upr + 1 - INTERVAL 12 MONTH AS DATE) AS pre_lwr, c.pre_upr, c.post_lwr, c.post_upr_long, c.post_upr_short, c.polygon_id IS NOT NULL AS has_polygon
FROM points p LEFT JOIN c ON c.fire_id = printf('fire_%02d', p.k) WHERE class IN ('burned', 'unburned')""",
    "stream_days": f"""WITH d AS (SELECT event_type, date_trunc('day', ts)::TIMESTAMP AS start, value FROM events)
SELECT event_type, CAST(start AS DATE) AS day, count(value) AS n, round(avg(value), 9) AS mean, min(value) AS low, max(value) AS high FROM d
WHERE start + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL {LATE_HOURS} HOUR FROM events) GROUP BY event_type, start""",
    "click_panel": f"""WITH {READINGS_SQL}, {FIRES_SQL}, n AS (SELECT pixel_id FROM training_locations WHERE lon IS NOT NULL AND lat IS NOT NULL AND pixel_id IS NOT NULL
  ORDER BY pow(lon - ({CLICK[0]}::DOUBLE), 2) + pow(lat - ({CLICK[1]}::DOUBLE), 2), pixel_id LIMIT 1),
p AS (SELECT pixel_id, {FIRE_SQL.format("min_by(fire_id, point_id)")} AS k FROM training_locations JOIN n USING (pixel_id) GROUP BY pixel_id),
c AS (SELECT strftime(day, '%Y-%m-%d') AS date, CASE WHEN day BETWEEN pre_lwr AND pre_upr THEN 'Pre-fire' WHEN day BETWEEN post_lwr AND post_end THEN 'Post-fire' ELSE 'Background' END AS period, avg(nbr) AS nbr
  FROM p LEFT JOIN fires f ON p.k = f.entity JOIN readings r ON r.pixel_id = p.pixel_id GROUP BY ALL),
l AS (SELECT min(nbr) AS lo, max(nbr) AS hi FROM c)
SELECT date, period, round(nbr, {ROUND}) AS nbr, round(lo - (hi - lo) * 0.2::DOUBLE, {ROUND}) AS y_min, round(hi + (hi - lo) * 0.2::DOUBLE, {ROUND}) AS y_max FROM c, l""",
    "landsat_region": _region_sql(),
    "scene_period": f"""SELECT CAST(l_orderkey AS VARCHAR) AS scene_id, l_partkey AS pixel_id, l_linenumber, {_sensor_sql("o_orderkey")} AS sensor, CASE WHEN o_orderkey IS NULL THEN NULL
WHEN o_orderdate BETWEEN TIMESTAMP '{SCENE_PERIODS[0]}' AND TIMESTAMP '{SCENE_PERIODS[1]}' THEN 'Pre-fire' WHEN o_orderdate BETWEEN TIMESTAMP '{SCENE_PERIODS[2]}' AND TIMESTAMP '{SCENE_PERIODS[3]}' THEN 'Post-fire' ELSE 'Background' END AS period
FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey""",
    "lulc_legend": f"WITH {LONG_SQL}, g AS (SELECT * FROM (VALUES {', '.join(str((c, n)) for c, n, _, _ in LEGEND)}) AS x(code, name)) SELECT year, code AS class, name, count(*) AS n FROM w LEFT JOIN g USING (code) GROUP BY ALL",
    "annual_mosaic": """SELECT pixel_id, arg_max(burn_date, row(year(ts), burn_date)) AS burn_date FROM burn_month WHERE burn_date > 0
AND pixel_id IN (SELECT pixel_id FROM training_locations WHERE class = 'unburned') GROUP BY pixel_id""",
    "calendar_windows": f'WITH {_values()} SELECT fire_id, make_date(year(pre_upr) - 1, 1, 1) AS begin, make_date(year(pre_upr) + 2, 1, 1) AS "end" FROM c',
    "one_fire": "SELECT 'fire_07' AS fire_id, 'alerces_15' AS description, DATE '2014-03-19' AS pre_lwr, DATE '2016-01-01' AS post_end",
    "export_points": f"""WITH p AS (SELECT DISTINCT point_id, {FIRE_SQL.format("fire_id")} AS k, lon FROM training_locations)
SELECT point_id, CASE WHEN k IS NOT NULL THEN printf('fire_%03d', k) END AS fire_id, lon, form FROM p CROSS JOIN (VALUES ('parquet'), ('csv')) f(form)""",
}

"""Queries of the general training-data problems (1, 2 and 5) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import fire_number, parse_date
from ..operators.asof import asof_join
from ..operators.grid import monthly_grid
from ..operators.spikes import flag_faults
from ..sources.tables import table

REVISION = ["revision_id", "polygon_id", "description", "pre_upr", "post_lwr", "post_upr_long", "post_upr_short"]


def _points_asof(spark: SparkSession, points: DataFrame, folder: str) -> DataFrame:
    return asof_join(
        points,
        table(spark, folder, "training_fires"),
        event_entity=fire_number("fire_id"),
        event_time="saved_at",
        entity=fire_number("fire_id"),
        valid_from="valid_from",
        known_at="recorded_at",
        attributes=REVISION,
    )


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Redelivered points find the same revision, so they are made one at the end."""
    points = table(spark, folder, "training_locations").select("point_id", "fire_id", "saved_at")
    return _points_asof(spark, points, folder).where("asof_revision_id is not null").select("point_id", F.col("asof_revision_id").alias("revision_id")).distinct()


def p1_asof(spark: SparkSession, folder: str) -> DataFrame:
    """Every point, with the pre_upr in force for it or null."""
    points = table(spark, folder, "training_locations").select("point_id", "fire_id", "saved_at").distinct()
    return _points_asof(spark, points, folder).select("point_id", F.col("asof_revision_id").alias("revision_id"), F.col("asof_pre_upr").alias("pre_upr"))


def p2_faults(spark: SparkSession, folder: str) -> DataFrame:
    return flag_faults(table(spark, folder, "chart_rows"), source="pixel_id", day=parse_date("date"), value="nbr", key="obs_id")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return p2_faults(spark, folder).select("obs_id")


def p2_bounds_stuck(spark: SparkSession, folder: str) -> DataFrame:
    """Impossible and stuck readings alone."""
    return p2_faults(spark, folder).where("fault <> 'spike'")


BOUNDS = ("2017-07", "2023-06")
DIGITS = 12  # of means, which sum in no fixed order


def _grid(spark: SparkSession, folder: str, **more) -> DataFrame:
    return monthly_grid(table(spark, folder, "chart_rows"), source="pixel_id", day=parse_date("date"), value="nbr", key="obs_id", **more)


def p5_grid(spark: SparkSession, folder: str) -> DataFrame:
    """Every month with its mean or interpolated value. Infinite and very large values are readings too, so sums are left as
    they are where a month or gap has one beyond a thousand."""
    value = F.when(F.abs("value") < 1_000, F.round("value", DIGITS))
    return _grid(spark, folder).select("pixel_id", "month", value.alias("value"), "n_readings", "state")


def p5_states(spark: SparkSession, folder: str) -> DataFrame:
    return _grid(spark, folder).select("pixel_id", "month", "n_readings", "state")


def p5_bounds(spark: SparkSession, folder: str) -> DataFrame:
    """The grid of every pixel from one month to another, months outside its readings marked."""
    return _grid(spark, folder, bounds=BOUNDS).select("pixel_id", "month", "n_readings", "state")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return _grid(spark, folder).where("n_readings = 0").select("pixel_id", "month")


FIRE_SQL = "try_cast(nullif(regexp_extract({}, '([0-9]+)', 1), '') AS BIGINT)"

DAY_SQL = """CASE
  WHEN regexp_matches(s, '^\\d{4}-\\d\\d-\\d\\d([T ].*)?$') THEN try_cast(s[1:10] AS DATE)
  WHEN regexp_matches(s, '^\\d{1,2}/\\d{1,2}/\\d{4}$') THEN try_cast(split_part(s, '/', 3) || '-' || split_part(s, '/', 2) || '-' || split_part(s, '/', 1) AS DATE)
  WHEN regexp_matches(s, '^\\d{4}/\\d\\d/\\d\\d$') THEN try_cast(replace(s, '/', '-') AS DATE)
  WHEN regexp_matches(s, '^\\d{8}$') THEN try_cast(s[1:4] || '-' || s[5:6] || '-' || s[7:8] AS DATE)
  WHEN regexp_matches(s, '^\\d{4}-\\d{3}$') THEN CASE WHEN year(try_cast(s[1:4] || '-01-01' AS DATE) + (s[6:8]::INT - 1)) = s[1:4]::INT
    THEN try_cast(s[1:4] || '-01-01' AS DATE) + (s[6:8]::INT - 1) END
  WHEN regexp_matches(s, '^\\d{1,2}-\\d{1,2}-\\d{4}$') THEN try_cast(split_part(s, '-', 3) || '-' || split_part(s, '-', 2) || '-' || split_part(s, '-', 1) AS DATE)
END"""

ASOF_SQL = f"""
WITH p AS (SELECT DISTINCT point_id, saved_at, {FIRE_SQL.format("fire_id")} AS n FROM training_locations),
r AS (SELECT DISTINCT revision_id, pre_upr, valid_from, recorded_at, {FIRE_SQL.format("fire_id")} AS n FROM training_fires),
m AS (SELECT p.point_id, r.revision_id, r.pre_upr,
        row_number() OVER (PARTITION BY p.point_id ORDER BY r.valid_from DESC, r.recorded_at DESC, r.revision_id DESC) AS k
      FROM p JOIN r ON p.n = r.n AND r.valid_from <= p.saved_at AND r.recorded_at <= p.saved_at)
"""

MONTHS_SQL = f"""
WITH t AS (SELECT DISTINCT pixel_id, obs_id, nbr, trim(date, ' \t\n\r' || chr(160)) AS s FROM chart_rows WHERE nbr IS NOT NULL AND NOT isnan(nbr) AND pixel_id IS NOT NULL),
d AS (SELECT pixel_id, obs_id, nbr, {DAY_SQL} AS d FROM t),
m AS (SELECT pixel_id, year(d) * 12 + month(d) - 1 AS m, count(*) AS n, avg(nbr) AS v FROM d WHERE d IS NOT NULL GROUP BY pixel_id, m),
g AS (SELECT pixel_id, m, n, v, lead(m) OVER w AS m2, lead(v) OVER w AS v2, lag(m) OVER w AS m0 FROM m WINDOW w AS (PARTITION BY pixel_id ORDER BY m)),
f AS (SELECT pixel_id, m AS m1, unnest(range(m + 1, m2)) AS m, m2 - m - 1 AS gap, v, v2 FROM g WHERE m2 > m + 1)
"""

QUERIES = {"p1_found": p1_found, "p1_asof": p1_asof, "p2_found": p2_found, "p2_faults": p2_faults, "p2_bounds_stuck": p2_bounds_stuck, "p5_found": p5_found, "p5_states": p5_states, "p5_grid": p5_grid, "p5_bounds": p5_bounds}

SQL = {
    "p1_found": ASOF_SQL + "SELECT point_id, revision_id FROM m WHERE k = 1",
    "p1_asof": ASOF_SQL + "SELECT p.point_id, m.revision_id, m.pre_upr FROM p LEFT JOIN m ON m.point_id = p.point_id AND m.k = 1",
    "p2_bounds_stuck": f"""
WITH t AS (SELECT DISTINCT pixel_id, obs_id, nbr, trim(date, ' \t\n\r' || chr(160)) AS s FROM chart_rows WHERE nbr IS NOT NULL),
d AS (SELECT pixel_id, obs_id, nbr, {DAY_SQL} AS d FROM t WHERE nbr BETWEEN -1 AND 1),
c AS (SELECT pixel_id, obs_id, d, CASE WHEN round(nbr, 6) = lag(round(nbr, 6)) OVER (PARTITION BY pixel_id ORDER BY d, obs_id) THEN 0 ELSE 1 END AS fresh FROM d WHERE d IS NOT NULL AND pixel_id IS NOT NULL),
r AS (SELECT pixel_id, obs_id, sum(fresh) OVER (PARTITION BY pixel_id ORDER BY d, obs_id) AS run FROM c)
SELECT obs_id, 'stuck' AS fault FROM r QUALIFY count(*) OVER (PARTITION BY pixel_id, run) >= 8
UNION ALL SELECT DISTINCT obs_id, 'bounds' FROM t WHERE isnan(nbr) OR nbr NOT BETWEEN -1 AND 1""",
    "p5_found": MONTHS_SQL + "SELECT pixel_id, printf('%04d-%02d', m // 12, m % 12 + 1) AS month FROM f",
    "p5_states": MONTHS_SQL
    + """SELECT pixel_id, printf('%04d-%02d', m // 12, m % 12 + 1) AS month, n AS n_readings, 'read' AS state FROM m
UNION ALL SELECT pixel_id, printf('%04d-%02d', m // 12, m % 12 + 1), 0, CASE WHEN gap <= 3 THEN 'filled' ELSE 'missing' END FROM f""",
    "p5_grid": MONTHS_SQL
    + f""", o AS (SELECT pixel_id, m, v, n AS n_readings, 'read' AS state FROM m UNION ALL SELECT pixel_id, m, CASE WHEN gap <= 3 THEN v + (v2 - v) * (m - m1) / (gap + 1) END, 0, CASE WHEN gap <= 3 THEN 'filled' ELSE 'missing' END FROM f)
SELECT pixel_id, printf('%04d-%02d', m // 12, m % 12 + 1) AS month, CASE WHEN abs(v) < 1000 THEN round(v, {DIGITS}) END AS value, n_readings, state FROM o""",
    "p5_bounds": MONTHS_SQL
    + f""", b AS (SELECT {int(BOUNDS[0][:4]) * 12 + int(BOUNDS[0][5:]) - 1} AS lo, {int(BOUNDS[1][:4]) * 12 + int(BOUNDS[1][5:]) - 1} AS hi),
o AS (SELECT pixel_id, m, n AS n_readings, 'read' AS state FROM m UNION ALL SELECT pixel_id, m, 0, CASE WHEN gap <= 3 THEN 'filled' ELSE 'missing' END FROM f
UNION ALL SELECT pixel_id, unnest(range(lo, m)), 0, 'outside' FROM g, b WHERE m0 IS NULL UNION ALL SELECT pixel_id, unnest(range(m + 1, hi + 1)), 0, 'outside' FROM g, b WHERE m2 IS NULL)
SELECT pixel_id, printf('%04d-%02d', m // 12, m % 12 + 1) AS month, n_readings, state FROM o""",
}

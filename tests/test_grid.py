import math

from pyspark.sql import functions as F

from cinderline.functions.text import parse_date
from cinderline.operators.grid import monthly_grid

SCHEMA = "obs_id bigint, pixel_id bigint, date string, nbr double, month string, state string"


def grid(spark, rows, **more):
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)
    out = monthly_grid(df, source="pixel_id", day=parse_date("date"), value="nbr", key="obs_id", **more)
    assert out.columns == ["pixel_id", "month", "value", "n_readings", "state"]
    return sorted([(r.pixel_id, r.month, None if r.value is None else round(r.value, 6), r.n_readings, r.state) for r in out.collect()])


def test_gaps_are_filled_or_marked(spark):
    rows = [(1, 7, "2000-11-03", 0.1), (2, 7, "2000-11-20", 0.3), (3, 7, "2001-02-01", 0.5), (4, 7, "2001-07-01", 0.7)]
    assert grid(spark, rows) == [
        (7, "2000-11", 0.2, 2, "read"),
        (7, "2000-12", 0.3, 0, "filled"),
        (7, "2001-01", 0.4, 0, "filled"),
        (7, "2001-02", 0.5, 1, "read"),
        (7, "2001-03", None, 0, "missing"),
        (7, "2001-04", None, 0, "missing"),
        (7, "2001-05", None, 0, "missing"),
        (7, "2001-06", None, 0, "missing"),
        (7, "2001-07", 0.7, 1, "read"),
    ]


def test_bounds(spark):
    rows = [(1, 7, "2001-02-01", 0.5), (2, 7, "2001-04-01", 0.7), (3, 8, "2001-03-31", 0.1)]
    got = grid(spark, rows, bounds=("2001-01", "2001-05"))
    assert [(p, m, s) for p, m, _, _, s in got] == [
        (7, "2001-01", "outside"), (7, "2001-02", "read"), (7, "2001-03", "filled"), (7, "2001-04", "read"), (7, "2001-05", "outside"),
        (8, "2001-01", "outside"), (8, "2001-02", "outside"), (8, "2001-03", "read"), (8, "2001-04", "outside"), (8, "2001-05", "outside"),
    ]
    assert len(grid(spark, rows, bounds=("2001-03", "2001-03"))) == 4


def test_dirty_rows(spark):
    rows = [(1, 7, "2001-02-01", 0.5), (1, 7, "2001-02-01", 0.5), (2, 7, "2001-02-02", 0.7), (None, 7, "2001-02-03", 0.6), (None, 7, "2001-02-03", 0.6)]
    rows += [(3, 7, None, 0.5), (4, 7, "NaT", 0.5), (5, 7, "2005-01-01", None), (6, 7, "2005-01-01", math.nan), (7, None, "2001-01-01", 0.5)]
    assert grid(spark, rows) == [(7, "2001-02", 0.6, 4, "read")]
    assert grid(spark, []) == []


def test_infinite_values_are_readings(spark):
    assert [r[1:2] + r[3:] for r in grid(spark, [(1, 7, "2001-02-01", math.inf), (2, 7, "2001-04-01", 0.1)])] == [("2001-02", 1, "read"), ("2001-03", 0, "filled"), ("2001-04", 1, "read")]

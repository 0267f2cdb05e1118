import datetime as dt

from pyspark.sql import functions as F

from cinderline.functions.text import fire_label, fire_number, fold_accents, parse_date, period_label


def column(spark, values, make):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", make(F.col("v")).alias("o")).orderBy("i").collect()
    return [r.o for r in rows]


def test_dates_of_all_layouts(spark):
    day = dt.date(2003, 2, 7)
    good = ["2003-02-07", " 2003-02-07 ", "2003-02-07T10:00:00Z", "2003/02/07", "20030207", "2003-038", "07/02/2003", "7-2-2003", "07-02-2003", " 2003-02-07", "7/2/2003"]
    assert column(spark, good, parse_date) == [day] * len(good)


def test_dates_that_are_none(spark):
    bad = [None, "", " ", "NaT", "sin fecha", "0000-00-00", "2003-02-30", "30/02/2003", "2003-366", "2003-000", "20031301", "2003", "2003-02", "x" * 10_000, "2003-0--07"]
    assert column(spark, bad, parse_date) == [None] * len(bad)
    assert column(spark, ["2004-366"], parse_date) == [dt.date(2004, 12, 31)]


def test_fire_numbers_and_labels(spark):
    assert column(spark, ["fire_007", "FIRE-7", " fire_7 ", "Fire_007 ", "fire_", "...", "", None], fire_number) == [7, 7, 7, 7, None, None, None, None]
    assert column(spark, ["1", "160", None], lambda c: fire_label(c.cast("bigint"))) == ["fire_001", "fire_160", None]


def test_period_labels(spark):
    assert column(spark, ["Pre-fire", "PRE_FIRE", "prefire", " Post-fire", "Background ", "x", "", None], period_label) == ["Pre-fire"] * 3 + ["Post-fire", "Background", None, None, None]


def test_accents(spark):
    assert column(spark, ["Ñandú", "é", "", None], fold_accents) == ["Nandu", "e", "", None]

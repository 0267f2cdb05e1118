import datetime as dt

import pytest
from pyspark.sql import functions as F

from cinderline.operators import burned, composite, indices, landcover, prep, series, timeutil, training
from cinderline.schema import OLI_BANDS, OPTICAL, SCHEME_A, SCHEME_B, TM_BANDS, raw_schema
from cinderline.sources.tables import bbox_overlap, one_delivery, one_record, write_csv, write_table

T0 = dt.datetime(2015, 1, 1)
HEALTHY, BURNED, NEGATIVE = [8400, 9200, 8900, 18200, 13100, 10100], [8900, 9500, 10100, 11800, 15200, 14900], [7300, 7600, 7200, 15000, 11000, 9000]
NAMES = ["nbr", "nbr2", "ndvi", "mirbi", "bai", "evi", "savi", "msi", "ndsi", "ndmi", "brightness", "greenness", "wetness"]
GOLDEN = [
    ("LC08", HEALTHY, [0.588896, 0.346639, 0.740768, 1.207050, 16.422299, 0.478395, 0.453860, 0.533278, -0.502931, 0.304395, 0.309548, 0.171299, -0.017283]),
    ("LT05", HEALTHY, [0.542147, 0.315548, 0.727626, 1.224839, 17.151065, 0.452303, 0.443369, 0.570643, -0.516494, 0.273364, 0.312594, 0.166764, -0.029412]),
    ("LC09", BURNED, [-0.255049, 0.019287, 0.231150, 1.961100, 214.808351, 0.093100, 0.099858, 1.751004, -0.561325, -0.272993, 0.287135, 0.002185, -0.163987]),
    ("LE07", BURNED, [-0.172061, 0.029840, 0.314412, 1.916422, 124.280957, 0.132934, 0.145461, 1.502721, -0.567533, -0.200870, 0.297451, 0.021507, -0.158530]),
    ("LC08", NEGATIVE, [0.634615, 0.366667, None, 1.470500, 29.708633, 0.448792, 0.452850, 0.482353, -0.838565, 0.349206, 0.181729, 0.152962, -0.020973]),
]


def raw(spark, sensor, rows):
    """rows: pixel, ts, six numbers or None, qa."""
    bands = TM_BANDS if sensor in ("LT05", "LE07") else OLI_BANDS
    return spark.createDataFrame([(p, f"s{i}", sensor, ts, *(dn or [None] * 6), qa) for i, (p, ts, dn, qa) in enumerate(rows)], raw_schema(bands))


@pytest.mark.parametrize("sensor,numbers,expected", GOLDEN)
def test_indices_from_raw_numbers(spark, sensor, numbers, expected):
    got = prep.get_landsat({sensor: raw(spark, sensor, [(1, T0, numbers, 0)])}, "2015-01-01", "2015-01-02", indices.add_fire_indices)
    assert got.columns == [*prep.KEYS, *OPTICAL, *NAMES]
    row = got.first()
    for name, value in zip(NAMES, expected):
        assert row[name] is None if value is None else abs(row[name] - value) < 1e-4 * max(1, abs(value)), name


@pytest.mark.parametrize("qa,keep", [(0, 1), (1, 1), (2, 0), (4, 1), (8, 0), (16, 0), (32, 0), (64, 1), (128, 0), (21824, 1), (21952, 0)])
def test_quality_mask(spark, qa, keep):
    assert prep.mask_quality(raw(spark, "LC08", [(1, T0, HEALTHY, qa)])).count() == keep


def test_union_dates_and_regions(spark):
    rows = [(1, T0, HEALTHY, 0), (1, T0, HEALTHY, 0), (2, T0 + dt.timedelta(days=30), HEALTHY, 0), (3, T0, None, 0)]
    sources = {s: raw(spark, s, rows) for s in ("LC08", "LE07")}
    get = lambda **more: prep.get_landsat(sources, "2015-01-01", "2015-01-31", indices.add_nbr, **more)
    assert get().count() == 6
    assert get().where("pixel_id = 3 and nbr is not null").count() == 0
    scenes = spark.createDataFrame([("s0", 0.0, 0.0, 1.0, 1.0), ("s1", 5.0, 5.0, 6.0, 6.0)], "scene_id string, xmin double, ymin double, xmax double, ymax double")
    assert get(scenes=scenes, roi=(1.0, 1.0, 2.0, 2.0)).count() == 2
    assert get(roi_pixels=spark.createDataFrame([(3,)], "pixel_id bigint")).count() == 2
    assert scenes.where(bbox_overlap(7, 7, 8, 8)).count() == 0


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    write_table(raw(spark, "LC08", [(1, T0, HEALTHY, 0)]), f"{tmp_path}/raw")
    out = prep.get_landsat({"LC08": spark.read.parquet(f"{tmp_path}/raw")}, "2015-01-01", "2015-01-31", indices.add_fire_indices).select("pixel_id", "nbr")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "SR_B5" in plan and "SR_B2" not in plan and "Python" not in plan and "Exchange" not in plan


def test_division_by_zero_and_nulls(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, -1.0), (None, 1.0), (0.3, 0.1)], "a double, b double")
    got = [r[0] for r in df.select(indices.normalized_difference(F.col("a"), F.col("b"))).collect()]
    assert got[:3] == [0.0, None, None] and abs(got[3] - 0.5) < 1e-12
    assert [r[0] for r in df.select(indices.clamp(F.col("a"), 0.0, 0.5)).collect()] == [0.0, 0.5, None, 0.3]


def test_expression_texts(spark):
    df = spark.createDataFrame([(2.0, 3.0)], "nir double, red double")
    assert indices.expression(df, "x", "(1 - r) ** 2 + n ** 3 / 2", {"r": "red", "n": "nir"}).first().x == 8.0


def test_unmixing_has_no_shade():
    w = indices.unmixing_weights()
    assert max(abs(x) for x in w["shade"]) < 1e-9 and abs(w["gv"][3] - 1.7890567511) < 1e-6


SERIES = {
    1: ([0.60, 0.62, 0.58, 0.61, 0.10, 0.05, 0.08, 0.12, 0.15], (-0.51, 4, 0.505)),
    2: ([0.75, 0.5, 0.625, 0.375, 0.5, 0.5], (-0.25, 1, 0.25)),
    3: ([0.50, 0.52, 0.51, 0.50, 0.10], (-0.40, 4, None)),
    4: ([0.70, 0.10, 0.12, 0.11, 0.13, 0.20], (-0.60, 1, 0.575)),
    5: ([0.6, 0.1, 0.1, 0.1], None),
    6: ([0.10, 0.20, 0.25, 0.40, 0.60], (0.05, 2, -0.35)),
}


@pytest.mark.parametrize("kind", ["window", "array", "long"])
def test_series_features(spark, kind):
    rows = [(p, float(i), v, 100 * p + i) for p, (values, _) in SERIES.items() for i, v in enumerate(values)]
    rows += [(p, 0.5, None, 900 + p) for p in SERIES] + [(None, 1.0, 0.5, 999), (7, None, 0.5, 998)]
    if kind != "array":
        rows += rows[:20]
    df = spark.createDataFrame(rows[::-1], "pixel_id bigint, t double, nbr double, k bigint")
    fn, more = (series.ts_features_array, {}) if kind == "array" else (series.ts_features, {"key": "k"} | ({"max_series": 2} if kind == "long" else {}))
    got = {r.pixel_id: (round(r.max_drop, 9), r.date_drop, None if r.dnbr is None else round(r.dnbr, 9)) for r in fn(df, pixel="pixel_id", order=["t", "k"], time=F.col("t"), nbr="nbr", **more).collect()}
    assert got == {p: e for p, (_, e) in SERIES.items() if e}
    assert fn(df.limit(0), pixel="pixel_id", order=["t", "k"], time=F.col("t"), nbr="nbr", **more).count() == 0


def test_composites_and_mosaic(spark):
    df = spark.createDataFrame([(1, 1, 0.1), (1, 2, 0.2), (1, 3, None), (1, 4, 0.4), (1, 5, 0.9), (2, 1, 0.5), (2, 9, None)], "pixel_id bigint, t int, nbr double")
    assert {r.pixel_id: r.nbr for r in composite.median_composite(df, ["pixel_id"], ["nbr"]).collect()} == {1: pytest.approx(0.3), 2: 0.5}
    m = composite.dnbr(composite.window_medians(df, ["pixel_id"], {"pre": F.col("t") < 3, "post": F.col("t") >= 3}, ["nbr"]), "nbr_pre", "nbr_post")
    assert {r.pixel_id: r.dnbr for r in m.collect()} == {1: pytest.approx(-0.5), 2: None}
    assert {r.pixel_id: r.nbr for r in composite.mosaic(df, ["pixel_id"], "nbr", ["t"]).collect()} == {1: 0.9, 2: 0.5}
    limits = series.series_limits(spark.createDataFrame([(1, 0.1), (1, 0.6)], "pixel_id bigint, nbr double"), ["pixel_id"], "nbr").first()
    assert (round(limits.y_min, 9), round(limits.y_max, 9)) == (0.0, 0.7)


def test_burn_years(spark):
    rows = [(1, "2003-02-01", 40), (1, "2003-03-01", 0), (1, "2015-01-01", 12), (1, "1999-01-01", 9), (2, "2004-01-01", 0), (2, "2004-02-01", None)]
    df = spark.createDataFrame([(p, dt.datetime.fromisoformat(t), d) for p, t, d in rows + rows[:1]], "pixel_id bigint, ts timestamp, burn_date int")
    assert [tuple(r) for r in burned.burn_year(df).collect()] == [(1, 2015, 2003)]
    assert sorted(tuple(r) for r in burned.burn_by_year(df).collect()) == [(1, 2003), (1, 2015)]
    assert {r.pixel_id: r.burn_date for r in burned.product_mosaic(df, "burn_date").collect()} == {1: 12, 2: 0}


CODES = [3, 66, 6, 12, 11, 75, 63, 21, 9, 29, 25, 24, 33, 34, 27, 5, None]


def test_land_cover(spark):
    wide = spark.createDataFrame([(i, c, 3) for i, c in enumerate(CODES)], "pixel_id bigint, classification_2013 int, classification_2014 int")
    for scheme, expected in ((SCHEME_A, [1, 2, 1, 3, 3, 3, 3, 3, 1, 0, 0, 0, 0, 0, 0, None, None]), (SCHEME_B, [1, 4, 1, 2, 2, 2, 2, 2, 1, 3, 3, 3, 3, 3, 3, None, None])):
        out = landcover.reclass(wide, scheme)
        assert [r.classification_2013 for r in out.orderBy("pixel_id").collect()] == expected
    long = landcover.to_long(wide)
    assert long.count() == 2 * len(CODES)
    assert sorted(map(tuple, landcover.to_wide(long, [2013, 2014]).collect()), key=str) == sorted(map(tuple, wide.collect()), key=str)
    assert wide.select(landcover.class_at(wide, F.lit(2014))).distinct().first()[0] == 3
    assert wide.select(landcover.class_at(wide, F.lit(1990))).distinct().first()[0] is None
    assert landcover.year_band(wide, 2014).columns == ["pixel_id", "class"]


def test_fire_windows(spark):
    got = {r.fire_id: r for r in timeutil.with_windows(training.fire_catalogue(spark)).collect()}
    assert len(got) == 30 and got["fire_12"].polygon_id is None and sum(r.is_forest for r in got.values()) == 15
    last = got["fire_30"]
    d = dt.date
    assert (last.pre_end, last.pre_lwr, last.fire_year, last.series_begin, last.series_end, last.lulc_year) == (d(2017, 11, 30), d(2016, 11, 30), 2018, d(2016, 7, 1), d(2019, 7, 1), 2016)
    edge = spark.createDataFrame([("fire_99", d(2016, 6, 30), d(2016, 7, 2), d(2016, 9, 1), d(2016, 8, 1)), ("fire_11", d(2015, 12, 31), None, None, None)], "fire_id string, pre_upr date, post_lwr date, post_upr_long date, post_upr_short date")
    rows = {r.fire_id: r for r in timeutil.with_windows(edge).collect()}
    assert (rows["fire_99"].fire_year, rows["fire_99"].series_begin, rows["fire_99"].lulc_year, rows["fire_99"].post_end) == (2017, d(2015, 7, 1), 2015, d(2016, 9, 2))
    assert (rows["fire_11"].fire_year, rows["fire_11"].lulc_year, rows["fire_11"].post_end) == (2016, 2015, None)
    check = timeutil.with_windows(edge, pre_months=3, inclusive_end=False).where("fire_id = 'fire_99'").first()
    assert (check.pre_lwr, check.pre_end, check.post_end_long) == (d(2016, 3, 30), d(2016, 7, 1), d(2016, 9, 1))
    with pytest.raises(KeyError):
        training.one_fire(edge, "fire_00")
    assert training.one_fire(training.fire_catalogue(spark), "fire_03")["description"] == "turbio_15"


def test_dates_of_readings(spark):
    df = spark.createDataFrame([(dt.date(2015, 2, 28),), (dt.date(2016, 2, 29),), (None,)], "d date")
    assert [r[0] for r in df.select(timeutil.frac_year(F.col("d"))).collect()] == [2015.158904109589, 2016.1612021857923, None]
    ts = [dt.datetime(2015, 1, i) for i in (1, 2, 3, 4, 5)]
    tags = spark.createDataFrame([(t,) for t in ts], "ts timestamp").select(timeutil.period_tag(F.col("ts"), *[F.lit(ts[i]) for i in (1, 2, 2, 3)])).collect()
    assert [t[0] for t in tags] == ["Background", "Pre-fire", "Pre-fire", "Post-fire", "Background"]


def test_range_lookup_and_points(spark):
    d = dt.date
    windows = spark.createDataFrame([("a", d(2015, 1, 20), d(2015, 3, 2)), ("b", d(2015, 2, 1), d(2015, 2, 2)), ("c", d(2015, 2, 2), d(2015, 2, 2))], "fire_id string, lo date, hi date")
    rows = spark.createDataFrame([(1, d(2015, 2, 1)), (2, d(2015, 3, 2)), (3, d(2015, 3, 1)), (4, None)], "k int, day date")
    assert sorted((r.k, r.fire_id) for r in training.range_lookup(rows, F.col("day"), windows, "lo", "hi").collect()) == [(1, "a"), (1, "b"), (3, "a")]
    p = spark.createDataFrame([(1, "fire_01", "x"), (2, "fire_77", "y"), (3, None, "z")], "point_id int, fire_id string, class string")
    both = training.label_points(p, p.limit(1))
    assert sorted(r["class"] for r in both.collect()) == ["burned"] * 3 + ["unburned"]
    polygons = spark.createDataFrame([("2015_50",)], "fire_id string")
    out = {(r.point_id, r["class"]): (r.description, r.has_polygon) for r in training.with_fire(both, training.fire_catalogue(spark), polygons).collect()}
    assert out[(1, "burned")] == ("cholila", True) and out[(3, "burned")] == (None, False) and len(out) == 4


def test_records_and_files(spark, tmp_path):
    rows = [(1, "a", T0), (1, "a", T0 + dt.timedelta(1)), (2, None, T0), (None, "x", T0), (None, "x", T0)]
    df = spark.createDataFrame(rows, "k bigint, v string, loaded_at timestamp")
    got = one_record(df, "k")
    assert got.columns == df.columns and sorted(map(tuple, got.collect()), key=str) == sorted([rows[0], *rows[2:]], key=str)
    again = one_delivery(df, "k")
    assert again.columns == df.columns and sorted(map(tuple, again.collect()), key=str) == sorted([rows[0], *rows[2:]], key=str)
    assert one_delivery(df.limit(0), "k").count() == one_record(df.limit(0), "k").count() == 0
    write_csv(got.select("k", "v"), f"{tmp_path}/csv")
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").count() == 4
    write_table(df, f"{tmp_path}/parts", ["v"])
    assert spark.read.parquet(f"{tmp_path}/parts").where("v = 'a'").count() == 2

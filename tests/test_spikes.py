import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinderline.functions.text import parse_date
from cinderline.operators import spikes as spikes_module
from cinderline.operators.spikes import SpikeRules, _segment_median, flag_faults, judge, phase_space_outliers

SCHEMA = "obs_id bigint, pixel_id bigint, date string, nbr double, fault string, block int"


def series(pixel, values, step=8, first=dt.date(2001, 1, 1), start=0):
    return [(start + i, pixel, str(first + dt.timedelta(days=step * i)), v, "clash", 1) for i, v in enumerate(values)]


def flags(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA)
    out = flag_faults(df, source="pixel_id", day=parse_date("date"), value="nbr", key="obs_id", **more).collect()
    found = {r.obs_id: r.fault for r in out}
    assert len(found) == len(out)
    return found


def noise(n, seed=1, level=0.5, sigma=0.02):
    return [round(float(x), 4) for x in level + sigma * np.random.default_rng(seed).standard_normal(n)]


def test_each_kind_of_fault(spark):
    v = noise(60)
    v[20] = -0.2
    v[30], v[31] = 0.95, 0.93
    v[40:48] = [0.123456] * 8
    v[50], v[51], v[52], v[53] = 1.5, math.nan, math.inf, None
    got = flags(spark, series(1, v))
    assert {i for i, f in got.items() if f == "spike"} == {20, 30, 31}
    assert {i for i, f in got.items() if f == "stuck"} == set(range(40, 48))
    assert {i for i, f in got.items() if f == "bounds"} == {50, 51, 52}


def test_what_is_no_fault(spark):
    drop = noise(25) + noise(25, 2, level=0.05)
    season = [round(0.4 + 0.25 * math.sin(i / 7), 4) for i in range(80)]
    seven = noise(20, 3) + [0.3] * 7 + noise(20, 4)
    gap = series(4, noise(20, 5), start=3000) + series(4, [0.9] + noise(20, 6), first=dt.date(2003, 1, 1), start=3100)
    rows = series(1, drop) + series(2, season, start=1000) + series(3, seven, start=2000) + gap + series(5, [0.1], start=4000) + series(6, [0.1, 0.9, 0.1], step=200, start=4100)
    assert flags(spark, rows) == {}


def test_dirty_rows(spark):
    v = noise(40)
    v[20] = -0.4
    rows = series(1, v)
    rows += rows  # redelivered
    rows += [(900, 1, None, 5.0, "", 0), (901, None, "2001-01-01", -5.0, "", 0), (902, None, None, 0.5, "", 0), (None, 1, "2001-01-01", 9.0, "", 0), (903, 1, "NaT", 0.1, "", 0), (904, 2, "2001-01-01", None, "", 0)]
    assert flags(spark, rows) == {20: "spike", 900: "bounds", 901: "bounds"}
    assert flags(spark, []) == {}


@pytest.mark.parametrize("limit", [40, 64])
def test_long_series_are_cut_with_margins(spark, limit):
    v = noise(600, 7)
    spots = [0, *range(25, 590, 37), 599]
    for i in spots[1:-1]:
        v[i] = round(v[i] - 0.6, 4)
    v[300:311] = [0.4321] * 11
    rows = series(1, v) + series(2, noise(20, 8), start=10_000)
    assert flags(spark, rows, max_series=limit) == flags(spark, rows)


def test_one_day_with_very_many_readings_is_cut(spark):
    v = noise(500, 9)
    v[250] = 0.9
    rows = series(1, v, step=0)
    assert flags(spark, rows, max_series=50)[250] == "spike"


def test_small_batches_change_nothing(spark):
    rows = [r for p in range(30) for r in series(p, noise(30, p)[:15] + [-0.5] + noise(30, p)[15:], start=100 * p)]
    assert flags(spark, rows, batch_rows=7) == flags(spark, rows) == {100 * p + 15: "spike" for p in range(30)}


def test_segment_medians():
    g = np.repeat([0, 1, 2, 4], [3, 4, 1, 400])
    x = np.random.default_rng(0).normal(size=len(g))
    x[1] = np.nan
    got = _segment_median(g, x, 5)
    assert np.allclose([got[i] for i in (0, 1, 2, 4)], [np.nanmedian(x[g == i]) for i in (0, 1, 2, 4)]) and np.isnan(got[3])


def test_phase_space_flags_spikes_of_every_series():
    rng = np.random.default_rng(2)
    u = rng.normal(0.5, 0.02, 2_000)
    at = np.arange(10, 2_000, 40)
    u[at] += 0.4
    assert phase_space_outliers(np.repeat(np.arange(50), 40), u, np.zeros(2_000, bool), 50, SpikeRules())[at].all()
    assert list(judge(np.zeros(0), np.zeros(0), np.zeros(0), np.zeros(0), SpikeRules())) == []


def test_copies_at_a_cut_take_no_place_in_the_margins(spark):
    v = noise(300, 11)
    v[146:154] = [0.4321] * 8
    for i in (99, 199):
        v[i] = -0.3
    rows = series(1, v)
    rows += [rows[i] for i in (100, 150, 200) for _ in range(400)] + [(5_000 + i, 1, rows[200][2], 9.0, "", 0) for i in range(400)]
    want = {99: "spike", 199: "spike"} | dict.fromkeys(range(146, 154), "stuck") | dict.fromkeys(range(5_000, 5_400), "bounds")
    for limit in (60, 100, 150, 1_200):
        assert flags(spark, rows, max_series=limit) == want
    assert flags(spark, rows) == want


@pytest.mark.parametrize("named", [False, True])
def test_scatter_is_that_of_the_whole_source(spark, named):
    rng = np.random.default_rng(12)
    sigma = np.repeat([0.004, 0.03, 0.004, 0.03], 300)
    v = np.round(0.4 + 0.1 * np.sin(np.arange(1_200) / 40) + sigma * rng.standard_normal(1_200), 4)
    v[np.arange(20, 1_190, 41)] += np.resize([0.05, -0.15, 0.3], 29)
    v[620:660] = 0.4321
    rows = series(1, v.tolist()) + series(2, v[::-1].tolist(), start=5_000) + series(3, noise(50, 13), start=9_000)
    rows += rows[100:140]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("obs_id", F.format_string("k%05d", "obs_id") if named else F.col("obs_id")).withColumn("pixel_id", F.col("pixel_id").cast("string" if named else "bigint"))
    found = [{(r.obs_id, r.fault) for r in flag_faults(df, source="pixel_id", day=parse_date("date"), value="nbr", key="obs_id", max_series=m).collect()} for m in (100_000, 100)]
    assert found[0] == found[1] and sum(f == "spike" for _, f in found[0]) > 10


def test_neighbours_are_near_and_agree(spark):
    rows = []
    for pixel, gaps, after in ((1, (24, 64), 0.5), (2, (56, 56), 0.7), (3, (24, 64), 0.54), (4, (64, 90), 0.5)):
        v = noise(20, pixel, sigma=0.004) + [0.8] + noise(20, pixel + 10, level=after, sigma=0.004)
        days = np.cumsum([0] + [8] * 19 + list(gaps) + [8] * 19)
        rows += [(100 * pixel + i, pixel, str(dt.date(2001, 1, 1) + dt.timedelta(days=int(d))), x, "", 0) for i, (d, x) in enumerate(zip(days, v))]
    assert flags(spark, rows) == {120: "spike", 320: "spike"}


def test_the_ellipsoid_decides(monkeypatch):
    rng = np.random.default_rng(5)
    u = rng.normal(0.5, 0.02, 4_000)
    at = np.arange(20, 4_000, 80)
    u[at] += np.resize([0.4, -0.3], len(at))
    group, t, still = np.repeat(np.arange(50), 80), np.tile(np.arange(80) * 8.0, 50), np.zeros(4_000, bool)
    found = spikes_module.spikes(group, t, u, still, 50, SpikeRules())
    assert list(np.flatnonzero(found)) == list(at)
    monkeypatch.setattr(spikes_module, "phase_space_outliers", lambda group, u, *more: np.ones(len(u), bool))
    assert spikes_module.spikes(group, t, u, still, 50, SpikeRules()).sum() > 500


def test_rounds_go_on_until_nothing_is_new():
    u = np.random.default_rng(6).normal(0.5, 0.004, 200)
    for k, height in ((50, 0.4), (52, 0.4), (54, 0.4), (53, 0.2)):
        u[k] += height
    still, group, rules = np.zeros(200, bool), np.zeros(200, int), SpikeRules()
    flagged, new, work = spikes_module._rounds(group, u, still, 1, rules, None)
    assert flagged[[50, 52, 53, 54]].all() and not new.any()
    planes = spikes_module._planes(work, group)
    medians = [_segment_median(group, d, 1) for d in spikes_module._deviations(planes, still)]
    assert not (spikes_module._outside(planes, group, medians, np.array([200]), rules) & ~flagged).any()


def test_limit_of_a_series_changes_no_flag(spark):
    rng = np.random.default_rng(14)
    v = np.r_[rng.normal(0.5, 0.003, 900), rng.normal(0.5, 0.05, 2_100)]
    v[np.arange(30, 900, 50)] += 0.2
    rows = series(1, np.round(np.clip(v, -1, 1), 4).tolist(), step=1) + [(9_000 + i, None, "2001-01-01", 2.0, "", 0) for i in range(50)]
    found = [flags(spark, rows, max_series=m) for m in (100_000, 2_999, 1_000)]
    assert found[0] == found[1] == found[2] and sum(f == "bounds" for f in found[0].values()) == 50

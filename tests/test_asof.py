import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cinderline.operators.asof import asof_join, validity_intervals

T0 = dt.datetime(2024, 1, 1)
EVENTS = "event_id bigint, who string, at timestamp, value string"
REVISIONS = "revision_id bigint, who string, value string, valid_from timestamp, known timestamp"


def run(spark, events, revisions, **more):
    e, r = spark.createDataFrame(events, EVENTS), spark.createDataFrame(revisions, REVISIONS)
    return asof_join(e, r, event_entity=F.col("who"), event_time="at", entity=F.col("who"), valid_from="valid_from", known_at="known", attributes=["revision_id", "value"], **more)


def brute(events, revisions):
    out = []
    for eid, who, at, _ in events:
        ok = [(v, k, rid, val is not None, val or "") for rid, w, val, v, k in revisions if None not in (who, w, at, v, k) and w == who and v <= at and k <= at]
        out.append((eid, max(ok)[2] if ok else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("more", [{}, {"broadcast_rows": 0, "salts": 3}, {"bucket_s": 3_600}])
def test_against_brute_force(spark, more):
    rng = random.Random(5)
    when = lambda: T0 + dt.timedelta(hours=rng.randrange(0, 2_400))
    revisions = [(i, rng.choice(["a", "a", "a", "b", "c", None]), rng.choice(["x", "y", None]), when() if rng.random() > 0.05 else None, when() if rng.random() > 0.05 else None) for i in range(120)]
    revisions += revisions[:10]
    times = [r[3] for r in revisions if r[3]]
    events = [(i, rng.choice(["a", "a", "b", "d", None]), rng.choice([when(), rng.choice(times), None]), "own") for i in range(300)]
    got = run(spark, events, revisions, **more)
    assert got.columns == ["event_id", "who", "at", "value", "asof_valid_from", "asof_known_at", "asof_revision_id", "asof_value"]
    assert sorted([(r.event_id, r.asof_revision_id) for r in got.collect()], key=str) == brute(events, revisions)


def test_nothing_learned_later_and_equal_moments(spark):
    day = dt.timedelta(days=1)
    revisions = [(1, "a", "old", T0, T0), (2, "a", "new", T0 + day, T0 + 10 * day), (3, "a", "early", T0 + 20 * day, T0 + 5 * day)]
    events = [(1, "a", T0, ""), (2, "a", T0 + 9 * day, ""), (3, "a", T0 + 10 * day, ""), (4, "a", T0 + 19 * day, ""), (5, "a", T0 + 20 * day, ""), (6, "a", T0 - day, ""), (6, "a", T0 - day, "")]
    assert sorted((r.event_id, r.asof_value) for r in run(spark, events, revisions).na.fill("-").collect()) == [(1, "old"), (2, "old"), (3, "new"), (4, "new"), (5, "early"), (6, "-"), (6, "-")]


def test_empty_sides_and_clashing_names(spark):
    assert run(spark, [], [(1, "a", "x", T0, T0)]).count() == 0
    assert [r.asof_value for r in run(spark, [(1, "a", T0, "")], []).collect()] == [None]
    e = spark.createDataFrame([(1, "a", T0, "", 9)], EVENTS + ", asof_value int")
    r = spark.createDataFrame([(1, "a", "x", T0, T0)], REVISIONS)
    got = asof_join(e, r, event_entity=F.col("who"), event_time="at", entity=F.col("who"), valid_from="valid_from", known_at="known", attributes=["revision_id", "value"]).first()
    assert (got["asof_value"], got["asof_value_"]) == (9, "x")


def test_join_is_on_entity_and_bucket(spark):
    plan = run(spark, [(1, "a", T0, "")], [(1, "a", "x", T0, T0)])._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_stray_times_cost_one_bucket_each(spark):
    far = dt.datetime(9999, 6, 1)
    revisions = [(i, w, "x", T0 + dt.timedelta(days=9 * i), T0) for i in range(40) for w in "ab"] + [(99, "a", "far", far, T0)]
    events = [(i, w, T0 + dt.timedelta(days=i), "") for i in range(300) for w in "ab"]
    stray = [(900, "a", far, ""), (901, "b", far, ""), (902, "a", dt.datetime(1, 2, 1), "")]
    got = {r.event_id: r.asof_revision_id for r in run(spark, events + stray, revisions).collect() if r.event_id >= 900}
    assert got == {900: 99, 901: 39, 902: None}
    e, r = spark.createDataFrame(events + stray, EVENTS), spark.createDataFrame(revisions, REVISIONS)

    def intervals(e):
        needed = e.select(F.col("who").alias("__entity"), F.floor(F.unix_micros("at") / (30 * 86_400_000_000)).alias("__bucket")).distinct()
        return validity_intervals(r, entity=F.col("who"), valid_from=F.col("valid_from"), known_at=F.col("known"), attributes=["revision_id"], needed=needed).count()

    assert intervals(e.where("event_id < 900")) <= intervals(e) <= intervals(e.where("event_id < 900")) + 4

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinderline.llm.quantiles import RankSketch, merge_sketches, read_quantiles, sketch_groups

QS = [0.0001, 0.001, 0.01, 0.1, 0.5, 0.9, 0.99, 0.999, 0.9999]
BOUND = 3 * 0.131 / 32


def worst(sketch, values, high):
    s, n, out = np.sort(values), len(values), 0.0
    for q in QS:
        rank = max(1, math.ceil(q * n))
        got = sketch.quantiles([q])[0]
        low, top = np.searchsorted(s, got, "left") + 1, np.searchsorted(s, got, "right")
        error = 0 if low <= rank <= top else min(abs(low - rank), abs(top - rank))
        out = max(out, error / (n - rank + 1 if high else rank))
    return out


@pytest.mark.parametrize("high", [False, True])
@pytest.mark.parametrize("kind", ["normal", "sorted", "reversed", "ties", "heavy"])
def test_relative_rank_error_after_merging(high, kind):
    rng = np.random.default_rng(7)
    x = rng.normal(size=120_000)
    x = {"normal": x, "sorted": np.sort(x), "reversed": np.sort(x)[::-1], "ties": np.round(x, 1), "heavy": np.exp(4 * x)}[kind]
    whole = None
    for load in np.array_split(x, 9):
        own = RankSketch(high)
        for part in np.array_split(load, 11):
            own.update(part)
        own = RankSketch.from_bytes(own.to_bytes())
        if whole is None:
            whole = own
        else:
            whole.merge(own)
    assert whole.n == len(x) and sum(c.size << h for h, c in enumerate(whole.levels)) == len(x)
    assert worst(whole, x, high) <= BOUND
    assert len(whole.to_bytes()) < 60_000
    assert whole.quantiles([0, 1]) == [x.min(), x.max()]


def test_small_and_empty_sketches_are_exact():
    s = RankSketch(True)
    assert s.quantiles([0.5]) == [None]
    s.update(np.array([3.0, 1.0, np.inf, 2.0]))
    s.merge(RankSketch(True))
    assert s.quantiles([0.0, 0.25, 0.5, 0.75, 1.0]) == [1.0, 1.0, 2.0, 3.0, np.inf]
    assert RankSketch.from_bytes(s.to_bytes()).quantiles([0.5]) == [2.0]


def test_groups_loads_and_dirty_values(spark):
    rng = np.random.default_rng(1)
    rows = [(None if g == 2 else f"g{g}", int(load), float(v), 1) for g, n in ((0, 30_000), (1, 50), (2, 500)) for load, v in zip(rng.integers(0, 3, n), rng.normal(g, 1, n))]
    dirty = [("g0", 0, None, 1), ("g0", 0, math.nan, 1), ("g9", 0, None, 1)]
    df = spark.createDataFrame(rows + dirty, "grp string, load_no int, v double, n int").repartition(5)
    kept = sketch_groups(df, groups={"grp": F.col("grp"), "load_no": F.col("load_no")}, value=F.col("v"), held_items=2_000)
    assert kept.count() == 9
    got = {r.grp: r for r in read_quantiles(merge_sketches(kept, ["grp"]), {"p01": 0.01, "p50": 0.5, "p99": 0.99}).collect()}
    assert set(got) == {"g0", "g1", None}
    for g in got:
        x = np.sort([r[2] for r in rows if r[0] == g])
        assert got[g].n == len(x)
        for name, q in (("p01", 0.01), ("p50", 0.5), ("p99", 0.99)):
            rank, at = max(1, math.ceil(q * len(x))), np.searchsorted(x, got[g][name]) + 1
            assert abs(at - rank) <= BOUND * min(rank, len(x) - rank + 1) + (0 if q != 0.5 else BOUND * len(x) / 2)
    assert merge_sketches(kept, []).count() == 1
    assert sketch_groups(df.limit(0), groups={"grp": F.col("grp")}, value=F.col("v")).count() == 0


def test_a_group_that_very_many_partitions_hold(spark):
    rng = np.random.default_rng(3)
    parts = []
    for k in range(1_000):
        pair = RankSketch(False), RankSketch(True)
        for sketch in pair:
            sketch.update(np.arange(k, 60_000, 1_000) + rng.random(60) * 0)
        parts.append(("hot", bytearray(pair[0].to_bytes()), bytearray(pair[1].to_bytes())))
    sketches = spark.createDataFrame(parts, "grp string, low binary, high binary").repartition(40)
    for groups in (["grp"], []):
        row = read_quantiles(merge_sketches(sketches, groups, fan_in=8), {"p01": 0.01, "p99": 0.99}).collect()
        assert len(row) == 1 and row[0].n == 60_000
        assert abs(row[0].p01 - 600) <= BOUND * 600 + 1 and abs(row[0].p99 - 59_400) <= BOUND * 600 + 1

"""Implausible readings: spikes, stuck values and impossible values, judged per source.

Phase-space thresholding on numpy arrays that hold many series one after another. Spark brings each series (or, of a
source with very many readings, each stretch of it with a margin) together and in order; the kernel sees bounded batches.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

GAUSS = 1.4826  # scale of the median absolute deviation for normal scatter
PLANES = 3  # value beside its level, first and second difference
REACH = 4  # a round looks at so many readings on either side
SKETCH = 512  # values of a stretch that bracket a median


@dataclass(frozen=True)
class SpikeRules:
    low: float = -1.0  # physical bounds, inclusive
    high: float = 1.0
    radius: float = 9.0  # of the ellipsoid, in scatters: a spike of ten usual scatters lies beyond it, whatever its neighbours' noise
    guard: float = 3.0  # a reading within radius / guard scatters of its level is none, whatever the steps beside it
    min_scatter: float = 0.003  # resolution of the sensor
    max_gap: float = 72.0  # days between the readings of a spike and its neighbours, for the level to be back within weeks
    back: float = 0.5  # neighbours before and after differ by at most this share of the spike's height
    run: int = 8  # equal values in a row that count as stuck
    digits: int = 6  # equality of stuck values


def _segment_median(group: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Median of the finite values of each group 0..n-1, NaN where there are none. group is sorted.

    Short groups of like length are sorted as rows of a padded matrix, which is much faster than one long sort.
    """
    ok = np.isfinite(values)
    g, v = group[ok], values[ok]
    count = np.bincount(g, minlength=n)
    first = np.cumsum(count) - count
    out = np.full(n, np.nan)
    longest = int(count.max(initial=0))
    if longest * n <= 4 * len(v) + 1024:
        wide = np.full((n, longest + 1), np.inf)
        wide[g, np.arange(len(v)) - first[g]] = v
        wide.sort(axis=1)
        has = np.flatnonzero(count)
        out[has] = (wide[has, (count[has] - 1) // 2] + wide[has, count[has] // 2]) / 2
        return out
    v = v[np.lexsort((v, g))]
    has = count > 0
    out[has] = (v[first[has] + (count[has] - 1) // 2] + v[first[has] + count[has] // 2]) / 2
    return out


def _shift(values: np.ndarray, group: np.ndarray, k: int) -> np.ndarray:
    """values k places earlier (k > 0) or later in the same group, else NaN."""
    out = np.full(len(values), np.nan)
    a, b = (slice(k, None), slice(None, -k)) if k > 0 else (slice(None, k), slice(-k, None))
    out[a] = np.where(group[a] == group[b], values[b], np.nan)
    return out


def _level(values: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Median of each value and up to two on either side in its group: spikes of one or two readings go, steps stay."""
    five = np.sort(np.stack([values, *[_shift(values, group, k) for k in (2, 1, -1, -2)]]), axis=0)  # NaN last
    there, pick = np.isfinite(five).sum(axis=0), np.arange(len(values))
    return (five[(there - 1) // 2, pick] + five[there // 2, pick]) / 2


def _planes(work: np.ndarray, group: np.ndarray) -> list[np.ndarray]:
    """Phase space of each reading: value less level, first difference (to the next reading), second difference; NaN over the ends."""
    before, after = _shift(work, group, 1), _shift(work, group, -1)
    return [work - _level(work, group), after - work, after - 2 * work + before]


def _deviations(planes: list[np.ndarray], still: np.ndarray) -> list[np.ndarray]:
    """What the scatters are medians of: stuck readings and readings that are their own level tell nothing."""
    value, first, second = (np.where(still, np.nan, np.abs(p)) for p in planes)
    return [np.where(value == 0, np.nan, value), first, second]


def _outside(planes: list[np.ndarray], group: np.ndarray, medians: list[np.ndarray], size: np.ndarray, rules: SpikeRules) -> np.ndarray:
    """Readings beyond the ellipsoid whose axes are `radius` robust scatters (at least the universal threshold sqrt(2 ln n)).

    Of the first differences on both sides of a reading the lesser counts, as a step has a great one on one side.
    """
    floors = [rules.min_scatter, rules.min_scatter * np.sqrt(2), rules.min_scatter * np.sqrt(6)]
    value, first, second = planes
    first = np.fmin(np.abs(first), np.abs(_shift(first, group, 1)))
    radius = np.maximum(np.sqrt(2 * np.log(np.maximum(size, 2))), rules.radius)[group]
    part = [np.nan_to_num(p) / np.fmax(GAUSS * m, f)[group] for p, m, f in zip((value, first, second), medians, floors)]
    return (part[0] ** 2 + part[1] ** 2 + part[2] ** 2 > radius**2) & (np.abs(part[0]) > radius / rules.guard)


def phase_space_outliers(group: np.ndarray, u: np.ndarray, still: np.ndarray, n: int, rules: SpikeRules, known: np.ndarray | None = None) -> np.ndarray:
    """Readings beyond the robust ellipsoid of their series over value, first and second difference.

    The value is taken less its level (slow change is no fault); medians of the absolute deviations give the scatters of each
    series. Flagged readings are replaced by the median of up to two unflagged ones on either side and all is looked at again,
    until nothing new is flagged. known, for stretches: the numbers of the whole series of each group, see _whole_numbers.
    """
    return _rounds(group, u, still, n, rules, known)[0]


def _rounds(group: np.ndarray, u: np.ndarray, still: np.ndarray, n: int, rules: SpikeRules, known: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(flagged, flagged in the last round, values with replacements) after all rounds, or with known after those whose numbers are there."""
    flagged, new, work = np.zeros(len(u), bool), np.zeros(len(u), bool), u.copy()
    size = np.bincount(group, minlength=n) if known is None else known[:, 0]
    for turn in itertools.count() if known is None else range((known.shape[1] - 1) // PLANES):
        planes = _planes(work, group)
        if known is None:
            medians = [_segment_median(group, d, n) for d in _deviations(planes, still)]
        else:
            medians = list(known[:, 1 + turn * PLANES : 1 + (turn + 1) * PLANES].T)
        new = _outside(planes, group, medians, size, rules) & ~flagged
        if not new.any():
            if known is None:
                break
            continue
        flagged |= new
        at = np.flatnonzero(flagged)
        kept = np.where(flagged, np.nan, u)
        near = np.sort(np.stack([_shift(kept, group, k)[at] for k in (2, 1, -1, -2)]), axis=0)  # NaN last
        there = np.isfinite(near).sum(axis=0)
        pick = np.arange(len(at))
        level = (near[np.maximum(there - 1, 0) // 2, pick] + near[np.minimum(there // 2, 3), pick]) / 2
        work[at] = np.where(there > 0, level, u[at])
    return flagged, new, work


def stuck(group: np.ndarray, u: np.ndarray, rules: SpikeRules) -> np.ndarray:
    """Readings in a run of at least rules.run equal values, that is of zero differences."""
    if not len(u):
        return np.zeros(0, bool)
    r = np.round(u, rules.digits)
    starts = np.r_[True, (r[1:] != r[:-1]) | (group[1:] != group[:-1])]
    run = np.cumsum(starts) - 1
    return np.bincount(run)[run] >= rules.run


def spikes(group: np.ndarray, t: np.ndarray, u: np.ndarray, still: np.ndarray, n: int, rules: SpikeRules, known: np.ndarray | None = None) -> np.ndarray:
    """Phase-space outliers that are no step and no season: the level is back after one or two readings.

    The ellipsoid decides what is far off; of that, an outlier is a spike where the reading before it (them) and the one after
    are near in time and differ by at most a share of its height, the least distance to either of them.
    """
    far = phase_space_outliers(group, u, still, n, rules, known)
    before, after, after2 = _shift(u, group, 1), _shift(u, group, -1), _shift(u, group, -2)
    t1, t3, t4 = _shift(t, group, 1), _shift(t, group, -1), _shift(t, group, -2)
    with np.errstate(invalid="ignore"):
        near = (t - t1 <= rules.max_gap) & (t3 - t <= rules.max_gap)
        height = np.minimum(np.abs(u - before), np.abs(u - after))
        single = far & near & (np.abs(after - before) <= rules.back * height)
        height = np.minimum(np.minimum(np.abs(u - before), np.abs(u - after2)), np.minimum(np.abs(after - before), np.abs(after - after2)))
        double = far & np.r_[far[1:], False] & near & (t4 - t3 <= rules.max_gap) & (np.abs(after2 - before) <= rules.back * height)
    return single | double | np.r_[False, double[:-1]]


def judge(source: np.ndarray, t: np.ndarray, u: np.ndarray, key: np.ndarray, rules: SpikeRules, known: np.ndarray | None = None) -> np.ndarray:
    """Fault of each row ('' where none) of whole series: rows sorted by (source, t, key), source as dense numbers.

    u has no NaN for null (nulls are left out before); t is NaN where the day is unknown. Equal (source, key) next to
    each other are one reading and get the same fault. known: numbers of the whole series, a row for each number in source.
    """
    fault = np.full(len(u), "", dtype=object)
    bad = ~((u >= rules.low) & (u <= rules.high))
    fault[bad] = "bounds"
    again = np.r_[False, (key[1:] == key[:-1]) & (source[1:] == source[:-1])]
    use = ~bad & ~again & np.isfinite(t)
    if use.any():
        ids, group = np.unique(source[use], return_inverse=True)
        tt, uu = t[use], u[use]
        still = stuck(group, uu, rules)
        jump = spikes(group, tt, uu, still, len(ids), rules, None if known is None else known[ids])
        fault[use] = np.where(jump, "spike", np.where(still, "stuck", ""))
    for i in np.flatnonzero(again):
        fault[i] = fault[i - 1]
    return fault


def _known_rows(source: pa.Array, series: np.ndarray, known: dict) -> np.ndarray:
    """A row of numbers for each of the series 0, 1, ..., which stand one after another."""
    first = np.flatnonzero(np.r_[True, series[1:] != series[:-1]])
    return np.array([known[s] for s in source.take(pa.array(first)).to_pylist()], float)


def _series(source: pa.Array, block: np.ndarray) -> np.ndarray:
    s = (source.dictionary_encode(null_encoding="encode").indices if source.null_count or pa.types.is_string(source.type) else source).to_numpy(zero_copy_only=False)
    return np.cumsum(np.r_[False, (s[1:] != s[:-1]) | (block[1:] != block[:-1])])


def _kernel(rules: SpikeRules, key_type: pa.DataType, batch_rows: int, known: dict | None = None):
    out = pa.schema([("key", key_type), ("fault", pa.string())])

    def judged(table: pa.Table) -> pa.RecordBatch:
        cols = {c: table.column(c).combine_chunks() for c in ("source", "block", "day", "value", "halo", "key")}
        k = (cols["key"].dictionary_encode().indices if pa.types.is_string(key_type) else cols["key"]).to_numpy(zero_copy_only=False)
        series = _series(cols["source"], cols["block"].to_numpy())
        day = cols["day"].to_numpy(zero_copy_only=False).astype(float)
        fault = judge(series, day, cols["value"].to_numpy(), k, rules, None if known is None else _known_rows(cols["source"], series, known))
        hit = (fault != "") & ~cols["halo"].to_numpy(zero_copy_only=False) & np.r_[True, (k[1:] != k[:-1]) | (series[1:] != series[:-1])]
        return pa.RecordBatch.from_arrays([cols["key"].filter(pa.array(hit)), pa.array(fault[hit], pa.string())], schema=out)

    return _by_series(judged, batch_rows)


def _by_series(judged: Callable[[pa.Table], pa.RecordBatch], batch_rows: int):
    """judged over tables of whole series (or stretches), which stand one after another in the batches."""

    def last_start(table: pa.Table) -> int:
        """Where the last series begins: it may go on in the next batch."""
        s, b = table.column("source"), table.column("block")
        i, tail = len(table) - 1, (s[len(table) - 1], b[len(table) - 1])
        lo, hi = 0, i
        while lo < hi:  # rows of a series are contiguous
            mid = (lo + hi) // 2
            if (s[mid], b[mid]) == tail:
                hi = mid
            else:
                lo = mid + 1
        return lo

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows >= batch_rows:
                table = pa.Table.from_batches(held).combine_chunks()
                cut = last_start(table)
                if cut:
                    yield judged(table.slice(0, cut))
                held = table.slice(cut).to_batches()
                rows = len(table) - cut
        if rows:
            yield judged(pa.Table.from_batches(held).combine_chunks())

    return run


def flag_faults(readings: DataFrame, *, source: str, day: Column, value: str, key: str, rules: SpikeRules = SpikeRules(), max_series: int = 100_000, batch_rows: int = 200_000) -> DataFrame:
    """(key, fault) of each implausible reading, one row per key: fault is 'bounds', 'spike' or 'stuck', in this order of precedence.

    'bounds': value outside [low, high] or not finite, whatever its day. 'spike' and 'stuck' are judged on the readings
    in bounds that have a source and a day, in order of day, then key. Null values, and null sources except for bounds, are
    left out; rows with the same key are one reading; readings of one day are taken in order of key. key is a whole number
    or a string; rows with a null key cannot be named and are left out. An empty table gives no rows.

    Readings are shuffled once, on source; those that need no series (out of bounds) are spread by key. A source with more than max_series rows loses its copies and its readings out
    of bounds first, and if more than max_series are left is cut into stretches of so many, each with the
    neighbouring readings of the stretches beside it. The scatters are those of the whole source, exactly, from
    several passes over its stretches, so max_series changes no result. Whether
    such sources exist is one count per source; three numbers a round of each source that is cut (at most rows / max_series of them) go to the driver and nothing else.
    """
    rows = readings.select(F.col(source).alias("source"), F.datediff(day, F.lit("1970-01-01").cast("date")).alias("day"), F.col(value).cast("double").alias("value"), F.col(key).alias("key"))
    usable = F.col("value").between(rules.low, rules.high)
    # rows without a day go along, as a filter on it here would work the days out twice; judge leaves them out
    rows = rows.where(F.col("value").isNotNull() & F.col("key").isNotNull() & (F.col("source").isNotNull() | ~usable | F.isnan("value")))
    sizes = readings.where(F.col(source).isNotNull()).groupBy(F.col(source).alias("source")).count().where(F.col("count") > max_series)
    hot = sizes.count()
    halo = 2 * rules.run + 8 * REACH  # for eight rounds; more is fetched if there are more
    more = []
    types = dict(rows.dtypes)
    key_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[types["key"]]
    schema = f"key {types['key']}, fault string"
    if hot:
        rows, aside, cut, width = _places(rows, sizes.select("source"), hot, max(max_series, halo), rules)
        more.append(aside)
        known = {r["source"]: [float(r["size"])] for r in cut.groupBy("source").agg(F.count("*").alias("size")).collect()}
        if known:
            cut = _whole_numbers(cut, known, width, halo, rules, batch_rows)
            more.append(cut.mapInArrow(_kernel(rules, key_type, batch_rows, known), schema))
    # what is out of bounds is judged by itself, so it goes anywhere
    block = F.when(usable, 0).otherwise(1 + F.pmod(F.xxhash64("key"), F.lit(1_000))).cast("bigint")
    placed = rows.withColumns({"block": block, "halo": F.lit(False)}).repartition("source", "block").sortWithinPartitions("source", "block", "day", "key")
    flagged = placed.mapInArrow(_kernel(rules, key_type, batch_rows), schema)
    for m in more:
        flagged = flagged.unionByName(m)
    return flagged.groupBy(F.col("key").alias(key)).agg(F.min("fault").alias("fault"))


def _places(rows: DataFrame, hot_sources: DataFrame, hot: int, width: int, rules: SpikeRules) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """(rows of sources that need no cut, rows out of bounds as (key, fault), the others with their place n, width).

    Sources in hot_sources lose their copies and their rows out of bounds first; those that then still have more than
    width readings are to be cut. n counts a source's readings in order of day, then key. Of a key that is delivered
    with several days or values the least counts.
    """
    hint = F.broadcast if hot <= 1_000_000 else (lambda d: d)
    hot_sources = hint(cut_lineage(hot_sources))
    busy, cool = rows.join(hot_sources, "source", "left_semi"), rows.join(hot_sources, "source", "left_anti")
    usable = F.col("value").between(rules.low, rules.high)
    aside = busy.where(~usable).select("key", F.lit("bounds").alias("fault"))
    one = busy.where(usable & F.col("day").isNotNull()).groupBy("source", "key").agg(F.min(F.struct("day", "value")).alias("r")).select("source", "r.day", "r.value", "key")
    # the place of a reading in its source: its place in the part of a range-partitioned table, after those of earlier parts
    one = cut_lineage(one.repartitionByRange("source", "day", "key").sortWithinPartitions("source", "day", "key").withColumn("id", F.monotonically_increasing_id()))
    one = one.withColumn("part", F.shiftright("id", 33))
    parts = one.groupBy("source", "part").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy("source")
    parts = parts.select("source", "part", (F.sum("n").over(whole.orderBy("part")) - F.col("n") - F.col("first")).alias("shift"), F.sum("n").over(whole).alias("size"))
    one = one.join(hint(parts), ["source", "part"]).withColumn("n", F.col("id") + F.col("shift"))
    keep = ["source", "day", "value", "key"]
    return cool.select(*keep).unionByName(one.where(F.col("size") <= width).select(*keep)), aside, one.where(F.col("size") > width).select(*keep, "n"), width


def _stretches(cut: DataFrame, width: int, halo: int) -> DataFrame:
    """Stretches of width readings by place n, with margins of halo readings, each in one partition and in order."""
    at, block = F.col("n") % width, F.floor(F.col("n") / width)
    keep = ["source", "day", "value", "key"]
    inner = cut.select(*keep, block.alias("block"), F.lit(False).alias("halo"))
    head = cut.where((at < halo) & (block > 0)).select(*keep, (block - 1).alias("block"), F.lit(True).alias("halo"))
    tail = cut.where(at >= width - halo).select(*keep, (block + 1).alias("block"), F.lit(True).alias("halo"))
    return cut_lineage(inner.unionByName(head).unionByName(tail).repartition("source", "block").sortWithinPartitions("source", "block", "day", "key"))


def _whole_numbers(cut: DataFrame, known: dict, width: int, halo: int, rules: SpikeRules, batch_rows: int) -> DataFrame:
    """Appends to the size of each source in known the three medians of each round, until a round flags nothing; returns the stretches.

    A stretch repeats all rounds so far from these numbers, and each reaches REACH readings further into its margins.
    """
    whole = cut
    cut = _stretches(whole, width, halo)
    for turn in itertools.count(1):
        if 2 * rules.run + turn * REACH > halo and halo < width:
            halo = min(2 * halo, width)
            cut = _stretches(whole, width, halo)
        medians = _exact_medians(cut, known, rules, batch_rows)
        for s in known:
            known[s] = known[s] + medians[s]
        new = _pass(cut, known, None, rules, batch_rows, count=True).agg(F.sum("w")).first()[0]
        if not new:
            return cut


def _exact_medians(cut: DataFrame, known: dict, rules: SpikeRules, batch_rows: int) -> dict:
    """source: medians of the deviations of the next round over all its stretches, NaN where there are no values.

    Evenly spaced values of each sorted stretch give bounds of ranks and so a bracket (low, high] around both middle values;
    a second pass counts the values in it.
    """
    order = Window.partitionBy("source", "stat")
    k1, k2 = F.floor((F.col("size") - 1) / 2), F.floor(F.col("size") / 2)
    running = lambda d: d.groupBy("source", "stat", "v").agg(F.sum("w").alias("w"), F.sum("slack").alias("slack")).select(
        "source", "stat", "v", F.sum("w").over(order.orderBy("v")).alias("upto"), F.sum("w").over(order).alias("size"), F.sum("slack").over(order).alias("slack")
    )
    bounds = running(_pass(cut, known, None, rules, batch_rows)).groupBy("source", "stat")
    bounds = bounds.agg(F.max(F.when(F.col("upto") + F.col("slack") <= k1, F.col("v"))).alias("low"), F.min(F.when(F.col("upto") > k2, F.col("v"))).alias("high"), F.max("size").alias("size"))
    brackets: dict = {}
    for r in bounds.collect():
        brackets[r["source"], r["stat"]] = (-np.inf if r["low"] is None else r["low"], r["high"])
    values = running(_pass(cut, known, brackets, rules, batch_rows)).groupBy("source", "stat")
    values = values.agg(F.min(F.when(F.col("upto") > k1, F.col("v"))).alias("a"), F.min(F.when(F.col("upto") > k2, F.col("v"))).alias("b"))
    out = {s: [np.nan] * PLANES for s in known}
    for r in values.collect():
        out[r["source"]][r["stat"]] = (r["a"] + r["b"]) / 2
    return out


def _pass(cut: DataFrame, known: dict, brackets: dict | None, rules: SpikeRules, batch_rows: int, count: bool = False) -> DataFrame:
    """(source, stat, v, w, slack): w deviations of a stretch lie at v or between the row before and v.

    Without brackets evenly spaced values, at v or below which at most slack more lie than their w add up to; with brackets each
    value inside, and those above and below at infinity. With count, w is the number of readings that the last round flagged.
    """
    source_type = dict(cut.dtypes)["source"]
    known = dict(known)

    def looked(table: pa.Table) -> pa.RecordBatch:
        source, halo = table.column("source").combine_chunks(), table.column("halo").combine_chunks().to_numpy(zero_copy_only=False)
        group, u = _series(source, table.column("block").combine_chunks().to_numpy()), table.column("value").combine_chunks().to_numpy()
        rows = _known_rows(source, group, known)
        n = len(rows)
        first = np.searchsorted(group, np.arange(n + 1))
        names = source.take(pa.array(first[:-1])).to_pylist()
        still = stuck(group, u, rules)
        _, new, work = _rounds(group, u, still, n, rules, rows)
        stats = [new] if count else _deviations(_planes(work, group), still)
        at, stat, v, w, slack = [], [], [], [], []
        for i, name in enumerate(names):
            own = slice(first[i], first[i + 1])
            for j, z in enumerate(stats):
                x = z[own][~halo[own]]
                loose = 0
                if count:
                    x, many = np.zeros(1), np.array([x.sum()])
                elif brackets is None:
                    x = np.sort(x[np.isfinite(x)])
                    every = max(1, len(x) // SKETCH)
                    ends = np.unique(np.r_[np.arange(every - 1, len(x), every), len(x) - 1]) if len(x) else np.zeros(0, int)
                    x, many, loose = x[ends], np.diff(ends, prepend=-1), every - 1
                else:
                    low, high = brackets.get((name, j), (-np.inf, np.inf))
                    x = x[np.isfinite(x)]
                    inside, many = np.unique(x[(x > low) & (x <= high)], return_counts=True)
                    x, many = np.r_[-np.inf, inside, np.inf], np.r_[(x <= low).sum(), many, (x > high).sum()]
                    x, many = x[many > 0], many[many > 0]
                at.append(np.full(len(x), first[i]))
                stat.append(np.full(len(x), j, np.int32))
                v.append(x)
                w.append(many)
                slack.append(np.r_[loose, np.zeros(len(x) - 1)] if len(x) else np.zeros(0))
        cols = [source.take(pa.array(np.concatenate(at))), pa.array(np.concatenate(stat)), pa.array(np.concatenate(v), pa.float64())]
        cols += [pa.array(np.concatenate(c).astype(np.int64)) for c in (w, slack)]
        return pa.RecordBatch.from_arrays(cols, names=["source", "stat", "v", "w", "slack"])

    return cut.mapInArrow(_by_series(looked, batch_rows), f"source {source_type}, stat int, v double, w bigint, slack bigint")

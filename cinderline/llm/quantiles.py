"""Percentiles of very large columns by mergeable sketches of relative-rank compactors."""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECTION = 32  # items in a section at first; the rank error falls in proportion
SECTIONS = 3  # sections at first; a compactor doubles them as it works
HEADER = struct.Struct("<BIQdd")
LEVEL = struct.Struct("<QIdI")


class Compactor:
    """Items of weight 2**level. Half of the capacity, at the protected end of the order, is never compacted; of the rest the
    sections next to it are compacted the more seldom the closer they lie (by the trailing ones of a counter)."""

    __slots__ = ("parts", "size", "state", "sections", "section")

    def __init__(self, section: float, sections: int = SECTIONS, state: int = 0, items: np.ndarray | None = None):
        self.parts = [] if items is None else [items]
        self.size = 0 if items is None else len(items)
        self.state, self.sections, self.section = state, sections, section

    def add(self, items: np.ndarray) -> None:
        self.parts.append(items)
        self.size += len(items)

    @property
    def items(self) -> np.ndarray:
        if len(self.parts) != 1:
            self.parts = [np.concatenate(self.parts) if self.parts else np.zeros(0)]
        return self.parts[0]

    @property
    def section_items(self) -> int:
        return 2 * max(2, round(self.section / 2))

    @property
    def capacity(self) -> int:
        return 2 * self.sections * self.section_items

    def compact(self, high: bool, coin: int) -> np.ndarray:
        """Takes the unprotected part out and returns every second item of it."""
        ordered = np.sort(self.items)
        ones = (self.state ^ (self.state + 1)).bit_length() - 1
        kept = self.capacity // 2 + max(0, self.sections - ones - 1) * self.section_items
        kept += (len(ordered) - kept) % 2
        if high:
            out, rest = ordered[: len(ordered) - kept], ordered[len(ordered) - kept :]
        else:
            out, rest = ordered[kept:], ordered[:kept]
        self.parts, self.size = [rest], len(rest)
        self.state += 1
        if self.state >= 1 << (self.sections - 1) and self.section > 4 * math.sqrt(2):
            self.sections *= 2
            self.section /= math.sqrt(2)
        return out[coin::2]


class RankSketch:
    """A bounded summary of many numbers. With high, the error of a rank is relative to its distance from the greatest
    value, else from the least: with `section` items a section its standard deviation is about 0.13 / section of that
    distance, and at most three times as much in 997 of 1000 cases. Merging keeps the bound, whatever the order.
    """

    def __init__(self, high: bool, section: int = SECTION):
        self.high, self.section, self.n = high, section, 0
        self.low_value, self.high_value = math.inf, -math.inf
        self.levels = [Compactor(section)]

    def update(self, values: np.ndarray) -> None:
        """Adds values, none of them NaN."""
        if not len(values):
            return
        self.n += len(values)
        self.low_value = min(self.low_value, float(values.min()))
        self.high_value = max(self.high_value, float(values.max()))
        self.levels[0].add(values)
        self._compress()

    def merge(self, other: RankSketch) -> None:
        if not other.n:
            return
        self.n += other.n
        self.low_value, self.high_value = min(self.low_value, other.low_value), max(self.high_value, other.high_value)
        while len(self.levels) < len(other.levels):
            self.levels.append(Compactor(self.section))
        for mine, theirs in zip(self.levels, other.levels):
            mine.add(theirs.items)
            mine.state |= theirs.state
            if theirs.sections > mine.sections:
                mine.sections, mine.section = theirs.sections, theirs.section
        self._compress()

    def _compress(self) -> None:
        h = 0
        while h < len(self.levels):
            level = self.levels[h]
            if level.size >= level.capacity:
                if h + 1 == len(self.levels):
                    self.levels.append(Compactor(self.section))
                coin = (self.n * 0x9E3779B97F4A7C15 + level.state * 0xD1B54A32D192ED03 + h * 0x94D049BB133111EB >> 17) & 1
                self.levels[h + 1].add(level.compact(self.high, coin))
            h += 1

    def quantiles(self, shares: list[float]) -> list[float | None]:
        """The value at rank max(1, ceil(share * n)) of the values in order; None if there are none."""
        if not self.n:
            return [None] * len(shares)
        values = np.concatenate([c.items for c in self.levels])
        weights = np.repeat([1 << h for h in range(len(self.levels))], [c.size for c in self.levels])
        order = np.argsort(values, kind="stable")
        values, upto = values[order], np.cumsum(weights[order])
        out = []
        for s in shares:
            rank = max(1, math.ceil(s * self.n - 1e-9))
            out.append(self.low_value if rank == 1 else self.high_value if rank >= self.n else float(values[min(np.searchsorted(upto, rank), len(values) - 1)]))
        return out

    def to_bytes(self) -> bytes:
        head = HEADER.pack(self.high, self.section, self.n, self.low_value, self.high_value)
        return head + b"".join(LEVEL.pack(c.state, c.sections, c.section, c.size) + np.asarray(c.items, "<f8").tobytes() for c in self.levels)

    @classmethod
    def from_bytes(cls, data: bytes) -> RankSketch:
        high, section, n, low, top = HEADER.unpack_from(data)
        sketch = cls(bool(high), section)
        sketch.n, sketch.low_value, sketch.high_value, sketch.levels = n, low, top, []
        at = HEADER.size
        while at < len(data):
            state, sections, width, size = LEVEL.unpack_from(data, at)
            at += LEVEL.size
            sketch.levels.append(Compactor(width, sections, state, np.frombuffer(data, "<f8", size, at)))
            at += 8 * size
        return sketch


def sketch_groups(rows: DataFrame, *, groups: dict[str, Column], value: Column, section: int = SECTION, held_items: int = 2_000_000) -> DataFrame:
    """(groups, low, high): one sketch for either tail per group, BINARY, to be kept and merged later.

    Null and NaN values are left out; infinite ones count; a null group value is a group; groups without values have no
    row. Each partition makes its own sketches before anything is shuffled, and gives out what it holds whenever that is more
    than held_items numbers, so neither a large group nor many groups gather in one task.
    """
    names = list(groups)
    data = rows.select(*[c.alias(n) for n, c in groups.items()], value.cast("double").alias("__v")).where("__v is not null and not isnan(__v)")
    schema = ", ".join(f"`{n}` {t}" for n, t in data.dtypes if n != "__v") + ", low binary, high binary"

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[RankSketch, RankSketch]] = {}
        waiting: list[pa.RecordBatch] = []
        kinds = None

        def absorb() -> None:
            table = pa.Table.from_batches(waiting)
            waiting.clear()
            codes, keys = _codes(table.select(names))
            order = np.argsort(codes, kind="stable")
            values = table.column("__v").to_numpy()[order]
            edge = np.searchsorted(codes[order], np.arange(len(keys) + 1))
            for i, key in enumerate(keys):
                pair = held.setdefault(key, (RankSketch(False, section), RankSketch(True, section)))
                for sketch in pair:
                    sketch.update(values[edge[i] : edge[i + 1]])

        def flush() -> pa.RecordBatch:
            columns = [pa.array([k[i] for k in held], kinds[i]) for i in range(len(names))]
            columns += [pa.array([p[i].to_bytes() for p in held.values()], pa.binary()) for i in (0, 1)]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=[*names, "low", "high"])

        for batch in batches:
            kinds = [batch.schema.field(n).type for n in names]
            waiting.append(batch)
            if sum(b.num_rows for b in waiting) >= 250_000:
                absorb()
                if sum(c.size for pair in held.values() for s in pair for c in s.levels) > held_items:
                    yield flush()
        if waiting and sum(b.num_rows for b in waiting):
            absorb()
        if held:
            yield flush()

    return merge_sketches(data.mapInArrow(build, schema), names)


def _codes(table: pa.Table) -> tuple[np.ndarray, list[tuple]]:
    """Dense numbers of the rows' keys, and the keys."""
    code, keys = np.zeros(len(table), np.int64), [()]
    for name in table.column_names:
        column = table.column(name).combine_chunks().dictionary_encode(null_encoding="encode")
        own = column.dictionary.to_pylist()
        both, code = np.unique(code * max(1, len(own)) + column.indices.to_numpy(), return_inverse=True)
        keys = [(*keys[b // max(1, len(own))], own[b % max(1, len(own))]) for b in both.tolist()]
    return code, keys


def merge_sketches(sketches: DataFrame, groups: list[str], fan_in: int = 256) -> DataFrame:
    """(groups, low, high): the sketches of each group as one. groups may be fewer than the sketches were made for.

    Sketches are merged one by one as they stream in, so a group with very many of them needs the memory of two. They are
    merged in two levels, first those of fan_in partitions each, so that no task has to take the sketches of all partitions
    of a group that all of them hold.
    """
    some = sketches.select(*groups, "low", "high", F.floor(F.spark_partition_id() / F.lit(fan_in)).alias("__part"))
    return _merged(_merged(some, [*groups, "__part"]).drop("__part"), groups)


def _merged(kept: DataFrame, groups: list[str]) -> DataFrame:
    kept = kept.select(*groups, "low", "high")
    schema = ", ".join(f"`{n}` {t}" for n, t in kept.dtypes)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, pair, ready = None, None, []
        kinds = None

        def out() -> pa.RecordBatch:
            columns = [pa.array([k[i] for k, _ in ready], kinds[i]) for i in range(len(groups))]
            columns += [pa.array([p[i].to_bytes() for _, p in ready], pa.binary()) for i in (0, 1)]
            ready.clear()
            return pa.RecordBatch.from_arrays(columns, names=[*groups, "low", "high"])

        for batch in batches:
            kinds = [batch.schema.field(n).type for n in groups]
            keys = list(zip(*(batch.column(n).to_pylist() for n in groups))) if groups else [()] * batch.num_rows
            for key, low, high in zip(keys, batch.column("low"), batch.column("high")):
                new = RankSketch.from_bytes(low.as_py()), RankSketch.from_bytes(high.as_py())
                if pair is not None and key == last:
                    pair[0].merge(new[0])
                    pair[1].merge(new[1])
                    continue
                if pair is not None:
                    ready.append((last, pair))
                    if len(ready) >= 500:
                        yield out()
                last, pair = key, new
        if pair is not None:
            ready.append((last, pair))
            yield out()

    placed = kept.repartition(*groups).sortWithinPartitions(*groups) if groups else kept.coalesce(1)
    return placed.mapInArrow(merge, schema)


def read_quantiles(sketches: DataFrame, shares: dict[str, float]) -> DataFrame:
    """The columns of sketches without low and high, n, and a DOUBLE column for each share: up to the median from the
    sketch that is exact at the least values, above it from the other."""
    names = [c for c in sketches.columns if c not in ("low", "high")]
    order = list(shares.items())

    @F.pandas_udf("struct<n bigint, q array<double>>")
    def read(low: pd.Series, high: pd.Series) -> pd.DataFrame:
        rows = []
        for a, b in zip(low, high):
            pair = RankSketch.from_bytes(a), RankSketch.from_bytes(b)
            rows.append((pair[0].n, [pair[s > 0.5].quantiles([s])[0] for _, s in order]))
        return pd.DataFrame(rows, columns=["n", "q"])

    got = sketches.select(*names, read("low", "high").alias("__r"))
    return got.select(*names, F.col("__r.n").alias("n"), *[F.col("__r.q")[i].alias(name) for i, (name, _) in enumerate(order)])

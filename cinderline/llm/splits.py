"""Splits that keep related records together."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import reduce
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import BLANK, INVISIBLE, fold_accents
from ..operators.lookup import left_lookup
from ..session import cut_lineage
from .components import components

# Words of texts that stand where a name should and name nobody.
NOBODY = """a agregar anon anonima anonimo anonymous apellido author autor autora automatico by completa completo da de desconhecida desconhecido desconocida desconocido
full is n/a n/d n.a. na nadie name nan nd ninguem ninguno no nobody nombre nome none not null pendiente por s.d. s/a s/d s/n sem sd sin su tbd the tu unknown
user usuario x xx xxx xxxx y your your_name yourname""".split()


def name_key(name: Column, nobody: Sequence[str] = NOBODY) -> Column:
    """The distinct words of a name in order, without case, accents, commas and white space; null where it names nobody.

    Null, texts without a letter, and texts only of words from nobody name nobody. A letter more or less is another name.
    """
    plain = F.lower(fold_accents(F.regexp_replace(name, INVISIBLE, "")))
    words = F.array_sort(F.array_distinct(F.filter(F.split(plain, f"(?:{BLANK}|,)+"), lambda w: w != "")))
    somebody = F.exists(words, lambda w: w.rlike(r"\p{L}") & ~w.isin(*nobody))
    return F.when(somebody, F.array_join(words, " "))


def linked_nodes(records: DataFrame, *, key: str, links: dict[str, Column], keep: bool = True) -> tuple[DataFrame, DataFrame]:
    """(records as (key, node), labels as (node, root)).

    links names the ties, each a STRING column or null. Records with an equal tie are of one component, also by way of
    further records. A record's node is its first tie that is not null; without any it stands alone, as its key or, where that is
    null, under a number of its own. With keep the records' nodes are written once, for who reads them again; without it only the labels serve.
    """
    names = list(links)
    ties = records.select(F.col(key), *[F.concat(F.lit(f"{n}:"), links[n]).alias(f"__{n}") for n in names])
    tied = F.coalesce(*[F.col(f"__{n}") for n in names])
    alone = F.coalesce(F.concat(F.lit("alone:"), F.col(key).cast("string")), F.concat(F.lit("unnamed:"), F.monotonically_increasing_id().cast("string")))
    placed = ties.select(F.col(key), F.coalesce(tied, alone).alias("node"), F.array(*[F.col(f"__{n}") for n in names]).alias("ties"))
    if keep:
        placed = cut_lineage(placed)  # also, numbers must not change between reads
    edges = placed.select(F.col("node").alias("u"), F.explode("ties").alias("v")).where("v is not null")
    return placed.select(key, "node"), components(edges)


def _totals(items: list[tuple[int, int]], most: int) -> int:
    """Bitset of the totals up to most of subsets of items (size, number of groups in it)."""
    reach, mask = 1, (1 << (most + 1)) - 1
    for size, many in items:
        reach |= (reach << (size * many)) & mask
    return reach


def _taken(items: list[tuple[int, int]], goal: int) -> Counter:
    """How many groups of each size make up goal, which some subset of items does. By halves, so that only bitsets of the
    goal's length are held and no history."""
    if not goal:
        return Counter()
    if len(items) == 1:
        return Counter({items[0][0]: items[0][1]})
    left, right = items[: len(items) // 2], items[len(items) // 2 :]
    rest = 1 << goal  # what is left of the goal after a subset of the right half
    for size, many in right:
        rest |= rest >> (size * many)
    both = _totals(left, goal) & rest
    part = (both & -both).bit_length() - 1
    return _taken(left, part) + _taken(right, goal - part)


def closest_counts(sizes: dict[int, int], target: int) -> dict[int, int]:
    """How many groups of each size to take so that the total is as close to target as can be (below rather than above), exactly.

    sizes has the number of groups of each size. All is counted in the sizes' greatest common divisor. Small sizes that
    together reach every total up to some `filled` need no search. Of the others a bitset holds the totals that can be
    reached, to the target and one group beyond; multiplicities enter as powers of two. What is short of the target is filled up with small ones.
    """
    total = sum(s * m for s, m in sizes.items())
    if not total or target <= 0:
        return {}
    unit = reduce(gcd, [s for s, m in sizes.items() if m])
    target = min(target, total)
    groups = sorted((s // unit, m) for s, m in sizes.items() if m)
    filled, small = 0, 0
    while small < len(groups) and groups[small][0] <= filled + 1:
        filled += groups[small][0] * groups[small][1]
        small += 1
    near = target // unit
    items = []
    for size, many in groups[small:]:
        many = min(many, -(-(near + 1) // size))  # more of one size would only go further beyond the target
        k = 1
        while many:
            items.append((size, min(k, many)))
            many -= items[-1][1]
            k *= 2
    best = 0
    if near > filled:
        reach = _totals(items, near + max((s for s, _ in items), default=0))
        below = (reach & ((1 << (near + 1)) - 1)).bit_length() - 1
        above = reach >> (near + 1)
        options = [below] + ([near + (above & -above).bit_length()] if above else [])
        best = min(options, key=lambda t: abs(max(t, min(t + filled, near)) * unit - target))
    counts = _taken(items, best)
    spare = max(0, min(filled, near - best))
    if best + spare == near and spare < filled and (near + 1) * unit - target < target - near * unit:
        spare += 1
    for size, many in reversed(groups[:small]):
        take = min(many, spare // size)
        counts[size] += take
        spare -= take * size
    return {s * unit: c for s, c in counts.items() if c}


def split_together(records: DataFrame, *, key: str, links: dict[str, Column], parts: dict[str, float]) -> DataFrame:
    """(key, component, split): every record in one of parts, records tied by an equal link (see linked_nodes) in the same.

    parts gives the proportions; the last one takes what the others leave, each of which gets the closest total that whole
    components allow. Among components of one size the choice is by hash, the same at each run. Records must be unique
    by key; a null key is a record of its own kind, alone if it has no tie. An empty table gives no rows.

    Records are counted per node before anything is joined, so a fire or author with a third of all records is one row.
    Only the number of components of each size, at most sqrt(2 n) numbers, goes to the driver; the bitsets there have as many bits as
    a part has records (divided by the sizes' common divisor), or one component more.
    """
    placed, labels = linked_nodes(records, key=key, links=links)
    nodes = placed.groupBy("node").count().join(labels, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "count")
    nodes = cut_lineage(nodes)
    groups = nodes.groupBy("root").agg(F.sum("count").alias("size"))
    sizes = {r["size"]: r["many"] for r in groups.groupBy("size").agg(F.count("*").alias("many")).collect()}
    total = sum(s * m for s, m in sizes.items())
    names, left, cuts = list(parts), dict(sizes), []
    share = sum(parts.values())
    for name in names[:-1]:
        taken = closest_counts(left, round(total * parts[name] / share))
        left = {s: m - taken.get(s, 0) for s, m in left.items() if m > taken.get(s, 0)}
        cuts.append(taken)
    upto: dict[int, list[int]] = {s: [sum(c.get(s, 0) for c in cuts[: i + 1]) for i in range(len(cuts))] for s in sizes}
    spark = records.sparkSession
    plan = spark.createDataFrame([(s, u) for s, u in upto.items()], "size bigint, upto array<bigint>")

    slot = F.pmod(F.xxhash64("root"), F.lit(1024))
    groups = groups.withColumn("slot", slot)
    per_slot = groups.groupBy("size", "slot").count()
    before = per_slot.select("size", "slot", (F.sum("count").over(Window.partitionBy("size").orderBy("slot")) - F.col("count")).alias("before"))
    ranked = groups.join(before, ["size", "slot"]).withColumn("rank", F.col("before") + F.row_number().over(Window.partitionBy("size", "slot").orderBy("root")))
    part = F.size(F.filter("upto", lambda u: u < F.col("rank")))
    chosen = ranked.join(F.broadcast(plan), "size").select("root", F.element_at(F.array(*[F.lit(n) for n in names]), part + 1).alias("split"))
    by_node = left_lookup(nodes, cut_lineage(chosen), "root").select("node", F.col("root").alias("component"), "split")
    return left_lookup(placed, cut_lineage(by_node), "node").select(key, "component", "split")

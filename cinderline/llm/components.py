"""Connected components by hooking and shortcutting over parent tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _lookup(left: DataFrame, right: DataFrame, key: str, small: bool) -> DataFrame:
    """Left join with a table unique by key. Both sides are written tables, so adaptive execution can split a hub's rows."""
    return left.join(F.broadcast(right) if small else right, key, "left")


def components(edges: DataFrame, *, broadcast_rows: int = 200_000) -> DataFrame:
    """(node, root) for every node of edges (u, v): nodes are of one component where their root, its least node, is equal.

    Nodes get numbers in random order. In each round every node that still has edges takes its least neighbour, if that is less, as
    parent (hooking; a partial minimum before the shuffle, so a hub costs one row per task), and then its grandparent
    (shortcutting). The ends of the edges become these; loops and doubles go, so edges shrink by a large factor each round,
    and the rounds end when none is left, for any graph. At last the parent tables of all rounds are joined from the last to the first.
    Both tables of a round are checkpointed, so a lost executor repeats one round at most. A table of parents is broadcast
    only where the counted edges leave it at most broadcast_rows rows.
    Repeated edges, loops and null ends are allowed: null ends tie nothing, but the other end is a node.
    """
    pairs = cut_lineage(edges.select("u", "v").distinct())
    named = pairs.select(F.explode(F.array("u", "v")).alias("node")).where("node is not null").distinct()
    named = cut_lineage(named.select("node", F.xxhash64(F.monotonically_increasing_id()).alias("id")))  # one to one on 64 bits, so numbers are unique
    few = named.count() <= broadcast_rows
    live = pairs.where("u is not null and v is not null and u <> v")
    for end in ("u", "v"):
        live = _lookup(live, named.select(F.col("node").alias(end), F.col("id").alias(f"n{end}")), end, few)
    live = live.select(F.col("nu").alias("u"), F.col("nv").alias("v"))
    rounds: list[tuple[DataFrame, bool]] = []
    while True:
        live = cut_lineage(live.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
        many = live.count()
        if not many:
            break
        small = 2 * many <= broadcast_rows
        ends = live.select(F.explode(F.array(F.struct(F.col("u").alias("id"), F.col("v").alias("other")), F.struct(F.col("v").alias("id"), F.col("u").alias("other")))).alias("e"))
        hooked = ends.groupBy(F.col("e.id").alias("id")).agg(F.min("e.other").alias("other")).select("id", F.least("id", "other").alias("parent"))
        if not small:
            hooked = cut_lineage(hooked)
        step = cut_lineage(_lookup(hooked, hooked.select(F.col("id").alias("parent"), F.col("parent").alias("grand")), "parent", small).select("id", F.col("grand").alias("parent")))
        rounds.append((step, small))
        for end in ("u", "v"):
            live = _lookup(live, step.select(F.col("id").alias(end), F.col("parent").alias(f"n{end}")), end, small)
        live = live.where("nu <> nv").select(F.col("nu").alias("u"), F.col("nv").alias("v"))
    if not rounds:
        return named.select("node", F.col("node").alias("root"))
    roots, small = rounds.pop()
    while rounds:
        later, (step, next_small) = roots.select(F.col("id").alias("parent"), F.col("parent").alias("root")), rounds.pop()
        roots = _lookup(step, later if small else cut_lineage(later), "parent", small).select("id", F.coalesce("root", "parent").alias("parent"))
        small = next_small
    labelled = _lookup(named, roots if small else cut_lineage(roots), "id", small).select("node", F.coalesce("parent", "id").alias("id"))
    labelled = cut_lineage(labelled)
    least = labelled.groupBy("id").agg(F.min("node").alias("root"))
    return _lookup(labelled, least if few else cut_lineage(least), "id", few).select("node", "root")

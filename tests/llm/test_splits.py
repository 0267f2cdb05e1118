import random
import tracemalloc
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from cinderline.functions.text import fire_label, fire_number
from cinderline.llm.components import components
from cinderline.llm.splits import closest_counts, name_key, split_together

PARTS = {"test": 0.1, "validation": 0.1, "train": 0.8}


def roots(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        for x in (u, v):
            if x is not None:
                find(x)
        if u is not None and v is not None:
            a, b = sorted((find(u), find(v)))
            parent[b] = a
    return {x: find(x) for x in parent}


def least(labels):
    groups = {}
    for node, root in labels.items():
        groups.setdefault(root, []).append(node)
    return {n: min(g) for g in groups.values() for n in g}


@pytest.mark.parametrize("seed,n,m", [(0, 60, 40), (1, 200, 150)])
def test_components_against_union_find(spark, seed, n, m):
    rng = random.Random(seed)
    node = lambda: f"n{rng.randrange(n):03d}"
    edges = [(node(), node()) for _ in range(m)] + [("n000", None), (None, "lonely"), (None, None), ("self", "self")]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u string, v string")).collect()}
    assert got == least(roots(edges))


def test_components_of_a_path_a_star_and_nothing(spark):
    order = list(range(40))
    random.Random(3).shuffle(order)
    path = [(f"p{a:02d}", f"p{b:02d}") for a, b in zip(order, order[1:])]
    star = [("zhub", f"s{i:02d}") for i in range(40)]
    got = {r.node: r.root for r in components(spark.createDataFrame(path + star, "u string, v string")).collect()}
    assert {v for k, v in got.items() if k[0] == "p"} == {"p00"} and {v for k, v in got.items() if k[0] in "sz"} == {"s00"}
    assert components(spark.createDataFrame([], "u string, v string")).count() == 0


def test_components_when_tables_are_too_large_to_broadcast(spark):
    rng = random.Random(9)
    edges = [(f"n{rng.randrange(300):03d}", f"n{rng.randrange(300):03d}") for _ in range(220)] + [("hub", f"s{i:03d}") for i in range(200)] + [("alone", None)]
    df = spark.createDataFrame(edges, "u string, v string")
    assert {r.node: r.root for r in components(df, broadcast_rows=0).collect()} == least(roots(edges))


def test_names(spark):
    same = ["Wilébano Perubquí", "PERUBQUI , Wilébano", " wilebano  perubqui", "Perubquí,Wilébano", "Wilébano Perubquí", "Wilébano Perubquí", "Wil­ébano Perubquí"]
    nobody = [None, "", " ", "-", "...", "?", "N/A", "unknown", "anónimo", "sin autor", "Your full name", ",", "123"]
    other = ["Wilébano Perubqui Soto", "Wilébana Perubquí"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(same + nobody + other)], "i int, v string")
    keys = [r[0] for r in df.orderBy("i").select(name_key(F.col("v"))).collect()]
    assert set(keys[: len(same)]) == {"perubqui wilebano"} and keys[len(same) : -2] == [None] * len(nobody) and len(set(keys[-2:]) - {keys[0], None}) == 2


@pytest.mark.parametrize("seed", range(6))
def test_closest_totals(seed):
    rng = random.Random(seed)
    groups = [rng.choice([1, 2, 3, 5, 8, 13, 40]) for _ in range(10)]
    sizes = {s: groups.count(s) for s in groups}
    for target in (0, 1, 7, sum(groups) // 10, sum(groups) // 2, sum(groups), 10**9):
        best = min(abs(sum(c) - min(target, sum(groups))) for k in range(len(groups) + 1) for c in combinations(groups, k))
        counts = closest_counts(sizes, target)
        assert all(0 < c <= sizes[s] for s, c in counts.items())
        assert abs(sum(s * c for s, c in counts.items()) - min(target, sum(groups))) == best


def test_totals_are_closest_at_any_size():
    for n in (2_300_000, 2_400_000, 30_000_000):
        assert closest_counts({n: 9}, 9 * n // 10) == {n: 1}
    assert closest_counts({n: 1 for n in range(1, 6_001)}, 1_800_300) and sum(s * c for s, c in closest_counts({n: 1 for n in range(1, 6_001)}, 1_800_300).items()) == 1_800_300
    odd = {2 * n + 3: 1 for n in range(3_000)}
    assert sum(s * c for s, c in closest_counts(odd, 900_000).items()) == 900_000
    assert closest_counts({6: 3, 10: 2}, 17) == {6: 1, 10: 1} and closest_counts({5: 1}, 2) == {} and closest_counts({5: 1}, 3) == {5: 1} and closest_counts({}, 4) == {}


def test_totals_take_no_history():
    tracemalloc.start()
    counts = closest_counts({3_000 + 7 * n: 1 for n in range(2_000)}, 2_000_000)
    assert abs(sum(s * c for s, c in counts.items()) - 2_000_000) <= 3 and tracemalloc.get_traced_memory()[1] < 50_000_000
    tracemalloc.stop()


def test_split(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([f"fire_{rng.randrange(300):03d}", None, "...", "fire_"]), rng.choice([f"Ana {rng.randrange(400)}a", None, "unknown", ""]), "clash") for i in range(1_500)]
    rows += [(2_000 + i, "FIRE-999", f"Solo {i}b", "clash") for i in range(500)]  # a fire with a quarter of all
    df = spark.createDataFrame(rows, "point_id bigint, fire_id string, author string, split string")
    out = split_together(df, key="point_id", links={"fire": fire_label(fire_number("fire_id")), "author": name_key(F.col("author"))}, parts=PARTS).collect()
    assert sorted(r.point_id for r in out) == sorted(r[0] for r in rows)
    at = {r.point_id: r for r in out}
    for ties in (lambda r: (r[1] or "").lower().replace("-", "_").replace("fire_", "").strip(".") or None, lambda r: r[2] if r[2] not in ("unknown", "") else None):
        seen = {}
        for r in rows:
            if ties(r) is not None:
                assert seen.setdefault(ties(r), at[r[0]].component) == at[r[0]].component
    assert len({(r.component, r.split) for r in out}) == len({r.component for r in out})
    share = {p: sum(r.split == p for r in out) for p in PARTS}
    assert abs(share["test"] - 200) <= 2 and abs(share["validation"] - 200) <= 2
    assert split_together(df.limit(0), key="point_id", links={"fire": F.col("fire_id")}, parts=PARTS).count() == 0


def test_null_keys_are_records_of_their_own(spark):
    rows = [(None, None)] * 40 + [(None, "fire_1")] * 5 + [(i, None) for i in range(50)] + [(100, "fire_1")]
    df = spark.createDataFrame(rows, "point_id bigint, fire string").repartition(3)
    out = split_together(df, key="point_id", links={"fire": F.col("fire")}, parts=PARTS).collect()
    assert len(out) == 96 and all(r.split in PARTS and r.component for r in out)
    assert len({r.component for r in out}) == 91
    assert abs(sum(r.split == "test" for r in out) - 10) <= 1 and abs(sum(r.split == "validation" for r in out) - 10) <= 1

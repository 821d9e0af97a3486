import random
from collections import defaultdict

import pytest

from tapesh.llm import packing as P


def test_best_fit():
    assert P.best_fit([5, 4, 3, 2], 7) == [0, 1, 1, 0]
    assert P.best_fit([], 7) == []


@pytest.mark.parametrize("per_task", [40, 10_000])
def test_pack(spark, per_task):
    rng = random.Random(6)
    sizes = {i: rng.choice([rng.randrange(1, 60), rng.randrange(1, 100), 0]) for i in range(600)} | {1000: 250, 1001: 100, 1002: 300}
    rows = [(i, s, "x") for i, s in sizes.items()] + [(2000, None, "x"), (2001, -4, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, size int, container_id string")
    out = P.pack(df, "doc_id", "size", capacity=100, slack=1, items_per_task=per_task).collect()
    held, parts = defaultdict(int), defaultdict(list)
    for r in out:
        if r["container_id"] is not None:
            held[r["container_id"]] += r["part_size"]
        parts[r["doc_id"]].append((r["part_no"], r["part_size"]))
    assert max(held.values()) <= 100
    for i, s in sizes.items():
        assert sum(p for _, p in parts[i]) == s
        assert len(parts[i]) == 1 or s > 100
    assert sorted(parts[1000]) == [(0, 100), (1, 100), (2, 50)] and sorted(parts[1002]) == [(0, 100), (1, 100), (2, 100)]
    assert parts[2000] == [(0, None)] == parts[2001]
    total = sum(sizes.values())
    assert len(held) <= 1.05 * total / 100 + 2


def test_larger_tables_are_dealt(spark):
    df = spark.range(25_000).selectExpr("id as doc_id", "1 + (id * 7919) % 1300 as size")
    out = P.pack(df, "doc_id", "size").collect()
    held = defaultdict(int)
    for r in out:
        held[r["container_id"]] += r["part_size"]
    assert len(out) == 25_000 and max(held.values()) <= P.CAPACITY
    assert len({c.split("-")[1] for c in held if c.startswith("0-")}) == 3
    assert len(held) <= 1.01 * sum(held.values()) / P.CAPACITY + 1


def test_the_tree_goes_on_to_one_task(spark):
    """Every partition of the first round leaves one container half full; they all meet."""
    df = spark.range(4_000).selectExpr("id as doc_id", "if(id % 40 = 0, 3, 10) as size")
    out = P.pack(df, "doc_id", "size", capacity=100, slack=0, items_per_task=50).collect()
    held = defaultdict(int)
    for r in out:
        held[r["container_id"]] += r["part_size"]
    total = sum(held.values())
    assert len(out) == 4_000 and max(held.values()) <= 100 and len(held) <= 1.02 * total / 100 + 1
    assert {c.split("-")[0] for c in held} >= {"0", "1", "2"}


def test_what_fits_nowhere_ends_the_tree(spark):
    df = spark.range(1_000).selectExpr("id as doc_id", "60 as size")
    out = P.pack(df, "doc_id", "size", capacity=100, slack=1, items_per_task=50).collect()
    assert len({r["container_id"] for r in out}) == 1_000


def test_edges(spark):
    none = spark.createDataFrame([], "doc_id bigint, size bigint")
    assert P.pack(none, "doc_id", "size").count() == 0
    only = spark.createDataFrame([(1, 0), (2, 0)], "doc_id bigint, size bigint")
    assert {r["container_id"] for r in P.pack(only, "doc_id", "size").collect()} == {"empty"}
    twice = spark.createDataFrame([(1, 60), (1, 60)], "doc_id bigint, size bigint")
    assert len({r["container_id"] for r in P.pack(twice, "doc_id", "size", 100).collect()}) == 2


def test_packing_is_repeatable(spark):
    df = spark.range(500).selectExpr("id as doc_id", "1 + (id * 37) % 90 as size")
    runs = [sorted(map(tuple, P.pack(d, "doc_id", "size", 100, 1, 50).collect())) for d in (df, df.repartition(7))]
    assert runs[0] == runs[1]

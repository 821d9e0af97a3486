import random

import pytest

from tapesh import runtime
from tapesh.llm import components as C


def brute(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {x: find(x) for x in root}


@pytest.mark.parametrize("hot_rows", [1, 50_000])
def test_groups_match_union_find(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(runtime, "HOT_ROWS", hot_rows)
    rng = random.Random(5)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(0, i) for i in range(300, 360)]
    edges += [(i, i + 1) for i in range(1000, 1040)] + [(5, 5), (None, 1), (2, None), (7, 8), (8, 7)]
    df = spark.createDataFrame([(*e, "x", 1) for e in edges], "u bigint, v bigint, c string, p int")
    assert {r["node"]: r["root"] for r in C.connected_groups(df).collect()} == brute(edges)


def test_no_edges(spark):
    assert C.connected_groups(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


@pytest.mark.parametrize("hot_rows", [1, 50_000])
def test_link_posts(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(runtime, "HOT_ROWS", hot_rows)
    posts = [
        (1, None, "A، B", 0), (2, None, "B", 0), (3, None, None, 0), (4, "k", "B", 0), (5, "k", "C", 0), (6, "k", "C", 0), (7, None, "C", 0),
        (8, "z", "A", 0), (9, None, "A", 0), (10, None, "A", 0), (None, "k", "A", 0), (4, "k", "B", 0), (11, "q", "D", 0), (12, "q", None, 0),
    ]
    pairs = [
        (2, 1, "B"), (1, 2, "B"), (5, 7, "C"), (7, 7, "C"), (None, 1, "A"), (1, 99, "A"), (9, 10, "Z"), (9, 10, None), (2, 4, "B"), (3, 9, "A"), (8, 9, "B"),
    ]
    p = spark.createDataFrame(posts, "post_id bigint, cluster_id string, location_entities string, first int")
    q = spark.createDataFrame([(i, *x) for i, x in enumerate(pairs)], "pair_no bigint, post_a bigint, post_b bigint, shared_location string")
    got = sorted(tuple(r) for r in C.link_posts(p, q).collect())
    assert got == [(1, 1), (2, 1), (4, 1), (5, 1), (6, 1), (7, 1), (11, 11), (12, 11)]
    assert C.link_posts(p.limit(0), q).count() == 0
    assert sorted(tuple(r) for r in C.link_posts(p, q.limit(0)).collect()) == [(4, 4), (5, 4), (6, 4), (11, 11), (12, 11)]

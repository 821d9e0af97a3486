"""Similarity joins, components and communities against brute force."""

import numpy as np
import pytest

from tapesh import runtime
from tapesh.operators import graph as G


def vectors(spark, n=60, seed=1):
    x = np.random.default_rng(seed).normal(size=(n, 5))
    rows = [(f"d{i % 3}", i, [float(y) for y in v]) for i, v in enumerate(x)] + [("d0", 900, None), ("d0", 901, [0.0] * 5), ("d9", 902, [1.0] * 5)]
    return x, spark.createDataFrame(rows, "day string, id bigint, v array<float>")


@pytest.mark.parametrize("block", [3, 7, 1000])
def test_edges_match_brute_force(spark, block):
    x, df = vectors(spark)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = {(i, j) for i in range(60) for j in range(i + 1, 60) if i % 3 == j % 3 and u[i] @ u[j] >= 0.4}
    got = [(r["src"], r["dst"]) for r in G.similarity_edges(df, "day", "id", "v", 0.4, block).collect()]
    assert sorted(got) == sorted(want) and len(got) == len(set(got))
    assert G.similarity_edges(df.limit(0), "day", "id", "v", 0.4).count() == 0


@pytest.mark.parametrize(("hot_rows", "in_task"), [(1, 0), (50_000, 0), (50_000, 500_000)])
def test_components(spark, monkeypatch, hot_rows, in_task):
    monkeypatch.setattr(runtime, "HOT_ROWS", hot_rows)
    rng = np.random.default_rng(2)
    edges = [tuple(map(int, e)) for e in rng.integers(0, 150, size=(90, 2))] + [(200, i) for i in range(201, 240)] + [(i, i + 1) for i in range(300, 330)]
    root = {}

    def find(a):
        root.setdefault(a, a)
        while root[a] != a:
            a = root[a]
        return a

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    df = spark.createDataFrame([*edges, (None, 5), (7, None), (3, 3)], "src bigint, dst bigint")
    assert {r["node"]: r["component"] for r in G.connected_components(df, task_edges=in_task).collect()} == {a: find(a) for a in root}
    names = spark.createDataFrame([("b", "c"), ("c", "a")], "src string, dst string")
    assert {r["component"] for r in G.connected_components(names, task_edges=in_task).collect()} == {"a"}


def two_cliques():
    left = [(i, j, 1.0) for i in range(5) for j in range(i + 1, 5)]
    right = [(i, j, 1.0) for i in range(5, 10) for j in range(i + 1, 10)]
    return [*left, *right, (4, 5, 0.1)]


def test_communities(spark):
    rows = [("d", *e) for e in two_cliques()] + [("d", 20, 21, 1.0), ("e", 30, 31, 1.0), ("e", 31, 32, 1.0)]
    df = spark.createDataFrame(rows, "day string, src bigint, dst bigint, weight double")
    out = G.communities(df, "day")
    got = {r["node"]: r["community"] for r in out.collect()}
    assert len(got) == 15 == out.count()
    assert got[20] == got[21] == 20
    assert {got[i] for i in range(5)} == {0} and {got[i] for i in range(5, 10)} == {5}
    assert sorted(map(tuple, G.communities(df.repartition(5), "day").collect())) == sorted(map(tuple, out.collect()))


def test_communities_beat_singletons_and_stay_connected(spark):
    rng = np.random.default_rng(3)
    edges = {tuple(sorted(map(int, e))) for e in rng.integers(0, 80, size=(200, 2)) if e[0] != e[1]}
    df = spark.createDataFrame([("d", a, b, 1.0) for a, b in edges], "day string, src bigint, dst bigint, weight double")
    got = G.communities(df, "day")
    member = {r["node"]: r["community"] for r in got.collect()}
    assert set(member) == {x for e in edges for x in e}
    assert G.modularity(df, got, "day").first()["modularity"] > 0.2
    inside = spark.createDataFrame([(a, b) for a, b in edges if member[a] == member[b]], "src bigint, dst bigint")
    comp = {r["node"]: r["component"] for r in G.connected_components(inside).collect()}
    assert all(comp.get(x, x) == c for x, c in member.items())


@pytest.mark.parametrize("most", [3])
def test_communities_do_not_depend_on_the_size_of_a_component(spark, most):
    df = spark.createDataFrame([("d", *e) for e in two_cliques()], "day string, src bigint, dst bigint, weight double")
    got = {r["node"]: r["community"] for r in G.communities(df, "day").collect()}
    assert got == {i: 0 if i < 5 else 5 for i in range(10)}


def test_leiden_by_arrays_and_by_dictionaries(monkeypatch):
    rng = np.random.default_rng(4)
    e = np.array(sorted({tuple(sorted(map(int, x))) for x in rng.integers(0, 90, size=(1500, 2)) if x[0] != x[1]}))
    w = rng.random(len(e))
    runs = []
    for few in (0, 10_000):
        monkeypatch.setattr(G, "FEW", few)
        runs.append(G.leiden(90, e[:, 0], e[:, 1], w, float(w.sum())).tolist())
    assert runs[0] == runs[1] and 1 < len(set(runs[0])) < 90


def test_many_copies_of_a_message_stay_apart_from_others(spark):
    near, other, bridge = [1.0, 0.0], [0.0, 1.0], [0.6, 0.8]
    rows = [("d", i, near if i < 1001 else other if i < 1041 else bridge) for i in range(1042)]
    df = spark.createDataFrame(rows, "day string, id bigint, v array<float>")
    edges = G.similarity_edges(df, "day", "id", "v", 0.55)
    assert edges.count() > 500_000
    got = {r["node"]: r["community"] for r in G.communities(edges, "day").collect()}
    assert {got[i] for i in range(1001)} == {0} and {got[i] for i in range(1001, 1041)} == {1001} and len(got) == 1042


def test_equal_vectors_are_one_node(spark):
    """The communities of copies are as good as those found among all rows, and copies stay together."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(14, 4))
    picks = [int(k) for k in rng.integers(0, 14, size=70)]
    rows = [("d", i, [float(y) for y in x[k]]) for i, k in enumerate(picks)] + [("d", 200, [0.0] * 4), ("d", 201, [0.0] * 4), ("e", 300, [1.0] * 4), ("e", 301, [1.0] * 4), ("d", 400, None)]
    df = spark.createDataFrame(rows, "day string, id bigint, v array<float>")
    got = G.vector_communities(df, "day", "id", "v", 0.7)
    found = {r["node"]: r["community"] for r in got.collect()}
    edges = G.similarity_edges(df, "day", "id", "v", 0.7)
    assert set(found) == {r[c] for r in edges.collect() for c in ("src", "dst")} and got.count() == len(found)
    assert found[300] == found[301] == 300
    for i, a in enumerate(picks):
        for j, b in enumerate(picks[:i]):
            assert a != b or found[i] == found[j]
    plain = {r["day"]: r["modularity"] for r in G.modularity(edges, G.communities(edges, "day"), "day").collect()}
    folded = {r["day"]: r["modularity"] for r in G.modularity(edges, got, "day").collect()}
    assert all(folded[d] >= plain[d] - 1e-6 for d in plain)


def test_many_copies_are_no_pairs(spark):
    df = spark.range(200_000).selectExpr("'d' as day", "id", "array(1f, 2f, cast(if(id = 7, 3, 2) as float)) as v")
    got = G.vector_communities(df, "day", "id", "v", 0.9)
    assert got.count() == 200_000 and got.select("community").distinct().count() <= 2

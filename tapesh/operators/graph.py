"""Similarity joins, connected components and communities.

similarity_edges is exact: within a scope the vectors are dealt to blocks and
every two blocks meet in one task, as a matrix product, so a task holds two
blocks however large the scope is. connected_components alternates large-star
and small-star steps over the edge table. communities runs Leiden on pieces
that are never connected to one another, each whole in a task whatever its
size: a task holds the edges of one component as flat arrays.

Defined cases: null and zero vectors have no similar ones; loops and edges
with a null end are void; repeated edges count once for components and add
up for communities; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapesh.runtime import HOT_ROWS, Scratch, hot_values, lookup_join, small


def similarity_edges(df: DataFrame, scope: str, row: str, vec: str, threshold: float, block_rows: int = 2048) -> DataFrame:
    """<scope>, src, dst, weight: pairs src < dst of a scope with cosine of at least threshold."""
    rows = df.where(F.col(vec).isNotNull()).select(scope, F.col(row).alias("id"), F.col(vec).alias("v"))
    blocks = rows.groupBy(scope).agg(F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("int").alias("_nb"))
    rows = rows.join(small(blocks), scope).withColumn("b", F.pmod(F.xxhash64("id"), F.col("_nb")).cast("int"))
    met = rows.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)))
    met = met.select(scope, "id", "v", "b", F.least("b", "_o").alias("_lo"), F.greatest("b", "_o").alias("_hi"))

    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = f"`{scope}` {kinds[scope]}, src {kinds[row]}, dst {kinds[row]}, weight double"
    at = [scope, "_lo", "_hi"]
    return met.repartition(*at).sortWithinPartitions(*at, "id").mapInPandas(_meetings(scope, threshold), schema)


def _meetings(scope: str, threshold: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Runs of rows of one scope and two blocks, each as a matrix product; many small runs share a batch."""

    def meet(ids: np.ndarray, x: np.ndarray, b: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        left, right = (slice(None), slice(None)) if lo == hi else (np.flatnonzero(b == lo), np.flatnonzero(b == hi))
        s = x[left] @ x[right].T
        i, j = np.nonzero(s >= threshold)
        a, c = ids[left][i], ids[right][j]
        keep = a < c if lo == hi else a != c
        return np.minimum(a, c)[keep], np.maximum(a, c)[keep], s[i, j][keep]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for pdf in _then_none(batches):
            if pdf is not None and not len(pdf):
                continue
            last = None if pdf is None else (pdf[scope].iat[-1], pdf["_lo"].iat[-1], pdf["_hi"].iat[-1])
            if pdf is not None:
                held.append(pdf)
                first = held[0]
                if last == (first[scope].iat[0], first["_lo"].iat[0], first["_hi"].iat[0]):
                    continue  # the run may go on
            if not held:
                continue
            rows = pd.concat(held, ignore_index=True) if len(held) > 1 else held[0].reset_index(drop=True)
            keys = rows[[scope, "_lo", "_hi"]]
            starts = np.flatnonzero((keys != keys.shift()).any(axis=1).to_numpy())
            ends = np.append(starts[1:], len(rows))
            whole = len(starts) if pdf is None else len(starts) - 1
            held = [] if pdf is None else [rows.iloc[starts[-1] :]]
            if not whole:
                continue
            n = ends[whole - 1]
            x = np.array(rows["v"].iloc[:n].tolist(), dtype=np.float64)
            length = np.linalg.norm(x, axis=1, keepdims=True)
            x = np.divide(x, length, out=np.zeros_like(x), where=length > 0)
            ids, b, los, his, scopes = (rows[c].to_numpy() for c in ("id", "b", "_lo", "_hi", scope))
            found = []
            for p, q in zip(starts[:whole], ends[:whole], strict=True):
                if q - p > 1:
                    src, dst, w = meet(ids[p:q], x[p:q], b[p:q], los[p], his[p])
                    if len(src):
                        found.append(pd.DataFrame({scope: np.repeat(scopes[p : p + 1], len(src)), "src": src, "dst": dst, "weight": w}))
            if found:
                yield pd.concat(found, ignore_index=True)

    return run


def _then_none(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def _star(edges: DataFrame, large: bool, rows: int) -> DataFrame:
    """One step; edges are (u, v) with u < v, and at most so many rows both ways."""
    if large:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("n"))
    hot = hot_values(least, "u", "n", rows=rows)
    at = lookup_join(near, least.drop("n"), ["u"], hot, F.col("v"))
    far = at.where(F.col("v") > F.col("u")) if large else at
    out = far.select(F.col("m").alias("u"), F.col("v").alias("v"))
    if not large:
        out = out.unionByName(least.select(F.col("m").alias("u"), F.col("u").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


#: Edges that one task takes in, some 200 bytes each.
TASK_EDGES = 500_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, component of all edges (u, v) given, by union to the smaller root."""
    above: dict = {}

    def root(x):
        top = x
        while above[top] != top:
            top = above[top]
        while above[x] != top:
            above[x], x = top, above[x]
        return top

    schema = None
    for batch in batches:
        schema = pa.schema([("node", batch.schema.field(0).type), ("component", batch.schema.field(0).type)])
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(above.setdefault(a, a)), root(above.setdefault(b, b))
            if a != b:
                above[max(a, b)] = min(a, b)
    if above:
        nodes = list(above)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, schema.field(0).type), pa.array([root(x) for x in nodes], schema.field(0).type)], schema=schema)


def connected_components(edges: DataFrame, u: str = "src", v: str = "dst", task_edges: int = TASK_EDGES) -> DataFrame:
    """node, component: the smallest node linked to each node of the edges.

    Distinct edges that one task can hold are united there, more by star steps
    over tables; the result is the same.
    """
    scratch = Scratch(edges.sparkSession, "components")
    real = edges.where(F.col(u).isNotNull() & F.col(v).isNotNull() & (F.col(u) != F.col(v)))
    cur = scratch.write(real.select(F.least(u, v).alias("u"), F.greatest(u, v).alias("v")).distinct())
    mark = lambda e: e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    before = mark(cur)
    if before[0] <= task_edges:
        kind = cur.schema["u"].dataType.simpleString()
        return scratch.write(cur.coalesce(1).mapInArrow(_forest, f"node {kind}, component {kind}"))
    while before[0]:
        rows = 2 * before[0]
        wide = _star(cur, True, rows)
        if rows >= HOT_ROWS:  # else nothing has to be counted between the steps
            wide = scratch.write(wide)
        new = scratch.write(_star(wide, False, rows))
        after = mark(new)
        scratch.drop(wide, cur)
        cur = new
        if after == before:
            break
        before = after
    return cur.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(cur.select(F.col("u").alias("node"), F.col("u").alias("component"))).distinct()


# ---- communities

#: Neighbours up to which a dictionary is quicker than arrays.
FEW = 64


def leiden(n: int, src: np.ndarray, dst: np.ndarray, weight: np.ndarray, total: float, resolution: float = 1.0, own: np.ndarray | None = None) -> np.ndarray:
    """Community of each of n nodes by modularity (Traag, Waltman, van Eck 2019), in fixed order, without chance.

    Every pair is an edge once at most; own is the weight inside each node;
    total is the weight of the whole graph.
    """
    member = np.arange(n)
    part = np.arange(n)
    own = np.zeros(n) if own is None else own  # later of nodes merged in earlier rounds too
    while True:
        adj = _Adjacency(n, src, dst, weight)
        degree = adj.sums() + 2 * own
        part = _move(adj, degree, part, total, resolution)
        fine = _refine(adj, degree, part, total, resolution)
        del adj
        _, fine = np.unique(fine, return_inverse=True)
        k = int(fine.max()) + 1 if n else 0
        if k == n:
            _, part = np.unique(part, return_inverse=True)
            return part[member]
        first = np.zeros(k, dtype=int)
        first[fine[::-1]] = np.arange(n)[::-1]
        inner = np.bincount(fine, weights=own, minlength=k)
        a, b = fine[src], fine[dst]
        inner += np.bincount(a[a == b], weights=weight[a == b], minlength=k)
        lo, hi, w = np.minimum(a, b)[a != b], np.maximum(a, b)[a != b], weight[a != b]
        pair, at = np.unique(lo * k + hi, return_inverse=True)
        src, dst, weight, own = pair // k, pair % k, np.bincount(at, weights=w, minlength=len(pair)), inner
        _, coarse = np.unique(part[first], return_inverse=True)
        part, member, n = coarse, fine[member], k


class _Adjacency:
    """Neighbours of each node and their weights in two flat arrays, in the order of the edges."""

    def __init__(self, n: int, src: np.ndarray, dst: np.ndarray, weight: np.ndarray):
        ends = np.column_stack([src, dst]).ravel()
        order = np.argsort(ends, kind="stable")
        self.n = n
        self.start = np.concatenate([[0], np.cumsum(np.bincount(ends, minlength=n))]).tolist()
        self.to = np.column_stack([dst, src]).ravel()[order]
        self.weight = weight[order // 2]

    def of(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(self.start[i], self.start[i + 1])
        return self.to[at], self.weight[at]

    def sums(self) -> np.ndarray:
        return np.array([sum(self.of(i)[1].tolist()) for i in range(self.n)], dtype=float)


def _gains(part: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parts in rising order, and the weight to each."""
    if len(part) > FEW:
        parts, at = np.unique(part, return_inverse=True)
        return parts, np.bincount(at, weights=weight, minlength=len(parts))
    out: dict[int, float] = {}
    for c, w in zip(part.tolist(), weight.tolist(), strict=True):
        out[c] = out.get(c, 0.0) + w
    parts = sorted(out)
    return np.array(parts, dtype=int), np.array([out[c] for c in parts], dtype=float)


def _move(adj: _Adjacency, degree: np.ndarray, part: np.ndarray, total: float, resolution: float) -> np.ndarray:
    part = part.copy()
    mass = np.bincount(part, weights=degree, minlength=len(degree))
    todo, queued = list(range(adj.n)), np.ones(adj.n, dtype=bool)
    at = 0
    while at < len(todo):
        i = todo[at]
        at += 1
        queued[i] = False
        c, d = int(part[i]), degree[i]
        mass[c] -= d
        near, weight = adj.of(i)
        parts, gain = _gains(part[near], weight)
        value = gain - resolution * d * mass[parts] / (2 * total)
        here = np.searchsorted(parts, c)
        inside = here < len(parts) and parts[here] == c
        best, high = c, value[here] if inside else -resolution * d * mass[c] / (2 * total)
        top = np.maximum.accumulate(value)
        for k in np.flatnonzero(np.concatenate([[True], value[1:] > top[:-1]])[: len(value)]).tolist():  # only these can be better
            if value[k] > high + 1e-12:
                best, high = int(parts[k]), value[k]
        mass[best] += d
        if best != c:
            part[i] = best
            again = near[(part[near] != best) & ~queued[near]]
            queued[again] = True
            todo += again.tolist()
    return part


def _refine(adj: _Adjacency, degree: np.ndarray, part: np.ndarray, total: float, resolution: float) -> np.ndarray:
    """Within each community single nodes join a neighbour's part, so that every part stays connected."""
    fine = np.arange(adj.n)
    mass = degree.astype(float).copy()
    size = np.ones(adj.n, dtype=int)
    for i in range(adj.n):
        if size[fine[i]] > 1 or fine[i] != i:
            continue
        near, weight = adj.of(i)
        with_it = part[near] == part[i]
        parts, gain = _gains(fine[near[with_it]], weight[with_it])
        if not len(parts):
            continue
        value = gain - resolution * degree[i] * mass[parts] / (2 * total)
        k = int(np.argmax(value))
        if value[k] > 1e-12:
            best = int(parts[k])
            fine[i] = best
            mass[best] += degree[i]
            size[best] += 1
    return fine


def communities(edges: DataFrame, scope: str, resolution: float = 1.0) -> DataFrame:
    """<scope>, node, community (its smallest node): Leiden on the edges (<scope>, src, dst, weight) of each scope.

    An edge from a node to itself is weight inside the node. Communities never
    cross components, so each component is a task of its own, with the weight
    of its whole scope. No component is coarsened, divided or left out.
    """
    scratch = Scratch(edges.sparkSession, "leiden")
    e = edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    e = e.groupBy(scope, F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).agg(F.sum("weight").alias("w"))
    e = scratch.write(e)
    totals = e.groupBy(scope).agg(F.sum("w").alias("total"))
    comp = scratch.write(connected_components(e, "a", "b"))
    loops = e.where(F.col("a") == F.col("b"))
    alone = loops.join(comp.select(F.col("node").alias("a")), "a", "left_anti").select(scope, F.col("a").alias("node"), F.col("a").alias("community"))
    degrees = e.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    e = scratch.write(lookup_join(e, comp.select(F.col("node").alias("a"), F.col("component").alias("comp")), ["a"], hot_values(degrees, "a", "n"), F.col("b")))
    sizes = scratch.write(e.groupBy("comp").agg(F.count(F.lit(1)).alias("n")))
    pairs = e.join(sizes.where("n = 1").select("comp"), "comp", "left_semi")
    ready = e.join(sizes.where("n > 1").select("comp"), "comp", "left_semi").join(small(totals), scope)

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        total = table.column("total")[0].as_py()
        a, b, w = (table.column(c).to_numpy() for c in ("a", "b", "w"))
        del table
        ids = np.unique(np.concatenate([np.unique(a), np.unique(b)]))
        a, b, w = np.searchsorted(ids, a), np.searchsorted(ids, b), w.astype(float)
        own = np.bincount(a[a == b], weights=w[a == b], minlength=len(ids))
        a, b, w = a[a != b], b[a != b], w[a != b]
        order = np.lexsort([b, a])
        got = leiden(len(ids), a[order], b[order], w[order], total, resolution, own)
        first = np.unique(got, return_index=True)[1]  # ids rise
        kind = key[1].type  # of a node
        return pa.table({scope: pa.repeat(key[0], len(ids)), "node": pa.array(ids, kind), "community": pa.array(ids[first[got]], kind)})

    kinds = {f.name: f.dataType.simpleString() for f in edges.schema.fields}
    found = ready.groupBy(scope, "comp").applyInArrow(run, f"`{scope}` {kinds[scope]}, node {kinds['src']}, community {kinds['src']}")
    ends = F.explode(F.array("a", "b"))  # a component of one edge is one community
    return found.unionByName(pairs.select(scope, ends.alias("node"), F.col("a").alias("community"))).unionByName(alone)


def vector_communities(df: DataFrame, scope: str, row: str, vec: str, threshold: float, block_rows: int = 2048, resolution: float = 1.0) -> DataFrame:
    """<scope>, node, community of rows linked by the cosine of their vectors: similarity_edges() and communities(), equal vectors taken as one node.

    Rows of one vector are one node of the graph, with their number in the
    weights of its edges and the weight of their own pairs inside it, so a
    vector that a third of all rows have is one node and not its pairs. The
    modularity is that of all rows; rows of one vector stay together. Rows
    without a like have no community; neither have rows of length zero.
    """
    scratch = Scratch(df.sparkSession, "vectors")
    rows = df.where(F.col(vec).isNotNull() & F.col(row).isNotNull()).select(scope, F.col(row).alias("id"), F.col(vec).alias("v"))
    rows = rows.withColumn("h", F.xxhash64(scope, "v"))
    sets = scratch.write(rows.groupBy("h", scope, "v").agg(F.min("id").alias("rep"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n")), "sets")
    edges = similarity_edges(sets.select(scope, "rep", "v"), scope, "rep", "v", threshold, block_rows)
    positive = F.exists("v", lambda x: x != 0)
    many = scratch.write(sets.where((F.col("rep") != F.col("last")) & positive), "many")
    times = lambda k: many.select(F.col("rep").alias(k), F.col("n").cast("double").alias(f"n_{k}"))
    one = F.lit(1.0)
    edges = edges.join(times("src"), "src", "left").join(times("dst"), "dst", "left")
    edges = edges.select(scope, "src", "dst", (F.col("weight") * F.coalesce("n_src", one) * F.coalesce("n_dst", one)).alias("weight"))
    n = F.col("n").cast("double")
    inside = many.select(scope, F.col("rep").alias("src"), F.col("rep").alias("dst"), (n * (n - 1) / 2).alias("weight"))
    found = scratch.write(communities(scratch.write(edges.unionByName(inside), "edges"), scope, resolution), "found")
    of = ["h", scope, "v"]
    copies = lookup_join(rows, many.select(*of, "rep"), of, hot_values(many, "h", "n"), F.col("id")).where(F.col("id") != F.col("rep"))
    at = found.select(F.col("node").alias("rep"), "community")
    copies = lookup_join(copies.select(scope, "id", "rep"), at, ["rep"], hot_values(many, "rep", "n"), F.col("id"))
    return found.unionByName(copies.select(scope, F.col("id").alias("node"), "community"))


def modularity(edges: DataFrame, member: DataFrame, scope: str) -> DataFrame:
    """<scope>, modularity of a partition (<scope>, node, community)."""
    e = edges.select(scope, "src", "dst", "weight")
    m = member.select("node", "community")
    at = e.join(m.select(F.col("node").alias("src"), F.col("community").alias("cs")), "src").join(m.select(F.col("node").alias("dst"), F.col("community").alias("cd")), "dst")
    inside = at.groupBy(scope).agg(F.sum("weight").alias("m"), F.sum(F.when(F.col("cs") == F.col("cd"), F.col("weight")).otherwise(0.0)).alias("inside"))
    deg = at.select(scope, F.col("cs").alias("c"), "weight").unionByName(at.select(scope, F.col("cd").alias("c"), "weight")).groupBy(scope, "c").agg(F.sum("weight").alias("d"))
    sq = deg.groupBy(scope).agg(F.sum(F.col("d") * F.col("d")).alias("sq"))
    return inside.join(sq, scope).select(scope, (F.col("inside") / F.col("m") - F.col("sq") / (4 * F.col("m") * F.col("m"))).alias("modularity"))

"""Pairwise matches consolidated into groups, by deterministic Borůvka hooking.

Each round every component selects its smallest outgoing edge. With edges
ordered by (smaller end, larger end) that is the edge to its smallest
neighbour, so the selected edges form trees but for pairs that select each
other, where the smaller component becomes the root. Trees collapse by
pointer doubling, edges are relabelled by root and deduplicated, and the
next round runs on what is left, at most half the components. The smallest
component of a tree always is a root, so the last label is the smallest
node.

Defined cases: edges with a null end and loops are void, repeated edges
count once, an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapesh.runtime import Scratch, hot_values, lookup_join


def _counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def _ends(edges: DataFrame) -> DataFrame:
    u, v = F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")
    return edges.where(F.col("u") != F.col("v")).select(u, v).distinct()


def connected_groups(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """node, root: for every node of edges (u, v bigint) the smallest node linked to it."""
    scratch = scratch or Scratch(edges.sparkSession, "groups")
    edges = scratch.write(_ends(edges.where(F.col("u").isNotNull() & F.col("v").isNotNull())), "edges")
    rounds: list[tuple[DataFrame, int]] = []
    while rows := edges.count():
        parents = _hook(scratch, edges, 2 * rows)
        hot = hot_values(_counts(edges, "u"), "u", "n", rows=rows)
        at = lookup_join(edges, parents.select(F.col("c").alias("u"), F.col("p").alias("ru")), ["u"], hot, F.col("v"))
        hot = hot_values(_counts(edges, "v"), "v", "n", rows=rows)
        at = lookup_join(at, parents.select(F.col("c").alias("v"), F.col("p").alias("rv")), ["v"], hot, F.col("u"))
        left = scratch.write(_ends(at.select(F.col("ru").alias("u"), F.col("rv").alias("v"))), "edges")
        scratch.drop(edges)
        rounds.append((parents, 2 * rows))
        edges = left
    if not rounds:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    labels = rounds[-1][0]
    for parents, bound in reversed(rounds[:-1]):
        hot = hot_values(_counts(parents, "p"), "p", "n", rows=bound)
        top = labels.select(F.col("c").alias("p"), F.col("p").alias("r"))
        labels = lookup_join(parents, top, ["p"], hot, F.col("c"), "left").select("c", F.coalesce("r", "p").alias("p"))
        labels = scratch.write(labels, "labels")
    return labels.select(F.col("c").alias("node"), F.col("p").alias("root"))


def _hook(scratch: Scratch, edges: DataFrame, bound: int) -> DataFrame:
    """c, p: the root of each component's tree of selected edges; there are at most bound components."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    parents = scratch.write(both.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("p")), "selected")
    first = True
    while True:
        hot = hot_values(_counts(parents, "p"), "p", "n", rows=bound)
        up = parents.select(F.col("c").alias("p"), F.col("p").alias("g"))
        jumped = lookup_join(parents, up, ["p"], hot, F.col("c"))
        if first:  # of two that select each other the smaller is the root
            mutual = F.col("g") == F.col("c")
            step = jumped.select("c", F.when(mutual, F.least("c", "p")).otherwise(F.col("p")).alias("p"), F.lit(True).alias("moved"))
        else:
            step = jumped.select("c", F.col("g").alias("p"), (F.col("g") != F.col("p")).alias("moved"))
        step = scratch.write(step, "doubled")
        scratch.drop(parents)
        parents = step
        if not first and parents.where("moved").isEmpty():
            return parents.select("c", "p")
        first = False
        parents_path = parents._scratch_path
        parents = parents.select("c", "p", "moved")
        parents._scratch_path = parents_path


def link_posts(posts: DataFrame, pairs: DataFrame) -> DataFrame:
    """post_id, group_id of each post linked to another one.

    Posts with the same non-null cluster_id are linked, and the two posts of
    a pair unless an id is null or unknown, both are equal, or
    shared_location does not occur in location_entities of both.

    A label links its posts through the smallest one (so one label holding a
    third of all posts is no more edges than posts), and the labels are
    contracted before the first round.
    """
    scratch = Scratch(posts.sparkSession, "links")
    labelled = posts.where(F.col("cluster_id").isNotNull() & F.col("post_id").isNotNull()).select("post_id", "cluster_id")
    labels = labelled.groupBy("cluster_id").agg(F.min("post_id").alias("first"), F.max("post_id").alias("last"), F.count(F.lit(1)).alias("n"))
    labels = scratch.write(labels.where(F.col("first") < F.col("last")), "labels")
    hot_labels = hot_values(labels, "cluster_id", "n")
    ids = posts.where(F.col("post_id").isNotNull()).select("post_id", "cluster_id", "location_entities")
    named = lookup_join(ids, labels.select("cluster_id", "first"), ["cluster_id"], hot_labels, F.col("post_id"), "left")
    named = scratch.write(named.select("post_id", F.coalesce("first", "post_id").alias("c"), F.col("first").isNotNull().alias("many"), "location_entities"), "named")

    a, b = F.least("post_a", "post_b").alias("a"), F.greatest("post_a", "post_b").alias("b")
    real = F.col("post_a").isNotNull() & F.col("post_b").isNotNull() & (F.col("post_a") != F.col("post_b")) & F.col("shared_location").isNotNull()
    pairs = scratch.write(pairs.where(real).select(a, b, F.col("shared_location").alias("s")).distinct(), "pairs")
    # the places of the posts that pairs name are moved once, not those of all posts twice
    asked = pairs.select(F.explode(F.array("a", "b")).alias("post_id")).distinct()
    named_by_pairs = scratch.write(named.join(asked, "post_id", "left_semi").select("post_id", "c", "location_entities"), "asked")
    side = lambda k: named_by_pairs.select(F.col("post_id").alias(k), F.col("c").alias(f"c{k}"), F.col("location_entities").alias(f"l{k}"))
    n = pairs.count()
    at = lookup_join(pairs, side("a"), ["a"], hot_values(_counts(pairs, "a"), "a", "n", rows=n), F.col("b")).where(F.col("la").contains(F.col("s"))).drop("la")
    at = lookup_join(at, side("b"), ["b"], hot_values(_counts(pairs, "b"), "b", "n", rows=n), F.col("a")).where(F.col("lb").contains(F.col("s")))
    groups = connected_groups(at.select(F.col("ca").alias("u"), F.col("cb").alias("v")), scratch)

    hot = hot_values(labels, "first", "n")
    out = lookup_join(named, groups.select(F.col("node").alias("c"), "root"), ["c"], hot, F.col("post_id"), "left")
    out = out.where(F.col("many") | F.col("root").isNotNull())
    return out.select("post_id", F.coalesce("root", "c").alias("group_id")).distinct()

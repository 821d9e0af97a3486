"""Clusters of posts that share a future date and places or happenings, and their clean-up by medoid.

Posts are linked through their keys: all posts of a (date, key) to the
smallest one, so a key that a third of all posts share is as many edges as
posts. Three tiers, each among the posts that the ones before left: a place
and a happening, a place, a happening; what is left makes clusters of one.

Input rows: row_id bigint, future_date string, locations and events
array<string>. Rows without a date or without any key are not clustered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapesh.config import EngineConfig
from tapesh.functions import text as T
from tapesh.functions import vectors as V
from tapesh.operators.graph import connected_components, similarity_edges
from tapesh.runtime import Scratch, hot_values, lookup_join

TIERS = ("LocEvent", "Loc", "Event")


def entity_rows(df: DataFrame, row: str, date: str = "future_date", locations: str = "location_entities", events: str = "event_entities") -> DataFrame:
    """Rows of a date with at least one parsed place or happening."""
    out = df.select(F.col(row).alias("row_id"), F.col(date).alias("future_date"), T.entity_set(F.col(locations)).alias("locations"), T.entity_set(F.col(events)).alias("events"))
    dated = F.col("future_date").isNotNull() & (F.col("future_date") != "None")
    return out.where(F.col("row_id").isNotNull() & dated & ((F.size("locations") > 0) | (F.size("events") > 0)))


def tier_keys(tier: str) -> Column:
    """The keys by which a row meets others in a tier."""
    if tier == "Loc":
        return F.col("locations")
    if tier == "Event":
        return F.col("events")
    return F.flatten(F.transform("locations", lambda a: F.transform("events", lambda b: F.concat(a, F.lit("\x01"), b))))


def components_by_key(rows: DataFrame, tier: str) -> DataFrame:
    """row_id, component (its smallest row_id) of rows linked through keys of the tier within their date; at least two."""
    keyed = rows.select("row_id", "future_date", F.explode(tier_keys(tier)).alias("k"))
    firsts = keyed.groupBy("k", "future_date").agg(F.min("row_id").alias("f"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    edges = lookup_join(keyed, firsts.drop("n"), ["k", "future_date"], hot_values(firsts, "k", "n"), F.col("row_id"))
    return connected_components(edges.select(F.col("row_id").alias("src"), F.col("f").alias("dst"))).select(F.col("node").alias("row_id"), "component")


def tiers(rows: DataFrame) -> DataFrame:
    """row_id, future_date, tier (1 to 4), cluster_type, component."""
    scratch = Scratch(rows.sparkSession, "tiers")
    left = scratch.write(rows)
    done = None
    for k, tier in enumerate(TIERS, 1):
        comps = scratch.write(components_by_key(left, tier))
        hit = left.join(comps, "row_id").select("row_id", "future_date", F.lit(k).alias("tier"), F.lit(tier).alias("cluster_type"), "component")
        done = hit if done is None else done.unionByName(hit)
        left = scratch.write(left.join(comps.select("row_id"), "row_id", "left_anti"))
    has = lambda c: F.size(c) > 0
    kind = F.when(has("locations") & has("events"), "LocEvent_Solo").when(has("locations"), "Loc_Solo").otherwise("Event_Solo")
    return done.unionByName(left.select("row_id", "future_date", F.lit(4).alias("tier"), kind.alias("cluster_type"), F.col("row_id").alias("component")))


def global_number(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """df with out, each row's place in the order, from 1, without sorting in one task.

    The rows are range-partitioned and written with their place within the
    partition; the partitions' sizes, as few as partitions, give the rest.
    """
    scratch = Scratch(df.sparkSession, "numbered")
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    at = scratch.write(ranged.select("*", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_i")))
    sizes = sorted((r["_p"], r["n"]) for r in at.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).collect())
    before, rows = 0, []
    for p, n in sizes:
        rows.append((p, before))
        before += n
    starts = df.sparkSession.createDataFrame(rows, "_p int, _start bigint")
    return at.join(F.broadcast(starts), "_p").withColumn(out, F.col("_start") + F.col("_i") + 1).drop("_p", "_i", "_start")


def name_clusters(tiered: DataFrame) -> DataFrame:
    """row_id, future_date, cluster_id, cluster_type; clusters are numbered by date, tier and first row."""
    comps = tiered.groupBy("future_date", "tier", "component", "cluster_type").agg(F.count(F.lit(1)).alias("n"))
    numbered = global_number(comps, ["future_date", "tier", "component"], "no")
    name = F.concat_ws("_", F.lit("Cluster"), F.col("no").cast("string"), T.compact_date(F.col("future_date")), F.col("cluster_type"))
    named = numbered.select("tier", "component", name.alias("cluster_id"), "n")
    out = lookup_join(tiered, named.drop("n"), ["component", "tier"], hot_values(named, "component", "n"), F.col("row_id"))
    return out.select("row_id", "future_date", "cluster_id", "cluster_type")


def cluster_posts(df: DataFrame, row: str) -> DataFrame:
    """df with cluster_id and cluster_type, null where a row is not clustered."""
    named = name_clusters(tiers(entity_rows(df, row)))
    kept = df.drop("cluster_id", "cluster_type")
    return kept.join(named.select(F.col("row_id").alias(row), "cluster_id", "cluster_type"), row, "left")


def denoise(rows: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Members too far from their cluster's medoid lose their cluster, those too near are dropped.

    rows: row_id, cluster_id (null: passed on), vec and more. Clusters of one
    stay as they are. Returns rows with cluster_id as it is after.
    """
    scratch = Scratch(rows.sparkSession, "medoids")
    inside = rows.where(F.col("cluster_id").isNotNull())
    sizes = scratch.write(inside.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"))
    hot = hot_values(sizes, "cluster_id", "_n")
    many = inside.join(sizes.select("cluster_id"), "cluster_id", "left_semi")
    m = V.medoids(many, ["cluster_id"], "row_id", "vec", hot)
    m = m.select("cluster_id", F.col("row_id").alias("_medoid"), F.col("vec").alias("_mv"))
    at = lookup_join(many, m, ["cluster_id"], hot, F.col("row_id")).withColumn("_s", V.cosine(F.col("vec"), F.col("_mv")))
    own = F.col("row_id") == F.col("_medoid")
    at = at.where(own | (F.col("_s") <= cfg.medoid_duplicate))
    at = at.withColumn("cluster_id", F.when(own | (F.col("_s") >= cfg.medoid_noise), F.col("cluster_id"))).drop("_medoid", "_mv", "_s")
    rest = rows.where(F.col("cluster_id").isNull()).unionByName(inside.join(sizes.select("cluster_id"), "cluster_id", "left_anti"))
    return at.unionByName(rest)


def merge_by_medoid(rows: DataFrame, cfg: EngineConfig) -> DataFrame:
    """rows (row_id, future_date, cluster_id, vec and more) with clusters of a date merged whose medoids are similar; the smallest name stays."""
    inside = rows.where(F.col("cluster_id").isNotNull())
    counts = inside.groupBy("future_date").agg(F.count(F.lit(1)).alias("_n"))
    m = V.medoids(inside, ["future_date", "cluster_id"], "row_id", "vec", hot_values(counts, "future_date", "_n"))
    near = similarity_edges(m, "future_date", "cluster_id", "vec", cfg.medoid_merge, cfg.block_rows)
    new = connected_components(near).select(F.col("node").alias("cluster_id"), F.col("component").alias("_new"))
    return rows.join(new, "cluster_id", "left").withColumn("cluster_id", F.coalesce("_new", "cluster_id")).drop("_new")


def verify_candidates(rows: DataFrame, cfg: EngineConfig, text: str = "text", location: str = "location_entities") -> DataFrame:
    """cluster_id, size, messages, predicted_time, predicted_location of clusters above the gate.

    Messages are a sample that depends on the seed and the row ids alone.
    """
    inside = rows.where(F.col("cluster_id").isNotNull())
    sizes = inside.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > cfg.verify_above)
    inside = inside.join(sizes.select("cluster_id"), "cluster_id", "left_semi")
    drawn = F.row_number().over(Window.partitionBy("cluster_id").orderBy(F.xxhash64(F.lit(cfg.seed), "row_id"), "row_id"))
    sample = inside.select("cluster_id", "row_id", text, drawn.alias("_d")).where(F.col("_d") <= cfg.verify_sample)
    sample = sample.groupBy("cluster_id").agg(F.array_sort(F.collect_list(F.struct("_d", F.col(text).alias("t")))).alias("_s"))
    time, place = most_common(inside, "cluster_id", "future_date", "predicted_time"), most_common(inside, "cluster_id", location, "predicted_location", lists=True)
    out = sizes.join(sample, "cluster_id").join(time, "cluster_id", "left").join(place, "cluster_id", "left")
    return out.select("cluster_id", "size", F.transform("_s", lambda x: x["t"]).alias("messages"), "predicted_time", "predicted_location")


#: The first of a list's elements: in single or double quotes, or a number.
_FIRST = r"""(?s)^\s*(?:'((?:[^'\\]|\\.)*)'|"((?:[^"\\]|\\.)*)"|(-?[0-9][^,]*?))\s*(?:,.*)?$"""


def first_of_list(value: Column) -> Column:
    """The first element of a list written as '[..]', null of an empty one; other values without the blanks around them."""
    text = T.strip(value)
    listed = text.rlike(r"(?s)^\[.*\]$")
    inside = F.substring(text, F.lit(2), F.length(text) - 2)
    part = lambda k: F.regexp_extract(inside, _FIRST, k)
    first = F.regexp_replace(F.concat(part(1), part(2), part(3)), r"(?s)\\(.)", "$1")
    return F.when(~listed, text).when(T.strip(inside) == "", None).when(part(0) == "", text).otherwise(first)


def most_common(rows: DataFrame, key: str, value: str, out: str, lists: bool = False) -> DataFrame:
    """key, out: the most frequent non-blank value of each key, the smallest of equally frequent ones.

    lists: of a value written as a list its first element counts.
    """
    said = first_of_list(F.col(value)) if lists else F.col(value)
    rows = rows.select(key, said.alias("_v"))
    counts = rows.where(F.col("_v").isNotNull() & ~T.strip(F.col("_v")).isin("", "None")).groupBy(key, "_v").agg(F.count(F.lit(1)).alias("_c"))
    return counts.groupBy(key).agg(F.min_by("_v", F.struct(-F.col("_c"), F.col("_v"))).alias(out))

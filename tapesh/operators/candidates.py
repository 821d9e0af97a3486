"""Candidate events of a day: merged communities, their statistics, the rules, and what represents them.

Inputs are messages (day, msg_id, text, ts, vec) and a membership (day,
msg_id, cluster). Everything is keyed by day and cluster; nothing crosses a
day. Sizes of 1 have cohesion and coverage 0. Ties are broken by id or term.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapesh.config import EngineConfig
from tapesh.functions import text as T
from tapesh.functions import vectors as V
from tapesh.functions.jalali import format_jalali, to_jalali
from tapesh.operators.graph import connected_components, similarity_edges
from tapesh.operators.value_frequency import select_places
from tapesh.runtime import Scratch

KEYS = ["day", "cluster"]
#: Characters up to which all parts of a word, or of two adjacent words, are looked up among the terms; longer ones are compared with each term.
INDEXED = 60


def merge_clusters(messages: DataFrame, member: DataFrame, cfg: EngineConfig) -> DataFrame:
    """The membership with clusters of a day merged whose centroids are similar; the smallest cluster names them."""
    c = V.centroids(messages.select("msg_id", "vec").join(member, "msg_id"), KEYS, "vec")
    near = similarity_edges(c, "day", "cluster", "centroid", cfg.merge_similarity, cfg.block_rows)
    new = connected_components(near).select(F.col("node").alias("cluster"), "component")
    return member.join(new, "cluster", "left").select("day", "msg_id", F.coalesce("component", "cluster").alias("cluster"))


def similarities(messages: DataFrame, member: DataFrame) -> DataFrame:
    """day, cluster, msg_id, sim: cosine of each member to its cluster's centroid."""
    rows = messages.select("msg_id", "vec").join(member, "msg_id")
    return rows.join(V.centroids(rows, KEYS, "vec"), KEYS).select(*KEYS, "msg_id", V.cosine(F.col("vec"), F.col("centroid")).alias("sim"))


#: Similarities as whole numbers, exact to 2^-53, and their steps.
_SCALE, _SIM_STEPS = 1 << 53, (1 << 44, 1 << 26, 1 << 9, 1)
#: Places of the order statistics between which the percentile lies, counted from 1.
_PLACES = {f"{name}{k}": f"cast({kind}({p} * (_n - 1)) as bigint) + 1" for name, p in (("p25", 0.25), ("p50", 0.5)) for k, kind in (("a", "floor"), ("b", "ceil"))}


#: Members whose similarities one aggregation buffer takes, some 5 MB.
BUFFERED = 100_000


def cohesion(sims: DataFrame, cfg: EngineConfig, buffered: int = BUFFERED) -> DataFrame:
    """day, cluster, n, median_sim, p25_sim, cohesion, coverage.

    The percentiles are those of linear interpolation. Clusters of more than
    buffered members have the places between which these lie found by weighted
    steps, so no task holds a larger one.
    """
    scratch = Scratch(sims.sparkSession, "cohesion")
    rows = scratch.write(sims.select(*KEYS, F.col("sim").cast("double").alias("sim")), "sims")
    covered = F.avg(F.when(F.col("sim") >= cfg.coverage_similarity, 1.0).otherwise(0.0)).alias("_covered")
    n = F.count(F.lit(1)).alias("n")
    large = rows.groupBy(*KEYS).agg(n, covered).where(F.col("n") > buffered)
    some = large.limit(1).count() > 0
    few = rows.join(large.select(*KEYS), KEYS, "left_anti") if some else rows
    stats = few.groupBy(*KEYS).agg(n, covered, F.percentile("sim", F.lit(0.5)).alias("_p50"), F.percentile("sim", F.lit(0.25)).alias("_p25"))
    if some:
        large = scratch.write(large, "large")
        scaled = rows.join(large.select(*KEYS), KEYS, "left_semi").select(*KEYS, F.floor(F.col("sim") * F.lit(float(_SCALE))).cast("bigint").alias("_sim"))
        found = select_places(scaled, KEYS, {"_sim": _SIM_STEPS}, _PLACES)
        at = [F.max(F.when(F.col("which") == w, F.col("_sim") / F.lit(float(_SCALE)))).alias(w) for w in _PLACES]
        between = large.join(found.groupBy(*KEYS).agg(*at), KEYS)

        def percentile(name: str, p: float) -> Column:
            part = p * (F.col("n") - 1) - F.floor(p * (F.col("n") - 1))
            return F.col(f"{name}a") + part * (F.col(f"{name}b") - F.col(f"{name}a"))

        stats = stats.unionByName(between.select(*KEYS, "n", "_covered", percentile("p50", 0.5).alias("_p50"), percentile("p25", 0.25).alias("_p25")))
    of_many = lambda c, out: F.when(F.col("n") <= 1, 0.0).otherwise(F.col(c)).alias(out)
    out = stats.select(*KEYS, "n", of_many("_p50", "median_sim"), of_many("_p25", "p25_sim"), of_many("_covered", "coverage"))
    return out.withColumn("cohesion", 0.7 * F.col("median_sim") + 0.3 * F.col("p25_sim"))


def hourly_spike(rows: DataFrame, keys: list[str], ts: str, cfg: EngineConfig) -> DataFrame:
    """keys, total, peak, z_score, is_spike over the 24 hours, the empty ones included."""
    hours = rows.groupBy(*keys, F.hour(ts).alias("_h")).agg(F.count(F.lit(1)).cast("double").alias("_c"))
    s = hours.groupBy(*keys).agg(F.sum("_c").alias("t"), F.sum(F.col("_c") * F.col("_c")).alias("q"), F.max("_c").alias("p"))
    mean = F.col("t") / 24
    std = F.sqrt(F.greatest(F.col("q") / 24 - mean * mean, F.lit(0.0)))
    z = F.when(F.col("p") < cfg.min_peak, 0.0).otherwise((F.col("p") - mean) / (std + 1.0))
    flag = (z >= cfg.spike_flag_z) & (F.col("p") / F.col("t") >= cfg.spike_flag_share)
    return s.select(*keys, F.col("t").cast("long").alias("total"), F.col("p").cast("long").alias("peak"), z.alias("z_score"), flag.alias("is_spike"))


def iqr_fence(sizes: DataFrame, day: str = "day", n: str = "n") -> DataFrame:
    """day, fence: q3 + 1.5 iqr of the sizes; a day of one cluster has none (infinity).

    The sizes are counted first: a day of so many messages has at most about
    the square root of twice as many different ones.
    """
    often = sizes.groupBy(day, n).agg(F.count(F.lit(1)).alias("_f"))
    q1, q3 = (F.percentile(n, F.lit(p), F.col("_f")) for p in (0.25, 0.75))
    return often.groupBy(day).agg(F.when(F.sum("_f") > 1, q3 + 1.5 * (q3 - q1)).otherwise(F.lit(float("inf"))).alias("fence"))


def with_ratio(clusters: DataFrame, per_day: DataFrame) -> DataFrame:
    """clusters (day, n and more) with day_n of per_day, and ratio: the percentage of the day's messages."""
    return clusters.join(per_day, "day").withColumn("ratio", 100.0 * F.col("n") / F.col("day_n"))


def statistics(messages: DataFrame, member: DataFrame, cfg: EngineConfig) -> DataFrame:
    """A row per cluster with every metric of the rules."""
    stats = cohesion(similarities(messages, member), cfg)
    spikes = hourly_spike(messages.select("msg_id", "ts").join(member, "msg_id"), KEYS, "ts", cfg).drop("total")
    per_day = messages.groupBy("day").agg(F.count(F.lit(1)).alias("day_n"))
    return with_ratio(stats.join(spikes, KEYS).join(iqr_fence(stats), "day"), per_day)


def apply_rules(stats: DataFrame, cfg: EngineConfig) -> DataFrame:
    """The clusters that a rule accepts, with is_large, has_burst, is_cohesive and the reasons in that order."""
    large = F.col("n") > F.col("fence")
    burst = F.col("z_score") >= cfg.spike_z
    tight = (F.col("ratio") > cfg.cohesive_ratio) & (F.col("median_sim") > cfg.cohesive_median) & (F.col("coverage") > cfg.cohesive_coverage)
    out = stats.withColumns({"is_large": large, "has_burst": burst, "is_cohesive": tight})
    reasons = F.filter(F.array(*[F.when(F.col(c), F.lit(r)) for c, r in (("is_large", "dominant"), ("has_burst", "spike"), ("is_cohesive", "cohesive"))]), lambda x: x.isNotNull())
    return out.withColumn("reasons", reasons).where((F.size("reasons") > 0) & (F.col("ratio") > cfg.min_ratio))


def representatives(sims: DataFrame, cfg: EngineConfig) -> DataFrame:
    """day, cluster, msg_id, rank: up to top_messages members all, in order of id; else those nearest to the centroid.

    Both ranks are limited per task before the shuffle, so no task sorts a whole cluster.
    """
    k = cfg.top_messages
    by = Window.partitionBy(*KEYS)
    sizes = sims.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("_n"))
    rows = sims.select(*KEYS, "msg_id", F.round("sim", 9).alias("sim"))
    few = rows.join(sizes.where(F.col("_n") <= k), KEYS, "left_semi").withColumn("rank", F.row_number().over(by.orderBy("msg_id"))).where(F.col("rank") <= k)
    many = rows.join(sizes.where(F.col("_n") > k), KEYS, "left_semi").withColumn("rank", F.row_number().over(by.orderBy(F.col("sim").desc(), "msg_id"))).where(F.col("rank") <= k)
    return few.unionByName(many).select(*KEYS, "msg_id", "rank")


def term_counts(rows: DataFrame, keys: list[str], text: str, least: int = 2) -> DataFrame:
    """keys, term, freq: words and adjacent pairs of words that occur at least so often."""
    words = rows.select(*keys, F.explode(F.array(T.tokens(T.normalize_text(F.col(text))))).alias("_w"))  # worked out once a row
    return words.select(*keys, F.explode(T.terms(F.col("_w"))).alias("term")).groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("freq")).where(F.col("freq") >= least)


def _parts(piece: Column) -> Column:
    """All parts of a word; of two words with a blank between them those that hold the blank."""
    blank = F.locate(" ", piece)
    until = F.when(blank > 0, blank - 1).otherwise(F.length(piece))

    def from_(i: Column) -> Column:
        ends = F.sequence(F.when(blank > 0, blank + 1).otherwise(i), F.length(piece))
        return F.transform(ends, lambda j: F.substring(piece, i, j - i + 1))

    return F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), until), from_)))


def keyword_scores(messages: DataFrame, member: DataFrame, cfg: EngineConfig) -> DataFrame:
    """day, cluster, term, freq, score, rank of the best terms.

    A term's vector is the mean of the members whose normalised text contains
    it (as a substring); its score 0.7 cosine to the centroid and 0.3 of the
    logarithm of its frequency.
    """
    scratch = Scratch(messages.sparkSession, "keywords")  # the rows are read several times
    rows = messages.select("msg_id", "text", "vec").join(member, "msg_id")
    rows = scratch.write(rows.select(*KEYS, "msg_id", "vec", T.normalize_text(F.col("text")).alias("_norm")), "rows")
    terms = term_counts(rows, KEYS, "_norm", cfg.min_term_count)  # a normalised text stays as it is
    terms = scratch.write(terms, "terms")
    words = F.split("_norm", " ")
    pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
    pieces = F.array_distinct(F.concat(words, F.filter(pairs, lambda x: x.isNotNull())))
    pieces = scratch.write(rows.select(*KEYS, "msg_id", F.explode(pieces).alias("_piece")).where(F.col("_piece") != ""), "pieces")
    # a term is part of a text where it is part of one of its words, or of two adjacent ones across the blank between them
    distinct = pieces.select(*KEYS, "_piece").distinct()
    short = distinct.where(F.length("_piece") <= INDEXED).select(*KEYS, "_piece", F.explode(_parts(F.col("_piece"))).alias("term"))
    held = short.join(terms.select(*KEYS, "term"), [*KEYS, "term"])
    long = distinct.where(F.length("_piece") > INDEXED).join(terms.select(*KEYS, "term"), KEYS).where(F.col("_piece").contains(F.col("term")))
    held = held.select(*KEYS, "_piece", "term").unionByName(long.select(*KEYS, "_piece", "term"))
    holding = pieces.join(held, [*KEYS, "_piece"]).select(*KEYS, "msg_id", "term").distinct()
    holding = holding.join(rows.select("msg_id", "vec").dropDuplicates(["msg_id"]), "msg_id")
    means = V.centroids(holding, [*KEYS, "term"], "vec", "_mean").join(terms, [*KEYS, "term"])
    scored = means.join(V.centroids(rows, KEYS, "vec"), KEYS)
    score = F.round(0.7 * V.cosine(F.col("_mean"), F.col("centroid")) + 0.3 * F.log1p(F.col("freq").cast("double")), 6)
    w = Window.partitionBy(*KEYS).orderBy(F.col("score").desc(), "term")
    out = scored.select(*KEYS, "term", "freq", score.alias("score")).withColumn("rank", F.row_number().over(w))
    return out.where(F.col("rank") <= cfg.top_keywords)


def candidates(messages: DataFrame, member: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Candidate records (schemas.CANDIDATE with the flags) of merged clusters of at least two members."""
    sizes = member.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("_n"))
    member = member.join(sizes.where("_n > 1").select(*KEYS), KEYS, "left_semi")
    scratch = Scratch(messages.sparkSession, "candidates")  # both are read several times below
    member = scratch.write(merge_clusters(messages, member, cfg), "merged")
    accepted = scratch.write(apply_rules(statistics(messages, member, cfg), cfg), "accepted")
    first = member.groupBy(*KEYS).agg(F.min("msg_id").alias("first"))
    accepted = accepted.join(first, KEYS)
    n = F.row_number().over(Window.partitionBy("day").orderBy("first"))
    accepted = accepted.withColumn("cluster_id", F.concat(F.lit("CL_"), F.date_format("day", "yyyyMMdd"), F.lit("_"), n.cast("string")))
    inside = member.join(accepted.select(*KEYS), KEYS, "left_semi")
    best = keyword_scores(messages, inside, cfg).groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("_k"))
    top = representatives(similarities(messages, inside), cfg).join(messages.select("msg_id", "text", "ts"), "msg_id")
    top = top.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("rank", "text", "ts"))).alias("_m"))
    out = accepted.join(best, KEYS, "left").join(top, KEYS)
    nothing = F.array().cast("array<string>")
    return out.select(
        "day", "cluster", "cluster_id", format_jalali(to_jalali(F.col("day"))).alias("date_shamsi"), F.col("day").cast("timestamp_ntz").alias("date_gregorian"),
        F.col("n").cast("int").alias("size"), F.coalesce(F.transform("_k", lambda x: x["term"]), nothing).alias("keywords"),
        F.round("ratio", 2).alias("daily_ratio_pct"), "reasons", "is_large", "has_burst", "is_cohesive",
        F.struct(F.round("z_score", 2).alias("z_score"), F.round("median_sim", 3).alias("median_sim"), F.round("coverage", 3).alias("coverage")).alias("metrics"),
        F.transform("_m", lambda x: x["text"]).alias("messages"), F.transform("_m", lambda x: x["ts"]).alias("timestamps"),
    )

"""The two pipelines end to end: every stage a DataFrame, all days at once.

detect: messages -> classified -> embedded -> similarity edges -> communities
-> merged, scored candidates -> verified -> sink rows. predict: messages ->
future dates -> entities -> key clusters -> clean-up by medoid -> candidates
-> verified -> sink rows.

The embeddings are written once, since they are the one stage that must not
run twice; everything else is planned by Catalyst from there.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapesh.config import EngineConfig
from tapesh.functions import temporal
from tapesh.models import interfaces as M
from tapesh.operators import candidates as C
from tapesh.operators import graph as G
from tapesh.operators import keycluster as K
from tapesh.runtime import Scratch, spread
from tapesh.sinks import writers as W


@dataclass
class Models:
    classifier: Callable[[Column], Column] = field(default_factory=M.rule_classifier)
    embedder: Callable[[Column], Column] = field(default_factory=M.hashing_embedder)
    extractor: Callable[[Column], Column] | None = None
    generator: Callable[[], Callable[[str], str]] | None = None
    instruction: str = ""


def daily_counts(classified: DataFrame) -> DataFrame:
    """day, raw_count, kept_count."""
    day = F.to_date("ts").alias("day")
    return classified.groupBy(day).agg(F.count(F.lit(1)).alias("raw_count"), F.count_if("passed_filter").alias("kept_count"))


def run_totals(counts: DataFrame, candidates: DataFrame | None = None, verified: DataFrame | None = None) -> DataFrame:
    """One row of a run: days, raw, kept and filtered messages, candidates and verified events (null where a stage did not run)."""
    of = lambda df, out: df.agg(F.count(F.lit(1)).alias(out)) if df is not None else None
    raw, kept = F.coalesce(F.sum("raw_count"), F.lit(0)), F.coalesce(F.sum("kept_count"), F.lit(0))
    out = counts.agg(F.count(F.lit(1)).alias("days"), raw.alias("raw"), kept.alias("kept"), (raw - kept).alias("filtered"))
    for df, name in ((of(candidates, "candidates"), "candidates"), (of(verified, "verified"), "verified")):
        out = out.crossJoin(F.broadcast(df)) if df is not None else out.withColumn(name, F.lit(None).cast("long"))  # one row each
    return out


def until_aborted(replies: DataFrame, candidates: DataFrame, day: str, cfg: EngineConfig) -> DataFrame:
    """Replies up to the run of cfg.abort_after unreadable ones in a row that ends a day; 0 keeps all."""
    if not cfg.abort_after:
        return replies
    at = replies.join(candidates.select("cluster_id", F.col(day).alias("_day")), "cluster_id")
    return M.abort_run(at, "_day", "cluster_id", cfg.abort_after).drop("_day")


def detect(messages: DataFrame, cfg: EngineConfig, models: Models | None = None, execution_time: Column | None = None) -> dict[str, DataFrame]:
    """messages: msg_id, text, ts. Returns the tables of every stage by name."""
    models = models or Models()
    now = execution_time if execution_time is not None else F.current_timestamp()
    scratch = Scratch(messages.sparkSession, "detect")
    classified = M.classify(messages, "text", models.classifier)
    kept = classified.where("passed_filter").select(F.to_date("ts").alias("day"), "msg_id", F.col("clean_text").alias("text"), "ts")
    embedded = scratch.write(spread(kept).withColumn("vec", models.embedder(F.col("text"))), "embedded")
    found = G.vector_communities(embedded, "day", "msg_id", "vec", cfg.similarity, cfg.block_rows)
    member = scratch.write(found.select("day", F.col("node").alias("msg_id"), F.col("community").alias("cluster")), "member")
    cands = scratch.write(C.candidates(embedded, member, cfg), "candidates")
    rows = W.candidate_rows(cands, now, cfg)
    counts = daily_counts(classified)
    out = {"counts": counts, "communities": member, "candidates": cands, "candidate_rows": rows, "totals": run_totals(counts, cands)}
    if cfg.skip_verification:
        return out
    replies = scratch.write(M.verify(cands, "cluster_id", "messages", cfg, models.generator, models.instruction), "replies")
    replies = until_aborted(replies, cands, "day", cfg)
    events = replies.where("is_event")
    confirmed = events.select(W.stable_id(F.col("cluster_id")).alias("id"))
    return out | {
        "replies": replies,
        "verified": cands.join(events.select("cluster_id", "title", "summary", "confidence"), "cluster_id"),
        "event_rows": W.event_rows(events, cands, now, cfg),
        "candidate_rows": W.update_status(rows, confirmed),
        "totals": run_totals(counts, cands, events),
    }


def predict(messages: DataFrame, cfg: EngineConfig, models: Models | None = None, execution_time: Column | None = None, compat: bool = False) -> dict[str, DataFrame]:
    """messages: msg_id, text, ts, and location_entities and event_entities unless there is an extractor.

    Entities are looked for in rows with a future date only.
    """
    models = models or Models()
    now = execution_time if execution_time is not None else F.current_timestamp()
    scratch = Scratch(messages.sparkSession, "predict")
    dated = temporal.future_dates(messages.drop("future_date"), "text", "ts", compat=compat)
    if models.extractor is not None:
        dated = M.extract_entities(dated, "text", models.extractor)
    dated = scratch.write(dated.select("msg_id", "text", "ts", "jalali_date", "future_date", "location_entities", "event_entities"), "dated")
    clustered = K.cluster_posts(dated, "msg_id").where(F.col("cluster_id").isNotNull())
    embedded = scratch.write(clustered.withColumnRenamed("msg_id", "row_id").withColumn("vec", models.embedder(F.col("text"))), "embedded")
    cleaned = scratch.write(K.denoise(embedded, cfg), "denoised")
    merged = scratch.write(K.merge_by_medoid(cleaned, cfg), "merged")
    cands = scratch.write(K.verify_candidates(merged, cfg), "candidates")
    day = F.to_date("ts").alias("day")
    raw = messages.groupBy(day).agg(F.count(F.lit(1)).alias("raw_count"))
    counts = raw.join(dated.groupBy(day).agg(F.count(F.lit(1)).alias("kept_count")), "day", "left").na.fill(0, ["kept_count"])
    out = {"dated": dated, "clustered": embedded.drop("vec"), "cleaned": merged.drop("vec"), "candidates": cands, "totals": run_totals(counts, cands)}
    if cfg.skip_verification:
        return out
    replies = scratch.write(M.verify(cands, "cluster_id", "messages", cfg, models.generator, models.instruction), "replies")
    replies = until_aborted(replies, cands, "predicted_time", cfg)
    events = cands.join(replies.where("is_event").select("cluster_id", "title", "summary"), "cluster_id")
    rows = W.predicted_rows(events, now, now, cfg)
    return out | {"replies": replies, "verified": events, "predicted_rows": rows, "totals": run_totals(counts, cands, events)}

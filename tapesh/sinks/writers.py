"""Sink rows, the status lifecycle, reports and writers. A write that fails, fails the run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapesh.config import EngineConfig
from tapesh.functions import jalali as J
from tapesh.functions import text as T


def stable_id(key: Column, base: int = 0) -> Column:
    """A positive id made of the key alone, the same in every run."""
    return F.xxhash64(key).bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(base)


def _or_empty(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def candidate_rows(candidates: DataFrame, execution_time: Column, cfg: EngineConfig = EngineConfig()) -> DataFrame:
    """schemas.CANDIDATE_CLUSTERS, status 'pending'."""
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)).cast("int").alias(c)
    return candidates.select(
        stable_id(F.col("cluster_id")).alias("id"), F.array_join("keywords", ", ").alias("keywords"), flag("is_large"), F.col("size").cast("int").alias("cluster_size"),
        flag("has_burst"), flag("is_cohesive"), F.lit("").alias("sentiment_polarity"), execution_time.cast("timestamp_ntz").alias("execution_time"),
        F.lit("pending").alias("validation_status"), T.sample_json(F.col("messages"), cfg.sample_messages).alias("sample_messages"),
    )


def event_rows(events: DataFrame, candidates: DataFrame, execution_time: Column, cfg: EngineConfig = EngineConfig()) -> DataFrame:
    """schemas.DETECTED_EVENTS of verified clusters (cluster_id, title, summary) that are candidates."""
    at = events.select("cluster_id", "title", "summary").join(candidates.select("cluster_id", "size", "messages"), "cluster_id")
    return at.select(
        stable_id(F.concat(F.lit("event:"), F.col("cluster_id"))).alias("id"), stable_id(F.col("cluster_id")).alias("cluster_id"), _or_empty("title").alias("title"),
        _or_empty("summary").alias("summary"), execution_time.cast("timestamp_ntz").alias("execution_time"), F.lit(cfg.source_name or cfg.platform).alias("source"),
        F.col("size").cast("int").alias("total_messages"), T.sample_json(F.col("messages"), cfg.sample_messages).alias("sample_messages"),
    )


def update_status(rows: DataFrame, confirmed: DataFrame, attempted: bool = True, key: str = "id", messages: str = "sample_messages", keep_unread: DataFrame | None = None) -> DataFrame:
    """Candidate rows with their status after verification.

    Confirmed ids are 'confirmed', others with messages 'rejected', those
    without stay 'pending', as do all if nothing was attempted. keep_unread
    names ids whose replies never could be read; they stay 'pending' too.
    """
    if not attempted:
        return rows
    marks = confirmed.select(F.col(key)).distinct().withColumn("_yes", F.lit(True))
    out = rows.join(marks, key, "left")
    if keep_unread is not None:
        out = out.join(keep_unread.select(key).distinct().withColumn("_unread", F.lit(True)), key, "left")
    else:
        out = out.withColumn("_unread", F.lit(None).cast("boolean"))
    has = F.coalesce(F.get_json_object(messages, "$.messages[0]"), F.lit("")) != ""
    status = F.when(F.col("_yes"), "confirmed").when(has & F.col("_unread").isNull(), "rejected").otherwise("pending")
    return out.withColumn("validation_status", status).drop("_yes", "_unread").select(*rows.columns)


def predicted_rows(events: DataFrame, execution_time: Column, created_at: Column, cfg: EngineConfig = EngineConfig()) -> DataFrame:
    """schemas.PREDICTED_EVENTS of verified clusters."""
    named = lambda c: F.coalesce(F.nullif(T.strip(F.col(c)), F.lit("")), F.lit("N/A")).alias(c)
    return events.select(
        named("title"), named("summary"), J.standard_time(F.col("predicted_time")).alias("predicted_time"), _or_empty("predicted_location").alias("predicted_location"),
        execution_time.cast("timestamp_ntz").alias("execution_time"), F.lit(cfg.source_name or cfg.platform).alias("source"),
        T.sample_json(F.col("messages"), cfg.verify_sample).alias("sample_messages"), created_at.cast("timestamp_ntz").alias("created_at"),
    )


def event_records(predicted: DataFrame) -> DataFrame:
    """schemas.EVENT_RECORDS: the rows with a random id."""
    return predicted.select(F.uuid().alias("id"), *predicted.columns)


# ---- reports
# The labels of the reports below, which are read again by read_report() and by people.


def classification_report(kept: DataFrame, counts: DataFrame) -> DataFrame:
    """A line a row (day, no, value): phase-one blocks that read_report() reads again."""
    jalali = J.format_jalali(J.to_jalali(F.col("day")))
    head = F.concat(F.lit("Date (Jalali): "), jalali, F.lit(" | (Gregorian): "), F.col("day").cast("string"))
    sums = F.concat(F.lit("Total raw messages: "), F.col("raw_count").cast("string"), F.lit(" | Filtered out: "), (F.col("raw_count") - F.col("kept_count")).cast("string"))
    heads = counts.select("day", F.lit(0).alias("no"), F.concat(head, F.lit("\n"), sums, F.lit("\n" + "-" * 70)).alias("value"))
    line = F.concat(F.lit(" "), F.col("no").cast("string"), F.lit(". ["), F.date_format("ts", "HH:mm:ss"), F.lit("] "), F.col("clean_text"))
    ends = counts.select("day", F.lit(2_000_000_000).alias("no"), F.lit("\n" + "=" * 70 + "\n").alias("value"))
    return heads.unionByName(kept.select("day", "no", line.alias("value"))).unionByName(ends)


def clustering_report(members: DataFrame) -> DataFrame:
    """A line a row (day, cluster, no, value): phase-two blocks of clusters of at least two messages.

    members: day, cluster, msg_id, ts, text. Clusters are numbered within
    their day by their smallest message; a day without any has its head.
    """
    sizes = members.groupBy("day", "cluster").agg(F.count(F.lit(1)).alias("n"), F.min("msg_id").alias("first"))
    large = sizes.where("n > 1").withColumn("no", F.row_number().over(Window.partitionBy("day").orderBy("first")))
    days = members.select("day").distinct().join(large.groupBy("day").agg(F.count(F.lit(1)).alias("k")), "day", "left")
    head = F.concat(F.lit("Date (Jalali): "), J.format_jalali(J.to_jalali(F.col("day"))), F.lit(" | (Gregorian): "), F.col("day").cast("string"))
    found = F.concat(F.lit("\nClusters found (with more than 1 message): "), F.coalesce("k", F.lit(0)).cast("string"), F.lit("\n" + "-" * 70))
    zero, last = F.lit(0).cast("long"), F.lit((1 << 63) - 1)
    heads = days.select("day", F.lit(0).alias("cluster"), zero.alias("no"), F.concat(head, found).alias("value"))
    titles = large.select("day", F.col("no").alias("cluster"), F.lit(-(1 << 63)).alias("no"), F.concat(F.lit("\n Cluster #"), F.col("no").cast("string"), F.lit(" ("), F.col("n").cast("string"), F.lit(" message(s)):")).alias("value"))
    line = F.concat(F.lit("    - ["), F.date_format("ts", "HH:mm:ss"), F.lit("] "), F.col("text"))
    lines = members.join(large.select("day", "cluster", F.col("no").alias("_no")), ["day", "cluster"]).select("day", F.col("_no").alias("cluster"), F.col("msg_id").alias("no"), line.alias("value"))
    ends = days.select("day", F.lit(2_000_000_000).alias("cluster"), last.alias("no"), F.lit("\n" + "=" * 70 + "\n").alias("value"))
    return heads.unionByName(titles).unionByName(lines).unionByName(ends)


def candidate_report(candidates: DataFrame, most: int = 10) -> DataFrame:
    """cluster_id, value: phase-three blocks."""
    more = F.size("messages") - most
    lines = F.array_join(F.transform(F.slice("messages", 1, most), lambda m: F.concat(F.lit("      - "), m)), "\n")
    note = F.when(more > 0, F.concat(F.lit("\n      ... ("), more.cast("string"), F.lit(" more message(s))"))).otherwise("")
    value = F.concat(
        F.lit(" Candidate "), F.col("cluster_id"), F.lit(":\n   Cluster size: "), F.col("size").cast("string"), F.lit("\n   Share of day's messages: "),
        F.col("daily_ratio_pct").cast("string"), F.lit("%\n   Reasons: "), F.array_join("reasons", ", "), F.lit("\n   Metrics: "), F.to_json("metrics"), F.lit("\n   Sample messages:\n"), lines, note,
    )
    return candidates.select("cluster_id", value.alias("value"))


def verified_report(events: DataFrame, most: int = 10) -> DataFrame:
    """Phase-four rows, columns named as their values are."""
    return events.select("date_shamsi", "cluster_id", "size", "daily_ratio_pct", "title", "summary", "confidence", T.joined_with_note(F.col("messages"), most).alias("sample_messages"))


# ---- writing


def combined(*days: DataFrame) -> DataFrame:
    """The rows of all frames, columns by name; what a frame lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), days)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def overwrite_days(df: DataFrame, path: str, day: str = "day") -> None:
    """Replaces the days that df holds, and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def stage_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def report_text(lines: DataFrame, path: str, *order: str) -> None:
    """Report lines in order, each day's together."""
    lines.repartitionByRange(*order).sortWithinPartitions(*order).select("value").write.mode("overwrite").text(path)


def final_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)

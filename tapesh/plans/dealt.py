"""Queries p2, p3 and p4: hot keys, packed fields, mixed timestamps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapesh.functions import jalali as J
from tapesh.operators import split_fields as S
from tapesh.operators import timestamps as T
from tapesh.operators import value_frequency as V
from tapesh.runtime import read, small, spread

KEYS = ["key_kind", "key_value"]


def _keyed(posts: DataFrame, *columns: str) -> DataFrame:
    """A row for each key of a post: its future_date and its location_entities, as they stand."""
    kinds = F.array(*[F.struct(F.lit(c).alias("key_kind"), F.col(c).alias("key_value")) for c in ("future_date", "location_entities")])
    long = posts.select(*columns, F.explode(kinds).alias("k")).select("k.*", *columns)
    return long.where(F.col("key_value").isNotNull() & ~F.col("key_value").isin("", "None"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = read(spark, sf_dir, "posts").withColumn("_us", F.unix_micros(F.col("ingested_at").cast("timestamp")))
    order = {"_us": V.TIME_STEPS, "post_id": V.ID_STEPS}
    return V.select_at(_keyed(posts, "_us", "post_id"), KEYS, order, V.LOWER_MEDIAN).select(*KEYS, "post_id")


def p2_value_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per key: its posts, distinct channels and most frequent channel."""
    long = _keyed(read(spark, sf_dir, "posts"), "channel_id")
    freq = V.value_frequencies(long, KEYS, "channel_id")
    stats = V.value_stats(freq, KEYS, "channel_id")
    return stats.select(*KEYS, F.col("n_rows").alias("n_posts"), F.col("n_distinct").alias("n_channels"), F.col("mode").alias("top_channel"), F.col("mode_n").alias("top_n"))


def p3_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = read(spark, sf_dir, "posts")
    return S.split_fields(posts, "post_id", ["location_entities", "event_entities"])


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_names(spark, sf_dir).where("n_names >= 2").select("post_id", "field_name", "pos", "entity")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = small(read(spark, sf_dir, "channels").select("channel_id", "tz_name", "date_order"))
    posts = spread(read(spark, sf_dir, "posts").select("post_id", "channel_id", "date").where(F.col("date").isNotNull()))
    posts = T.to_utc_micros(posts.join(zones, "channel_id", "left"), "date", "tz_name", "date_order")
    tweets = read(spark, sf_dir, "tweets_2").select("tweet_id", "shdate").where(F.col("shdate").isNotNull()).distinct()
    tweets = T.to_utc_micros(tweets.withColumn("_tz", F.lit("Asia/Tehran")), "shdate", "_tz", None)
    rows = posts.select(F.lit("posts").alias("src"), F.col("post_id").alias("row_key"), "utc_us")
    rows = rows.unionByName(tweets.select(F.lit("tweets_2").alias("src"), F.col("tweet_id").alias("row_key"), "utc_us"))
    return rows.where(F.col("utc_us").isNotNull())


def p4_rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The moment of every post written in one of twelve ways, and read again."""
    at = F.col("ingested_at").cast("timestamp")
    local = F.from_utc_timestamp(at, "Asia/Kolkata")
    us = F.unix_micros(at)
    shown = lambda c, form: F.date_format(c, form)
    jalali = lambda c: J.format_jalali(J.to_jalali(F.to_date(c)))
    month = F.element_at(F.array(*[F.lit(m) for m in T.JALALI_MONTHS]), J.to_jalali(F.to_date(at))["m"])
    ways = [
        shown(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), shown(at, "yyyyMMdd'T'HHmmss'Z'"), us.cast("string"), F.expr("cast(unix_micros(cast(ingested_at as timestamp)) div 1000 as string)"),
        F.expr("cast(unix_micros(cast(ingested_at as timestamp)) div 1000000 as string)"), F.concat(shown(at, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000")),
        F.concat(F.lit("\t"), shown(at, "dd/MM/yyyy HH:mm:ss"), F.lit(" UTC ")), shown(at, "MMM d, yyyy hh:mm:ss a 'GMT'"), F.concat(jalali(at), shown(at, " HH:mm:ss+00:00")),
        F.translate(F.concat(jalali(local), shown(local, " HH:mm:ss")), "0123456789", T.PERSIAN_DIGITS),
        F.concat(J.to_jalali(F.to_date(at))["d"].cast("string"), F.lit(" "), month, F.lit(" "), J.to_jalali(F.to_date(at))["y"].cast("string"), shown(at, " - HH:mm:ss"), F.lit("Z")),
        F.concat(shown(at, "yyyy.M.d H:mm:ss"), F.lit("[Etc/UTC]")),
    ]
    value = F.element_at(F.array(*ways), (F.col("post_id") % len(ways) + 1).cast("int"))
    rows = read(spark, sf_dir, "posts").where(F.col("ingested_at").isNotNull()).select("post_id", value.alias("value"), F.lit("Asia/Kolkata").alias("zone"))
    return T.to_utc_micros(rows, "value", "zone", None).select("post_id", "utc_us")


QUERIES = {"p2_found": p2_found, "p2_value_stats": p2_value_stats, "p3_found": p3_found, "p4_found": p4_found, "p4_rendered": p4_rendered}

_LONG = """WITH k AS (
  SELECT 'future_date' AS key_kind, future_date AS key_value, post_id, ingested_at, channel_id FROM posts
  UNION ALL SELECT 'location_entities', location_entities, post_id, ingested_at, channel_id FROM posts),
l AS (SELECT * FROM k WHERE key_value IS NOT NULL AND key_value NOT IN ('', 'None'))"""

ORACLES = {
    "p4_rendered": """SELECT post_id, CASE post_id % 12 WHEN 0 THEN us WHEN 2 THEN us WHEN 3 THEN us // 1000 * 1000 ELSE us // 1000000 * 1000000 END AS utc_us
FROM (SELECT post_id, epoch_us(ingested_at) AS us FROM posts WHERE ingested_at IS NOT NULL)""",
    "p2_found": f"""{_LONG}, r AS (SELECT *, row_number() OVER (PARTITION BY key_kind, key_value ORDER BY ingested_at NULLS FIRST, post_id) AS rn,
  count(*) OVER (PARTITION BY key_kind, key_value) AS n FROM l)
SELECT key_kind, key_value, post_id FROM r WHERE rn = (n + 1) // 2""",
    "p2_value_stats": f"""{_LONG}, f AS (SELECT key_kind, key_value, channel_id, count(*) AS n FROM l WHERE channel_id IS NOT NULL GROUP BY ALL),
m AS (SELECT *, row_number() OVER (PARTITION BY key_kind, key_value ORDER BY n DESC, channel_id) AS rn FROM f)
SELECT key_kind, key_value, sum(n)::BIGINT AS n_posts, count(*) AS n_channels, max(CASE WHEN rn = 1 THEN channel_id END) AS top_channel,
  max(n) AS top_n FROM m GROUP BY ALL""",
}

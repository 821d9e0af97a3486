"""Record schemas of the stages and sinks, as DDL."""

CANDIDATE = (
    "cluster_id string, date_shamsi string, date_gregorian timestamp_ntz, size int, keywords array<string>, daily_ratio_pct double, "
    "reasons array<string>, metrics struct<z_score:double,median_sim:double,coverage:double>, messages array<string>, timestamps array<timestamp_ntz>"
)
CANDIDATE_CLUSTERS = (
    "id bigint, keywords string, is_large int, cluster_size int, has_burst int, is_cohesive int, sentiment_polarity string, "
    "execution_time timestamp_ntz, validation_status string, sample_messages string"
)
DETECTED_EVENTS = (
    "id bigint, cluster_id bigint, title string, summary string, execution_time timestamp_ntz, source string, total_messages int, sample_messages string"
)
PREDICTED_EVENTS = (
    "title string, summary string, predicted_time timestamp_ntz, predicted_location string, execution_time timestamp_ntz, source string, "
    "sample_messages string, created_at timestamp_ntz"
)
EVENT_RECORDS = "id string, " + PREDICTED_EVENTS
REPLY = "parsed boolean, is_event boolean, title string, summary string, confidence string, raw string, used_token_cap int, attempts int, oom_count int"


def empty(spark, ddl):
    """An empty frame of a schema."""
    return spark.createDataFrame([], ddl)

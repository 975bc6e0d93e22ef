"""Declared schemas; nothing is inferred from data."""

from pyspark.sql import types as T

PAYLOAD = T.StructType([
    T.StructField("query", T.StringType()),
    T.StructField("results_count", T.IntegerType()),
    T.StructField("page", T.IntegerType()),
    T.StructField("url", T.StringType()),
    T.StructField("referrer", T.StringType()),
    T.StructField("dwell_time_ms", T.LongType()),
    T.StructField("content_snippet", T.StringType()),
    T.StructField("recipient_id", T.StringType()),
    T.StructField("meta", T.StringType()),
    T.StructField("value", T.DoubleType()),
])

CLIENT = T.StructType([
    T.StructField("ip", T.StringType()),
    T.StructField("user_agent", T.StringType()),
    T.StructField("country", T.StringType()),
])

# What is read out of one JSON object. The bot flag has no fixed type in the log.
RECORD = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("payload", PAYLOAD),
    T.StructField("client", CLIENT),
    T.StructField("is_bot_flag", T.StringType()),
    T.StructField("schema_version", T.StringType()),
    T.StructField("event_order", T.LongType()),
])

def _some(record: T.StructType, **nested: list[str]) -> T.StructType:
    """The named fields of the nested records and nothing else of them."""
    kept = [T.StructField(f.name, T.StructType([f.dataType[n] for n in nested[f.name]])) if f.name in nested else f for f in record]
    return T.StructType(kept)


# What the disposition of a record looks at, what the counting job reads, and what the feature job reads.
JUDGED_RECORD = _some(
    T.StructType([RECORD[n] for n in ("action", "payload", "client", "is_bot_flag")]), payload=["dwell_time_ms"], client=["user_agent"],
)
COUNT_RECORD = T.StructType([RECORD["user_id"], *JUDGED_RECORD])
FEATURE_RECORD = _some(
    T.StructType([f for f in RECORD if f.name != "schema_version"]), payload=["query", "dwell_time_ms"], client=["user_agent", "country"],
)

# Columns of the typed event table.
EVENT_COLUMNS = [
    "timestamp", "ts", "user_id", "session_id", "action", "payload", "client",
    "is_bot_flag", "schema_version", "event_order", "status",
]

COUNTS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("cnt", T.LongType()),
])

METRICS = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("weightedPrecision", T.DoubleType()),
    T.StructField("weightedRecall", T.DoubleType()),
    T.StructField("f1", T.DoubleType()),
])

ASSIGNMENTS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("cluster", T.IntegerType()),
    T.StructField("pca_x", T.DoubleType()),
    T.StructField("pca_y", T.DoubleType()),
    T.StructField("label", T.IntegerType()),
    T.StructField("professional_ratio", T.DoubleType()),
    T.StructField("total_actions", T.LongType()),
    T.StructField("total_sessions", T.LongType()),
])

CLUSTER_METADATA = T.StructType([
    T.StructField("cluster_id", T.IntegerType()),
    T.StructField("archetype", T.StringType()),
    T.StructField("user_count", T.LongType()),
    T.StructField("centroid", T.ArrayType(T.DoubleType())),
    T.StructField("silhouette", T.DoubleType()),
])

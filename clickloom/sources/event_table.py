"""Clickstream rows and lines derived from a plain event table.

The table has (event_id, ts, user_id, value, props); every clickstream field follows from these by rule.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom.operators.cleaning import disposition

# What the rules below pick from, chosen to meet every professional term in some case, terms inside words and
# near misses of terms, empty texts, every bot term and names that only look like one.
PHRASES = [
    "intro to Machine Learning", "data engineer salary", "dataengineer", "KUBERNETES operators", "spark plugs", "a sparkling wine",
    "hadoop vs flink", "mlops", "MLOPS101", "neural networks explained", "neural net", "Microservices with go", "micro service",
    "ci/cd for beginners", "CI CD", "rootless docker", "dock workers", "Terraform modules", "terra forming mars", "system design interview",
    "system  design", "database sharding", "Stream Processing engines", "streams", "recommendation letters", "",
]
OTHER_PHRASE = "weekend hikes near me"
AGENTS = [
    "Mozilla/5.0 (X11; Linux x86_64; rv:121.0) Gecko/20100101 Firefox/121.0", "Opera/9.80", "", "Wget/1.21", "CURL/8.1", "my-Scraper 2",
    "Python-Requests/2.31", "Dalvik/2.1.0 (Linux; U; Android 14)", "okhttp/4.12", "SpiderMonkey shell", "news crawler", "Curling club app",
]
BOT_AGENT = "ExampleBot/3.1 (+http://example.org/bot)"
COUNTRIES = ["FR", "JP", "NG", "MX", "PL"]
SCHEMA_VERSION = "1.2"


def _pick(values: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed events without status, plus ``event_id`` and ``corrupt``."""
    uid = F.col("uid")
    kind = F.regexp_extract("props", "[0-9]+", 0).cast("int") % len(C.ACTIONS)
    facts = (
        spark.read.parquet(f"{sf_dir}/events.parquet")
        .withColumnsRenamed({"user_id": "uid", "ts": "full_ts"})
        .withColumn("action", _pick(C.ACTIONS, kind))
        .withColumn("bot", uid % 25 == 24)
    )
    phrase = F.when(uid % 20 < 9, _pick(PHRASES, F.col("event_id") % len(PHRASES))).otherwise(OTHER_PHRASE)
    viewed = F.col("action").isin("click", "view_profile", "page_view")
    agent = F.when(F.col("bot"), BOT_AGENT).otherwise(_pick(AGENTS, F.col("event_id") % len(AGENTS)))
    payload = F.struct(
        F.when(F.col("action") == "search", phrase).alias("query"),
        F.when(viewed, F.floor(F.col("value") * 1000)).cast("long").alias("dwell_time_ms"),
    )
    client = F.struct(
        agent.alias("user_agent"),
        _pick(COUNTRIES, F.col("event_id") % len(COUNTRIES)).alias("country"),
    )
    day = F.date_format("full_ts", "yyyyMMdd")
    return facts.select(
        "event_id",
        F.date_format("full_ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.date_trunc("second", "full_ts").alias("ts"),
        F.concat(F.lit("u_"), uid.cast("string")).alias("user_id"),
        F.concat(F.lit("s_"), uid.cast("string"), F.lit("_"), day).alias("session_id"),
        "action",
        payload.alias("payload"),
        client.alias("client"),
        F.col("bot").alias("is_bot_flag"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.col("event_id").alias("event_order"),
        (F.col("event_id") % 100 == 99).alias("corrupt"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed events with status. Corrupt lines belong to no user and no session."""
    rows = clickstream(spark, sf_dir)
    owned = {c: F.when(~F.col("corrupt"), F.col(c)) for c in ("user_id", "session_id")}
    return rows.withColumns(owned).withColumn("status", disposition(F.col("corrupt"), F.lit(True))).drop("corrupt")


def as_json(rows: DataFrame, options: dict[str, str] | None = None) -> Column:
    """JSON text of a clickstream row."""
    return F.to_json(F.struct(*[c for c in rows.columns if c not in ("event_id", "corrupt", "ts")]), options)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as JSON text, in columns ``event_id`` and ``line``."""
    rows = clickstream(spark, sf_dir)
    bad = F.lit('{"_corrupt": true, "raw": "}{broken_json"}')
    return rows.select("event_id", F.when(F.col("corrupt"), bad).otherwise(as_json(rows)).alias("line"))

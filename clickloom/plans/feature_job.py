"""Raw log to action counts and feature tables."""

from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.operators import cleaning, counts, features
from clickloom.sources import counts_tsv, raw_log, storage


def new_run_id() -> str:
    """Sorts by time, so the latest run is the greatest."""
    return datetime.now(UTC).strftime("%Y%m%d_%H%M%S_%f")


def count_actions(spark: SparkSession, log_path: str, counts_path: str, run_id: str | None = None, **cleaning_options) -> dict:
    """Clean a log and write its action counts as one run. Returns run id, counters and rows written."""
    run_id = run_id or new_run_id()
    read, written = Observation("read"), Observation("written")
    events = raw_log.read_events(spark, log_path, record=schemas.COUNT_RECORD, **cleaning_options)
    observed = events.observe(read, *cleaning.counter_columns())
    result = counts.action_counts(observed).observe(written, F.count(F.lit(1)).alias("rows_written"))
    counts_tsv.write_counts(result, counts_path, run_id)
    return {"run_id": run_id, **read.get, **written.get}


def build_features(
    spark: SparkSession,
    log_path: str,
    database: str,
    export_path: str,
    location: str | None = None,
    session_source: str = "raw",
    counts_path: str | None = None,
    user_buckets: int | None = None,
    **cleaning_options,
) -> dict:
    """Build all feature tables of a database from a log and export the feature table as Parquet.

    The text is read once and its events are shuffled once, into a table with one row per session. The pivot and the
    session features follow from that table, and the feature table joins these two, each reduced to one row per user.
    With ``counts_path`` the pivot comes from the latest run of the counting job instead. With ``user_buckets`` the pivot
    and a table of session totals are placed by user in so many buckets, and the feature table joins these without
    another shuffle. Every table is replaced, so a rerun gives the same tables. Returns the counters of the parse.
    """
    storage.create_database(spark, database, location)
    read = Observation("read")
    parsed = raw_log.read_events(spark, log_path, record=schemas.FEATURE_RECORD, **cleaning_options).observe(read, *cleaning.counter_columns())
    storage.save_table(features.session_table(parsed, session_source), f"{database}.session_table")

    table = spark.table(f"{database}.session_table")
    storage.save_table(features.features_of_sessions(table), f"{database}.session_features")
    if counts_path is None:
        pivot = features.pivot_of_sessions(table)
    else:
        pivot = counts.pivot_counts(counts_tsv.read_latest_run(spark, counts_path))
    sessions = spark.table(f"{database}.session_features")
    if user_buckets is None:
        storage.save_table(pivot, f"{database}.user_action_pivot")
        joined = features.join_features(spark.table(f"{database}.user_action_pivot"), sessions)
    else:
        placed = {"user_action_pivot": pivot, "session_totals": features.session_totals(sessions)}
        for name, rows in placed.items():
            storage.save_placed(rows, f"{database}.{name}", "user_id", user_buckets)
        joined = features.join_totals(*[spark.table(f"{database}.{name}") for name in placed])
    storage.save_table(joined, f"{database}.feature_table", partition_by="dt", order_by="user_id")
    storage.export_parquet(spark.table(f"{database}.feature_table"), export_path)
    return dict(read.get)


def read_features(
    spark: SparkSession, table: str, first_day: str | None = None, last_day: str | None = None
) -> DataFrame:
    """Feature table by name; a range of first active days prunes partitions."""
    rows = spark.table(table)
    if first_day:
        rows = rows.where(F.col("dt") >= first_day)
    if last_day:
        rows = rows.where(F.col("dt") <= last_day)
    return rows

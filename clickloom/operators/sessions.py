"""Session features.

Every session figure is an aggregate that combines on the map side, so one session may hold any share
of the log. No window runs over raw events.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions import rules
from clickloom.operators.cleaning import emitted

SESSION = ["user_id", "session_id"]


def session_events(events: DataFrame, source: str = "raw") -> DataFrame:
    """Events that belong to a session: all with both ids, or with ``source="clean"`` the emitted ones."""
    if source not in ("raw", "clean"):
        raise ValueError("source must be 'raw' or 'clean'")
    rows = events if source == "raw" else emitted(events)
    return rows.where(F.col("user_id").isNotNull() & F.col("session_id").isNotNull())


def seconds() -> Column:
    return F.unix_seconds("ts")


def professional_searches() -> Column:
    return F.count_if(rules.is_professional_search(F.col("action"), F.col("payload.query")))


def deep_clicks() -> Column:
    return F.count_if(rules.is_deep_click(F.col("action"), F.col("payload.dwell_time_ms")))


def first_country() -> Column:
    """Country of the first event; a missing one stays missing. The country itself breaks the last tie."""
    return F.min(F.struct("ts", "event_order", F.col("client.country").alias("country")))["country"]


def mean_gap(first: Column, last: Column, timed: Column) -> Column:
    """Mean of successive differences: they telescope to last - first over the number of gaps."""
    return (last - first).cast("double") / F.when(timed > 1, timed - 1)


def session_features(events: DataFrame, source: str = "raw") -> DataFrame:
    first, last, timed = F.min(seconds()), F.max(seconds()), F.count(seconds())
    return session_events(events, source).groupBy(*SESSION).agg(
        F.min("timestamp").alias("session_start"),
        F.max("timestamp").alias("session_end"),
        F.count(F.lit(1)).alias("session_events"),
        mean_gap(first, last, timed).alias("avg_inter_event_sec"),
        ((last - first).cast("double") / 60).alias("session_duration_min"),
        professional_searches().alias("n_professional_searches"),
        deep_clicks().alias("n_deep_clicks"),
        first_country().alias("country"),
        F.min("ts").alias("first_ts"),
    )


#: Seconds of a session that one window sees at most.
SLAB_SECONDS = 86_400


def event_gaps(events: DataFrame, slab_seconds: int = SLAB_SECONDS) -> DataFrame:
    """Gap to the previous event, one row per distinct second of a session with the events it stands for.

    Events of the same second have gap 0 among themselves, so they are counted first. A session is cut into slabs of
    time, and the window sees one of them, so a session that never ends is many tasks. The first second of a slab follows
    the last one of the slab before, which a second window finds among one row per slab.
    """
    per_second = (
        session_events(events)
        .select(*SESSION, seconds().alias("second"))
        .groupBy(*SESSION, "second")
        .agg(F.count(F.lit(1)).alias("n_events"))
        .withColumn("slab", F.floor(F.col("second") / slab_seconds))
    )
    inside = F.lag("second", 1).over(Window.partitionBy(*SESSION, "slab").orderBy("second"))
    last = per_second.groupBy(*SESSION, "slab").agg(F.max("second").alias("last"))
    before = F.lag("last", 1).over(Window.partitionBy(*SESSION).orderBy("slab"))
    ahead = last.withColumn("before", before).drop("last")
    rows = per_second.withColumn("inside", inside).join(ahead, [*SESSION, "slab"], "left")
    previous = F.coalesce("inside", "before")
    return rows.select(
        *SESSION, "second", "n_events", previous.alias("previous_second"), (F.col("second") - previous).alias("gap_sec"),
    )


def session_gaps(events: DataFrame) -> DataFrame:
    """Mean gap per session from the gaps themselves; the definition behind ``mean_gap``."""
    timed = F.sum(F.when(F.col("second").isNotNull(), F.col("n_events")).otherwise(0))
    mean = F.sum("gap_sec").cast("double") / F.when(timed > 1, timed - 1)
    # All events of a session in one second: no previous second, but gaps of zero.
    mean = F.when(timed > 1, F.coalesce(mean, F.lit(0.0)))
    return event_gaps(events).groupBy(*SESSION).agg(mean.alias("avg_inter_event_sec"))


def session_country(events: DataFrame) -> DataFrame:
    return session_events(events).groupBy(*SESSION).agg(first_country().alias("country"))

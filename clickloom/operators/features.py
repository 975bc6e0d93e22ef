"""User feature table."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom.functions import rules
from clickloom.operators import sessions as S

# Pivot columns that become features; logins are counted but not used.
PIVOT_FEATURES = [f"n_{a}" for a in C.PIVOT_ACTIONS if a != "login"]
COLUMNS = ["user_id", *C.FEATURES, "label", "dt"]


def _with_targets(users: DataFrame) -> DataFrame:
    """Ratios, label and first active day on top of the per-user totals."""
    ratio = rules.guarded_ratio(F.col("total_professional_searches"), F.col("total_actions"))
    ctr = rules.guarded_ratio(F.col("n_click"), F.col("n_search"))
    label = rules.high_value(
        F.col("total_professional_searches"), F.col("n_send_message"), F.col("avg_session_duration_min")
    )
    return users.select(
        "*",
        ratio.alias("professional_ratio"),
        ctr.alias("click_through_rate"),
        label.alias("label"),
        F.date_format("first_ts", "yyyy-MM-dd").alias("dt"),
    ).select(*COLUMNS)


def _mean_minutes(total_seconds: Column, sessions: Column) -> Column:
    """Mean over sessions from whole seconds, so it does not depend on the order of summation."""
    return total_seconds.cast("double") / 60 / F.when(sessions > 0, sessions)


def feature_table(events: DataFrame, source: str = "raw") -> DataFrame:
    """Feature table in one pass over the events.

    Cleaned events are a subset of session events, so both the action counts and the session figures
    come from one aggregate per session, then one per user; no join, no second scan. Users without a
    cleaned event drop out, as they would in the join of counts and sessions.
    """
    clean = F.col("status") == "emitted"
    actions = [name.removeprefix("n_") for name in PIVOT_FEATURES]
    first, last, timed = F.min(S.seconds()), F.max(S.seconds()), F.count(S.seconds())
    per_session = S.session_events(events, source).groupBy(*S.SESSION).agg(
        *[F.count_if(clean & (F.col("action") == a)).alias(f"n_{a}") for a in actions],
        F.count_if(clean).alias("total_actions"),
        F.min("ts").alias("first_ts"),
        F.count(F.lit(1)).alias("session_events"),
        (last - first).alias("session_seconds"),
        S.mean_gap(first, last, timed).alias("avg_inter_event_sec"),
        S.professional_searches().alias("n_professional_searches"),
        S.deep_clicks().alias("n_deep_clicks"),
    )
    per_user = per_session.groupBy("user_id").agg(
        *[F.sum(name).alias(name) for name in [*PIVOT_FEATURES, "total_actions"]],
        F.count(F.lit(1)).alias("total_sessions"),
        _mean_minutes(F.sum("session_seconds"), F.count("session_seconds")).alias("avg_session_duration_min"),
        F.avg("session_events").alias("avg_events_per_session"),
        F.avg("avg_inter_event_sec").alias("avg_inter_event_sec"),
        F.sum("n_professional_searches").alias("total_professional_searches"),
        F.sum("n_deep_clicks").alias("total_deep_clicks"),
        F.min("first_ts").alias("first_ts"),
    )
    return _with_targets(per_user.where(F.col("total_actions") > 0))


def session_table(events: DataFrame, source: str = "raw") -> DataFrame:
    """All that is stored of a session: figures, first time and country, and a counter for each pivot action."""
    clean = F.col("status") == "emitted"
    first, last, timed = F.min(S.seconds()), F.max(S.seconds()), F.count(S.seconds())
    return S.session_events(events, source).groupBy(*S.SESSION).agg(
        F.min("timestamp").alias("session_start"),
        F.max("timestamp").alias("session_end"),
        F.count(F.lit(1)).alias("session_events"),
        S.mean_gap(first, last, timed).alias("avg_inter_event_sec"),
        ((last - first).cast("double") / 60).alias("session_duration_min"),
        S.professional_searches().alias("n_professional_searches"),
        S.deep_clicks().alias("n_deep_clicks"),
        S.first_country().alias("country"),
        F.min("ts").alias("first_ts"),
        *[F.count_if(clean & (F.col("action") == a)).alias(f"n_{a}") for a in C.PIVOT_ACTIONS],
        F.count_if(clean).alias("total_actions"),
    )


def pivot_of_sessions(table: DataFrame) -> DataFrame:
    """User-action pivot from the session table; users without a cleaned event have no row."""
    names = [*[f"n_{a}" for a in C.PIVOT_ACTIONS], "total_actions"]
    return table.groupBy("user_id").agg(*[F.sum(n).alias(n) for n in names]).where(F.col("total_actions") > 0)


def features_of_sessions(table: DataFrame) -> DataFrame:
    """Session features from the session table."""
    return table.drop(*[f"n_{a}" for a in C.PIVOT_ACTIONS], "total_actions")


def session_totals(sessions: DataFrame) -> DataFrame:
    """What the feature table takes from session features, one row per user."""
    whole_seconds = F.round(F.col("session_duration_min") * 60).cast("long")
    return sessions.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_sessions"),
        _mean_minutes(F.sum(whole_seconds), F.count(whole_seconds)).alias("avg_session_duration_min"),
        F.avg("session_events").alias("avg_events_per_session"),
        F.avg("avg_inter_event_sec").alias("avg_inter_event_sec"),
        F.sum("n_professional_searches").alias("total_professional_searches"),
        F.sum("n_deep_clicks").alias("total_deep_clicks"),
        F.min("first_ts").alias("first_ts"),
    )


def join_totals(pivot: DataFrame, totals: DataFrame) -> DataFrame:
    """Feature table from the pivot and the session totals; stored tables placed by user join without a shuffle."""
    return _with_targets(pivot.join(totals, "user_id", "inner"))


def join_features(pivot: DataFrame, sessions: DataFrame) -> DataFrame:
    """Feature table from a stored pivot and stored session features.

    Sessions are reduced to one row per user before the join, so neither side has a repeated key.
    """
    return join_totals(pivot, session_totals(sessions))


def model_input(features: DataFrame, labelled: bool = True) -> DataFrame:
    """Rows with all features present, for training also the label, as double."""
    if not labelled:
        return features.dropna(subset=C.FEATURES)
    return features.withColumn("label", F.col("label").cast("double")).dropna(subset=[*C.FEATURES, "label"])


def label_distribution(rows: DataFrame) -> DataFrame:
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def rows_per_day(features: DataFrame) -> DataFrame:
    return features.groupBy("dt").agg(F.count(F.lit(1)).alias("n_users"))

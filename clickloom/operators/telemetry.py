"""Size of a run, counted rather than estimated."""

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom.operators import sessions as S

STATUS = "Feature engineering complete."


def pipeline_telemetry(events: DataFrame) -> DataFrame:
    """Rows at every stage of a run, from one scan of the events.

    Lines without ids form a group of their own, which counts as records but not as session or user.
    """
    clean = F.col("status") == "emitted"
    per_session = events.groupBy(*S.SESSION).agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(clean).alias("cleaned"),
        *[F.count_if(clean & (F.col("action") == a)).alias(a) for a in C.ACTIONS],
        F.count(S.seconds()).alias("timed"),
    )
    in_session = F.col("user_id").isNotNull() & F.col("session_id").isNotNull()
    per_user = per_session.groupBy("user_id").agg(
        F.sum("records").alias("records"),
        F.sum("cleaned").alias("cleaned"),
        *[F.sum(a).alias(a) for a in C.ACTIONS],
        F.count_if(in_session).alias("sessions"),
        F.count_if(in_session & (F.col("timed") > 1)).alias("sessions_with_gap"),
    )
    is_user = F.col("user_id").isNotNull() & (F.col("cleaned") > 0)
    kinds = reduce(add, [(F.col(a) > 0).cast("long") for a in C.ACTIONS])
    return per_user.agg(
        F.sum("records").alias("raw_records"),
        F.sum("cleaned").alias("cleaned_records"),
        F.coalesce(F.sum(F.when(is_user, kinds + 1)), F.lit(0)).alias("count_rows"),
        F.sum("sessions").alias("sessions"),
        F.count_if(is_user).alias("total_users"),
        F.count_if(is_user & (F.col("sessions_with_gap") == 0)).alias("users_without_gap"),
        F.count_if(is_user & (F.col("sessions_with_gap") > 0)).alias("model_rows"),
    ).withColumn("status", F.lit(STATUS))

"""Read-only lookups over stored results."""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom.functions import rules
from clickloom.operators.evaluation import METRIC_COLUMNS
from clickloom.operators.segmentation import name_clusters


def metrics_long(metrics: DataFrame) -> DataFrame:
    """(model, metric, value) rows of a metrics report."""
    return metrics.unpivot("model", METRIC_COLUMNS, "metric", "value")


def cluster_points(assignments: DataFrame, limit: int = C.DEFAULT_POINTS) -> DataFrame:
    """First points by user id, with archetype."""
    if not 1 <= limit <= C.MAX_POINTS:
        raise ValueError(f"limit must be between 1 and {C.MAX_POINTS}")
    return name_clusters(assignments.orderBy("user_id").limit(limit))


def cluster_extents(assignments: DataFrame, padding: float = 0.05) -> DataFrame:
    """Range of both coordinates, widened on each side by a share of the range."""

    def ends(axis: str) -> list[Column]:
        low, high = F.min(f"pca_{axis}"), F.max(f"pca_{axis}")
        pad = (high - low) * padding
        return [(low - pad).alias(f"{axis}_min"), (high + pad).alias(f"{axis}_max")]

    return assignments.agg(*ends("x"), *ends("y"))


def user_profiles(assignments: DataFrame) -> DataFrame:
    """Profile of every user in the assignments; join with a frame of ids for a bulk lookup."""
    label = F.coalesce(F.col("label").cast("int"), F.lit(0))
    cluster = F.coalesce(F.col("cluster"), F.lit(0))
    return assignments.select(
        "user_id",
        label.alias("label"),
        rules.label_name(label).alias("label_name"),
        cluster.alias("cluster"),
        rules.archetype(cluster).alias("archetype"),
        F.round(F.coalesce(F.col("professional_ratio").cast("double"), F.lit(0.0)), 4).alias("professional_ratio"),
        F.coalesce(F.col("total_actions").cast("long"), F.lit(0)).alias("total_actions"),
    )


def user_profile(assignments: DataFrame, user_id: str, predictions: DataFrame | None = None) -> DataFrame:
    """Profile of one user, empty if unknown. The id test reaches the file scan.

    With ``predictions`` the vote on that user is added; it is null for users outside the scored set.
    """
    if not re.fullmatch(C.USER_ID_PATTERN, user_id):
        raise ValueError("user id must have 3 to 64 letters, digits, '_' or '-'")
    wanted = F.col("user_id") == user_id
    profile = user_profiles(assignments.where(wanted))
    if predictions is None:
        return profile
    return profile.join(predictions.where(wanted).select("user_id", C.ENSEMBLE_COLUMN), "user_id", "left")


def bulk_profiles(assignments: DataFrame, ids: DataFrame) -> DataFrame:
    """Profiles of the distinct ids in a frame with column ``user_id``; unknown ids give no row.

    Ids are made distinct first, so an id that fills much of the frame is not shuffled row by row.
    """
    return user_profiles(assignments.join(ids.select("user_id").distinct(), "user_id", "left_semi"))

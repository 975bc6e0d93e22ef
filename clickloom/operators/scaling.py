"""Split, vector assembly and scaling."""

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom.functions import rules


def mark_training(rows: DataFrame, fraction: float = C.TRAIN_FRACTION) -> DataFrame:
    return rows.withColumn("is_train", rules.in_training_set(F.col("user_id"), fraction))


def split(rows: DataFrame, fraction: float = C.TRAIN_FRACTION) -> tuple[DataFrame, DataFrame]:
    train = rules.in_training_set(F.col("user_id"), fraction)
    return rows.where(train), rows.where(~train)


@dataclass(frozen=True)
class Statistics:
    """Of the complete rows their number, and of each feature mean, sample deviation, smallest and largest value."""

    count: int
    features: dict[str, tuple[float, float, float, float]]


def statistics(rows: DataFrame) -> Statistics:
    """All that fits need to know of their rows beforehand, in one aggregate and one row."""
    measures = (F.avg, F.stddev_samp, F.min, F.max)
    complete = rows.dropna(subset=C.FEATURES)
    columns = [measure(F.col(c).cast("double")).alias(f"{c}_{i}") for c in C.FEATURES for i, measure in enumerate(measures)]
    found = complete.agg(F.count(F.lit(1)).alias("n"), *columns).first()
    # A single row has no deviation.
    return Statistics(found["n"], {c: tuple(found[f"{c}_{i}"] or 0.0 for i in range(len(measures))) for c in C.FEATURES})


def arranged(rows: DataFrame, users_per_partition: int = 100_000, count: int | None = None) -> DataFrame:
    """Row placement that depends on nothing but the users, so that iterative fits are repeatable.

    Users are unique, so hashing on the id spreads them evenly. The number of partitions follows the
    number of users, ``count`` if it is known: each iteration of a fit visits every partition, and empty ones only cost
    time. ``users_per_partition`` sets the parallelism of the fits and drops nothing; the perceptron and the clusters
    depend on the partitioning, so another value may give another, equally good, model.
    """
    partitions = max(1, math.ceil((rows.count() if count is None else count) / users_per_partition))
    return rows.repartition(partitions, "user_id").sortWithinPartitions("user_id")


def assembler(inputs: list[str], output: str) -> VectorAssembler:
    return VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid="skip")


def _computed(kind: str, formula: Callable[..., str], known: Statistics) -> PipelineModel:
    """Vector ``<kind>_features`` of a formula for each feature over its value and its statistics."""
    if not known.count:
        raise ValueError("no complete training rows: features cannot be scaled")
    columns = [f"{formula(f'cast({c} as double)', *known.features[c])} AS {kind}_{c}" for c in C.FEATURES]
    scale = SQLTransformer(statement=f"SELECT *, {', '.join(columns)} FROM __THIS__")
    return PipelineModel([scale, assembler([f"{kind}_{c}" for c in C.FEATURES], f"{kind}_features")])


def fit_standard(rows: DataFrame, known: Statistics | None = None) -> PipelineModel:
    """``standard_features``: centred and scaled by the sample deviation, zero for a feature that doesn't vary."""
    def formula(value, mean, deviation, low, high):
        return f"({value} - {mean!r}D) / {deviation!r}D" if deviation else f"{value} * 0"

    return _computed("standard", formula, known or statistics(rows))


def fit_spread(rows: DataFrame, known: Statistics | None = None) -> PipelineModel:
    """``spread_features``: scaled like ``standard_features``, but not centred."""
    def formula(value, mean, deviation, low, high):
        return f"{value} / {deviation!r}D" if deviation else f"{value} * 0"

    return _computed("spread", formula, known or statistics(rows))


def fit_minmax(rows: DataFrame, known: Statistics | None = None) -> PipelineModel:
    """``minmax_features``: scaled to [0, 1] by the range of ``rows``, a half for a feature that doesn't vary.

    Later rows may fall outside that range, and naive Bayes refuses negative input, so each feature is
    held to the range. The range is saved with the model.
    """
    def formula(value, mean, deviation, low, high):
        held = f"(least(greatest({value}, {low!r}D), {high!r}D) - {low!r}D)"
        return f"{held} / {high - low!r}D" if high > low else f"{held} + 0.5D"

    return _computed("minmax", formula, known or statistics(rows))

"""Quality of predictions and clusters."""

from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom import constants as C

VOTE_NAMES = {**C.VOTERS, C.ENSEMBLE_COLUMN: C.ENSEMBLE_NAME}
METRIC_COLUMNS = ["accuracy", "weightedPrecision", "weightedRecall", "f1"]


def confusion(predictions: DataFrame, names: dict[str, str]) -> DataFrame:
    """(model, label, prediction, n) for all models from a single aggregate.

    Rows are first counted per combination of label and predictions, of which there are only a few, and
    only these counts are spread over the models.
    """
    combined = predictions.groupBy("label", *names).agg(F.count(F.lit(1)).alias("n"))
    entries = F.array(*[
        F.struct(F.lit(name).alias("model"), F.col(column).alias("prediction")) for column, name in names.items()
    ])
    return (
        combined.select("label", "n", F.inline(entries))
        .groupBy("model", "label", "prediction")
        .agg(F.sum("n").alias("n"))
    )


def _ratio(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(numerator / F.when(denominator > 0, denominator), F.lit(0.0))


def classification_metrics(
    predictions: DataFrame, names: dict[str, str] | None = None, digits: int | None = 4
) -> DataFrame:
    """Accuracy and class-weighted precision, recall and F1 of each prediction column."""
    cells = confusion(predictions, VOTE_NAMES if names is None else names)
    # From here on a row is a cell of a confusion matrix.
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    by_label, by_prediction = Window.partitionBy("model", "label"), Window.partitionBy("model", "prediction")
    classes = (
        cells.withColumn("actual", F.sum("n").over(by_label))
        .withColumn("predicted", F.sum("n").over(by_prediction))
        .groupBy("model", "label")
        .agg(
            F.sum(hit).alias("hits"),
            F.max("actual").alias("actual"),
            F.coalesce(F.max(F.when(F.col("label") == F.col("prediction"), F.col("predicted"))), F.lit(0)).alias(
                "predicted"
            ),
        )
    )
    precision = _ratio(F.col("hits"), F.col("predicted"))
    recall = _ratio(F.col("hits"), F.col("actual"))
    f1 = _ratio(2 * precision * recall, precision + recall)
    total = F.sum("actual")
    metrics = classes.groupBy("model").agg(
        (F.sum("hits") / total).alias("accuracy"),
        (F.sum(precision * F.col("actual")) / total).alias("weightedPrecision"),
        (F.sum(recall * F.col("actual")) / total).alias("weightedRecall"),
        (F.sum(f1 * F.col("actual")) / total).alias("f1"),
    )
    if digits is None:
        return metrics
    return metrics.select("model", *[F.round(c, digits).alias(c) for c in METRIC_COLUMNS])


def area_under_curve(scored: DataFrame, raw: str) -> float:
    return BinaryClassificationEvaluator(labelCol="label", rawPredictionCol=raw).evaluate(scored)


def silhouette(clustered: DataFrame, features: str = "standard_features", cluster: str = "cluster") -> float:
    """Mean silhouette under squared Euclidean distance."""
    evaluator = ClusteringEvaluator(featuresCol=features, predictionCol=cluster, metricName="silhouette")
    return evaluator.evaluate(clustered)

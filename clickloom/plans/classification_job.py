"""Train, score and evaluate the classifiers on a feature table."""

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom.operators import evaluation, features, models, scaling
from clickloom.sources import storage


def fit_one(rows: DataFrame, fit):
    """One model, fitted on the training users by ``fit``; they are held in memory only while it runs.

    One aggregate over them tells their number, by which they are placed, and what the scalers need.
    """
    train = scaling.split(rows)[0]
    known = scaling.statistics(train)
    train = scaling.arranged(train, count=known.count).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return fit(train, known)
    finally:
        train.unpersist()


def fit_on(rows: DataFrame) -> models.Ensemble:
    """Ensemble fitted on the training users."""
    return fit_one(rows, models.fit_ensemble)


def with_curve_areas(metrics: DataFrame, ensemble: models.Ensemble, scored: DataFrame) -> DataFrame:
    """Optional extra column: area under the ROC curve, null for the vote, which has no score."""
    area = F.lit(None).cast("double")
    for column, name in C.VOTERS.items():
        if column in ensemble.models:
            value = evaluation.area_under_curve(scored, column.replace("_pred", "_raw"))
            area = F.when(F.col("model") == name, F.round(F.lit(value), 4)).otherwise(area)
    return metrics.withColumn("areaUnderROC", area)


def classify(
    spark: SparkSession, table: str, output: str, curve_area: bool = False, placed: tuple[str, int] | None = None,
) -> DataFrame:
    """Save models, predictions on the test users and the metrics report below ``output``.

    With ``placed``, a table name and a number of buckets, the predictions are also that table, placed by user.
    """
    rows = features.model_input(spark.table(table))
    ensemble = fit_on(rows)
    for column, model in ensemble.models.items():
        storage.save_model(model, f"{output}/models/{column.removesuffix('_pred')}")

    test = scaling.split(rows)[1]
    # Ranged by user, so a lookup of one user opens one file.
    scored = models.predictions(ensemble, test).repartitionByRange("user_id").sortWithinPartitions("user_id")
    storage.export_parquet(scored, f"{output}/predictions")
    stored = spark.read.parquet(f"{output}/predictions")
    if placed:
        storage.save_placed(stored, placed[0], "user_id", placed[1])
    metrics = evaluation.classification_metrics(stored)
    if curve_area:
        metrics = with_curve_areas(metrics, ensemble, ensemble.transform(test))
    storage.write_records(metrics, f"{output}/metrics")
    return storage.read_metrics(spark, f"{output}/metrics")

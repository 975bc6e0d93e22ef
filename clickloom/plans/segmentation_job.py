"""Segment the users of a feature table."""

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from clickloom.operators import features, scaling, segmentation
from clickloom.sources import storage


def fit_on(rows: DataFrame, repeatable: bool = False) -> segmentation.Segmentation:
    known = scaling.statistics(rows)
    held = scaling.arranged(rows, count=known.count).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return segmentation.fit(held, known=known, repeatable=repeatable)
    finally:
        held.unpersist()


def segment(
    spark: SparkSession, table: str, output: str, training_cost: bool = False, placed: tuple[str, int] | None = None,
    repeatable: bool = False,
) -> DataFrame:
    """Save the model, the assignments and the cluster records below ``output``.

    Assignments are ranged and sorted by user, so a lookup of one user opens one file. With ``placed``, a table name
    and a number of buckets, they are also that table, placed by user. ``repeatable`` clusters have no random start.
    """
    rows = features.model_input(spark.table(table), labelled=False)
    fitted = fit_on(rows, repeatable)
    storage.save_model(fitted.model, f"{output}/models/segments")
    storage.export_parquet(
        fitted.assignments(rows).repartitionByRange("user_id").sortWithinPartitions("user_id"), f"{output}/cluster_assignments"
    )
    storage.write_records(segmentation.cluster_metadata(fitted, rows, training_cost), f"{output}/cluster_metadata")
    stored = spark.read.parquet(f"{output}/cluster_assignments")
    if placed:
        storage.save_placed(stored, placed[0], "user_id", placed[1])
    return stored

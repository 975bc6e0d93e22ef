"""Tables between stages, in the folder that the cluster shares."""

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from clickloom.sources import storage

#: With this, Spark deletes the shuffle files of a query when the query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Shuffle files of queries that run in here go with the query instead of staying until garbage collection."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write once, read many times; a lost executor costs a re-read only."""
    with shuffles_removed(df.sparkSession):
        return storage.stage(df, name)

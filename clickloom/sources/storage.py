"""Where things are written: scratch space, tables, exports, reports, models."""

import tempfile
import uuid

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom import schemas


# Temporary folders of local sessions, by application, and scratch directories that were handed out.
_local_roots: dict[str, str] = {}
_handed_out: list[str] = []


def scratch_dir(spark: SparkSession, name: str) -> str:
    """New directory name in the folder the cluster shares for checkpoints.

    That is ``spark.checkpoint.dir``, or the directory that was set on the context. Without either a local session
    gets a temporary folder; a cluster session is refused, because executors could not see a folder of the
    driver's machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir() or _local_roots.get(context.applicationId)
    if root is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="clickloom-")
    _handed_out.append(f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _handed_out[-1]


def scratch_dirs() -> list[str]:
    """Scratch directories that were handed out and not deleted, oldest first."""
    return list(_handed_out)


def delete_scratch(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Delete what was written to scratch directories, or to some of them; frames that were read from there are gone then."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for name in scratch_dirs() if paths is None else paths:
        _handed_out.remove(name)
        path = hadoop.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write once, read many times: cuts the lineage, and a lost executor costs only a re-read."""
    path = scratch_dir(df.sparkSession, name)
    export_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Rows in a reliable checkpoint, partitioned as they are.

    Iterative fits then neither replay nor ship the plan behind their input with every job, and a lost
    executor costs a re-read.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    quoted = "`" + name.replace("`", "``") + "`"
    if location is None:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted}")
    else:
        escaped = location.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted} LOCATION '{escaped}'")


def _placed(df: DataFrame, partition_by: str | None, order_by: str | None) -> DataFrame:
    """Rows arranged for a write.

    A partitioned write is rebalanced on the partition column: adaptive execution then splits a day
    that holds much of the data and merges days that hold little, instead of one file per task and day.
    """
    if partition_by:
        df = df.hint("rebalance", partition_by)
    keys = [c for c in (partition_by, order_by) if c]
    return df.sortWithinPartitions(*keys) if order_by else df


def _writer(df: DataFrame, file_format: str, partition_by: str | None, order_by: str | None) -> DataFrameWriter:
    writer = _placed(df, partition_by, order_by).write.mode("overwrite").format(file_format)
    writer = writer.option("compression", "snappy")
    return writer.partitionBy(partition_by) if partition_by else writer


def save_table(df: DataFrame, table: str, partition_by: str | None = None, order_by: str | None = None) -> None:
    """Replace a columnar table."""
    _writer(df, "orc", partition_by, order_by).saveAsTable(table)


def save_placed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """Replace a table of one row per ``key``, placed in buckets by it, each one sorted file.

    Tables placed alike join and group by the key without a shuffle, and a test of the key for equality reads one
    bucket. A table with many rows per key isn't placed like this: its rows of one key would all be one task's.
    """
    placed = df.repartition(buckets, key).sortWithinPartitions(key).write.mode("overwrite").format("parquet")
    placed = placed.option("path", path) if path else placed
    placed.bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def stage_placed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Written once by ``save_placed`` and read back; the rows are in the shared folder, the catalog forgets the name."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    save_placed(df, table, key, buckets, scratch_dir(spark, name))
    found = spark.table(table)
    found.schema  # resolved now; the plan holds the files and their placement
    spark.sql(f"DROP TABLE {table}")
    return found


def export_parquet(
    df: DataFrame, path: str, partition_by: str | None = None, order_by: str | None = None
) -> None:
    """Replace a Parquet directory."""
    _writer(df, "parquet", partition_by, order_by).save(path)


def write_records(df: DataFrame, path: str) -> None:
    """Small report as one JSON file, one record per line."""
    df.coalesce(1).write.mode("overwrite").json(path)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def subdirectories(spark: SparkSession, path: str) -> dict[str, bool]:
    """Names of sub-directories and whether their write completed."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.listStatus(root) if s.isDirectory()]
    return {p.getName(): fs.exists(hadoop.Path(p, "_SUCCESS")) for p in found}


#: Write option for a directory whose writer says itself when it is complete.
NO_SUCCESS_FILE = "mapreduce.fileoutputcommitter.marksuccessfuljobs"


def touch(spark: SparkSession, path: str) -> None:
    """Empty file."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True).close()


def marked_directories(spark: SparkSession, path: str, mark: str) -> tuple[list[str], list[str]]:
    """Directories at or below a path that hold the file ``mark``, and all other directories and files outside of them."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def sort(place) -> tuple[list[str], list[str]]:
        if fs.exists(hadoop.Path(place, mark)):
            return [place.toString()], []
        inside = [s for s in fs.listStatus(place) if not s.getPath().getName().startswith(("_", "."))]
        below = [sort(s.getPath()) for s in inside if s.isDirectory()]
        marked = [p for found, _ in below for p in found]
        if not marked:
            return [], [place.toString()]
        files = [s.getPath().toString() for s in inside if not s.isDirectory()]
        return marked, files + [p for _, rest in below for p in rest]

    return sort(root) if fs.exists(root) and fs.getFileStatus(root).isDirectory() else ([], [path])


def latest_run(spark: SparkSession, path: str) -> str:
    done = [name for name, completed in subdirectories(spark, path).items() if completed and name.startswith("run_id=")]
    if not done:
        raise FileNotFoundError(f"no completed run below {path}")
    return max(done)


def read_metrics(spark: SparkSession, path: str, document: bool = False) -> DataFrame:
    """Metric records, one per line or, with ``document``, as one JSON array per file."""
    return spark.read.schema(schemas.METRICS).option("multiLine", document).json(path)


def read_assignments(spark: SparkSession, path: str, document: bool = False) -> DataFrame:
    """Cluster assignments, as Parquet; with ``document`` as one JSON array of records per file."""
    if not document:
        return spark.read.parquet(path)
    return spark.read.schema(schemas.ASSIGNMENTS).option("multiLine", True).json(path)


def read_cluster_metadata(spark: SparkSession, path: str, document: bool = False) -> DataFrame:
    """Cluster records, one per line; with ``document`` a JSON array or an object with a ``clusters`` list."""
    record = schemas.CLUSTER_METADATA
    if not document:
        return spark.read.schema(record).json(path)
    either = T.StructType([*record.fields, T.StructField("clusters", T.ArrayType(record))])
    rows = spark.read.schema(either).option("multiLine", True).json(path)
    bare = F.array(F.struct(*record.names))
    return rows.select(F.inline(F.coalesce("clusters", bare)))

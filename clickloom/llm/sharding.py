"""Shards that all have the corpus' mixture of sources, by proportional stratified interleaving.

Rows of a source are ordered by a seeded hash of their id. The nth of m rows gets the fraction (n - u) / m, where u is
drawn for the source from [0, 1), so that sources of few rows are spread too; over all sources the rows are ordered by
fraction and cut into equal runs. A run then has its share of every source, give or
take a row. Both orders are distributed: rows fall into buckets of bounded size by hash or by fraction, are numbered
within them, and add the sizes of the buckets before.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm import workspace

#: Rows that one task numbers at a time, on average.
BUCKET_ROWS = 20_000
#: Seed of the shuffle.
SEED = 7


def _numbered(rows: DataFrame, within: list[str], bucket: str, order: list[str], name: str) -> DataFrame:
    """Position from 1 within each group of ``within``, in the order of bucket and ``order``."""
    counts = rows.groupBy(*within, bucket).agg(F.count("*").alias("here"))
    before = Window.partitionBy(*within).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    earlier = counts.withColumn("before", F.coalesce(F.sum("here").over(before), F.lit(0))).drop("here")
    inside = F.row_number().over(Window.partitionBy(*within, bucket).orderBy(*order))
    return rows.withColumn("inside", inside).join(earlier, [*within, bucket]).withColumn(
        name, F.col("before") + F.col("inside"),
    ).drop("before", "inside")


def interleave(docs: DataFrame, shards: int = 8, seed: int = SEED, doc_id: str = "doc_id", text: str = "text",
               source: str = "source", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc_id, source, size, text_crc32, shard, slot) per row of ``docs``; slots run from 0 in each shard.

    Row counts of shards differ by one at most. ``size`` is the text's UTF-8 bytes plus one. Null texts are empty;
    null sources are a source of their own. Rows with the same id follow each other by checksum and size; fully
    equal rows are interchangeable. Texts are judged each on its own: equal texts may lie in different shards.
    """
    binary = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = workspace.stage(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("")).alias("stratum"),
        (F.octet_length(binary) + 1).cast("long").alias("size"), F.crc32(binary).alias("text_crc32"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary")).alias("shuffled"),
    ), "rows")
    total = rows.count()
    buckets = max(1, total // bucket_rows)
    by_hash = F.floor(F.conv(F.substring("shuffled", 1, 8), 16, 10).cast("long") * buckets / (1 << 32))
    ties = ["shuffled", "doc_id", "text_crc32", "size"]
    ranked = _numbered(rows.withColumn("bucket", by_hash), ["stratum"], "bucket", ties, "rank")
    sizes = rows.groupBy("stratum").agg(F.count("*").alias("rows"))
    drawn = F.md5(F.concat(F.lit(f"{seed}:"), F.col("stratum")).cast("binary"))
    offset = F.conv(F.substring(drawn, 1, 8), 16, 10).cast("double") / (1 << 32)
    fraction = (F.col("rank") - offset) / F.col("rows")
    spread = workspace.stage(ranked.join(sizes, "stratum").withColumn("fraction", fraction), "fractions")
    slab = F.least(F.floor(F.col("fraction") * buckets), F.lit(buckets - 1))
    placed = _numbered(
        spread.withColumns({"bucket": slab, "all": F.lit(0)}), ["all"], "bucket", ["fraction", "stratum", *ties], "position",
    )
    place = F.col("position") - 1
    shard = F.expr(f"(position - 1) * {shards} div {max(total, 1)}")
    first = F.expr(f"(shard * {max(total, 1)} + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard.cast("int")).select(
        "doc_id", "source", "size", "text_crc32", "shard", (place - first).alias("slot"),
    )

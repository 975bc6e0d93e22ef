"""A training corpus from raw documents, in stages that each write all they keep.

Documents are filtered by quality, near duplicates are reduced to one of each group, passages that repeat across
documents are cut out, documents with benchmark passages are dropped, and the rest is encoded to token ids.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import bpe, decontamination, quality, simhash, suffix_dedup, workspace
from clickloom.sources import storage


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels that aren't held out, scores 0.5 or more."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~quality.held_out())
    return quality.keep(docs, quality.fit(docs, labels))


def _free_name(docs: DataFrame, name: str) -> str:
    """The name, with underscores if a column has it already; like Spark, this doesn't regard case."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of three-word shingles are linked by three bits or fewer.

    The one with the smallest id stays, of several texts of that id the one with the smallest digest. A document is
    known by its id and the digest of its text, so each text of an id is judged, and repeated rows go to one. Null
    and empty texts share fingerprint zero and are one group. Documents without an id stay.
    """
    name = _free_name(docs, "row_key")
    key = F.struct(F.col("doc_id").alias("id"), F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest"))
    keyed = docs.where("doc_id is not null").withColumn(name, key)
    found = simhash.near_duplicates(keyed, doc_id=name, shingle_words=simhash.SHINGLE_WORDS, max_bits=simhash.MAX_BITS)
    first = found.where("doc_id = component_id").select(F.col("doc_id").alias(name)).distinct()
    kept = keyed.join(first, name, "left_semi").dropDuplicates([name])
    return kept.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without strings of 200 bytes that start at two places; ``n_chars`` follows the text."""
    cut = suffix_dedup.without_repeats(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut


def benchmark_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words less than a twentieth lies in windows of the benchmark."""
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.xxhash64("text").cast("string"))
    name = _free_name(docs, "row_key")
    keyed = docs.withColumn(name, key)
    found = decontamination.matches(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), doc_id=name)
    marked = decontamination.contaminated(found).where("contaminated").select(F.col("doc_id").alias(name)).distinct()
    return keyed.join(marked, name, "left_anti").select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, decoded_sha256) of every document; the digest is of the bytes decoded from the ids."""
    rules = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    decoded = bpe.decode(bpe.encode(docs, *rules), *rules)
    return decoded.select("doc_id", "ids", F.size("ids").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality_filter),
    ("SimHash near-dedup", near_dedup),
    ("suffix-array dedup", repeat_removal),
    ("benchmark decontamination", benchmark_removal),
    ("byte-level BPE", encoding),
]

#: The learned classifier has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents. What a stage has read and written on its way is deleted once its result is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), storage.scratch_dirs()
    for name, stage in STAGES:
        docs = workspace.stage(stage(spark, docs, sf_dir), name.replace(" ", "_"))
        *done, _ = [path for path in storage.scratch_dirs() if path not in before]
        storage.delete_scratch(spark, done)
    return docs

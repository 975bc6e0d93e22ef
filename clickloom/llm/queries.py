"""Queries of the operators over the given tables, with the columns and digests their users compare."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import (
    bpe, decontamination, embedding_dedup, filter_audit, merkle, multi_index, ngram_lm, quality, sharding, simhash, suffix_dedup,
    token_files, url_filter,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register under the function's name."""
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op9_suffix_array_dedup(spark, sf_dir):
    rows = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return rows.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op3_simhash_near_dedup(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op8_benchmark_decontamination(spark, sf_dir):
    found = decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.array_sort("items"), ",")
    return decontamination.contaminated(found).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(names.cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


@query
def op1_byte_level_bpe(spark, sf_dir):
    rules = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    decoded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), *rules), *rules)
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op7_stratified_interleaving(spark, sf_dir):
    placed = sharding.interleave(table(spark, sf_dir, "documents"), shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op10_stupid_backoff(spark, sf_dir):
    scored = ngram_lm.score(table(spark, sf_dir, "documents"))
    return scored.select("doc_id", "n_words", (F.round("log_score", 4) + 0.0).alias("log_score"))


@query
def op4_attention_quality(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(~quality.held_out()))
    return quality.score(docs, model).select(
        "doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op5_arrow_token_files(spark, sf_dir):
    index = token_files.write(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return token_files.checksums(token_files.starts(index)).select("doc_id", "start", "n_tokens", "ids_crc32")


#: Rules of the URL filter.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


@query
def op2_boosted_url_filter(spark, sf_dir):
    """The URLs that a rule judges are the labelled ones; the trees learn from them and judge the rest."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rule = url_filter.rule_of(*url_filter.host_and_path(), URL_RULES)
    verdict = F.element_at(F.create_map(*[F.lit(x) for pair in URL_RULES.items() for x in pair]), rule)
    labelled = pages.select("url", F.when(verdict == "block", 1).when(verdict == "allow", 0).alias("label"))
    return url_filter.judge(pages, URL_RULES, url_filter.fit(labelled))


@query
def op6_lattice_near_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op11_filter_interaction_audit(spark, sf_dir):
    return filter_audit.audit(filter_audit.cells(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


@query
def op12_inverted_multi_index(spark, sf_dir):
    return multi_index.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op13_merkle_manifest(spark, sf_dir):
    """Rows whose id has an even checksum are tampered with after the manifest is built: their line ends go."""
    def leaf(text):
        return merkle.digest([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text])

    touched = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", "source", leaf(F.col("text")).alias("leaf"),
        F.when(touched, leaf(F.replace("text", F.lit("\n"), F.lit("")))).alias("tampered"),
    )
    made = merkle.manifest(rows, "source", "doc_id", "leaf")
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return made.proofs().select(
        "doc_id", "leaf", "subroot", F.lit(made.root).cast("string").alias("root"), merkle.path_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))

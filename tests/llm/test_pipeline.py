import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from clickloom.llm import bpe, quality
from clickloom.sources import storage

from . import brute
from .conftest import CLASHES, prose


def documents():
    """Clean prose, junk, copies, near copies, a passage that three documents share, and a benchmark passage."""
    rng, rows = random.Random(1), []
    for n in range(60):
        rows.append((n, prose(n, 150)))
    for n in range(60, 90):
        rows.append((n, " ".join(w + "###%%%" for w in prose(n, 120).split())))
    rows += [(200, rows[3][1]), (201, rows[3][1]), (3, rows[3][1])]
    words = rows[4][1].split()
    words[7] = "changed"
    rows.append((202, " ".join(words)))
    shared = prose(999, 60)
    rows += [(300 + n, prose(500 + n, 80) + " " + shared + " " + prose(600 + n, 80)) for n in range(3)]
    rows += [(400, prose(700, 60) + " " + prose(1234, 40) + " " + prose(701, 60)), (500, None), (501, "")]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("corpus"))
    rows = documents()
    columns = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES.split())
    clashes = ["x"] * len(CLASHES.split())
    spark.createDataFrame([(i, t, "en", "s", len(t or ""), *clashes) for i, t in rows], columns).write.parquet(f"{base}/documents.parquet")
    labels = [(i, int("#" not in t), 0) for i, t in rows if t and i < 90]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame([(1, prose(1234, 40))], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    return base


def test_stages_as_brute_force(spark, folder):
    """Each stage on what its predecessor kept, against plain Python."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    rows = documents()
    stages = dict(corpus_pipeline.STAGES)

    docs = stages["quality classifier"](spark, docs, folder)
    model = quality.fit(spark.read.parquet(f"{folder}/documents.parquet"),
                        spark.read.parquet(f"{folder}/labels.parquet").where(~quality.held_out()))
    good = [r.score >= 0.5 for r in quality.score(spark.createDataFrame([(n, t) for n, (_, t) in enumerate(rows)], "doc_id long, text string"), model)
            .orderBy("doc_id").collect()]
    assert all(g == ("#" not in (t or "")) for g, (_, t) in zip(good, rows) if t)
    rows = [r for g, r in zip(good, rows) if g]
    assert docs.columns == columns
    assert sorted((r.doc_id, r.text or "") for r in docs.collect()) == sorted((i, t or "") for i, t in rows)

    docs = stages["SimHash near-dedup"](spark, docs, folder)
    prints = {i: brute.fingerprint(t) for i, t in rows}
    first = brute.components(list(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    rows = sorted((i, t) for i, t in dict(rows).items() if first[i] == i)
    assert docs.columns == columns
    assert sorted((r.doc_id, r.text) for r in docs.collect()) == rows

    docs = stages["suffix-array dedup"](spark, docs, folder)
    rows = [(i, w[-1].decode(errors="ignore")) for (i, _), w in zip(rows, brute.without_repeats([t for _, t in rows]))]
    assert docs.columns == columns
    assert sorted((r.doc_id, r.text, r.n_chars) for r in docs.collect()) == sorted((i, t, len(t)) for i, t in rows)

    docs = stages["benchmark decontamination"](spark, docs, folder)
    bad = {r[0] for r in brute.decontaminate(rows, [(1, prose(1234, 40))]) if r[-1]}
    assert bad == {400}
    rows = [r for r in rows if r[0] not in bad]
    assert docs.columns == columns
    assert sorted((r.doc_id, r.text) for r in docs.collect()) == sorted(rows)

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {t: i for i, t in enumerate(bpe.read_ranks(path))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((i, library.encode_ordinary(t), hashlib.sha256(t.encode()).hexdigest()) for i, t in rows)
    last = stages["byte-level BPE"](spark, docs, folder).collect()
    assert sorted((r.doc_id, r.ids, r.decoded_sha256) for r in last) == want
    assert sorted((r.doc_id, r.ids, r.decoded_sha256) for r in corpus_pipeline.run(spark, folder).collect()) == want


def test_only_the_result_stays(spark, folder):
    before = storage.scratch_dirs()
    rows = corpus_pipeline.run(spark, folder)
    (left,) = [path for path in storage.scratch_dirs() if path not in before]
    assert rows.count() == spark.read.parquet(left).count() > 0


def test_a_column_named_like_the_key_in_other_case(spark, folder):
    """Spark takes ROW_KEY and row_key for one column."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumns({"ROW_KEY": F.concat(F.lit("k"), "doc_id"), "Row_Key_": F.lit("y")})
    for stage in (corpus_pipeline.near_dedup, corpus_pipeline.benchmark_removal):
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns
        assert all(r["ROW_KEY"] == f"k{r.doc_id}" and r["Row_Key_"] == "y" for r in kept.collect())


def test_no_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_documents_without_id_stay(spark, folder):
    docs = spark.createDataFrame([(None, "same text"), (None, "same text"), (1, "same text")], "doc_id long, text string")
    kept = corpus_pipeline.near_dedup(spark, docs, folder).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "None", "None"]

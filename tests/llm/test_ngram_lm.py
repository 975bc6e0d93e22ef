import math
from collections import Counter

import pytest

from clickloom.llm import ngram_lm

from . import brute
from .conftest import EDGE_TEXTS, prose


def expected(docs, corpus):
    single, pair = Counter(), Counter()
    for _, text in corpus:
        words = brute.hit_words(text)
        single.update(words)
        pair.update(zip(words, words[1:]))
    total = sum(single.values())
    for i, text in docs:
        words, score = brute.hit_words(text), 0.0
        for n, word in enumerate(words):
            alone = single[word] / total if single[word] else 1 / (total + 1)
            if n and pair[words[n - 1], word]:
                score += math.log10(pair[words[n - 1], word] / single[words[n - 1]])
            else:
                score += math.log10(alone * (0.4 if n else 1))
        yield i, len(words), round(score, 6)


def got(rows):
    return sorted((r.doc_id, r.n_words, round(r.log_score, 6) + 0.0) for r in rows.collect())


@pytest.fixture(scope="module")
def rows():
    return [(n, prose(n, 30 + n)) for n in range(40)] + list(EDGE_TEXTS)


@pytest.mark.parametrize("block_bytes", [1 << 24, 2000])
def test_own_corpus(spark, rows, block_bytes):
    frame = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, block int")
    assert got(ngram_lm.score(frame, block_bytes=block_bytes)) == sorted(expected(rows, rows))


def test_other_corpus(spark, rows, edge_docs):
    corpus = spark.createDataFrame(rows[:40], "doc_id long, text string")
    found = ngram_lm.score(edge_docs, corpus, block_bytes=3000)
    assert got(found) == sorted(expected(EDGE_TEXTS, rows[:40]))


def test_small_parts(spark, rows, monkeypatch):
    monkeypatch.setattr(ngram_lm, "PART_BYTES", 50)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(ngram_lm.score(frame)) == sorted(expected(rows, rows))


def test_no_rows(no_docs, edge_docs):
    assert ngram_lm.score(no_docs).count() == 0
    assert {r.n_words for r in ngram_lm.score(edge_docs, no_docs).collect()} == {len(brute.hit_words(t)) for _, t in EDGE_TEXTS}

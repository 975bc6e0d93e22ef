import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from clickloom.llm import bpe

from .conftest import EDGE_TEXTS

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def library(vocabulary):
    ranks = {t: i for i, t in enumerate(vocabulary)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def ids(codec, texts):
    return [np.frombuffer(x, np.int32).tolist() for x in codec.encode(texts)]


def test_random_texts_as_the_library(vocabulary, library):
    rng = random.Random(3)
    parts = [" ", "\n", "a", "B", "é", "1", "!", "'", "s", "\t", "漢", "😀", "\x1c", "ll", "́", " ", "　"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(4000)]
    texts += ["a" * 3000, " " * 300, "it's 'tis I'LL", "<|endoftext|> x", "a   b ", "a \n b", "x\n\n y"]
    codec = bpe.Codec(vocabulary, PATTERN)
    assert ids(codec, texts) == [library(t) for t in texts]


def test_every_character_as_the_library(vocabulary, library):
    codec = bpe.Codec(vocabulary, PATTERN)
    for low in range(0, 0x30000, 0x1000):
        chars = [chr(c) for c in range(low, low + 0x1000) if not 0xD800 <= c < 0xE000]
        texts = [f"a{c}b {c}1{c}{c} ." for c in chars[::3]]
        assert ids(codec, texts) == [library(t) for t in texts]


def test_starting_over_changes_nothing(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    codec = bpe.Codec(vocabulary, PATTERN)
    texts = [t or "" for _, t in EDGE_TEXTS]
    assert ids(codec, texts) + ids(codec, texts) == 2 * [library(t) for t in texts]


def test_perfect_hash_is_minimal(vocabulary):
    keys = np.fromiter(map(bpe._key, vocabulary), np.uint64, len(vocabulary))
    found = bpe.PerfectHash(keys)
    assert found.size == len(vocabulary)
    assert sorted(found.slots(keys)) == list(range(len(vocabulary)))


def test_odd_rows_round_trip(spark, edge_docs, library):
    rows = bpe.decode(bpe.encode(edge_docs, PATH, PATTERN), PATH, PATTERN).collect()
    got = sorted((r.doc_id, r.ids, hashlib.sha256(bytes(r.decoded)).digest()) for r in rows)
    assert got == sorted((i, library(t or ""), hashlib.sha256((t or "").encode()).digest()) for i, t in EDGE_TEXTS)


def test_no_rows(no_docs):
    assert bpe.decode(bpe.encode(no_docs, PATH, PATTERN), PATH, PATTERN).count() == 0


def test_null_ids_decode_to_nothing(spark):
    rows = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [bytes(r.decoded) for r in bpe.decode(rows, PATH, PATTERN).collect()] == [b"", b""]

import random

import numpy as np
import pytest

from clickloom.llm import suffix_array, suffix_dedup

from . import brute
from .conftest import EDGE_TEXTS, prose


@pytest.mark.parametrize("step", [1, 5, 4096])
def test_array_and_prefixes(monkeypatch, step):
    monkeypatch.setattr(suffix_array, "STEP", step)
    rng = np.random.default_rng(step)
    for trial in range(250):
        text = rng.integers(0, rng.choice([1, 2, 3, 5, 50, 200]), int(rng.integers(0, 60)))
        if trial % 3 == 0:
            text = np.repeat(text, rng.integers(1, 9, len(text)))
        if trial % 5 == 0:
            text = np.tile(text, 3)
        order = suffix_array.suffix_array(text)
        assert list(order) == sorted(range(len(text)), key=lambda i: list(text[i:]))
        prefix = suffix_array.common_prefixes(text.astype(np.uint8), order, np.arange(len(text), 0, -1))
        for a, b in zip(order, order[1:]):
            same = 0
            while max(a, b) + same < len(text) and text[a + same] == text[b + same]:
                same += 1
            assert prefix[b] == same


def texts():
    rng = random.Random(4)
    shared = [prose(100 + i, 60) for i in range(5)]
    rows = list(EDGE_TEXTS)
    for n in range(40):
        parts = [prose(200 + n, rng.randrange(40))]
        for _ in range(rng.randrange(3)):
            s = rng.choice(shared)
            parts += [s[rng.randrange(50):len(s) - rng.randrange(50)], prose(rng.random(), rng.randrange(1, 30))]
        rows.append((100 + n, " ".join(parts)))
    return rows + [(90, shared[0] * 3), (91, "ab" * 400), (92, "x" * 199), (93, "y" * 200), (94, "z" * 201)]


@pytest.fixture(scope="module")
def rows():
    return texts()


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, kept string")


@pytest.mark.parametrize("max_contexts", [4096, 2])
def test_as_brute_force(frame, rows, max_contexts):
    got = sorted((r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), bytes(r.kept))
                 for r in suffix_dedup.remove_repeats(frame, max_contexts=max_contexts).collect())
    assert got == sorted((i, *want) for (i, _), want in zip(rows, brute.without_repeats([t for _, t in rows])))


def test_small_shards(frame, rows, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 1)
    got = sorted((r.doc_id, bytes(r.kept)) for r in suffix_dedup.remove_repeats(frame).collect())
    assert got == sorted((i, want[-1]) for (i, _), want in zip(rows, brute.without_repeats([t for _, t in rows])))


def test_rows_and_whole_characters_stay(edge_docs):
    cut = suffix_dedup.without_repeats(edge_docs)
    assert cut.columns == edge_docs.columns
    assert cut.schema["rest"].dataType == edge_docs.schema["rest"].dataType
    got = sorted((r.doc_id, r.text) for r in cut.collect())
    want = brute.without_repeats([t for _, t in EDGE_TEXTS])
    assert [i for i, _ in got] == sorted(i for i, _ in EDGE_TEXTS)
    assert got == sorted((i, w[-1].decode(errors="ignore")) for (i, _), w in zip(EDGE_TEXTS, want))


def test_no_rows(no_docs):
    assert suffix_dedup.remove_repeats(no_docs).count() == 0
    assert suffix_dedup.without_repeats(no_docs).count() == 0


def test_null_ids(spark):
    frame = spark.createDataFrame([(None, "q" * 300), (None, "short"), (1, "q" * 250)], "doc_id long, text string")
    assert sorted(bytes(r.kept) for r in suffix_dedup.remove_repeats(frame).collect()) == [b"", b"", b"short"]

import hashlib
import random

import pytest

from clickloom.llm import decontamination

from . import brute
from .conftest import EDGE_TEXTS, prose

ITEMS = [
    (1, prose(11, 40)), (2, "one two THREE, four"), (2, "one two THREE, four"), (3, None), (4, " !! "), (5, prose(12, 13)), (6, prose(12, 13)),
    (70, "word"),
]


def texts():
    rng = random.Random(8)
    rows = list(EDGE_TEXTS)
    for n in range(30):
        words = (ITEMS[0][1] if n % 2 else ITEMS[5][1]).split()
        low = rng.randrange(len(words) - 8)
        rows.append((100 + n, " ".join([prose(n, rng.randrange(60)), *words[low:low + rng.randrange(5, 30)], prose(n + 50, 20)])))
    return rows + [(200, ITEMS[0][1].upper() + "." + ITEMS[5][1])]


@pytest.fixture(scope="module")
def frames(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts()], "doc_id long, text string, item_id string")
    return docs, spark.createDataFrame([(i, t, 0) for i, t in ITEMS], "item_id long, text string, doc_id int")


def digests(rows):
    return sorted((r.doc_id, r.n_words, r.n_hit, len(r["items"]), hashlib.sha256(",".join(sorted(r["items"])).encode()).hexdigest(),
                   r.contaminated) for r in rows.collect())


@pytest.mark.parametrize("query_bytes", [1 << 20, 60])
def test_as_brute_force(frames, query_bytes):
    found = decontamination.contaminated(decontamination.matches(*frames, query_bytes=query_bytes))
    assert digests(found) == sorted(brute.decontaminate(texts(), ITEMS))


def test_spans_cover_the_hits(frames):
    for r in decontamination.matches(*frames).collect():
        assert sum(s.end - s.start for s in r.spans) == r.n_hit
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_long_words_of_two_letters(spark):
    """Two Thue-Morse words, which polynomials modulo a power of two can't tell apart."""
    word = "a"
    for _ in range(11):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    for size in (1024, 2048):
        docs = spark.createDataFrame([(1, f"x {word[:size]} y"), (2, f"x {other[:size]} y")], "doc_id long, text string")
        items = spark.createDataFrame([(7, word[:size])], "item_id long, text string")
        assert {r.doc_id: r.n_hit for r in decontamination.matches(docs, items).collect()} == {1: 1, 2: 0}


def test_proximity(spark):
    docs = spark.createDataFrame([
        (1, "x alpha beta gamma x"), (2, "x alpha x beta gamma"), (3, "gamma beta alpha"), (4, "alpha x x x x beta gamma"),
    ], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    near = {slop: sorted(r.doc_id for r in decontamination.matches(docs, items, slop=slop).collect() if r.n_hit) for slop in (0, 1, 4)}
    assert near == {0: [1], 1: [1, 2], 4: [1, 2, 3, 4]}


def test_odd_rows(edge_docs, frames):
    found = decontamination.contaminated(decontamination.matches(edge_docs, frames[1]))
    assert digests(found) == sorted(brute.decontaminate(EDGE_TEXTS, ITEMS))


def test_no_rows(no_docs, frames):
    assert decontamination.matches(no_docs, frames[1]).count() == 0
    assert [r.n_hit for r in decontamination.matches(frames[0], frames[1].where("false")).collect()] == [0] * len(texts())


def test_full_index_keeps_every_place(spark):
    index = decontamination.build_index(spark.createDataFrame([(1, "a b a"), (2, "b")], "doc_id long, text string")).collect()
    places = [sorted(p for r in index for p in r.places), sum(len(r.terms) for r in index)]
    assert places[1] in (2, 3) and sum(len(r.places) for r in index) == 4


def test_blocks_of_items_when_splits_change(spark, frames, tmp_path, monkeypatch):
    """A scan that is split in another way for the second block of items still gives the same documents."""
    docs, items = frames
    path, setting = str(tmp_path / "docs"), "spark.sql.files.maxPartitionBytes"
    docs.repartition(12).write.parquet(path)
    search, before = decontamination._search, spark.conf.get(setting)

    def then_split(*args):
        found = search(*args)
        spark.conf.set(setting, "1m")
        return found

    monkeypatch.setattr(decontamination, "_search", then_split)
    try:
        found = decontamination.contaminated(decontamination.matches(spark.read.parquet(path), items, query_bytes=60))
        assert digests(found) == sorted(brute.decontaminate(texts(), ITEMS))
    finally:
        spark.conf.set(setting, before)

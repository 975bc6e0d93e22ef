from collections import Counter

import pytest

from clickloom.llm import sharding

from . import brute
from .conftest import EDGE_TEXTS


def checked(rows, shards):
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts[s] for s in range(shards)) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    sources = {r.source for r in rows}
    for source in sources:
        here = Counter(r.shard for r in rows if r.source == source)
        share = sum(here.values()) / shards
        assert all(abs(share - here[s]) <= 1 + len(sources) / 2 for s in range(shards)), source


@pytest.mark.parametrize("bucket_rows", [20_000, 7])
def test_every_shard_has_the_mixture(spark, bucket_rows):
    rows = [(i, str(i), "big" if i % 3 else f"s{i % 5}") for i in range(403)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = sharding.interleave(frame, 8, bucket_rows=bucket_rows).collect()
    checked(found, 8)
    assert sorted(r.doc_id for r in found) == list(range(403))
    whole = {(r.doc_id, r.shard, r.slot) for r in sharding.interleave(frame, 8).collect()}
    assert whole == {(r.doc_id, r.shard, r.slot) for r in found}


@pytest.mark.parametrize("bucket_rows", [20_000, 50])
def test_sources_of_one_row_are_spread(spark, bucket_rows):
    rows = [(i, "x", "big") for i in range(800)] + [(1000 + i, "x", f"s{i}") for i in range(200)]
    found = sharding.interleave(spark.createDataFrame(rows, "doc_id long, text string, source string"), 8, bucket_rows=bucket_rows).collect()
    checked(found, 8)
    small = Counter(r.shard for r in found if r.source != "big")
    assert len(small) == 8 and max(small.values()) <= 3 * 200 / 8


def test_seed_deals_anew(spark):
    frame = spark.createDataFrame([(i, "x", "s") for i in range(100)], "doc_id long, text string, source string")
    one, two = ({r.doc_id: r.shard for r in sharding.interleave(frame, 4, seed=s).collect()} for s in (1, 2))
    assert one != two


def test_odd_rows(edge_docs):
    found = sharding.interleave(edge_docs, 3).collect()
    checked(found, 3)
    got = sorted((r.doc_id, r.size, r.text_crc32) for r in found)
    assert got == sorted((i, len((t or "").encode()) + 1, brute.crc(t)) for i, t in EDGE_TEXTS)


def test_no_rows(no_docs):
    assert sharding.interleave(no_docs, 8).count() == 0

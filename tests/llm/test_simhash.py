import random

import numpy as np
import pytest

from clickloom.llm import components, simhash

from . import brute
from .conftest import EDGE_TEXTS, prose


def expected(rows):
    prints = {i: brute.fingerprint(t) for i, t in rows}
    found = brute.components(list(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    return sorted((i, prints[i], found[i]) for i, _ in rows)


def got(frame):
    return sorted((r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in frame.collect())


def test_odd_rows(edge_docs):
    assert got(simhash.near_duplicates(edge_docs)) == expected(EDGE_TEXTS)


def test_edited_copies(spark):
    rng, rows = random.Random(5), []
    for n in range(12):
        words = prose(n, 400).split()
        for copy in range(6):
            changed = list(words)
            for _ in range(copy):
                changed[rng.randrange(400)] = "new"
            rows.append((n * 10 + copy, " ".join(changed)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(simhash.near_duplicates(frame)) == expected(rows)


def test_no_rows(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("max_bits,block", [(3, 4096), (3, 8), (5, 16), (1, 8)])
def test_links_connect_all_close_values(spark, max_bits, block):
    rng = random.Random(max_bits)
    values = {rng.getrandbits(64)}
    for _ in range(300):
        value = rng.choice(sorted(values)) if rng.random() < 0.7 else rng.getrandbits(64)
        for bit in rng.sample(range(64), rng.randrange(1, max_bits + 3)):
            value ^= 1 << bit
        values.add(value)
    nodes = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fingerprint long")
    found = {r.node: r.component for r in components.components(simhash.links(nodes, max_bits, block)).collect()}
    signed = [r.fingerprint for r in nodes.collect()]
    want = brute.components(signed, lambda a, b: ((a ^ b) % (1 << 64)).bit_count() <= max_bits)
    assert {v: found.get(v, v) for v in signed} == want


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 150)] + [(5000, 5000)]
    found = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(150)}

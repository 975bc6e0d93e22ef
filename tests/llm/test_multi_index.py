import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import multi_index

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, asks, k=10):
    """Nearest others of each query, from the differences of all pairs."""
    fit = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    found = []
    for i, v in fit:
        if asks(i):
            others = {(float(np.sqrt(((v - w) ** 2).sum())), j) for j, w in fit if j != i and len(w) == len(v)}
            found += [(i, rank, j, d) for rank, (d, j) in enumerate(sorted(others)[:k], 1)]
    return sorted(found)


def found(spark, rows, **options):
    table = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in multi_index.search(table, F.col("vec_id") % 10 == 0, **options).collect())


def points(n, width, seed):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(n, width)).astype(np.float32).tolist()


def odd_rows():
    """Odd vectors, ties, copies of one vector in a third of the rows, repeated rows and ids, two sizes."""
    rows = list(enumerate(points(150, 6, 1)))
    rows += [(150 + n, rows[10][1]) for n in range(80)] + [(300 + n, [float(n % 3), 1.0, 0.0, 0.0, 0.0, 0.0]) for n in range(30)]
    rows += [(400, None), (410, []), (420, [0.0] * 6), (430, [float("nan")] + [1.0] * 5), (440, [float("inf")] * 6), (450, [None, 1.0, 1.0, 1.0, 1.0, 1.0])]
    rows += [(None, rows[0][1]), (20, rows[20][1]), (30, rows[31][1]), (500, [1.0, 2.0]), (510, [1.0, -2.0]), (511, [-0.0, 2.0]), (520, [0.0, 2.0]), (600, [5.0])]
    random.Random(4).shuffle(rows)
    return rows


def test_whole_search_as_brute_force(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "GROUP_ROWS", 16)
    monkeypatch.setattr(multi_index, "GROUP_QUERIES", 4)
    rows = odd_rows()
    # A repeated row has its answers as often; an id with two vectors has those of both.
    got, want = found(spark, rows, share=1.0), brute(rows, lambda i: i % 10 == 0)
    assert [(q, r, v) for q, r, v, _ in got] == [(q, r, v) for q, r, v, _ in want]
    assert [s for *_, s in got] == pytest.approx([s for *_, s in want], rel=1e-12)


def test_recall(spark, small):
    """Random directions have no structure that helps; the calibrated search still finds its share."""
    rows = list(enumerate(points(2500, 24, 2)))
    got = {(q, v) for q, _, v, _ in found(spark, rows)}
    want = {(q, v) for q, _, v, _ in brute(rows, lambda i: i % 10 == 0)}
    assert len(got & want) >= 0.9 * len(want)
    table = spark.read.parquet(f"{small}/embeddings.parquet")
    got = {(r.query_id, r.vec_id) for r in multi_index.search(table, F.col("vec_id") % 10 == 0).collect()}
    want = {(q, v) for q, _, v, _ in brute([tuple(r) for r in table.select("vec_id", "embedding").collect()], lambda i: i % 10 == 0)}
    assert len(got & want) >= 0.9 * len(want)


def test_search_ends_early_where_vectors_gather(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(40, 16)) * 10
    rows = [(n, (centers[n % 40] + rng.normal(size=16) * 0.1).tolist()) for n in range(2000)]
    entries = spark.createDataFrame([(n, v, True) for n, v in rows], "entry long, v array<double>, asked boolean")
    model = multi_index.fit(entries, 16, 2000)
    cells = model.cells(np.array([v for _, v in rows]))
    counts = np.bincount(cells, minlength=len(model.first) * len(model.second))
    index = spark.createDataFrame([(n, v, True, int(c)) for (n, v), c in zip(rows, cells)], "entry long, v array<double>, asked boolean, cell int")
    assert multi_index.calibrated(index, model, counts, 10, 0.96) < 0.1


def test_traverse_by_summed_distance():
    rng = np.random.default_rng(5)
    first, second, counts = rng.random(7), rng.random(9), rng.integers(0, 4, 63)
    sums = (first[:, None] + second).reshape(-1)
    order = [c for c in np.argsort(sums) if counts[c]]
    assert list(multi_index.traverse(first, second, counts, 1e9)) == order
    some = list(multi_index.traverse(first, second, counts, 20))
    assert some == order[:len(some)] and counts[some].sum() >= 20 > counts[some[:-1]].sum()
    assert list(multi_index.traverse(np.zeros(1), np.zeros(1), np.array([0]), 5)) == []


def test_groups_are_bounded():
    counts = np.array([3, 0, 4, 9, 1, 1, 25, 2, 0, 5])
    first, over = multi_index.groups_of(counts, 5, 8)
    held = {}
    for cell, (a, n, c) in enumerate(zip(first, over, counts)):
        for g in range(a, a + n):
            held.setdefault(g, []).append((cell // 5, c / n))
    assert all(sum(c for _, c in some) <= 8 or len([c for _, c in some if c]) == 1 and sum(c for _, c in some) < 9 for some in held.values())
    assert all(len({a for a, c in some if c}) <= 1 for some in held.values())
    assert over.tolist() == [1, 1, 1, 2, 1, 1, 4, 1, 1, 1]


def test_few_or_no_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0])]) == []
    assert found(spark, [(10, [1.0])]) == []
    assert found(spark, [(10, [1.0, 1.0]), (3, [1.0, 2.0])]) == [(10, 1, 3, 1.0)]
    assert found(spark, [(10, [1.0]), (20, [1.0]), (3, [1.0])]) == [(10, 1, 3, 0.0), (10, 2, 20, 0.0), (20, 1, 3, 0.0), (20, 2, 10, 0.0)]


def test_extra_columns(spark):
    table = spark.createDataFrame([(n, [float(n), 1.0]) for n in range(12)], SCHEMA)
    more = table.withColumns({c: F.lit("x") for c in ("v", "ids", "entry", "cell", "grp", "asked", "score", "rank", "query_id", "width")})
    asks = F.col("vec_id") % 10 == 0
    assert sorted(map(tuple, multi_index.search(more, asks).collect())) == sorted(map(tuple, multi_index.search(table, asks).collect()))

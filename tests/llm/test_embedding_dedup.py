import numpy as np
import pytest

from clickloom.llm import embedding_dedup

from . import brute


def vectors():
    rng = np.random.default_rng(6)
    base = rng.normal(size=(60, 64))
    rows = []
    for n in range(400):
        near = base[n % 60] + rng.normal(size=64) * rng.choice([0.05, 0.2, 0.35, 2.0])
        rows.append((n, [float(np.float32(x)) for x in near * rng.uniform(0.5, 2)]))
    one = rows[0][1]
    return rows + [(500, one), (501, one), (502, None), (503, []), (504, [0.0] * 64), (505, [float("nan")] * 64),
                   (506, [1.0] * 63 + [None]), (507, [float("inf")] + [1.0] * 63), (508, [1.0, 0.0]), (509, [2.0, 0.0]), (510, [-1.0, 0.0]),
                   (500, one)]


def cosines(rows):
    fit = [(k, np.array(v)) for k, (_, v) in enumerate(rows)
           if v and None not in v and np.isfinite(v).all() and np.any(v)]
    for size in {len(v) for _, v in fit}:
        some = [(k, v / np.linalg.norm(v)) for k, v in fit if len(v) == size]
        x = np.array([v for _, v in some])
        for a, b in zip(*np.nonzero(x @ x.T >= 0.9)):
            if a != b:
                yield some[a][0], some[b][0]


def test_as_brute_force(spark):
    rows = vectors()
    frame = spark.createDataFrame([(i, v, 3) for i, v in rows], "vec_id long, embedding array<float>, node int")
    found = embedding_dedup.near_duplicates(frame).collect()
    linked = set(cosines(rows))
    want, ids = {}, [i for i, _ in rows]
    parts = brute.components([i for i in dict.fromkeys(ids)], lambda a, b: any(
        (x, y) in linked for x in [k for k, i in enumerate(ids) if i == a] for y in [k for k, i in enumerate(ids) if i == b]))
    degree = {k: sum(1 for x, _ in linked if x == k) for k in range(len(rows))}
    got = sum(r.n_links for r in found)
    assert got >= 0.9 * len(linked) and len(found) == len(rows)
    for k, i in enumerate(ids):
        want[i] = max(want.get(i, 0), degree[k])
    assert all(r.n_links <= want[r.vec_id] for r in found)
    assert sum(parts[r.vec_id] == r.component_id for r in found) >= 0.95 * len(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)
    alone = {r.vec_id: (r.n_links, r.component_id) for r in found if 502 <= r.vec_id <= 507}
    assert alone == {i: (0, i) for i in range(502, 508)}
    assert {r.vec_id: r.n_links for r in found if r.vec_id >= 508} == {508: 1, 509: 1, 510: 0}


def test_recall_at_the_threshold():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.normal(size=(3000, 64))
    y -= (y * x).sum(1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    y = 0.9 * x + np.sqrt(1 - 0.81) * y
    own_x, asked_x = embedding_dedup.cells(x)
    own_y, asked_y = embedding_dedup.cells(y)
    met = [bool(set(a) & set(b)) or bool(set(c) & set(d)) for a, b, c, d in zip(asked_x.tolist(), own_y.tolist(), asked_y.tolist(), own_x.tolist())]
    assert np.mean(met) >= 0.9


def test_nearest_lattice_points():
    rng = np.random.default_rng(3)
    x = rng.uniform(-2, 2, size=(200, 8))
    near = embedding_dedup.nearest(x)
    distance = ((x - near) ** 2).sum(1)
    assert (distance <= 1 + 1e-9).all()  # the covering radius
    assert all((((x - (near + v)) ** 2).sum(1) >= distance - 1e-9).all() for v in embedding_dedup.MINIMAL)
    assert len(embedding_dedup.MINIMAL) == 240


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_no_vectors(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert [(r.vec_id, r.n_links, r.kept) for r in embedding_dedup.near_duplicates(frame).collect()] == [(1, 0, True)] * len(rows)

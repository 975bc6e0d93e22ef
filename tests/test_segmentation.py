import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom.operators import bisection, evaluation, features, segmentation
from clickloom.plans import segmentation_job
from clickloom.sources import event_table, storage


@pytest.fixture(scope="module")
def rows(spark):
    table = features.feature_table(event_table.events(spark, "/root/testdata/sf0.01"))
    return storage.stage(features.model_input(table, labelled=False), "segment_input").persist()


@pytest.fixture(scope="module")
def fitted(rows):
    return segmentation_job.fit_on(rows)


@pytest.fixture(scope="module")
def matrix(rows):
    raw = np.array([[float(r[c]) for c in C.FEATURES] for r in rows.orderBy("user_id").collect()])
    return (raw - raw.mean(axis=0)) / raw.std(axis=0, ddof=1)


def test_assignments_cover_all_users(rows, fitted):
    found = fitted.assignments(rows)
    assert found.columns == segmentation.ASSIGNMENT_COLUMNS
    assert found.count() == rows.count()
    assert found.select("cluster").distinct().count() == C.CLUSTERS


def test_projection_equals_principal_axes(rows, fitted, matrix):
    """Coordinates and variance shares against the eigenvectors of the correlation matrix."""
    values, vectors = np.linalg.eigh(np.corrcoef(matrix.T))
    top = vectors[:, ::-1][:, :2]
    top = top * np.sign(top[np.abs(top).argmax(axis=0), [0, 1]])
    shares = [r.explained_variance for r in segmentation.explained_variance(fitted.projection).orderBy("component").collect()]
    assert shares == pytest.approx(values[::-1][:2] / values.sum())
    found = fitted.assignments(rows).orderBy("user_id").collect()
    assert np.allclose([[r.pca_x, r.pca_y] for r in found], matrix @ top, atol=1e-9)


def test_records(rows, fitted, matrix):
    records = segmentation.cluster_metadata(fitted, rows, training_cost=True).orderBy("cluster_id").collect()
    labels = np.array([r.cluster for r in fitted.assignments(rows).orderBy("user_id").collect()])
    assert [r.user_count for r in records] == [int((labels == r.cluster_id).sum()) for r in records]
    assert [r.archetype for r in records] == list(C.ARCHETYPES.values())
    # Bisection stops within a small tolerance of the mean.
    for r in records:
        assert np.allclose(r.centroid, matrix[labels == r.cluster_id].mean(axis=0), atol=1e-2)
    within = sum(((matrix[labels == r.cluster_id] - r.centroid) ** 2).sum() for r in records)
    assert records[0].training_cost == pytest.approx(within, rel=1e-3)


def test_silhouette_equals_pairwise_form(rows, fitted, matrix):
    labels = np.array([r.cluster for r in fitted.assignments(rows).orderBy("user_id").collect()])
    far = ((matrix[:, None, :] - matrix[None, :, :]) ** 2).sum(axis=2)
    scores = []
    for i, own in enumerate(labels):
        mean = {c: far[i, (labels == c) & (np.arange(len(labels)) != i)].mean() for c in set(labels)}
        a, b = mean.pop(own), min(v for c, v in mean.items() if c != own)
        scores.append((b - a) / max(a, b))
    assert evaluation.silhouette(fitted.transform(rows)) == pytest.approx(np.mean(scores))


def test_saved_model_assigns_the_same(rows, fitted, tmp_path):
    storage.save_model(fitted.model, str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).transform(rows).select("user_id", "cluster")
    assert fitted.assignments(rows).select("user_id", "cluster").exceptAll(again).count() == 0


def test_fit_does_not_depend_on_file_order(rows, fitted):
    other = segmentation_job.fit_on(rows.repartition(5)).assignments(rows)
    mine = fitted.assignments(rows)
    assert mine.select("user_id", "cluster").exceptAll(other.select("user_id", "cluster")).count() == 0


def test_too_few_users_stay_one_cluster(rows):
    few = rows.where(F.col("user_id") < "u_11")
    fit = segmentation_job.fit_on(few)
    record = segmentation.cluster_metadata(fit, few).collect()
    assert [(r.user_count, r.silhouette) for r in record] == [(few.count(), None)]


def test_archetype_names(spark):
    rows = spark.createDataFrame([(0,), (4,), (5,), (12,)], "cluster int")
    assert [r.archetype for r in segmentation.name_clusters(rows).collect()] == [
        "Power Networkers", "Casual Observers", "Segment-5", "Segment-12",
    ]
    assert segmentation.name_clusters(rows, {5: "Own"}).where("archetype = 'Own'").count() == 1


def test_empty_cluster_gets_a_record_of_size_zero(spark):
    centers = spark.createDataFrame([(0, [1.23456]), (7, [2.0])], "cluster_id int, centroid array<double>")
    sizes = spark.createDataFrame([(0, 3)], "cluster int, n_users long")
    found = segmentation.describe_clusters(centers, sizes, 0.123456).orderBy("cluster_id").collect()
    assert [tuple(r) for r in found] == [
        (0, "Power Networkers", 3, [1.2346], 0.1235), (7, "Segment-7", 0, [2.0], 0.1235),
    ]


# Clusters without a random start.


def bisected(matrix, k=C.CLUSTERS, smallest=bisection.SMALLEST):
    """Plain form: labels of the rows."""
    labels, dead = np.zeros(len(matrix), int), set()
    while len(set(labels)) < k:
        sizes = {c: (labels == c).sum() for c in set(labels) - dead}
        able = {c: ((matrix[labels == c] - matrix[labels == c].mean(axis=0)) ** 2).sum() for c, n in sizes.items() if n >= smallest}
        if not able:
            break
        chosen = min(able, key=lambda c: (-able[c], c))
        part = matrix[labels == chosen]
        axis = np.linalg.eigh(np.atleast_2d(np.cov(part.T)))[1][:, -1]
        axis *= np.sign(axis[np.abs(axis).argmax()])
        far = (part - part.mean(axis=0)) @ axis > 0
        for _ in range(bisection.ROUNDS):
            if far.all() or not far.any():
                break
            a, b = part[~far].mean(axis=0), part[far].mean(axis=0)
            far = ((part - b) ** 2).sum(axis=1) < ((part - a) ** 2).sum(axis=1)
        if far.all() or not far.any():
            dead.add(chosen)
            continue
        labels[np.flatnonzero(labels == chosen)[far]] = len(set(labels))
    return labels


@pytest.fixture(scope="module")
def repeatable(rows):
    return segmentation_job.fit_on(rows, repeatable=True)


def test_repeatable_clusters_equal_plain_form(rows, repeatable, matrix):
    found = [r.cluster for r in repeatable.assignments(rows).orderBy("user_id").collect()]
    assert found == bisected(matrix).tolist()
    records = segmentation.cluster_metadata(repeatable, rows, training_cost=True).orderBy("cluster_id").collect()
    assert [r.user_count for r in records] == np.bincount(found).tolist()
    means = [matrix[np.array(found) == c].mean(axis=0) for c in range(len(records))]
    assert np.allclose([r.centroid for r in records], means, atol=1e-4)
    assert records[0].training_cost == pytest.approx(sum(((matrix - np.array(means)[found]) ** 2).sum(axis=1)))


def test_saved_repeatable_clusters_assign_the_same(rows, repeatable, tmp_path):
    storage.save_model(repeatable.model, str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).transform(rows).select("user_id", "cluster")
    assert repeatable.assignments(rows).select("user_id", "cluster").exceptAll(again).count() == 0
    other = segmentation.fit(rows.repartition(7), repeatable=True).assignments(rows).select("user_id", "cluster")
    assert again.exceptAll(other).count() == 0


XY = {"x": (0.0, 1.0), "y": (0.0, 1.0)}


def points(spark, values):
    frame = spark.createDataFrame([(float(x), float(y)) for x, y in values], "x double, y double")
    return VectorAssembler(inputCols=["x", "y"], outputCol="v").transform(frame)


def test_equal_rows_and_small_clusters_stay_whole(spark):
    """Two heaps of equal rows are two clusters, however many are asked for; one below the size isn't split."""
    heaps = points(spark, [(0, 0)] * 30 + [(5, 1)] * 25)
    tree = bisection.fit(heaps, XY, "v", k=5)
    assert [(g.n, g.mean, round(g.cost, 9)) for g in tree.groups] == [(30, (0.0, 0.0), 0.0), (25, (5.0, 1.0), 0.0)]
    few = points(spark, [(n, 0) for n in range(19)])
    assert [g.n for g in bisection.fit(few, XY, "v", k=5).groups] == [19]
    assert [g.n for g in bisection.fit(few, XY, "v", k=2, smallest=2).groups] == [10, 9]
    assert bisection.fit(few.limit(0), XY, "v", k=5).groups == (bisection.Group(0, (0.0, 0.0), 0.0),)
    assert bisection.fit(few.limit(1), XY, "v", k=5, smallest=1).expression() == "0"


@pytest.mark.parametrize("seed", range(3))
def test_random_points_equal_plain_form(spark, seed):
    values = np.random.default_rng(seed).normal(size=(90, 2)) * [3, 1] + np.random.default_rng(seed).integers(0, 3, (90, 1)) * 6
    tree = bisection.fit(points(spark, values.tolist()), XY, "v", k=7, smallest=9)
    found = tree.stage().transform(points(spark, values.tolist()))
    assert [r.cluster for r in found.collect()] == bisected(values, 7, 9).tolist()


def test_each_row_takes_one_way_down(spark):
    """The expression grows with the splits, not with their depth."""
    splits = tuple(bisection.Split(n, n + 1, (0.0,), (1.0 + n,)) for n in range(12))
    tree = bisection.Bisection({"x": (0.0, 1.0)}, splits, ())
    assert tree.expression().count("CASE") == 12

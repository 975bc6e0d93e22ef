import itertools
import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom.operators import evaluation, features, models, scaling
from clickloom.plans import classification_job
from clickloom.sources import event_table, storage


@pytest.fixture(scope="module")
def rows(spark):
    table = features.feature_table(event_table.events(spark, "/root/testdata/sf0.01"))
    return storage.stage(features.model_input(table), "model_input").persist()


@pytest.fixture(scope="module")
def ensemble(rows):
    return classification_job.fit_on(rows)


def test_vote_does_not_depend_on_order(spark):
    votes = spark.createDataFrame(
        [(*v, float(sum(v) > 1.5)) for v in itertools.product([0.0, 1.0], repeat=3)],
        "a double, b double, c double, expected double",
    )
    for order in itertools.permutations("abc"):
        assert models.vote(votes, list(order)).where("ensemble_prediction <> expected").count() == 0


def test_vote_tie_is_negative(spark):
    votes = spark.createDataFrame([(1.0, 0.0), (1.0, 1.0)], "a double, b double")
    assert [r.ensemble_prediction for r in models.vote(votes, ["a", "b"]).collect()] == [0.0, 1.0]


def _metrics(spark, pairs):
    frame = spark.createDataFrame(pairs, "label double, p double")
    ours = evaluation.classification_metrics(frame, {"p": "m"}, digits=None).first()
    judge = MulticlassClassificationEvaluator(labelCol="label", predictionCol="p")
    for name in evaluation.METRIC_COLUMNS:
        assert ours[name] == pytest.approx(judge.setMetricName(name).evaluate(frame)), name


def test_metrics_equal_the_evaluator(spark):
    _metrics(spark, [(0.0, 0.0)] * 5 + [(0.0, 1.0)] * 2 + [(1.0, 1.0)] * 7 + [(1.0, 0.0)] * 3)
    # A class never predicted, a class that only occurs as prediction, more than two classes.
    _metrics(spark, [(0.0, 0.0), (1.0, 0.0), (1.0, 0.0)])
    _metrics(spark, [(0.0, 0.0), (0.0, 1.0)])
    _metrics(spark, [(0.0, 0.0), (1.0, 2.0), (2.0, 2.0), (2.0, 1.0), (1.0, 1.0)])


def test_scaling_of_constant_columns(spark):
    data = [(f"u{i}", *[float(i) if j else 7.0 for j in range(len(C.FEATURES))]) for i in range(4)]
    frame = spark.createDataFrame(data, ["user_id", *C.FEATURES])
    assert scaling.fit_standard(frame).transform(frame).first().standard_features[0] == 0.0
    assert scaling.fit_minmax(frame).transform(frame).first().minmax_features[0] == 0.5


def test_rows_outside_the_training_range_are_clamped(spark):
    data = [(f"u{i}", *[float(i)] * len(C.FEATURES)) for i in range(1, 4)]
    frame = spark.createDataFrame(data, ["user_id", *C.FEATURES])
    outside = spark.createDataFrame(
        [("low", *[-9.0] * len(C.FEATURES)), ("high", *[99.0] * len(C.FEATURES))], ["user_id", *C.FEATURES]
    )
    scaled = {r.user_id: r.minmax_features for r in scaling.fit_minmax(frame).transform(outside).collect()}
    assert set(scaled["low"]) == {0.0} and set(scaled["high"]) == {1.0}


def test_saved_models_predict_the_same(spark, rows, ensemble, tmp_path):
    test = scaling.split(rows)[1]
    for column, model in ensemble.models.items():
        storage.save_model(model, f"{tmp_path}/{column}")
        storage.save_model(model, f"{tmp_path}/{column}")
        before = model.transform(test).select("user_id", column)
        after = PipelineModel.load(f"{tmp_path}/{column}").transform(test).select("user_id", column)
        assert before.exceptAll(after).count() == 0 and after.count() == test.count()


def test_chained_scoring_equals_joined_scoring(rows, ensemble):
    test = scaling.split(rows)[1]
    chained = models.predictions(ensemble, test)
    scored = {c: m.transform(test).select("user_id", c) for c, m in ensemble.models.items()}
    joined = models.vote(models.combine_predictions(test, scored), list(scored)).select(*chained.columns)
    assert chained.exceptAll(joined).count() == joined.exceptAll(chained).count() == 0
    assert chained.count() == test.count()


def test_models_learn_the_label(rows, ensemble):
    train = scaling.split(rows)[0]
    metrics = evaluation.classification_metrics(models.predictions(ensemble, train))
    found = {r.model: r.accuracy for r in metrics.collect()}
    assert set(found) == {"NaiveBayes", "LinearSVM", "MLP-NN", "Ensemble-Vote"}
    majority = train.groupBy("label").count().agg(F.max("count")).first()[0] / train.count()
    assert found["LinearSVM"] > majority and found["MLP-NN"] > 0.95


def test_curve_areas(rows, ensemble):
    scored = ensemble.transform(scaling.split(rows)[0])
    metrics = evaluation.classification_metrics(scored)
    found = {r.model: r.areaUnderROC for r in classification_job.with_curve_areas(metrics, ensemble, scored).collect()}
    assert found["Ensemble-Vote"] is None and 0.5 < found["LinearSVM"] <= 1


def test_bayes_parameters_are_distributions(rows):
    table = models.bayes_parameters(models.fit_naive_bayes(scaling.split(rows)[0])).collect()
    assert len(table) == 2 * len(C.FEATURES)
    for label in (0, 1):
        assert sum(math.exp(r.theta) for r in table if r.label == label) == pytest.approx(1)
    # The smoothed prior leaves a little more than nothing for no class at all.
    assert sum({r.label: math.exp(r.pi) for r in table}.values()) == pytest.approx(1, abs=1e-9)


def test_refit_gives_the_same_model(rows):
    first, second = (
        models.fit_linear_svm(scaling.arranged(scaling.split(rows.repartition(n))[0])).stages[-1] for n in (1, 6)
    )
    assert first.coefficients == second.coefficients


def test_one_job_before_the_fits(spark, small):
    """Number of users, means, deviations and ranges come from one aggregate; building the scalers runs nothing."""
    rows = storage.stage(features.model_input(features.feature_table(event_table.events(spark, small))), "rows")
    group = "one job"
    spark.sparkContext.setJobGroup(group, "statistics")
    try:
        known = scaling.statistics(rows)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        for fit in (scaling.fit_standard, scaling.fit_spread, scaling.fit_minmax):
            fit(rows, known)
        scaling.arranged(rows, count=known.count)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == jobs <= 2
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert known.count == rows.count()
    exact = rows.agg(F.avg("n_search"), F.stddev("n_search"), F.min("n_search"), F.max("n_search")).first()
    assert known.features["n_search"] == pytest.approx(tuple(exact))


def test_statistics_leave_out_incomplete_rows(spark):
    rows = spark.createDataFrame([[1.0] * len(C.FEATURES), [3.0] * len(C.FEATURES), [None] + [9.0] * (len(C.FEATURES) - 1)], ", ".join(f"{c} double" for c in C.FEATURES))
    known = scaling.statistics(rows)
    assert known.count == 2 and set(known.features.values()) == {(2.0, 2 ** 0.5, 1.0, 3.0)}
    none = scaling.statistics(rows.where("false"))
    assert none.count == 0
    with pytest.raises(ValueError):
        scaling.fit_standard(rows, none)
    alone = scaling.statistics(rows.limit(1))
    assert scaling.fit_standard(rows, alone).transform(rows.limit(1)).first().standard_features.toArray().tolist() == [0.0] * len(C.FEATURES)

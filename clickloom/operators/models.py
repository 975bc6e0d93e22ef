"""Three classifiers and their vote."""

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LinearSVC, MultilayerPerceptronClassifier, NaiveBayes
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom.functions import rules
from clickloom.operators import scaling
from clickloom.sources import storage


def naive_bayes() -> NaiveBayes:
    return NaiveBayes(
        featuresCol="minmax_features", labelCol="label", smoothing=1.0, modelType="multinomial",
        predictionCol="nb_pred", rawPredictionCol="nb_raw", probabilityCol="nb_probability",
    )


def linear_svm() -> LinearSVC:
    return LinearSVC(
        featuresCol="standard_features", labelCol="label", maxIter=100, regParam=0.01,
        predictionCol="svm_pred", rawPredictionCol="svm_raw",
    )


def perceptron() -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(
        featuresCol="standard_features", labelCol="label", layers=[len(C.FEATURES), 64, 32, 2],
        maxIter=100, blockSize=128, seed=C.SEED, stepSize=0.03,
        predictionCol="mlp_pred", rawPredictionCol="mlp_raw", probabilityCol="mlp_probability",
    )


def fit_naive_bayes(train: DataFrame, known: scaling.Statistics | None = None) -> PipelineModel:
    scaler = scaling.fit_minmax(train, known)
    return PipelineModel([*scaler.stages, naive_bayes().fit(scaler.transform(train))])


def _loaded(model, train: DataFrame):
    """The stage as stored: a freshly fitted one keeps a training summary that refers to the session, and
    scoring would ship both to every task."""
    path = storage.scratch_dir(train.sparkSession, "model")
    storage.save_model(model, path)
    return type(model).load(path)


def fit_on_standard(train: DataFrame, known: scaling.Statistics | None, *estimators) -> list[PipelineModel]:
    """Pipelines of the estimators over one scaler and one copy of the scaled vectors."""
    scaler = scaling.fit_standard(train, known)
    vectors = storage.cut(scaler.transform(train).select("label", "standard_features"))
    return [PipelineModel([*scaler.stages, _loaded(e.fit(vectors), train)]) for e in estimators]


def fit_linear_svm(train: DataFrame, known: scaling.Statistics | None = None) -> PipelineModel:
    return fit_on_standard(train, known, linear_svm())[0]


def fit_perceptron(train: DataFrame, known: scaling.Statistics | None = None) -> PipelineModel:
    return fit_on_standard(train, known, perceptron())[0]


@dataclass(frozen=True)
class Ensemble:
    """Fitted voters by prediction column; each is a complete pipeline that can be saved alone."""

    models: dict[str, PipelineModel]

    def transform(self, rows: DataFrame) -> DataFrame:
        """All predictions and the vote side by side: no join, scaled features computed once."""
        seen: set[str] = set()
        for model in self.models.values():
            stages = [s for s in model.stages if s.uid not in seen]
            seen.update(s.uid for s in stages)
            rows = PipelineModel(stages).transform(rows)
        return vote(rows, list(self.models))


def fit_ensemble(train: DataFrame, known: scaling.Statistics | None = None) -> Ensemble:
    """All voters, from one pass for the statistics of the features."""
    known = known or scaling.statistics(train)
    svm, mlp = fit_on_standard(train, known, linear_svm(), perceptron())
    return Ensemble({"nb_pred": fit_naive_bayes(train, known), "svm_pred": svm, "mlp_pred": mlp})


def vote(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.withColumn(C.ENSEMBLE_COLUMN, rules.majority([F.col(c) for c in columns]))


def predictions(ensemble: Ensemble, rows: DataFrame) -> DataFrame:
    return ensemble.transform(rows).select("user_id", "label", *ensemble.models, C.ENSEMBLE_COLUMN)


def combine_predictions(test: DataFrame, scored: dict[str, DataFrame]) -> DataFrame:
    """Inner join of the test rows with predictions scored elsewhere, one column per set."""
    for column, frame in scored.items():
        test = test.join(frame.select("user_id", column), "user_id", "inner")
    return test


def bayes_parameters(model: PipelineModel) -> DataFrame:
    """Log prior and log likelihoods of a fitted naive Bayes, one row per class and feature."""
    fitted = model.stages[-1]
    prior, likelihood = fitted.pi.toArray(), fitted.theta.toArray()
    rows = [
        (label, name, float(prior[label]), float(likelihood[label, i]))
        for label in range(len(prior))
        for i, name in enumerate(C.FEATURES)
    ]
    return SparkSession.active().createDataFrame(rows, "label int, feature string, pi double, theta double")

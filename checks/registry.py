"""Queries over the driver tables, by name.

Where the operator under test is not a fit, predictions, clusters and coordinates come from simple rules
on the feature table, so that plain SQL can follow.
"""

import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom.operators import (
    cleaning, counts, evaluation, features, lookups, models, scaling, segmentation, sessions, telemetry,
)
from clickloom.plans import classification_job, feature_job, segmentation_job
from clickloom.session import configure
from clickloom.sources import counts_tsv, event_table, raw_log, storage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Buckets of stored tables.
BUCKETS = 8
# Ends of ids that a text format must not lose.
HOSTILE = ["", "\t", "\n", "\r\n", "\"q", "\\", "\\t", "\\\\n", " x "]


def query(build: Query) -> Query:
    """Register under the function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(build(configure(spark), sf_dir))

    QUERIES[build.__name__] = run
    return run


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to 6 places for comparison; adding zero turns -0.0 into 0.0."""
    doubles = {name for name, kind in df.dtypes if kind == "double"}
    return df.select(*[(F.round(c, 6) + 0.0).alias(c) if c in doubles else F.col(c) for c in df.columns])


# Inputs.


def events(spark, sf_dir):
    return event_table.events(spark, sf_dir)


def feature_rows(spark, sf_dir):
    return features.feature_table(events(spark, sf_dir))


def stored_features(spark, sf_dir):
    """Feature table written and read back, as the model jobs find it."""
    return storage.stage(feature_rows(spark, sf_dir), "feature_table")


def stored_model_input(spark, sf_dir):
    return features.model_input(stored_features(spark, sf_dir))


RULE_VOTERS = {
    "nb_pred": "total_actions % 2 = 1",
    "svm_pred": "n_search > n_click",
    "mlp_pred": "total_sessions % 3 = 0",
}


def rule_predictions(rows: DataFrame) -> DataFrame:
    votes = {name: F.expr(rule).cast("double") for name, rule in RULE_VOTERS.items()}
    return models.vote(rows.withColumns(votes), list(votes))


def rule_clusters(rows: DataFrame) -> DataFrame:
    return rows.withColumn("cluster", (F.substring("user_id", 3, 20).cast("long") % 7).cast("int"))


def rule_assignments(rows: DataFrame) -> DataFrame:
    placed = rule_clusters(rows).withColumns({
        "pca_x": F.col("avg_session_duration_min"),
        "pca_y": F.col("avg_events_per_session"),
    })
    return placed.select(*segmentation.ASSIGNMENT_COLUMNS)


# Reading and cleaning.


@query
def raw_scan(spark, sf_dir):
    """Write the events as gzip JSON lines, read them back typed."""
    path = storage.scratch_dir(spark, "raw_log")
    event_table.lines(spark, sf_dir).select("line").write.options(compression="gzip", maxRecordsPerFile=500_000).text(path)
    return raw_log.read_events(spark, path).select(
        F.when(F.col("status") != "corrupt", F.col("event_order")).alias("event_order"),
        "timestamp", "user_id", "session_id", "action",
        F.col("payload.query").alias("query"),
        F.col("payload.dwell_time_ms").alias("dwell_time_ms"),
        F.col("client.user_agent").alias("user_agent"),
        F.col("client.country").alias("country"),
        "is_bot_flag", "status",
    )


@query
def spanning_records(spark, sf_dir):
    """The events pretty-printed over many lines, read back as one object each."""
    path = storage.scratch_dir(spark, "pretty_log")
    rows = event_table.clickstream(spark, sf_dir)
    bad = F.to_json(F.struct(F.lit(True).alias("_corrupt"), F.lit("}{broken_json}").alias("raw")), {"pretty": "true"})
    rows.select(F.when(F.col("corrupt"), bad).otherwise(event_table.as_json(rows, {"pretty": "true"}))).write.options(
        maxRecordsPerFile=500_000).text(path)
    return raw_log.read_events(spark, path, spanning=True).select(
        F.when(F.col("status") != "corrupt", F.col("event_order")).alias("event_order"), "timestamp", "user_id", "session_id", "action",
        F.col("payload.query").alias("query"), F.col("payload.dwell_time_ms").alias("dwell_time_ms"),
        F.col("client.user_agent").alias("user_agent"), F.col("client.country").alias("country"), "is_bot_flag", "status",
    )


@query
def parse_repair(spark, sf_dir):
    """Lines cut, extended and garbled by rule."""
    rows = event_table.clickstream(spark, sf_dir)
    good = event_table.as_json(rows)
    variants = [
        good,
        F.concat(good, F.lit(",")),
        F.concat(good, F.lit(" ,, ")),
        F.substring(good, F.lit(1), F.length(good) - 1),
        F.concat(good, good),
        F.concat(F.lit(" \t"), good, F.lit(" ")),
        F.lit("7"),
        F.lit("[1]"),
        F.concat(F.lit("}{"), good),
        F.lit('{"raw": "}{broken_json"}'),
        F.lit("  "),
        F.lit(""),
    ]
    kind = F.col("event_id") % len(variants)
    line = F.lit(None).cast("string")
    for i, text in enumerate(variants):
        line = F.when(kind == i, text).otherwise(line)
    typed = raw_log.type_events(rows.select("event_id", line.alias("line")))
    outcome = F.when(F.col("status").isin("corrupt", "blank"), F.col("status")).otherwise("parsed")
    return typed.select("event_id", outcome.alias("outcome"), "user_id", "action")


@query
def framed_records(spark, sf_dir):
    """A good search record behind text, behind records that are rejected, and before another good one."""
    rows = event_table.clickstream(spark, sf_dir)
    base = '{"user_id":"%U","session_id":"s","timestamp":"2024-01-01T00:00:00","action":"%A","is_bot_flag":%F}'
    good = F.replace(F.lit(base.replace("%A", "search").replace("%F", "false")), F.lit("%U"), F.col("user_id"))
    bot = F.lit(base.replace("%U", "u_bot").replace("%A", "search").replace("%F", "true"))
    invalid = F.lit(base.replace("%U", "u_bad").replace("%A", "dance").replace("%F", "false"))
    variants = [
        F.concat(F.lit("2024-01-01 INFO "), good), F.concat(F.lit("\ufeff"), good), F.concat(bot, good), F.concat(invalid, F.lit(" "), good),
        F.concat(good, bot), F.concat(F.lit("{} } "), good), F.concat(bot, F.lit("]"), good), F.concat(bot, F.lit(' "junk" '), good),
        F.concat(bot, F.lit(',"x",'), good), F.concat(F.lit('{"raw":"}{"}'), bot, F.lit("["), good, F.lit("]")),
        F.concat(bot, F.lit(' {"payload":{"a":"}"}} {"b":"\\"{"}'), good), F.concat(bot, invalid),
    ]
    line = F.get(F.array(*variants), (F.col("event_id") % len(variants)).cast("int"))
    return raw_log.type_events(rows.select("event_id", line.alias("line"))).select("event_id", "user_id", "status")


# Field variants: id part, action and payload part, client part, flag part of a record.
_IDS = '"user_id":"%U","session_id":"%S","timestamp":"%T"'
_SEARCH = '"action":"search","payload":{"query":"spark"}'
_CLIENT = '"client":{"user_agent":"Mozilla/5.0","country":"US"}'
_FLAG = '"is_bot_flag":false'
FIELD_VARIANTS = [
    (_IDS, _SEARCH, _CLIENT, _FLAG),
    ('"user_id":12,"session_id":"%S","timestamp":"%T"', _SEARCH, _CLIENT, _FLAG),
    ('"user_id":null,"session_id":"%S","timestamp":"%T"', _SEARCH, _CLIENT, _FLAG),
    ('"session_id":"%S","timestamp":"%T"', _SEARCH, _CLIENT, _FLAG),
    ('"user_id":"","session_id":"%S","timestamp":"%T"', _SEARCH, _CLIENT, _FLAG),
    ('"user_id":"%U","session_id":7,"timestamp":"%T"', _SEARCH, _CLIENT, _FLAG),
    ('"user_id":"%U","session_id":"%S","timestamp":1700000000', _SEARCH, _CLIENT, _FLAG),
    (_IDS, '"action":"dance"', _CLIENT, _FLAG),
    (_IDS, '"action":"dance"', _CLIENT, '"is_bot_flag":true'),
    (_IDS, '"action":"click","payload":{"dwell_time_ms":400}', _CLIENT, _FLAG),
    (_IDS, '"action":"click","payload":{"dwell_time_ms":500}', _CLIENT, _FLAG),
    (_IDS, '"action":"page_view","payload":{}', _CLIENT, _FLAG),
    (_IDS, '"action":"search","payload":{"dwell_time_ms":10}', _CLIENT, _FLAG),
    (_IDS, '"action":"click","payload":{"dwell_time_ms":"300"}', _CLIENT, _FLAG),
    (_IDS, '"action":"click","payload":{"dwell_time_ms":"soon"}', _CLIENT, _FLAG),
    (_IDS, '"action":"click","payload":null', '"client":null', _FLAG),
    (_IDS, _SEARCH, '"client":{"user_agent":"CURL/7"}', _FLAG),
    (_IDS, _SEARCH, _CLIENT, '"is_bot_flag":"yes"'),
    (_IDS, _SEARCH, _CLIENT, '"is_bot_flag":0'),
    (_IDS, _SEARCH, '"x":1', '"y":2'),
]


@query
def validate_fields(spark, sf_dir):
    """Records whose fields miss, change type or hit a limit by rule."""
    rows = event_table.clickstream(spark, sf_dir)
    templates = F.array(*[F.lit("{" + ",".join(parts) + "}") for parts in FIELD_VARIANTS])
    line = F.get(templates, (F.col("event_id") % len(FIELD_VARIANTS)).cast("int"))
    for mark, column in (("%U", "user_id"), ("%S", "session_id"), ("%T", "timestamp")):
        line = F.replace(line, F.lit(mark), F.col(column))
    typed = raw_log.type_events(rows.select("event_id", line.alias("line")))
    return typed.select("event_id", "user_id", "session_id", "action", "status")


@query
def clean_events(spark, sf_dir):
    return cleaning.emitted(events(spark, sf_dir)).select("event_id", "user_id", "action")


@query
def clean_counters(spark, sf_dir):
    return cleaning.counters(events(spark, sf_dir))


# Counts.


@query
def action_counts(spark, sf_dir):
    return counts.action_counts(events(spark, sf_dir))


@query
def tsv_scan(spark, sf_dir):
    """Write counts as a run and scan the directory."""
    path = storage.scratch_dir(spark, "counts")
    counts_tsv.write_counts(counts.action_counts(events(spark, sf_dir)), path, "20240201_000000")
    return counts_tsv.read_counts(spark, path)


def tsv_lines(spark, sf_dir):
    """Tab-separated tuples, some malformed by rule."""
    rows = event_table.clickstream(spark, sf_dir)
    start = F.concat_ws("\t", "user_id", "action")
    kind = F.col("event_id") % 8
    text = (
        F.when(kind < 3, F.concat(start, F.lit("\t1")))
        .when(kind == 3, start)
        .when(kind == 4, F.concat(start, F.lit("\t1\t1")))
        .when(kind == 5, F.concat(start, F.lit("\tx")))
        .when(kind == 6, F.concat(start, F.lit("\t 5 ")))
        .otherwise("")
    )
    return rows.select(text.alias("value"))


@query
def tsv_validate(spark, sf_dir):
    return counts_tsv.reason_counts(tsv_lines(spark, sf_dir))


@query
def tuple_counts(spark, sf_dir):
    return counts.reduce_tuples(counts_tsv.valid_tuples(tsv_lines(spark, sf_dir)))


@query
def latest_run(spark, sf_dir):
    """Two runs below one directory, the second over the whole log."""
    path = storage.scratch_dir(spark, "runs")
    whole = events(spark, sf_dir)
    counts_tsv.write_counts(counts.action_counts(whole.where("ts < '2024-01-15'")), path, "20240115_000000")
    counts_tsv.write_counts(counts.action_counts(whole), path, "20240201_000000")
    return counts_tsv.read_latest_run(spark, path)


@query
def tsv_hostile_ids(spark, sf_dir):
    """Counts of users whose ids hold what ends a field, a line or an escape, through the files."""
    path = storage.scratch_dir(spark, "hostile")
    found = counts.action_counts(events(spark, sf_dir))
    odd = F.array(*[F.lit(x) for x in HOSTILE])
    number = (F.substring("user_id", 3, 20).cast("long") % len(HOSTILE)).cast("int")
    counts_tsv.write_counts(found.withColumn("user_id", F.concat("user_id", F.get(odd, number))), path, "1")
    return counts_tsv.read_latest_run(spark, path)


@query
def tsv_foreign_ids(spark, sf_dir):
    """A run of another writer, whose backslashes are backslashes, below one directory with an own run of hostile ids."""
    path = storage.scratch_dir(spark, "foreign")
    found = counts.action_counts(events(spark, sf_dir))
    number = F.substring("user_id", 3, 20).cast("long") % 3
    plain = F.concat("user_id", F.get(F.array(F.lit("\\new"), F.lit("C:\\temp"), F.lit("\\\\")), number.cast("int")))
    lines = found.where(number != 1).select(F.concat_ws("\t", plain, "action", F.col("cnt").cast("string")).alias("value"))
    lines.write.text(f"{path}/20240101_000000")
    counts_tsv.write_counts(found.where(number == 1).withColumn("user_id", F.concat("user_id", F.lit("\\t\t\n"))), path, "20240201_000000")
    return counts_tsv.read_counts(spark, path)


@query
def features_from_counts(spark, sf_dir):
    """Feature table from a stored count run and the session table."""
    path = storage.scratch_dir(spark, "count_runs")
    rows = events(spark, sf_dir)
    counts_tsv.write_counts(counts.action_counts(rows), path, "20240201_000000")
    pivot = counts.pivot_counts(counts_tsv.read_latest_run(spark, path))
    table = storage.stage(features.session_table(rows), "session_table")
    return features.join_features(pivot, features.features_of_sessions(table))


@query
def profile_of_one(spark, sf_dir):
    """Profile of user 10, looked up in the stored assignments."""
    assigned = rule_assignments(feature_rows(spark, sf_dir))
    path = storage.scratch_dir(spark, "assignments")
    storage.export_parquet(assigned.repartitionByRange("user_id").sortWithinPartitions("user_id"), path)
    return lookups.user_profile(storage.read_assignments(spark, path), "u_10")


@query
def user_action_pivot(spark, sf_dir):
    return counts.user_action_pivot(events(spark, sf_dir))


@query
def pivot_of_counts(spark, sf_dir):
    return counts.pivot_counts(counts.action_counts(events(spark, sf_dir)))


# Sessions.


@query
def session_features(spark, sf_dir):
    return sessions.session_features(events(spark, sf_dir)).drop("first_ts")


@query
def clean_session_features(spark, sf_dir):
    return sessions.session_features(events(spark, sf_dir), source="clean").drop("first_ts")


@query
def event_gaps(spark, sf_dir):
    return sessions.event_gaps(events(spark, sf_dir))


@query
def session_gaps(spark, sf_dir):
    return sessions.session_gaps(events(spark, sf_dir))


@query
def session_country(spark, sf_dir):
    return sessions.session_country(events(spark, sf_dir))


def _per_session(spark, sf_dir, column):
    rows = sessions.session_features(events(spark, sf_dir))
    return rows.where(F.col(column) > 0).select(*sessions.SESSION, column)


@query
def professional_searches(spark, sf_dir):
    return _per_session(spark, sf_dir, "n_professional_searches")


@query
def deep_clicks(spark, sf_dir):
    return _per_session(spark, sf_dir, "n_deep_clicks")


# Features.


@query
def feature_table(spark, sf_dir):
    return feature_rows(spark, sf_dir)


@query
def feature_table_joined(spark, sf_dir):
    rows = events(spark, sf_dir)
    return features.join_features(counts.user_action_pivot(rows), sessions.session_features(rows))


@query
def placed_features(spark, sf_dir):
    """Feature table from a pivot and session totals that are stored in buckets by user."""
    rows = storage.stage(features.session_table(events(spark, sf_dir)), "session_table")
    pivot = storage.stage_placed(features.pivot_of_sessions(rows), "pivot", "user_id", BUCKETS)
    totals = storage.stage_placed(features.session_totals(features.features_of_sessions(rows)), "totals", "user_id", BUCKETS)
    return features.join_totals(pivot, totals)


@query
def ratio_features(spark, sf_dir):
    return feature_rows(spark, sf_dir).select("user_id", "professional_ratio", "click_through_rate")


@query
def user_labels(spark, sf_dir):
    return feature_rows(spark, sf_dir).select("user_id", "label")


@query
def feature_partitions(spark, sf_dir):
    """Feature table written by day and read back."""
    path = storage.scratch_dir(spark, "feature_days")
    rows = feature_rows(spark, sf_dir)
    storage.export_parquet(rows, path, partition_by="dt", order_by="user_id")
    return features.rows_per_day(spark.read.schema(rows.schema).parquet(path))


@query
def feature_export(spark, sf_dir):
    return stored_features(spark, sf_dir)


@query
def orc_feature_table(spark, sf_dir):
    """Database, partitioned columnar table in it, read back by name; the catalog forgets both."""
    database = f"checks_{uuid.uuid4().hex}"
    storage.create_database(spark, database, storage.scratch_dir(spark, "database"))
    try:
        table = f"{database}.feature_table"
        storage.save_table(feature_rows(spark, sf_dir), table, partition_by="dt", order_by="user_id")
        return storage.stage(feature_job.read_features(spark, table), "orc_rows")
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


@query
def output_rows(spark, sf_dir):
    """What the counting job says that it wrote, and what is found in its run."""
    log, counted = storage.scratch_dir(spark, "raw_log"), storage.scratch_dir(spark, "counts")
    event_table.lines(spark, sf_dir).select("line").write.options(compression="gzip", maxRecordsPerFile=500_000).text(log)
    told = feature_job.count_actions(spark, log, counted)
    found = counts_tsv.read_latest_run(spark, counted)
    return found.agg(F.count("*").alias("rows_read"), F.countDistinct("user_id").alias("users")).select(
        F.lit(told["rows_written"]).cast("long").alias("rows_written"), "rows_read", "users",
    )


@query
def model_input(spark, sf_dir):
    return features.model_input(feature_rows(spark, sf_dir)).drop("dt")


@query
def label_distribution(spark, sf_dir):
    return features.label_distribution(features.model_input(feature_rows(spark, sf_dir)))


# Classification.


@query
def train_test_split(spark, sf_dir):
    rows = features.model_input(feature_rows(spark, sf_dir))
    return scaling.mark_training(rows).select("user_id", "is_train")


def _spread(rows: DataFrame, vector: str) -> DataFrame:
    values = vector_to_array(vector)
    return rows.select("user_id", *[values[i].alias(c) for i, c in enumerate(C.FEATURES)])


@query
def scaled_standard(spark, sf_dir):
    rows = stored_model_input(spark, sf_dir)
    return _spread(scaling.fit_standard(rows).transform(rows), "standard_features")


@query
def scaled_minmax(spark, sf_dir):
    """Range of the training users, applied to all."""
    rows = stored_model_input(spark, sf_dir)
    fitted = scaling.fit_minmax(scaling.split(rows)[0])
    return _spread(fitted.transform(rows), "minmax_features")


@query
def nb_parameters(spark, sf_dir):
    train, _ = scaling.split(stored_model_input(spark, sf_dir))
    return models.bayes_parameters(models.fit_naive_bayes(train))


@query
def nb_predictions(spark, sf_dir):
    train, test = scaling.split(stored_model_input(spark, sf_dir))
    return models.fit_naive_bayes(train).transform(test).select("user_id", "label", "nb_pred")


@query
def saved_model_predictions(spark, sf_dir):
    """Predictions of a model that was saved and loaded."""
    train, test = scaling.split(stored_model_input(spark, sf_dir))
    path = storage.scratch_dir(spark, "saved_model")
    storage.save_model(models.fit_naive_bayes(train), path)
    return PipelineModel.load(path).transform(test).select("user_id", "label", "nb_pred")


@query
def svm_predictions(spark, sf_dir):
    rows = stored_model_input(spark, sf_dir)
    fitted = classification_job.fit_one(rows, models.fit_linear_svm)
    return fitted.transform(scaling.split(rows)[1]).select("user_id", "label", "svm_pred")


@query
def mlp_predictions(spark, sf_dir):
    rows = stored_model_input(spark, sf_dir)
    fitted = classification_job.fit_one(rows, models.fit_perceptron)
    return fitted.transform(scaling.split(rows)[1]).select("user_id", "label", "mlp_pred")


@query
def ensemble_predictions(spark, sf_dir):
    rows = stored_model_input(spark, sf_dir)
    return models.predictions(classification_job.fit_on(rows), scaling.split(rows)[1])


@query
def trained_metrics(spark, sf_dir):
    rows = stored_model_input(spark, sf_dir)
    scored = models.predictions(classification_job.fit_on(rows), scaling.split(rows)[1])
    return evaluation.classification_metrics(scored)


@query
def vote_audit(spark, sf_dir):
    """Of each test user, whether the fitted vote is the majority of its three columns; of the training users, whether
    each fitted model is right more often than the larger class is large."""
    rows = stored_model_input(spark, sf_dir)
    train, test = scaling.split(rows)
    fitted = classification_job.fit_on(rows)
    columns = list(fitted.models)
    on_train = models.predictions(fitted, train)
    right = on_train.agg(*[F.avg((F.col(c) == F.col("label")).cast("double")).alias(c) for c in columns]).first()
    floor = train.agg(F.greatest(F.avg("label"), 1 - F.avg("label"))).first()[0]
    ones = sum((F.col(c) for c in columns[1:]), F.col(columns[0]))
    return models.predictions(fitted, test).select(
        "user_id", "label", (F.col(C.ENSEMBLE_COLUMN) == F.when(ones >= 2, 1.0).otherwise(0.0)).alias("is_majority"),
        F.lit(floor).alias("floor"), *[F.lit(right[c] >= floor).alias(f"{c}_above_floor") for c in columns],
    )


@query
def svm_audit(spark, sf_dir):
    """Of each test user, whether the prediction is the sign of the fitted margin; of the fit, whether its objective is
    below that of no weights, which is 1, and can't be lowered by scaling the weights."""
    rows = stored_model_input(spark, sf_dir)
    train, test = scaling.split(rows)
    model = classification_job.fit_one(rows, models.fit_linear_svm)
    svm = model.stages[-1]
    weights, bias = [float(w) for w in svm.coefficients], float(svm.intercept)
    raw = F.aggregate(
        F.zip_with(vector_to_array("standard_features"), F.array(*[F.lit(w) for w in weights]), lambda x, w: x * w),
        F.lit(bias), lambda a, b: a + b,
    )
    scored = model.transform(train).select(((2 * F.col("label") - 1) * raw).alias("margin"))
    # The penalty is on the weights of the scaled features.
    penalty = models.linear_svm().getRegParam() / 2 * sum(w * w for w in weights)
    loss = [(F.avg(F.greatest(1 - F.col("margin") * k, F.lit(0.0))) + penalty * k * k) for k in (1.0, 0.9, 1.1)]
    own, lower, higher = scored.agg(*loss).first()
    return model.transform(test).select(
        "user_id", "label", ((raw > 0).cast("double") == F.col("svm_pred")).alias("is_sign_of_margin"),
        F.lit(own < 1).alias("beats_no_weights"), F.lit(own <= min(lower, higher) + 1e-3).alias("scale_is_best"),
    )


@query
def ensemble_vote(spark, sf_dir):
    voted = rule_predictions(feature_rows(spark, sf_dir))
    return voted.select("user_id", *RULE_VOTERS, C.ENSEMBLE_COLUMN)


@query
def combine_predictions(spark, sf_dir):
    """Predictions scored apart from each other, joined to the test users."""
    rows = stored_model_input(spark, sf_dir)
    scored = {c: rows.select("user_id", F.expr(rule).cast("double").alias(c)) for c, rule in RULE_VOTERS.items()}
    test = scaling.split(rows)[1].select("user_id", "label")
    return models.vote(models.combine_predictions(test, scored), list(scored))


@query
def confusion_counts(spark, sf_dir):
    voted = rule_predictions(features.model_input(feature_rows(spark, sf_dir)))
    return evaluation.confusion(voted, evaluation.VOTE_NAMES)


@query
def classification_metrics(spark, sf_dir):
    voted = rule_predictions(features.model_input(feature_rows(spark, sf_dir)))
    return evaluation.classification_metrics(voted)


# Segmentation.


@query
def cluster_assignments(spark, sf_dir):
    rows = features.model_input(stored_features(spark, sf_dir), labelled=False)
    return segmentation_job.fit_on(rows).assignments(rows)


@query
def cluster_metadata(spark, sf_dir):
    rows = features.model_input(stored_features(spark, sf_dir), labelled=False)
    return segmentation.cluster_metadata(segmentation_job.fit_on(rows), rows)


@query
def repeatable_assignments(spark, sf_dir):
    """Clusters without a random start, which SQL finds anew."""
    rows = features.model_input(stored_features(spark, sf_dir), labelled=False)
    placed = segmentation_job.fit_on(rows, repeatable=True).assignments(rows)
    return placed.select("user_id", "cluster", "label", "professional_ratio", "total_actions", "total_sessions")


@query
def repeatable_metadata(spark, sf_dir):
    """Records of these clusters, one row per feature of a centre."""
    rows = features.model_input(stored_features(spark, sf_dir), labelled=False)
    records = segmentation.cluster_metadata(segmentation_job.fit_on(rows, repeatable=True), rows, training_cost=True)
    named = F.arrays_zip(F.array(*[F.lit(c) for c in C.FEATURES]).alias("feature"), F.col("centroid").alias("centre"))
    return records.select(
        "cluster_id", "archetype", "user_count", F.inline(named).alias("feature", "centre"), "silhouette",
        F.round("training_cost", 4).alias("training_cost"),
    )


@query
def cluster_audit(spark, sf_dir):
    """Fitted clusters add up: users, and squared distances within and between clusters to the total; the model's own
    cost and centres are those of the assignment."""
    rows = features.model_input(stored_features(spark, sf_dir), labelled=False)
    fitted = segmentation_job.fit_on(rows)
    placed = storage.stage(fitted.model.transform(rows).select("cluster", vector_to_array("standard_features").alias("z")), "placed")
    each = placed.select("cluster", F.posexplode("z").alias("i", "x")).groupBy("cluster", "i").agg(
        F.count("*").alias("n"), F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"),
    )
    within = F.sum(F.col("q") - F.col("s") * F.col("s") / F.col("n"))
    between = F.sum(F.col("s") * F.col("s") / F.col("n"))
    found = each.agg(within.alias("within"), between.alias("between"), F.countDistinct("cluster").alias("used")).first()
    means = {(r.cluster, r.i): r.s / r.n for r in each.collect()}  # clusters times features
    centres = all(abs(means[c, i] - v) < 1e-6 for c, centre in enumerate(fitted.centers) for i, v in enumerate(centre) if (c, i) in means)
    cost = float(fitted.clusters.summary.trainingCost)
    return placed.agg(F.count("*").alias("users")).select(
        "users", F.lit(found.within + found.between).alias("total"), F.lit(found.used <= C.CLUSTERS).alias("few_clusters"),
        F.lit(centres).alias("centres_are_means"), F.lit(abs(cost - found.within) < 1e-6 * max(cost, 1)).alias("cost_is_within"),
    )


@query
def pca_variance(spark, sf_dir):
    rows = features.model_input(stored_features(spark, sf_dir), labelled=False)
    return segmentation.explained_variance(segmentation.fit_projection(rows).stages[-1])


@query
def silhouette(spark, sf_dir):
    rows = stored_model_input(spark, sf_dir)
    scaled = rule_clusters(scaling.fit_standard(rows).transform(rows))
    score = evaluation.silhouette(scaled)
    return spark.createDataFrame([(score,)], "silhouette double")


@query
def cluster_sizes(spark, sf_dir):
    return segmentation.cluster_sizes(rule_clusters(feature_rows(spark, sf_dir)))


@query
def cluster_records(spark, sf_dir):
    """Centres of the rule clusters with their sizes, and one centre nobody belongs to."""
    clustered = rule_clusters(stored_features(spark, sf_dir))
    centers = clustered.groupBy(F.col("cluster").alias("cluster_id")).agg(
        F.array(F.avg("total_actions"), F.avg("total_sessions")).alias("centroid")
    )
    members = clustered.where("cluster <> 6")
    return segmentation.describe_clusters(centers, segmentation.cluster_sizes(members), 0.5).select(
        "cluster_id", "archetype", "user_count",
        F.col("centroid")[0].alias("mean_actions"), F.col("centroid")[1].alias("mean_sessions"), "silhouette",
    )


@query
def archetype_lookup(spark, sf_dir):
    named = segmentation.name_clusters(rule_clusters(feature_rows(spark, sf_dir)))
    return named.select("user_id", "cluster", "archetype")


@query
def coordinates_join(spark, sf_dir):
    """Users without a complete feature vector have no coordinates but keep their row."""
    rows = stored_features(spark, sf_dir)
    placed = rule_assignments(features.model_input(rows)).select("user_id", "pca_x", "pca_y")
    return segmentation.attach_coordinates(rule_clusters(rows).select("user_id", "cluster"), placed)


# Lookups.


@query
def metrics_report(spark, sf_dir):
    """Metrics written as a report and read back in long form."""
    path = storage.scratch_dir(spark, "metrics")
    voted = rule_predictions(features.model_input(feature_rows(spark, sf_dir)))
    storage.write_records(evaluation.classification_metrics(voted), path)
    return lookups.metrics_long(storage.read_metrics(spark, path))


@query
def cluster_points(spark, sf_dir):
    stored = storage.stage(rule_assignments(feature_rows(spark, sf_dir)), "assignments")
    return lookups.cluster_points(stored)


@query
def cluster_extents(spark, sf_dir):
    return lookups.cluster_extents(rule_assignments(feature_rows(spark, sf_dir)))


@query
def user_profile(spark, sf_dir):
    """Profiles in bulk, for every user id of the log."""
    assigned = rule_assignments(feature_rows(spark, sf_dir))
    return lookups.bulk_profiles(assigned, events(spark, sf_dir))


@query
def placed_profiles(spark, sf_dir):
    """Profiles in bulk of the users with a vote, from assignments and predictions in buckets by user."""
    rows = storage.stage(feature_rows(spark, sf_dir), "feature_table")
    assigned = storage.stage_placed(rule_assignments(rows), "assignments", "user_id", BUCKETS)
    voted = storage.stage_placed(rule_predictions(scaling.split(features.model_input(rows))[1]), "predictions", "user_id", BUCKETS)
    return lookups.bulk_profiles(assigned, voted)


@query
def pipeline_telemetry(spark, sf_dir):
    return telemetry.pipeline_telemetry(events(spark, sf_dir))

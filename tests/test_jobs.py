"""Whole runs from text to lookups."""

import json

import pytest
from conftest import record
from pyspark.sql import functions as F

from clickloom import __main__, schemas
from clickloom.operators import features, lookups, telemetry
from clickloom.plans import classification_job, feature_job, segmentation_job
from clickloom.sources import counts_tsv, event_table, raw_log, storage

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log") / "clickstream")
    event_table.lines(spark, SF).select("line").repartition(3).write.option("compression", "gzip").text(path)
    return path


@pytest.fixture(scope="module")
def built(spark, log, tmp_path_factory):
    base = tmp_path_factory.mktemp("features")
    counters = feature_job.build_features(spark, log, "run_one", str(base / "export"), str(base / "db"))
    return counters, str(base / "export")


def _same(a, b):
    """Equal as multisets, doubles to 9 places."""
    a, b = (df.withColumns({c: F.round(c, 9) for c, t in df.dtypes if t == "double"}) for df in (a, b.select(*a.columns)))
    return a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def _ranges(spark, path, user):
    """For each file whose id range holds the user, that it does."""
    ends = spark.read.parquet(path).groupBy(F.input_file_name().alias("file")).agg(F.min("user_id").alias("a"), F.max("user_id").alias("b"))
    return [True for r in ends.collect() if r.a <= user <= r.b]


def test_count_job(spark, log, tmp_path):
    report = feature_job.count_actions(spark, log, str(tmp_path))
    written = counts_tsv.read_latest_run(spark, str(tmp_path))
    assert report["records_in"] == 10_000 and report["records_corrupt"] == 100
    assert report["rows_written"] == written.count()
    assert report["records_emitted"] == written.where("action = '__total__'").agg(F.sum("cnt")).first()[0]
    # Another run of the same log becomes the latest and changes nothing.
    second = feature_job.count_actions(spark, log, str(tmp_path))
    assert second["run_id"] > report["run_id"]
    assert _same(counts_tsv.read_latest_run(spark, str(tmp_path)), written)


def test_tables_equal_features_of_the_events(spark, built):
    counters, export = built
    expected = features.feature_table(event_table.events(spark, SF))
    assert counters["records_in"] == 10_000
    assert _same(expected, spark.table("run_one.feature_table"))
    assert _same(expected, spark.read.parquet(export))


def test_stored_columns(spark, built):
    assert spark.table("run_one.session_features").columns == [
        "user_id", "session_id", "session_start", "session_end", "session_events", "avg_inter_event_sec",
        "session_duration_min", "n_professional_searches", "n_deep_clicks", "country", "first_ts",
    ]


def test_session_table_takes_one_scan_and_one_shuffle(spark, log):
    events = raw_log.read_events(spark, log, record=schemas.FEATURE_RECORD)
    plan = features.session_table(events)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan text") == 1


def test_telemetry_of_the_log_equals_the_stored_tables(spark, log, built):
    row = telemetry.pipeline_telemetry(raw_log.read_events(spark, log)).first()
    table = spark.table("run_one.feature_table")
    assert row.raw_records == built[0]["records_in"] and row.cleaned_records == built[0]["records_emitted"]
    assert row.total_users == table.count() and row.model_rows == features.model_input(table).count()
    assert row.sessions == spark.table("run_one.session_features").count()


def test_features_from_a_count_run(spark, log, built, tmp_path):
    """The pivot of the counting job's files gives the same feature table as the log."""
    feature_job.count_actions(spark, log, str(tmp_path / "counts"), "20240101_000000")
    feature_job.build_features(
        spark, log, "run_counts", str(tmp_path / "export"), str(tmp_path / "db"), counts_path=str(tmp_path / "counts"),
    )
    assert _same(spark.table("run_one.feature_table"), spark.table("run_counts.feature_table"))


def test_mixed_and_unreadable_times_give_one_first_day(spark):
    lines = [json.dumps(record(timestamp=t, user_id=u, session_id=s)) for u, s, t in [
        ("u_1", "s_1", "2024-03-01T10:00:00"), ("u_1", "s_1", "01/03/2024"), ("u_1", "s_2", "2024-03-01T23:30:00-05:00"),
        ("u_2", "s_3", "never"), ("u_2", "s_3", "2024-04-02 08:00:00"), ("u_3", "s_4", "2024-05-01T00:10:00+02:00"),
    ]]
    events = raw_log.type_events(spark.createDataFrame([(x,) for x in lines], "line string"))
    table = features.session_table(events)
    joined = features.join_features(features.pivot_of_sessions(table), features.features_of_sessions(table))
    assert _same(features.feature_table(events), joined)
    assert {r.user_id: r.dt for r in joined.collect()} == {"u_1": "2024-03-01", "u_2": "2024-04-02", "u_3": "2024-04-30"}


def test_commands(spark, log, built, tmp_path, capsys):
    out, counts = str(tmp_path / "out"), str(tmp_path / "counts")
    storage.export_parquet(spark.createDataFrame([("u_10", 1, 0.5, 0.5, 1, 0.25, 4, 2)], schemas.ASSIGNMENTS), f"{out}/cluster_assignments")
    storage.write_records(spark.createDataFrame([("NaiveBayes", 0.9, 0.9, 0.9, 0.9)], schemas.METRICS), f"{out}/metrics")
    for command, shown in [
        (["count", log, counts, "--run-id", "7", "--min-dwell-ms", "0"], "'run_id': '7'"), (["telemetry", log], "raw_records"),
        (["report", out], "weightedRecall"), (["points", out, "--limit", "1"], "u_10"), (["profile", out, "u_10"], "high-value"),
    ]:
        __main__.main(command)
        assert shown in capsys.readouterr().out
    assert (tmp_path / "counts" / "run_id=7" / "_SUCCESS").exists()
    with pytest.raises(SystemExit):
        __main__.main(["features", log, "db", "out", "--session-source", "other"])


def test_scratch_is_deleted(spark):
    path = storage.scratch_dir(spark, "gone")
    storage.export_parquet(spark.range(3), path)
    storage.delete_scratch(spark)
    assert not storage.subdirectories(spark, path.rpartition("/")[0]).get(path.rpartition("/")[2], False)


def test_rerun_replaces_every_table(spark, log, built, tmp_path):
    before = spark.table("run_one.feature_table").toPandas()
    feature_job.build_features(spark, log, "run_one", str(tmp_path / "export"))
    spark.catalog.refreshTable("run_one.feature_table")
    assert len(spark.table("run_one.feature_table").toPandas()) == len(before)
    assert _same(spark.createDataFrame(before), spark.table("run_one.feature_table"))


def test_days_prune_partitions(spark, built, capsys):
    table = spark.table("run_one.feature_table")
    first = table.agg(F.min("dt")).first()[0]
    part = feature_job.read_features(spark, "run_one.feature_table", first, first)
    assert 0 < part.count() == table.where(F.col("dt") == first).count() < table.count()
    part.explain()
    plan = capsys.readouterr().out
    filters = plan[plan.index("PartitionFilters: ["):]
    assert first in filters[: filters.index("]")]


def test_clean_sessions(spark, log, tmp_path):
    feature_job.build_features(
        spark, log, "run_clean", str(tmp_path / "export"), str(tmp_path / "db"), session_source="clean"
    )
    expected = features.feature_table(event_table.events(spark, SF), source="clean")
    assert _same(expected, spark.table("run_clean.feature_table"))


def test_models_segments_and_lookups(spark, built, tmp_path):
    out = str(tmp_path)
    metrics = classification_job.classify(spark, "run_one.feature_table", out)
    assert {r.model for r in metrics.collect()} == {"NaiveBayes", "LinearSVM", "MLP-NN", "Ensemble-Vote"}
    assigned = segmentation_job.segment(spark, "run_one.feature_table", out, training_cost=True)
    records = storage.read_cluster_metadata(spark, f"{out}/cluster_metadata")
    assert records.agg(F.sum("user_count")).first()[0] == assigned.count()
    assert lookups.cluster_points(assigned, 10).count() == 10
    scored = spark.read.parquet(f"{out}/predictions")
    user = scored.first().user_id
    assert [f for f in _ranges(spark, f"{out}/cluster_assignments", user)] == [True]
    assert lookups.user_profile(assigned, user, scored).first().ensemble_prediction in (0.0, 1.0)

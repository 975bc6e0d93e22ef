"""Tables in buckets by user: no shuffle in what is done by user over them."""

import pytest
from pyspark.sql import functions as F

from clickloom.operators import features, lookups, models, scaling
from clickloom.plans import feature_job
from clickloom.sources import event_table, storage

SF = "/root/testdata/sf0.01"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def rows(spark):
    return storage.stage(features.session_table(event_table.events(spark, SF)), "session_table")


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def same(a, b):
    a, b = (df.withColumns({c: F.round(c, 9) for c, t in df.dtypes if t == "double"}) for df in (a, b.select(*a.columns)))
    return a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_feature_table_from_placed_tables(spark, rows, no_broadcast):
    pivot = storage.stage_placed(features.pivot_of_sessions(rows), "pivot", "user_id", 4)
    totals = storage.stage_placed(features.session_totals(features.features_of_sessions(rows)), "totals", "user_id", 4)
    joined = features.join_totals(pivot, totals)
    assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
    assert same(joined, features.feature_table(event_table.events(spark, SF)))


def test_profiles_from_placed_tables(spark, rows, no_broadcast):
    table = features.feature_table(event_table.events(spark, SF))
    assigned = table.select("user_id", (F.length("user_id") % 3).alias("cluster"), "label", "professional_ratio", "total_actions")
    voted = scaling.split(features.model_input(table))[1].select("user_id", F.lit(1.0).alias("nb_pred"))
    placed = [storage.stage_placed(df, "t", "user_id", 4) for df in (assigned, models.vote(voted, ["nb_pred"]))]
    found = lookups.bulk_profiles(*placed)
    assert "Exchange" not in plan(found)
    assert same(found, lookups.bulk_profiles(assigned, voted))


def test_a_lookup_reads_one_bucket(spark, rows):
    pivot = storage.stage_placed(features.pivot_of_sessions(rows), "pivot", "user_id", 4)
    one = pivot.where("user_id = 'u_10'")
    assert one.count() == 1
    # The scan names its buckets only where it reads them one by one.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        assert "SelectedBucketsCount: 1 out of 4" in plan(pivot.where("user_id = 'u_10'"))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert len({r[0] for r in pivot.select(F.input_file_name()).distinct().collect()}) == 4


def test_feature_job_with_placed_tables(spark, tmp_path):
    log = str(tmp_path / "log")
    event_table.lines(spark, SF).select("line").write.text(log)
    feature_job.build_features(spark, log, "placed_run", str(tmp_path / "export"), str(tmp_path / "db"), user_buckets=3)
    assert same(features.feature_table(event_table.events(spark, SF)), spark.table("placed_run.feature_table"))
    totals = sorted(map(str, spark.table("placed_run.session_totals").collect()))
    assert len({t.split(",")[0] for t in totals}) == len(totals)
    feature_job.build_features(spark, log, "placed_run", str(tmp_path / "export"), str(tmp_path / "db"), user_buckets=3)
    assert sorted(map(str, spark.table("placed_run.session_totals").collect())) == totals

"""Shape of the physical plans: shuffles, scans, aggregates."""

import json
import re

import pytest
from conftest import record
from pyspark.sql import functions as F

from checks.registry import QUERIES
from clickloom import schemas
from clickloom.operators import counts, features, sessions, telemetry
from clickloom.sources import event_table, raw_log


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df) -> int:
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


@pytest.fixture()
def events(spark, small):
    return event_table.events(spark, small)


@pytest.mark.parametrize("build, expected", [
    (counts.action_counts, 1),
    (counts.user_action_pivot, 1),
    (sessions.session_features, 1),
    (sessions.session_country, 1),
    (features.feature_table, 2),
    (telemetry.pipeline_telemetry, 2),
])
def test_shuffles(events, build, expected):
    assert shuffles(build(events)) == expected


@pytest.mark.parametrize("build", [counts.action_counts, sessions.session_features, features.feature_table])
def test_rows_are_reduced_before_the_first_shuffle(events, build):
    text = plan(build(events))
    below = text[text.rindex("Exchange hashpartitioning"):]
    assert "partial_" in below


def test_a_session_of_a_year_is_many_tasks(spark):
    """The window over seconds sees a slab of a session; the one over sessions sees a row per slab."""
    hours = spark.range(365 * 24).select(
        F.substring(F.concat(F.lit("u"), "id"), 1, 1).alias("user_id"), F.substring(F.concat(F.lit("s"), "id"), 1, 1).alias("session_id"),
        F.timestamp_seconds(F.col("id") * 3600).alias("ts"),
    )
    found = sessions.event_gaps(hours)
    text = plan(found)
    assert re.search(r"Window \[lag\(second[^\n]*\[user_id[^\n]*session_id[^\n]*slab[^\n]*\], \[second", text)
    assert found.where("gap_sec = 3600").count() == 365 * 24 - 1
    slabs = found.select(F.floor(F.col("second") / sessions.SLAB_SECONDS).alias("slab"))
    assert slabs.groupBy("slab").count().agg(F.max("count")).first()[0] == 24


def test_features_use_hash_aggregates_only(events):
    text = plan(features.feature_table(events))
    assert "SortAggregate" not in text and "Sort [" not in text and "Join" not in text


def test_no_cross_joins_or_python_in_the_queries(spark, small):
    fits = ("svm", "mlp", "ensemble_predictions", "trained", "cluster_assign", "cluster_meta", "pca_", "nb_")
    for name, build in QUERIES.items():
        if not name.startswith(fits):
            text = plan(build(spark, small))
            assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
            assert "PythonUDF" not in text and "InPandas" not in text and "BatchEvalPython" not in text, name


def test_scans_read_needed_columns_only(events):
    scanned = re.search(r"ReadSchema: struct<(.*?)>", plan(counts.action_counts(events))).group(1)
    assert "ts:" not in scanned


def test_hot_session_matches_brute_force(spark, small):
    """A third of all events in one session of one user."""
    hot = F.col("event_id") % 3 == 0
    events = event_table.events(spark, small).withColumns({
        "user_id": F.when(hot, F.lit("u_hot")).otherwise(F.col("user_id")),
        "session_id": F.when(hot, F.lit("s_hot")).otherwise(F.col("session_id")),
    })
    rows = sorted(events.where("session_id = 's_hot'").collect(), key=lambda r: (r.ts, r.event_order))
    found = sessions.session_features(events).where("session_id = 's_hot'").first()
    times = [int(r.ts.timestamp()) for r in rows]
    gaps = [b - a for a, b in zip(times, times[1:])]
    assert (found.session_events, found.country) == (len(rows), rows[0].client.country)
    assert found.avg_inter_event_sec == pytest.approx(sum(gaps) / len(gaps))
    user = features.feature_table(events).where("user_id = 'u_hot'").first()
    assert user.total_actions == sum(r.status == "emitted" for r in rows) and user.total_sessions == 1


def test_a_filter_on_status_does_not_parse_again(typed):
    """One parse and its repair and one record of the line, and the same for either way of cutting up an odd line, however
    many record fields the filter looks at."""
    text = plan(counts.action_counts(typed(record())))
    assert text.count("parseJson") == 6 and text.count("StructField(timestamp,") == 3


@pytest.mark.parametrize("build, read, spared", [
    (counts.action_counts, schemas.COUNT_RECORD, ["timestamp", "query", "url", "content_snippet", "referrer", "ip", "country"]),
    (features.session_table, schemas.FEATURE_RECORD, ["url", "content_snippet", "referrer", "meta", "ip", "schema_version"]),
])
def test_a_job_extracts_its_fields_only(spark, build, read, spared):
    lines = spark.createDataFrame([(json.dumps(record()),)], "line string")
    text = plan(build(raw_log.type_events(lines, record=read)))
    assert not [f for f in spared if f"StructField({f}," in text]

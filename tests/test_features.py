import pytest
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom.functions import rules
from clickloom.operators import counts, features, sessions
from clickloom.sources import event_table

# Near the label rule, with mean session minutes of the user's sessions.
PIVOT = "user_id string, " + ", ".join(f"n_{a} long" for a in C.PIVOT_ACTIONS) + ", total_actions long"
SESSION = (
    "user_id string, session_id string, session_start string, session_events long, avg_inter_event_sec double,"
    " session_duration_min double, n_professional_searches long, n_deep_clicks long"
)


def _joined(spark, pivot, session_rows):
    rows = spark.createDataFrame(session_rows, SESSION).withColumn("first_ts", F.try_to_timestamp("session_start"))
    return features.join_features(spark.createDataFrame(pivot, PIVOT), rows)


@pytest.mark.parametrize("searches, messages, minutes, label", [
    (3, 1, 10.0, 1), (2, 1, 10.0, 0), (3, 0, 10.0, 0), (3, 1, 9.983333333333333, 0), (9, 4, 60.0, 1),
])
def test_label_boundaries(spark, searches, messages, minutes, label):
    pivot = [("u", 5, 0, 0, messages, 0, 0, 0, 0, 0, 10)]
    row = _joined(spark, pivot, [("u", "s", "2024-01-01T00:00:00", 4, 1.0, minutes, searches, 0)]).first()
    assert row.label == label


def test_mean_of_thirds_reaches_the_limit(spark):
    """Sessions of 20, 1000 and 780 seconds last 10 minutes on average; thirds must not lose the label."""
    pivot = [("u", 5, 0, 0, 1, 0, 0, 0, 0, 0, 10)]
    rows = [("u", f"s{s}", "2024-01-01T00:00:00", 2, 1.0, s / 60, 3, 0) for s in (20, 1000, 780)]
    assert _joined(spark, pivot, rows).first().label == 1


def test_ratios_and_their_guards(spark):
    pivot = [
        ("a", 4, 6, 0, 0, 0, 0, 0, 0, 0, 10),
        ("b", 0, 6, 0, 0, 0, 0, 0, 0, 0, 0),
    ]
    rows = [(u, "s", "2024-01-01T00:00:00", 4, 1.0, 1.0, 5, 2) for u in "ab"]
    found = {r.user_id: r for r in _joined(spark, pivot, rows).collect()}
    assert (found["a"].professional_ratio, found["a"].click_through_rate) == (0.5, 1.5)
    assert (found["b"].professional_ratio, found["b"].click_through_rate) == (0.0, 0.0)


def test_users_need_counts_and_sessions(spark):
    pivot = [(u, *[1] * 10) for u in ("both", "no_session")]
    rows = [(u, "s", "2024-01-02T00:00:00", 1, None, 0.0, 0, 0) for u in ("both", "no_counts")]
    row = _joined(spark, pivot, rows).collect()
    assert [r.user_id for r in row] == ["both"] and row[0].dt == "2024-01-02"


def test_one_pass_equals_join(spark, small):
    events = event_table.events(spark, small)

    def rows(df):
        doubles = [c for c, t in df.dtypes if t == "double"]
        return df.withColumns({c: F.round(c, 9) for c in doubles})

    for source in ("raw", "clean"):
        once = rows(features.feature_table(events, source))
        joined = rows(features.join_features(
            counts.user_action_pivot(events), sessions.session_features(events, source)
        ))
        assert once.columns == joined.columns == features.COLUMNS
        assert once.exceptAll(joined).count() == joined.exceptAll(once).count() == 0
        assert once.count() > 0


def test_features_do_not_depend_on_partitioning(spark, small):
    events = event_table.events(spark, small)
    base = features.feature_table(events).drop("avg_inter_event_sec")
    for n in (1, 7):
        other = features.feature_table(events.repartition(n)).drop("avg_inter_event_sec")
        assert base.exceptAll(other).count() == other.exceptAll(base).count() == 0


def test_types(spark, small):
    types = dict(features.feature_table(event_table.events(spark, small)).dtypes)
    doubles = {c for c, t in types.items() if t == "double"}
    assert doubles == {
        "avg_session_duration_min", "avg_events_per_session", "avg_inter_event_sec", "professional_ratio",
        "click_through_rate",
    }
    assert (types["label"], types["dt"], types["user_id"]) == ("int", "string", "string")
    assert all(types[c] == "bigint" for c in C.FEATURES if c not in doubles)


def test_model_input_drops_incomplete_rows(spark, small):
    rows = features.feature_table(event_table.events(spark, small))
    holed = rows.withColumn("avg_inter_event_sec", F.when(F.col("user_id") != "u_1", F.col("avg_inter_event_sec")))
    assert holed.where("user_id = 'u_1'").count() == 1
    assert features.model_input(holed).where("user_id = 'u_1'").count() == 0
    assert dict(features.model_input(holed).dtypes)["label"] == "double"
    assert dict(features.model_input(holed, labelled=False).dtypes)["label"] == "int"


def test_split_is_about_four_fifths_and_stable(spark):
    users = spark.range(20_000).select(F.concat(F.lit("u_"), "id").alias("user_id"))
    train = users.where(rules.in_training_set(F.col("user_id")))
    again = users.repartition(9).where(rules.in_training_set(F.col("user_id")))
    assert abs(train.count() / 20_000 - 0.8) < 0.01
    assert train.exceptAll(again).count() == 0

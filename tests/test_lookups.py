import json

import pytest

from clickloom.operators import lookups
from clickloom.sources import storage

ASSIGNED = (
    "user_id string, cluster int, pca_x double, pca_y double, label int, professional_ratio double,"
    " total_actions long, total_sessions long"
)


@pytest.fixture(scope="module")
def assigned(spark):
    rows = [
        ("u_2", 1, 1.0, -2.0, 1, 0.123456, 10, 2),
        ("u_1", 0, 0.0, 3.0, 0, 0.5, 4, 1),
        ("u_3", 9, 2.0, 0.0, 5, 0.0, 7, 1),
    ]
    return spark.createDataFrame(rows, ASSIGNED)


def test_points_are_limited_and_ordered(assigned):
    found = lookups.cluster_points(assigned, 2).collect()
    assert [(r.user_id, r.archetype) for r in found] == [("u_1", "Power Networkers"), ("u_2", "Passive Browsers")]
    assert lookups.cluster_points(assigned).count() == 3


@pytest.mark.parametrize("limit", [0, -1, 50_001])
def test_limit_is_checked(assigned, limit):
    with pytest.raises(ValueError):
        lookups.cluster_points(assigned, limit)


def test_extents(assigned):
    row = lookups.cluster_extents(assigned).first()
    assert tuple(row) == pytest.approx((-0.1, 2.1, -2.25, 3.25))


def test_profile(assigned):
    assert lookups.user_profile(assigned, "u_2").first().asDict() == {
        "user_id": "u_2", "label": 1, "label_name": "high-value", "cluster": 1, "archetype": "Passive Browsers",
        "professional_ratio": 0.1235, "total_actions": 10,
    }
    assert lookups.user_profile(assigned, "u_3").first().label_name == "unknown"
    assert lookups.user_profile(assigned, "u_999").count() == 0


@pytest.mark.parametrize("user_id", ["", "u1", "x" * 65, "u 1", "u_1;", "ü_12", "u_1\n"])
def test_ids_are_checked(assigned, user_id):
    with pytest.raises(ValueError):
        lookups.user_profile(assigned, user_id)


def test_missing_values_get_defaults(spark):
    row = spark.createDataFrame([("u_1", None, None, None, None, None, None, None)], ASSIGNED)
    found = lookups.user_profile(row, "u_1").first()
    assert tuple(found) == ("u_1", 0, "low-value", 0, "Power Networkers", 0.0, 0)


def test_profile_with_vote(spark, assigned):
    votes = spark.createDataFrame([("u_2", 1.0)], "user_id string, ensemble_prediction double")
    assert lookups.user_profile(assigned, "u_2", votes).first().ensemble_prediction == 1.0
    assert lookups.user_profile(assigned, "u_1", votes).first().ensemble_prediction is None


def test_bulk_profiles_ignore_repeats_and_unknown_ids(spark, assigned):
    ids = spark.createDataFrame([("u_1",), ("u_1",), ("u_9",), (None,)], "user_id string")
    assert [r.user_id for r in lookups.bulk_profiles(assigned, ids).collect()] == ["u_1"]


def test_id_test_reaches_the_scan(spark, assigned, tmp_path, capsys):
    storage.export_parquet(assigned, str(tmp_path / "a"))
    lookups.user_profile(spark.read.parquet(str(tmp_path / "a")), "u_2").explain()
    assert "EqualTo(user_id,u_2)" in capsys.readouterr().out


RECORD = {"cluster_id": 1, "archetype": "A", "user_count": 3, "centroid": [0.5], "silhouette": 0.25}


@pytest.mark.parametrize("document, text", [
    (False, json.dumps(RECORD) + "\n" + json.dumps(RECORD)),
    (True, json.dumps([RECORD, RECORD], indent=2)),
    (True, json.dumps({"clusters": [RECORD, RECORD]}, indent=2)),
])
def test_cluster_record_forms(spark, tmp_path, document, text):
    (tmp_path / "meta.json").write_text(text)
    found = storage.read_cluster_metadata(spark, str(tmp_path), document).collect()
    assert [r.asDict() for r in found] == [RECORD, RECORD]


@pytest.mark.parametrize("document", [False, True])
def test_metric_record_forms(spark, tmp_path, document):
    records = [{"model": m, "accuracy": 0.5, "weightedPrecision": 0.25, "weightedRecall": 0.75, "f1": 1.0} for m in "ab"]
    text = json.dumps(records, indent=2) if document else "\n".join(map(json.dumps, records))
    (tmp_path / "metrics.json").write_text(text)
    found = lookups.metrics_long(storage.read_metrics(spark, str(tmp_path), document))
    assert found.count() == 8 and found.where("model = 'b' and metric = 'f1'").first().value == 1.0

import gzip
import json

import pytest
from conftest import record, statuses

from clickloom.operators import cleaning
from clickloom.sources import raw_log

GOOD = json.dumps(record())


@pytest.mark.parametrize("line, expected", [
    (GOOD, "emitted"),
    (GOOD + ",", "emitted"),
    (GOOD + " ,, ", "emitted"),
    (GOOD[:-1], "emitted"),
    (GOOD[:-1] + ",", "emitted"),
    (GOOD + GOOD, "emitted"),
    ("\t " + GOOD + "\r", "emitted"),
    (GOOD[:-20], "corrupt"),
    ('{"user_id": "u_1", "payload": {"query": "x"}', "corrupt"),
    ("7", "corrupt"),
    ("[1]", "corrupt"),
    ("null", "corrupt"),
    ('"text"', "corrupt"),
    ("}{bad", "corrupt"),
    ('{"raw": "}{x"}', "corrupt"),
    ('{"_corrupt": true, "raw": "}{x"}', "corrupt"),
    ("{}", "invalid"),
    ("", "blank"),
    (" \t ", "blank"),
    ('{"user_id": "u_0", ' + GOOD[1:], "emitted"),
])
def test_line_disposition(typed, line, expected):
    assert statuses(typed(line)) == [expected]


def test_repeated_field_keeps_the_last_value(typed):
    row = typed('{"user_id": "u_0", ' + GOOD[1:]).first()
    assert row.user_id == "u_1"


BOT = json.dumps(record(user_id="u_bot", is_bot_flag=True))
INVALID = json.dumps(record(user_id="u_bad", action="dance"))


@pytest.mark.parametrize("line, user", [
    ("abc " + GOOD, "u_1"),
    ("2024-03-01 INFO {} " + GOOD, "u_1"),
    ("}{" + GOOD, "u_1"),
    ("\ufeff" + GOOD, "u_1"),
    (BOT + GOOD, "u_1"),
    (INVALID + ", " + GOOD + " x", "u_1"),
    ('{bad "x} ' + GOOD, "u_1"),
    ('{"raw": "}{"}' + GOOD, "u_1"),
    ("x " + json.dumps(record(payload={"query": 'a } " { \\\\'})) + "!", "u_1"),
    ("x" + GOOD[:-1], "u_1"),
    (BOT + "]" + GOOD, "u_1"),
    (BOT + ' "junk" ' + GOOD, "u_1"),
    (BOT + ',"x",' + GOOD, "u_1"),
    ("[" + BOT + "," + INVALID + "," + GOOD + "]", "u_1"),
    (BOT + "}}" + GOOD, "u_1"),
    (BOT + '"' + GOOD, "u_1"),
    (BOT + "{" + GOOD, None),
    (json.dumps(record(user_id="u_bot", is_bot_flag=True, payload={"query": 'a \\" } { \\\\'})) + "]" + GOOD, "u_1"),
    (json.dumps(record(user_id="u_bot", is_bot_flag=True, payload={"query": "x", "meta": record(user_id="u_in")})), None),
    (BOT + GOOD[:-1], "u_1"),
    (BOT + "\\", None),
    (BOT * 500 + GOOD, "u_1"),
    (BOT + INVALID, None),
    ("abc", None),
    ("{}} {", None),
])
def test_objects_among_other_text(typed, line, user):
    row = typed(line).first()
    assert (row.user_id if row.status == "emitted" else None) == user


def test_second_object_on_a_line_is_dropped(typed):
    rows = typed(GOOD + json.dumps(record(user_id="u_2"))).collect()
    assert [r.user_id for r in rows] == ["u_1"]


def _click(**payload):
    return record(action="click", payload=payload)


@pytest.mark.parametrize("item, expected", [
    (_click(dwell_time_ms=400), "invalid"),
    (_click(dwell_time_ms=499.7), "invalid"),
    (_click(dwell_time_ms=500), "emitted"),
    (_click(), "emitted"),
    (_click(dwell_time_ms=None), "emitted"),
    (_click(dwell_time_ms="300"), "invalid"),
    (_click(dwell_time_ms="soon"), "emitted"),
    (record(action="page_view", payload={"dwell_time_ms": 1}), "invalid"),
    (record(action="view_profile", payload={"dwell_time_ms": 1}), "emitted"),
    (record(payload={"dwell_time_ms": 10}), "emitted"),
    (record(user_id=12), "invalid"),
    (record(user_id=None), "invalid"),
    (record(user_id=...), "invalid"),
    (record(user_id=""), "emitted"),
    (record(user_id=["u"]), "invalid"),
    (record(session_id=7), "invalid"),
    (record(timestamp=1700000000), "invalid"),
    (record(timestamp="not a time"), "emitted"),
    (record(action="dance"), "invalid"),
    (record(action=["search"]), "invalid"),
    (record(action="dance", is_bot_flag=True), "invalid"),
    (record(client={"user_agent": "CURL/7"}), "bot"),
    (record(client={"user_agent": "Python-Requests/2"}), "bot"),
    (record(client=..., is_bot_flag=...), "emitted"),
    (record(client=None, payload=None), "emitted"),
    (record(client="text"), "emitted"),
    (record(is_bot_flag=True), "bot"),
    (record(is_bot_flag="no"), "bot"),
    (record(is_bot_flag=""), "emitted"),
    (record(is_bot_flag=0), "emitted"),
    (record(is_bot_flag=0.0), "emitted"),
    (record(is_bot_flag=2), "bot"),
    (record(is_bot_flag=[]), "emitted"),
    (record(is_bot_flag=[0]), "bot"),
    (record(is_bot_flag=None), "emitted"),
    (record(user_id="tab\tinside"), "emitted"),
])
def test_field_rules(typed, item, expected):
    assert statuses(typed(item)) == [expected]


def test_thresholds_and_agents_can_be_set(spark):
    lines = spark.createDataFrame(
        [(0, json.dumps(_click(dwell_time_ms=900))), (1, json.dumps(record(client={"user_agent": "MyProbe"})))],
        "n int, line string",
    )
    assert statuses(raw_log.type_events(lines)) == ["emitted", "emitted"]
    strict = raw_log.type_events(lines, min_dwell_ms=1000, bot_pattern="probe")
    assert statuses(strict) == ["invalid", "bot"]


def test_counters_count_blank_lines_as_read_only(typed):
    events = typed(GOOD, "", "}{", record(user_id=1), record(is_bot_flag=True), GOOD)
    found = {r.counter: r.n for r in cleaning.counters(events).collect()}
    assert found == {
        "records_in": 6, "records_corrupt": 1, "records_invalid_action": 1, "records_bot": 1, "records_emitted": 2,
    }


def test_timestamps_with_and_without_zone(typed):
    rows = typed(record(timestamp="2024-03-01T10:00:00+00:00"), record(), record(timestamp="x")).orderBy("n").collect()
    assert rows[0].ts == rows[1].ts and rows[2].ts is None


def test_plain_and_gzip_files_in_nested_directories(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.jsonl").write_text(GOOD + "\n" + GOOD + "\n")
    with gzip.open(tmp_path / "two.jsonl.gz", "wt") as out:
        out.write(GOOD + "\n")
    assert cleaning.emitted(raw_log.read_events(spark, str(tmp_path))).count() == 3


def test_fields_beyond_the_counted_ones_are_read(typed):
    row = typed(record(payload={
        "query": "q", "results_count": 3, "page": 2, "url": "u", "referrer": "r", "content_snippet": "c",
        "recipient_id": "u_9", "meta": "m", "value": 0.5,
    })).first()
    assert row.payload.asDict() == {
        "query": "q", "results_count": 3, "page": 2, "url": "u", "referrer": "r", "dwell_time_ms": None,
        "content_snippet": "c", "recipient_id": "u_9", "meta": "m", "value": 0.5,
    }
    assert (row.client.ip, row.schema_version) == ("10.0.0.1", "1.2")

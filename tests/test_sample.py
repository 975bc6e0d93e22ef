"""Six lines with a known outcome: two users, one bot, one corrupt line."""

from conftest import record, statuses

from clickloom.operators import counts, sessions


def _sample():
    def at(minute, **changes):
        return record(timestamp=f"2026-01-01T10:0{minute}:00", **changes)

    return [
        at(0, user_id="u_abc", payload={"query": "machine learning", "results_count": 10, "page": 1}),
        at(1, user_id="u_bot", session_id="s_2", action="click", payload={"dwell_time_ms": 1000}, is_bot_flag=True),
        at(2, user_id="u_abc", action="follow", payload={}),
        {"raw": "}{broken_json"},
        at(3, user_id="u_xyz", session_id="s_3", action="comment", payload={"content_snippet": "x"}),
        at(4, user_id="u_abc", action="save_post", payload={}),
    ]


def test_statuses(typed):
    assert statuses(typed(*_sample())) == ["emitted", "bot", "emitted", "corrupt", "emitted", "emitted"]


def test_counts(typed):
    rows = {tuple(r) for r in counts.action_counts(typed(*_sample())).collect()}
    assert rows == {
        ("u_abc", "follow", 1), ("u_abc", "save_post", 1), ("u_abc", "search", 1), ("u_abc", "__total__", 3),
        ("u_xyz", "comment", 1), ("u_xyz", "__total__", 1),
    }


def test_session(typed):
    row = sessions.session_features(typed(*_sample())).where("session_id = 's_1'").first()
    assert (row.session_events, row.session_duration_min, row.avg_inter_event_sec) == (3, 4.0, 120.0)
    assert (row.n_professional_searches, row.country) == (1, "US")
    assert (row.session_start, row.session_end) == ("2026-01-01T10:00:00", "2026-01-01T10:04:00")

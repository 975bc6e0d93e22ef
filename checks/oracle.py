"""DuckDB SQL for the registered queries, written from the definitions rather than from the Spark plans."""

from clickloom import constants as C
from clickloom.sources.event_table import AGENTS, BOT_AGENT, COUNTRIES, OTHER_PHRASE, PHRASES


def _list(values):
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _in(values):
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


PIVOT = [f"n_{a}" for a in C.PIVOT_ACTIONS]
USED = [c for c in PIVOT if c != "n_login"]
METRICS = ["accuracy", "weightedPrecision", "weightedRecall", "f1"]
VOTES = {**C.VOTERS, C.ENSEMBLE_COLUMN: C.ENSEMBLE_NAME}

# Common table expressions, in order; a query starts from one and gets all before it.
CTES = {
    "clicks": f"""
        SELECT event_id, ts AS full_ts, date_trunc('second', ts) AS ts, user_id AS uid,
            strftime(ts, '%Y-%m-%dT%H:%M:%S') AS "timestamp",
            'u_' || user_id AS user_id,
            's_' || user_id || '_' || strftime(ts, '%Y%m%d') AS session_id,
            {_list(C.ACTIONS)}[CAST(kind + 1 AS INT)] AS action,
            CASE WHEN kind = 0 THEN CASE WHEN user_id % 20 < 9
                THEN {_list(PHRASES)}[CAST(event_id % {len(PHRASES)} + 1 AS INT)] ELSE '{OTHER_PHRASE}' END END AS query,
            CASE WHEN kind IN (1, 2, 9) THEN CAST(floor(value * 1000) AS BIGINT) END AS dwell_time_ms,
            CASE WHEN user_id % 25 = 24 THEN '{BOT_AGENT}'
                ELSE {_list(AGENTS)}[CAST(event_id % {len(AGENTS)} + 1 AS INT)] END AS user_agent,
            {_list(COUNTRIES)}[CAST(event_id % {len(COUNTRIES)} + 1 AS INT)] AS country,
            user_id % 25 = 24 AS is_bot_flag,
            event_id % 100 = 99 AS corrupt
        FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INT) % 14 AS kind FROM events)""",
    "judged": f"""
        SELECT *, CASE WHEN corrupt THEN 'corrupt'
            WHEN action IN {_in(C.DWELL_CHECKED_ACTIONS)} AND dwell_time_ms < {C.MIN_DWELL_MS} THEN 'invalid'
            WHEN is_bot_flag OR regexp_matches(lower(user_agent), '{"|".join(C.BOT_AGENT_TERMS)}') THEN 'bot'
            ELSE 'emitted' END AS status
        FROM clicks""",
    "clean": "SELECT * FROM judged WHERE status = 'emitted'",
    "counted": f"""
        SELECT user_id, action, count(*) AS cnt FROM clean GROUP BY ALL
        UNION ALL SELECT user_id, '{C.TOTAL_ACTION}', count(*) FROM clean GROUP BY ALL""",
    "pivoted": "SELECT user_id, "
    + ", ".join(
        f"CAST(sum(CASE WHEN action = '{a}' THEN cnt ELSE 0 END) AS BIGINT) AS n_{a}" for a in C.PIVOT_ACTIONS
    )
    + f", CAST(sum(CASE WHEN action = '{C.TOTAL_ACTION}' THEN cnt ELSE 0 END) AS BIGINT) AS total_actions"
    " FROM counted GROUP BY user_id",
    "ordered": """
        SELECT *, CAST(epoch(ts) AS BIGINT) AS second,
            lag(CAST(epoch(ts) AS BIGINT)) OVER w AS previous,
            first_value(country) OVER w AS first_country
        FROM judged WHERE status <> 'corrupt'
        WINDOW w AS (PARTITION BY user_id, session_id ORDER BY ts, event_id)""",
    "sessions": f"""
        SELECT user_id, session_id, min("timestamp") AS session_start, max("timestamp") AS session_end,
            count(*) AS session_events, avg(second - previous) AS avg_inter_event_sec,
            CAST(max(second) - min(second) AS DOUBLE) / 60 AS session_duration_min,
            count(*) FILTER (action = 'search'
                AND regexp_matches(lower(query), '{"|".join(C.PROFESSIONAL_TERMS)}')) AS n_professional_searches,
            count(*) FILTER (action = 'click' AND dwell_time_ms > {C.DEEP_CLICK_MS}) AS n_deep_clicks,
            any_value(first_country) AS country
        FROM ordered GROUP BY user_id, session_id""",
    "joined": f"""
        SELECT p.user_id, {", ".join(USED)}, total_actions,
            count(DISTINCT session_id) AS total_sessions,
            avg(session_duration_min) AS avg_session_duration_min,
            avg(CAST(session_events AS DOUBLE)) AS avg_events_per_session,
            avg(avg_inter_event_sec) AS avg_inter_event_sec,
            CAST(sum(n_professional_searches) AS BIGINT) AS total_professional_searches,
            CAST(sum(n_deep_clicks) AS BIGINT) AS total_deep_clicks,
            min(session_start) AS first_start
        FROM pivoted p JOIN sessions s ON p.user_id = s.user_id GROUP BY ALL""",
    "featured": f"""
        SELECT * EXCLUDE (first_start),
            CASE WHEN total_actions > 0 THEN CAST(total_professional_searches AS DOUBLE) / total_actions
                ELSE 0.0::DOUBLE END AS professional_ratio,
            CASE WHEN n_search > 0 THEN CAST(n_click AS DOUBLE) / n_search ELSE 0.0::DOUBLE END AS click_through_rate,
            CASE WHEN total_professional_searches >= {C.LABEL_MIN_SEARCHES} AND n_send_message >= {C.LABEL_MIN_MESSAGES}
                AND avg_session_duration_min >= {C.LABEL_MIN_MINUTES} THEN CAST(1 AS INTEGER)
                ELSE CAST(0 AS INTEGER) END AS label,
            substr(first_start, 1, 10) AS dt
        FROM joined""",
    "modelled": """
        SELECT * REPLACE (CAST(label AS DOUBLE) AS label), substr(md5(user_id), 1, 2) < 'cd' AS is_train
        FROM featured WHERE avg_inter_event_sec IS NOT NULL""",
    # Models and metrics below look at one feature per row.
    "long": f"""
        SELECT user_id, label, is_train, unnest({_list(C.FEATURES)}) AS feature,
            unnest([{", ".join(f"CAST({c} AS DOUBLE)" for c in C.FEATURES)}]) AS x FROM modelled""",
    "standard": """
        SELECT l.user_id, l.feature, CASE WHEN sd > 0 THEN (x - mean) / sd ELSE 0.0 END AS z
        FROM long l JOIN (SELECT feature, avg(x) AS mean, stddev_samp(x) AS sd FROM long GROUP BY feature) m
            ON l.feature = m.feature""",
    "minmax": """
        SELECT l.user_id, l.label, l.is_train, l.feature,
            CASE WHEN hi = lo THEN 0.5 ELSE (least(greatest(x, lo), hi) - lo) / (hi - lo) END AS v
        FROM long l JOIN (SELECT feature, min(x) AS lo, max(x) AS hi FROM long WHERE is_train GROUP BY feature) b
            ON l.feature = b.feature""",
    "bayes": f"""
        SELECT label, feature,
            ln(count(*) + 1) - ln((SELECT count(*) FROM modelled WHERE is_train) + 2) AS pi,
            ln(sum(v) + 1) - ln(sum(sum(v)) OVER (PARTITION BY label) + {len(C.FEATURES)}) AS theta
        FROM minmax WHERE is_train GROUP BY label, feature""",
    "voted": f"""
        SELECT *, CASE WHEN nb_pred + svm_pred + mlp_pred > 1.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
            AS {C.ENSEMBLE_COLUMN}
        FROM (SELECT *, CAST(total_actions % 2 = 1 AS INT)::DOUBLE AS nb_pred,
            CAST(n_search > n_click AS INT)::DOUBLE AS svm_pred,
            CAST(total_sessions % 3 = 0 AS INT)::DOUBLE AS mlp_pred FROM featured)""",
    "cells": "SELECT model, label, prediction, count(*) AS n FROM ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS model, CAST(label AS DOUBLE) AS label, {column} AS prediction FROM voted"
        " WHERE avg_inter_event_sec IS NOT NULL"
        for column, name in VOTES.items()
    )
    + ") GROUP BY ALL",
    "measured": """
        SELECT model, round(sum(hit) / sum(actual), 4) AS accuracy,
            round(sum(p * actual) / sum(actual), 4) AS "weightedPrecision",
            round(sum(r * actual) / sum(actual), 4) AS "weightedRecall",
            round(sum(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END * actual) / sum(actual), 4) AS f1
        FROM (SELECT model, label, hit, actual, CASE WHEN said > 0 THEN hit / said ELSE 0 END AS p, hit / actual AS r
            FROM (SELECT a.model, a.label, CAST(sum(a.n) AS DOUBLE) AS actual,
                CAST(coalesce(sum(a.n) FILTER (a.prediction = a.label), 0) AS DOUBLE) AS hit,
                CAST(coalesce(any_value(s.n), 0) AS DOUBLE) AS said
                FROM cells a LEFT JOIN
                    (SELECT model, prediction, sum(n) AS n FROM cells GROUP BY ALL) s
                    ON a.model = s.model AND a.label = s.prediction
                GROUP BY a.model, a.label))
        GROUP BY model""",
    "clustered": "SELECT *, CAST(CAST(substr(user_id, 3) AS BIGINT) % 7 AS INTEGER) AS cluster FROM featured",
    "assigned": f"""
        SELECT user_id, cluster, avg_session_duration_min AS pca_x, avg_events_per_session AS pca_y, label,
            professional_ratio, total_actions, total_sessions,
            CASE cluster {" ".join(f"WHEN {k} THEN '{v}'" for k, v in C.ARCHETYPES.items())}
                ELSE 'Segment-' || cluster END AS archetype
        FROM clustered""",
}


def _with(start: str, body: str) -> str:
    names = list(CTES)
    used = names[: names.index(start) + 1]
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in used) + "\n" + body


def _rounded(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in columns)


FEATURE_SELECT = (
    f"user_id, {', '.join(USED)}, total_actions, total_sessions, "
    + _rounded("avg_session_duration_min", "avg_events_per_session", "avg_inter_event_sec")
    + ", total_professional_searches, total_deep_clicks, "
    + _rounded("professional_ratio", "click_through_rate")
    + ", label"
)
SESSION_SELECT = (
    "user_id, session_id, session_start, session_end, session_events, "
    + _rounded("avg_inter_event_sec", "session_duration_min")
    + ", n_professional_searches, n_deep_clicks, country"
)


def _wide(table: str, value: str) -> str:
    columns = ", ".join(f"round(max({value}) FILTER (feature = '{c}'), 6) + 0.0 AS {c}" for c in C.FEATURES)
    return f"SELECT user_id, {columns} FROM {table} GROUP BY user_id"


def _power_iteration(rounds: int = 600) -> str:
    """Shares of the two largest eigenvalues of the covariance matrix: the second after the first one's part is taken off."""
    n = len(C.FEATURES)
    times = "list_transform(m, lambda r: list_dot_product(r, v))"

    def step(number: int, matrix: str) -> str:
        name = f"power_{number}"
        return f"""
        , {name} AS (
            SELECT 0 AS k, m, list_transform(range({n}), lambda x: 1 + x / 50.0::DOUBLE) AS v FROM {matrix}
            UNION ALL
            SELECT k + 1, m, list_transform(w, lambda x: x / sqrt(list_dot_product(w, w)))
            FROM (SELECT k, m, {times} AS w FROM {name}) WHERE k < {rounds})
        , largest_{number} AS (SELECT m, v, list_dot_product(v, {times}) AS l FROM {name} WHERE k = {rounds})"""

    rest = f"list_transform(range(1, {n + 1}), lambda i: list_transform(range(1, {n + 1}), lambda j: m[i][j] - l * v[i] * v[j]))"
    return f"""
        , cells_of AS (SELECT a.feature AS i, b.feature AS j, sum(a.z * b.z) AS c
            FROM standard a JOIN standard b ON a.user_id = b.user_id GROUP BY ALL)
        , matrix_1 AS (SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(c ORDER BY j) AS r FROM cells_of GROUP BY i))
        {step(1, "matrix_1")}
        , matrix_2 AS (SELECT {rest} AS m FROM largest_1)
        {step(2, "matrix_2")}
        , whole AS (SELECT sum(c) AS trace FROM cells_of WHERE i = j)
        SELECT CAST(1 AS INTEGER) AS component, round(l / trace, 6) AS explained_variance FROM largest_1, whole
        UNION ALL SELECT CAST(2 AS INTEGER), round(l / trace, 6) FROM largest_2, whole"""


def _margin_classifier(penalty: float = 0.01, gap: float = 1e-6, rounds: int = 50_000) -> str:
    """Hinge loss and squared weights minimised through the dual: each round moves the pair of training users that violates
    the optimum most, until no pair does by more than ``gap``. Then the sign of the margin of the other users."""
    each = "list_transform(range(1, n + 1), lambda q: "
    return f"""
        , z AS (SELECT l.user_id, l.label, l.is_train, list(CASE WHEN sd > 0 THEN (x - mean) / sd ELSE 0.0 END ORDER BY l.feature) AS x
            FROM long l JOIN (SELECT feature, avg(x) AS mean, stddev_samp(x) AS sd FROM long WHERE is_train GROUP BY feature) m
                ON l.feature = m.feature GROUP BY ALL)
        , train AS (SELECT row_number() OVER (ORDER BY user_id) AS i, 2 * label - 1 AS y, x FROM z WHERE is_train)
        , side AS (SELECT list(y ORDER BY i) AS y, count(*) AS n, 1 / ({penalty}::DOUBLE * count(*)) AS c FROM train)
        , kernel AS (SELECT list(r ORDER BY i) AS k FROM
            (SELECT a.i, list(list_dot_product(a.x, b.x) ORDER BY b.i) AS r FROM train a, train b GROUP BY a.i))
        , dual AS (
            SELECT 0 AS t, list_transform(y, lambda q: 0.0::DOUBLE) AS a, list_transform(y, lambda q: -1.0::DOUBLE) AS g,
                1.0::DOUBLE AS high, -1.0::DOUBLE AS low FROM side
            UNION ALL
            SELECT t + 1,
                {each} a[q] + CASE WHEN q = i THEN y[i] * d WHEN q = j THEN -y[j] * d ELSE 0 END),
                {each} g[q] + y[q] * d * (k[i][q] - k[j][q])), up[i], down[j]
            FROM (SELECT *, least((up[i] - down[j]) / greatest(k[i][i] + k[j][j] - 2 * k[i][j], 1e-12),
                    CASE WHEN y[i] > 0 THEN c - a[i] ELSE a[i] END, CASE WHEN y[j] > 0 THEN a[j] ELSE c - a[j] END) AS d
                FROM (SELECT *, list_position(up, list_max(up)) AS i, list_position(down, list_min(down)) AS j
                    FROM (SELECT *,
                            {each} CASE WHEN y[q] > 0 AND a[q] < c OR y[q] < 0 AND a[q] > 0 THEN -y[q] * g[q] ELSE -1e9 END) AS up,
                            {each} CASE WHEN y[q] < 0 AND a[q] < c OR y[q] > 0 AND a[q] > 0 THEN -y[q] * g[q] ELSE 1e9 END) AS down
                        FROM dual, side, kernel)))
            WHERE high - low >= {gap} AND t < {rounds})
        , solved AS (SELECT a, (high + low) / 2 AS bias FROM dual ORDER BY t DESC LIMIT 1)
        SELECT e.user_id, e.label, CASE WHEN sum(a[i] * y * list_dot_product(t.x, e.x)) + any_value(bias) > 0 THEN 1.0::DOUBLE
            ELSE 0.0::DOUBLE END AS svm_pred
        FROM z e, train t, solved WHERE NOT e.is_train GROUP BY e.user_id, e.label"""


def _bisected(body: str, clusters: int = 5, smallest: int = 20, rounds: int = 30, powers: int = 400) -> str:
    """Clusters by splitting the one of largest cost at the mean of its leading axis, then moving both centres until they rest.

    ``body`` finds them in ``found`` (user_id, z, cluster)."""
    n = len(C.FEATURES)
    each = f"list_transform(range(1, {n + 1}), lambda i: "

    def means(side: str) -> str:
        return "[" + ", ".join(f"avg(z[{i}]) FILTER ({side})" for i in range(1, n + 1)) + "]"

    parts = [f"""
        , points AS MATERIALIZED (SELECT user_id, list(z ORDER BY list_position({_list(C.FEATURES)}, feature)) AS z FROM standard GROUP BY user_id)
        , leaf_0 AS MATERIALIZED (SELECT user_id, z, 0 AS cluster FROM points)"""]
    for s in range(1, clusters):
        parts.append(f"""
        , chosen_{s} AS MATERIALIZED (SELECT cluster, list(mean ORDER BY i) AS mean FROM (
                SELECT cluster, i, count(*) AS n, avg(x) AS mean, var_pop(x) * count(*) AS cost
                FROM (SELECT cluster, unnest(z) AS x, unnest(range(1, {n + 1})) AS i FROM leaf_{s - 1}) GROUP BY cluster, i)
            GROUP BY cluster HAVING any_value(n) >= {smallest} ORDER BY sum(cost) DESC, cluster LIMIT 1)
        , members_{s} AS MATERIALIZED (SELECT z, {each} z[i] - mean[i]) AS d FROM leaf_{s - 1} JOIN chosen_{s} USING (cluster))
        , matrix_{s} AS MATERIALIZED (SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(c ORDER BY j) AS r FROM (
            SELECT i, j, sum(d[i] * d[j]) AS c FROM members_{s}, range(1, {n + 1}) AS a(i), range(1, {n + 1}) AS b(j) GROUP BY i, j) GROUP BY i))
        , power_{s} AS (
            SELECT 0 AS t, list_transform(range({n}), lambda x: 1 + x / 50.0::DOUBLE) AS v
            UNION ALL
            SELECT t + 1, list_transform(w, lambda x: x / sqrt(list_dot_product(w, w)))
            FROM (SELECT t, list_transform(m, lambda r: list_dot_product(r, v)) AS w FROM power_{s}, matrix_{s}) WHERE t < {powers})
        , axis_{s} AS MATERIALIZED (SELECT list_transform(v, lambda x: x * CASE WHEN list_max(v) >= -list_min(v) THEN 1 ELSE -1 END) AS v
            FROM power_{s} WHERE t = {powers})
        , centres_{s} AS (
            SELECT 0 AS t, {means("NOT far")} AS a, {means("far")} AS b
            FROM (SELECT z, list_dot_product(d, v) > 0 AS far FROM members_{s}, axis_{s})
            UNION ALL
            SELECT t + 1, {means("NOT far")}, {means("far")}
            FROM (SELECT t, z, list_distance(z, b) < list_distance(z, a) AS far FROM centres_{s}, members_{s} WHERE t < {rounds}) GROUP BY t)
        , leaf_{s} AS MATERIALIZED (
            SELECT user_id, z, CASE WHEN l.cluster = c.cluster AND list_distance(z, b) < list_distance(z, a) THEN {s} ELSE l.cluster END AS cluster
            FROM leaf_{s - 1} l LEFT JOIN chosen_{s} c ON l.cluster = c.cluster LEFT JOIN (SELECT a, b FROM centres_{s} WHERE t = {rounds}) ON true)""")
    found = f"\n        , found AS MATERIALIZED (SELECT * FROM leaf_{clusters - 1})\n"
    return _with("standard", "".join(parts) + found + body).replace("WITH", "WITH RECURSIVE", 1)


def _cases(expected: dict[int, str]) -> str:
    return " ".join(f"WHEN {k} THEN {v}" for k, v in expected.items())


# Outcome of each field variant, in the order the registry lists them.
FIELD_STATUS = [
    "emitted", "invalid", "invalid", "invalid", "emitted", "invalid", "invalid", "invalid", "invalid",
    "invalid", "emitted", "emitted", "emitted", "invalid", "emitted", "emitted", "bot", "bot", "emitted", "emitted",
]
FIELD_ACTION = {7: "dance", 8: "dance", 9: "click", 10: "click", 11: "page_view", 13: "click", 14: "click", 15: "click"}

ORACLES = {
    "raw_scan": _with("judged", """
        SELECT CASE WHEN NOT corrupt THEN event_id END AS event_order,
            CASE WHEN NOT corrupt THEN "timestamp" END AS "timestamp",
            CASE WHEN NOT corrupt THEN user_id END AS user_id,
            CASE WHEN NOT corrupt THEN session_id END AS session_id,
            CASE WHEN NOT corrupt THEN action END AS action,
            CASE WHEN NOT corrupt THEN query END AS query,
            CASE WHEN NOT corrupt THEN dwell_time_ms END AS dwell_time_ms,
            CASE WHEN NOT corrupt THEN user_agent END AS user_agent,
            CASE WHEN NOT corrupt THEN country END AS country,
            is_bot_flag AND NOT corrupt AS is_bot_flag, status
        FROM judged"""),
    "parse_repair": _with("clicks", """
        SELECT event_id,
            CASE WHEN event_id % 12 IN (0, 1, 2, 3, 4, 5, 8) THEN 'parsed' WHEN event_id % 12 < 10 THEN 'corrupt' ELSE 'blank' END AS outcome,
            CASE WHEN event_id % 12 IN (0, 1, 2, 3, 4, 5, 8) THEN user_id END AS user_id,
            CASE WHEN event_id % 12 IN (0, 1, 2, 3, 4, 5, 8) THEN action END AS action
        FROM clicks"""),
    "framed_records": _with("clicks", """
        SELECT event_id, CASE WHEN event_id % 12 < 11 THEN user_id ELSE 'u_bot' END AS user_id,
            CASE WHEN event_id % 12 < 11 THEN 'emitted' ELSE 'bot' END AS status
        FROM clicks"""),
    "validate_fields": _with("clicks", f"""
        SELECT event_id,
            CASE event_id % 20 WHEN 1 THEN '12' WHEN 2 THEN NULL WHEN 3 THEN NULL WHEN 4 THEN '' ELSE user_id END AS user_id,
            CASE event_id % 20 WHEN 5 THEN '7' ELSE session_id END AS session_id,
            CASE event_id % 20 {_cases({k: f"'{v}'" for k, v in FIELD_ACTION.items()})} ELSE 'search' END AS action,
            {_list(FIELD_STATUS)}[CAST(event_id % 20 + 1 AS INT)] AS status
        FROM clicks"""),
    "clean_events": _with("clean", "SELECT event_id, user_id, action FROM clean"),
    "clean_counters": _with("judged", """
        SELECT 'records_in' AS counter, count(*) AS n FROM judged
        UNION ALL SELECT 'records_corrupt', count(*) FROM judged WHERE status = 'corrupt'
        UNION ALL SELECT 'records_invalid_action', count(*) FROM judged WHERE status = 'invalid'
        UNION ALL SELECT 'records_bot', count(*) FROM judged WHERE status = 'bot'
        UNION ALL SELECT 'records_emitted', count(*) FROM judged WHERE status = 'emitted'"""),
    "action_counts": _with("counted", "SELECT user_id, action, cnt FROM counted"),
    "tsv_scan": _with("counted", "SELECT user_id, action, cnt FROM counted"),
    "latest_run": _with("counted", "SELECT user_id, action, cnt FROM counted"),
    "tsv_hostile_ids": _with("counted", """
        SELECT user_id || ['', chr(9), chr(10), chr(13) || chr(10), '"q', chr(92), chr(92) || 't', chr(92) || chr(92) || 'n', ' x ']
            [CAST(CAST(substr(user_id, 3) AS BIGINT) % 9 + 1 AS INT)] AS user_id, action, cnt
        FROM counted"""),
    "tsv_validate": """
        SELECT CASE WHEN event_id % 8 IN (3, 4) THEN 'malformed_input' WHEN event_id % 8 = 5 THEN 'bad_count'
            WHEN event_id % 8 = 7 THEN 'blank' ELSE 'ok' END AS reason, count(*) AS n
        FROM events GROUP BY ALL""",
    "tuple_counts": _with("clicks", f"""
        , tuples AS (SELECT user_id, action, CASE WHEN event_id % 8 = 6 THEN 5 ELSE 1 END AS n
            FROM clicks WHERE event_id % 8 IN (0, 1, 2, 6))
        SELECT user_id, action, CAST(sum(n) AS BIGINT) AS cnt FROM tuples GROUP BY ALL
        UNION ALL SELECT user_id, '{C.TOTAL_ACTION}', CAST(sum(n) AS BIGINT) FROM tuples GROUP BY ALL"""),
    "user_action_pivot": _with("pivoted", f"SELECT user_id, {', '.join(PIVOT)}, total_actions FROM pivoted"),
    "pivot_of_counts": _with("pivoted", f"SELECT user_id, {', '.join(PIVOT)}, total_actions FROM pivoted"),
    "session_features": _with("sessions", f"SELECT {SESSION_SELECT} FROM sessions"),
    "clean_session_features": _with("sessions", f"SELECT {SESSION_SELECT} FROM sessions").replace(
        "WHERE status <> 'corrupt'", "WHERE status = 'emitted'"
    ),
    "event_gaps": _with("ordered", """
        SELECT user_id, session_id, second, count(*) AS n_events,
            lag(second) OVER (PARTITION BY user_id, session_id ORDER BY second) AS previous_second,
            CAST(max(second - previous) AS BIGINT) AS gap_sec
        FROM ordered GROUP BY user_id, session_id, second"""),
    "session_gaps": _with("sessions", f"""
        SELECT user_id, session_id, {_rounded("avg_inter_event_sec")} FROM sessions"""),
    "session_country": _with("sessions", "SELECT user_id, session_id, country FROM sessions"),
    "professional_searches": _with("sessions", """
        SELECT user_id, session_id, n_professional_searches FROM sessions WHERE n_professional_searches > 0"""),
    "deep_clicks": _with("sessions", """
        SELECT user_id, session_id, n_deep_clicks FROM sessions WHERE n_deep_clicks > 0"""),
    "feature_table": _with("featured", f"SELECT {FEATURE_SELECT}, dt FROM featured"),
    "feature_table_joined": _with("featured", f"SELECT {FEATURE_SELECT}, dt FROM featured"),
    "features_from_counts": _with("featured", f"SELECT {FEATURE_SELECT}, dt FROM featured"),
    "feature_export": _with("featured", f"SELECT {FEATURE_SELECT}, dt FROM featured"),
    "ratio_features": _with("featured", f"""
        SELECT user_id, {_rounded("professional_ratio", "click_through_rate")} FROM featured"""),
    "user_labels": _with("featured", "SELECT user_id, label FROM featured"),
    "feature_partitions": _with("featured", "SELECT dt, count(*) AS n_users FROM featured GROUP BY dt"),
    "model_input": _with("modelled", f"SELECT {FEATURE_SELECT} FROM modelled"),
    "label_distribution": _with("modelled", "SELECT label, count(*) AS n FROM modelled GROUP BY label"),
    "train_test_split": _with("modelled", "SELECT user_id, is_train FROM modelled"),
    "scaled_standard": _with("standard", _wide("standard", "z")),
    "scaled_minmax": _with("minmax", _wide("minmax", "v")),
    "nb_parameters": _with("bayes", f"""
        SELECT CAST(label AS INTEGER) AS label, feature, {_rounded("pi", "theta")} FROM bayes"""),
    "nb_predictions": _with("bayes", """
        , scores AS (SELECT m.user_id, m.label, b.label AS class, any_value(pi) + sum(v * theta) AS score
            FROM minmax m JOIN bayes b ON m.feature = b.feature WHERE NOT m.is_train GROUP BY ALL)
        SELECT user_id, label, arg_max(class, score) AS nb_pred FROM scores GROUP BY user_id, label"""),
    "vote_audit": _with("modelled", """
        SELECT user_id, label, true AS is_majority, round(greatest(share, 1 - share), 6) AS floor, true AS nb_pred_above_floor,
            true AS svm_pred_above_floor, true AS mlp_pred_above_floor
        FROM modelled, (SELECT avg(label) AS share FROM modelled WHERE is_train) WHERE NOT is_train"""),
    "svm_audit": _with("modelled", """
        SELECT user_id, label, true AS is_sign_of_margin, true AS beats_no_weights, true AS scale_is_best
        FROM modelled WHERE NOT is_train"""),
    "cluster_audit": _with("standard", """
        SELECT count(DISTINCT user_id) AS users, round(sum(z * z), 6) AS total, true AS few_clusters,
            true AS centres_are_means, true AS cost_is_within
        FROM standard"""),
    "ensemble_vote": _with("voted", f"SELECT user_id, nb_pred, svm_pred, mlp_pred, {C.ENSEMBLE_COLUMN} FROM voted"),
    "combine_predictions": _with("voted", f"""
        SELECT user_id, CAST(label AS DOUBLE) AS label, nb_pred, svm_pred, mlp_pred, {C.ENSEMBLE_COLUMN} FROM voted
        WHERE avg_inter_event_sec IS NOT NULL AND substr(md5(user_id), 1, 2) >= 'cd'"""),
    "confusion_counts": _with("cells", "SELECT model, label, prediction, n FROM cells"),
    "classification_metrics": _with("measured", f"""SELECT model, {_rounded(*[f'"{m}"' for m in METRICS])} FROM measured"""),
    "metrics_report": _with("measured", "".join(
        f"""{" UNION ALL " if i else ""}SELECT model, '{m}' AS metric, round("{m}", 6) AS value FROM measured"""
        for i, m in enumerate(METRICS)
    )),
    "silhouette": _with("standard", """
        , placed AS (SELECT *, CAST(substr(user_id, 3) AS BIGINT) % 7 AS cluster FROM standard)
        , pairs AS (SELECT a.user_id, a.cluster, b.user_id AS other, b.cluster AS other_cluster,
                sum((a.z - b.z) * (a.z - b.z)) AS d
            FROM placed a JOIN placed b ON a.feature = b.feature AND a.user_id <> b.user_id GROUP BY ALL)
        , means AS (SELECT user_id, cluster, other_cluster, avg(d) AS d FROM pairs GROUP BY ALL)
        , sides AS (SELECT user_id, any_value(d) FILTER (cluster = other_cluster) AS a,
                min(d) FILTER (cluster <> other_cluster) AS b FROM means GROUP BY user_id)
        SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM sides"""),
    "pca_variance": _with("standard", _power_iteration()).replace("WITH", "WITH RECURSIVE", 1),
    "cluster_sizes": _with("clustered", "SELECT cluster, count(*) AS n_users FROM clustered GROUP BY cluster"),
    "cluster_records": _with("assigned", """
        SELECT cluster AS cluster_id, any_value(archetype) AS archetype,
            CASE WHEN cluster = 6 THEN 0 ELSE count(*) END AS user_count,
            round(round(avg(total_actions), 4), 6) AS mean_actions,
            round(round(avg(total_sessions), 4), 6) AS mean_sessions, 0.5::DOUBLE AS silhouette
        FROM assigned GROUP BY cluster"""),
    "archetype_lookup": _with("assigned", "SELECT user_id, cluster, archetype FROM assigned"),
    "coordinates_join": _with("clustered", f"""
        SELECT user_id, cluster,
            CASE WHEN avg_inter_event_sec IS NOT NULL THEN round(avg_session_duration_min, 6) END AS pca_x,
            CASE WHEN avg_inter_event_sec IS NOT NULL THEN round(avg_events_per_session, 6) END AS pca_y
        FROM clustered"""),
    "cluster_points": _with("assigned", f"""
        SELECT user_id, cluster, {_rounded("pca_x", "pca_y")}, label, {_rounded("professional_ratio")},
            total_actions, total_sessions, archetype
        FROM assigned ORDER BY user_id LIMIT {C.DEFAULT_POINTS}"""),
    "cluster_extents": _with("assigned", """
        SELECT round(min(pca_x) - 0.05 * (max(pca_x) - min(pca_x)), 6) AS x_min,
            round(max(pca_x) + 0.05 * (max(pca_x) - min(pca_x)), 6) AS x_max,
            round(min(pca_y) - 0.05 * (max(pca_y) - min(pca_y)), 6) AS y_min,
            round(max(pca_y) + 0.05 * (max(pca_y) - min(pca_y)), 6) AS y_max FROM assigned"""),
    "user_profile": _with("assigned", """
        SELECT user_id, label, CASE label WHEN 0 THEN 'low-value' WHEN 1 THEN 'high-value' ELSE 'unknown' END AS label_name,
            cluster, archetype, round(round(professional_ratio, 4), 6) AS professional_ratio, total_actions
        FROM assigned"""),
    "profile_of_one": _with("assigned", """
        SELECT user_id, label, CASE label WHEN 0 THEN 'low-value' WHEN 1 THEN 'high-value' ELSE 'unknown' END AS label_name,
            cluster, archetype, round(round(professional_ratio, 4), 6) AS professional_ratio, total_actions
        FROM assigned WHERE user_id = 'u_10'"""),
    "pipeline_telemetry": _with("featured", """
        SELECT (SELECT count(*) FROM judged) AS raw_records, (SELECT count(*) FROM clean) AS cleaned_records,
            (SELECT count(*) FROM counted) AS count_rows, (SELECT count(*) FROM sessions) AS sessions,
            (SELECT count(*) FROM featured) AS total_users,
            (SELECT count(*) FROM featured WHERE avg_inter_event_sec IS NULL) AS users_without_gap,
            (SELECT count(*) FROM featured WHERE avg_inter_event_sec IS NOT NULL) AS model_rows,
            'Feature engineering complete.' AS status"""),
}

ORACLES["orc_feature_table"] = ORACLES["feature_table"]
ORACLES["saved_model_predictions"] = ORACLES["nb_predictions"]
ORACLES["output_rows"] = _with(
    "counted", "SELECT count(*) AS rows_written, count(*) AS rows_read, count(DISTINCT user_id) AS users FROM counted",
)
ORACLES["placed_features"] = ORACLES["feature_table"]
ORACLES["placed_profiles"] = _with("assigned", """
    SELECT user_id, label, CASE label WHEN 0 THEN 'low-value' WHEN 1 THEN 'high-value' ELSE 'unknown' END AS label_name,
        cluster, archetype, round(round(professional_ratio, 4), 6) AS professional_ratio, total_actions
    FROM assigned WHERE user_id IN (SELECT user_id FROM modelled WHERE NOT is_train)""")
ORACLES["tsv_foreign_ids"] = _with("counted", """
    SELECT user_id || [chr(92) || 'new', chr(92) || 't' || chr(9) || chr(10), chr(92) || chr(92)][CAST(n % 3 + 1 AS INT)] AS user_id, action, cnt
    FROM (SELECT *, CAST(substr(user_id, 3) AS BIGINT) AS n FROM counted)""")
# The margin classifier solved anew, to its optimum.
ORACLES["svm_predictions"] = _with("long", _margin_classifier()).replace("WITH", "WITH RECURSIVE", 1)
ORACLES["repeatable_assignments"] = _bisected(f"""
    SELECT user_id, CAST(cluster AS INTEGER) AS cluster, CAST(label AS INTEGER) AS label, {_rounded("professional_ratio")},
        total_actions, total_sessions
    FROM found JOIN modelled USING (user_id)""")
ORACLES["repeatable_metadata"] = _bisected(f"""
    , means AS (SELECT a.user_id, a.cluster, b.cluster AS other, avg(list_distance(a.z, b.z) ** 2) AS d
        FROM found a JOIN found b ON a.user_id <> b.user_id GROUP BY ALL)
    , sides AS (SELECT user_id, any_value(d) FILTER (cluster = other) AS a, min(d) FILTER (cluster <> other) AS b FROM means GROUP BY user_id)
    , score AS (SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 4) AS silhouette FROM sides)
    , parts AS (SELECT cluster, f, count(*) AS n, avg(x) AS mean, var_pop(x) * count(*) AS cost FROM
        (SELECT cluster, unnest(z) AS x, unnest({_list(C.FEATURES)}) AS f FROM found) GROUP BY cluster, f)
    SELECT CAST(cluster AS INTEGER) AS cluster_id,
        CASE cluster {" ".join(f"WHEN {k} THEN '{v}'" for k, v in C.ARCHETYPES.items())} ELSE 'Segment-' || cluster END AS archetype,
        n AS user_count, f AS feature, round(mean, 4) + 0.0 AS centre, silhouette,
        (SELECT round(sum(cost), 4) FROM parts) AS training_cost
    FROM parts, score""")
# Pretty-printed or not, the events are the same.
ORACLES["spanning_records"] = ORACLES["raw_scan"]

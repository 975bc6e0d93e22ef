import json

import pytest

from clickloom.session import build_session
from clickloom.sources import raw_log

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session("tests", {
        "spark.master": "local[4]",
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.warehouse.dir": str(base / "warehouse"),
        "spark.checkpoint.dir": str(base / "shared"),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


def record(**changes):
    """A good search record; a change to ``...`` removes the field."""
    base = {
        "timestamp": "2024-03-01T10:00:00",
        "user_id": "u_1",
        "session_id": "s_1",
        "action": "search",
        "payload": {"query": "weekend recipes"},
        "client": {"ip": "10.0.0.1", "user_agent": "Mozilla/5.0", "country": "US"},
        "is_bot_flag": False,
        "schema_version": "1.2",
    }
    base.update(changes)
    return {k: v for k, v in base.items() if v is not ...}


@pytest.fixture(scope="session")
def typed(spark):
    """Typed events of records or raw lines, in input order of ``n``."""

    def build(*items):
        lines = [(i, x if isinstance(x, str) else json.dumps(x)) for i, x in enumerate(items)]
        return raw_log.type_events(spark.createDataFrame(lines, "n int, line string"))

    return build


def statuses(events):
    return [r.status for r in events.orderBy("n").collect()]

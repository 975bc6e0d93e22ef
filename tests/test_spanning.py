import json

import pyarrow as pa
import pytest
from conftest import record

from clickloom.operators import cleaning, counts
from clickloom.plans import feature_job
from clickloom.sources import raw_log, spanning, storage


def users(events):
    return sorted(r.user_id for r in cleaning.emitted(events).collect())


def read(spark, tmp_path, text, name="log.json", **options):
    (tmp_path / name).write_text(text)
    return raw_log.read_events(spark, str(tmp_path), spanning=True, **options)


PRETTY = [json.dumps(record(user_id=f"u_{n:03}", payload={"query": 'a } "{ \\'}), indent=2) for n in range(120)]
USERS = [f"u_{n:03}" for n in range(120)]


@pytest.fixture(params=[1 << 27, 700])
def block_bytes(spark, request):
    """Files in one block, and in blocks that are shorter than three records."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("text", [
    "\n".join(PRETTY), "".join(PRETTY), ", ".join(PRETTY), "\n\n".join(PRETTY),
    "[\n" + ",\n".join("\n".join("  " + line for line in p.split("\n")) for p in PRETTY) + "\n]",
    "\n".join(json.dumps(json.loads(p)) for p in PRETTY), json.dumps([json.loads(p) for p in PRETTY], indent=4),
])
def test_forms_of_the_same_log(spark, tmp_path, block_bytes, text):
    events = read(spark, tmp_path, text)
    assert users(events) == USERS
    assert sum(r.status == "corrupt" for r in events.collect()) == 0


def test_objects_across_blocks(spark, tmp_path, block_bytes):
    """An object of many blocks, which is read whole, between others."""
    long = json.dumps(record(user_id="u_long", payload={"meta": [{"n": n} for n in range(400)]}), indent=1)
    assert users(read(spark, tmp_path, "\n".join([PRETTY[0], long, PRETTY[1]]))) == ["u_000", "u_001", "u_long"]


def test_open_object_ends_at_the_next_start(spark, tmp_path, block_bytes):
    cut = "\n".join(PRETTY[0].split("\n")[:-3])
    events = read(spark, tmp_path, "\n".join([*PRETTY[1:3], cut, *PRETTY[3:6], "}", PRETTY[6], "junk", PRETTY[7]]))
    assert users(events) == USERS[1:8]
    assert sum(r.status == "corrupt" for r in events.collect()) >= 1


def test_files_do_not_run_into_each_other(spark, tmp_path, block_bytes):
    (tmp_path / "a.json").write_text("\n".join(PRETTY[:2]) + '\n  {"open": {')
    assert users(read(spark, tmp_path, "  " + PRETTY[2], "b.json")) == USERS[:3]


def test_an_object_that_is_too_long_is_cut(spark, tmp_path):
    (tmp_path / "log.json").write_text(' {"open": [\n' + "1,\n" * 50 + "\n".join(PRETTY[:2]))
    lines = [r.line for r in spanning.read_lines(spark, str(tmp_path), max_pieces=20).collect()]
    assert max(text.count("\n") for text in lines) < 20
    assert sum(text.startswith("{\n") for text in lines) == 2


def test_blank_lines_and_empty_files(spark, tmp_path):
    assert read(spark, tmp_path, "").count() == 0
    events = read(spark, tmp_path, f"\n\n{PRETTY[0]}\n \n", "b.json")
    assert sorted(r.status for r in events.collect()) == ["blank", "blank", "blank", "emitted"]


def test_counting_job_over_spanning_objects(spark, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "a.json").write_text("\n".join(PRETTY))
    found = feature_job.count_actions(spark, str(tmp_path / "log"), str(tmp_path / "counts"), spanning=True)
    assert found["records_emitted"] == 120 and found["rows_written"] == 240
    flat = spark.createDataFrame([(json.dumps(json.loads(p)),) for p in PRETTY], "line string")
    want = counts.action_counts(raw_log.type_events(flat)).collect()
    got = counts.action_counts(raw_log.read_events(spark, str(tmp_path / "log"), spanning=True)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_only_what_crosses_an_edge_is_shuffled(spark, tmp_path, monkeypatch):
    """Objects that lie within a segment go on from the table of cut ones as they are."""
    stored, stage = {}, storage.stage
    monkeypatch.setattr(storage, "stage", lambda df, name: stored.setdefault(name, stage(df, name)))
    (tmp_path / "log.json").write_text("\n".join(PRETTY) + '\n{"open": [\n1,')
    lines = spanning.read_lines(spark, str(tmp_path))
    assert lines.count() == 121
    assert stored["cut"].where("line IS NULL").selectExpr("sum(size(pieces))").first()[0] == 2
    text = lines._jdf.queryExecution().optimizedPlan().toString()
    whole, edges = text[text.index("Union"):].split("isnotnull(line", 1)[0], text.split("isnotnull(line", 1)[1]
    assert not any(word in whole for word in ("Aggregate", "Window", "Join", "Sort"))
    assert "Aggregate" in text and "isnull(line" in edges


@pytest.mark.parametrize("indent", [None, 4])
def test_objects_across_segments(spark, tmp_path, indent):
    """One block of several segments, with records that start anew and with an array, whose depth goes on."""
    text = "\n".join(PRETTY * 8) if indent is None else json.dumps([json.loads(p) for p in PRETTY * 8], indent=indent)
    assert text.count("\n") > spanning.SEGMENT_PIECES
    assert users(read(spark, tmp_path, text)) == sorted(USERS * 8)


def test_segments_of_any_size_give_the_same_objects(monkeypatch):
    lines = "\n".join([*PRETTY[:3], "[", "  {", '"a": {}}, {"b"', ": 1", "}", "]", "}", " {", "", '"}', "{", *PRETTY[3:5]]).split("\n")
    batch = pa.record_batch([pa.array([line.encode() for line in lines]), pa.array(["f"] * len(lines)), pa.array([0] * len(lines))], ["value", "file", "block"])

    def pieces():
        found = {}
        for segment in spanning._segments([batch.slice(0, 7), batch.slice(7)]):
            row = segment.to_pylist()[0]
            for first, start, run, _ in spanning._objects(row["text"], row["at"], row["depth"]):
                begun = start or max(found)
                found[begun] = found.get(begun, []) + run
        return found

    want = pieces()
    for size in (1, 2, 5, 13):
        monkeypatch.setattr(spanning, "SEGMENT_PIECES", size)
        assert pieces() == want


def test_bytes_that_are_not_text(spark, tmp_path):
    (tmp_path / "log.json").write_bytes(b'{"a":\n"\xff\xe2\x82"\n}\n' + PRETTY[0].encode())
    assert sorted(r.line for r in spanning.read_lines(spark, str(tmp_path)).collect()) == sorted(['{"a":\n"\ufffd\ufffd"\n}', PRETTY[0]])

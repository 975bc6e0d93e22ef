import pytest
from pyspark.sql import functions as F

from clickloom.operators import cleaning, counts
from clickloom.sources import counts_tsv, event_table, storage

LINES = {
    "u_1\tsearch\t2": "ok", "u_1\tsearch\t 5 ": "ok", "u_1\tclick\t-1": "ok", "u_2\tshare\t+3": "ok",
    "u_2\tshare\t1_000": "ok", "\t\t4": "ok", "u_1\tsearch": "malformed_input",
    "u_1\tsearch\t1\t1": "malformed_input", "u_1\tsearch\t1\t": "malformed_input", "   ": "malformed_input",
    "u_1\tsearch\tx": "bad_count", "u_1\tsearch\t": "bad_count", "u_1\tsearch\t1.5": "bad_count",
    "u_1\tsearch\t1__0": "bad_count", "u_1\tsearch\t99999999999999999999": "bad_count", "": "blank",
}


def _lines(spark):
    return spark.createDataFrame([(x,) for x in LINES], "value string")


@pytest.mark.parametrize("line", LINES)
def test_tuple_lines(spark, line):
    checked = counts_tsv.validate_lines(spark.createDataFrame([(line,)], "value string"))
    assert checked.first().reason == LINES[line]


def test_reason_counts(spark):
    found = {r.reason: r.n for r in counts_tsv.reason_counts(_lines(spark)).collect()}
    assert found == {reason: list(LINES.values()).count(reason) for reason in set(LINES.values())}


def test_tuples_are_summed_with_totals(spark):
    rows = {tuple(r) for r in counts.reduce_tuples(counts_tsv.valid_tuples(_lines(spark))).collect()}
    assert rows == {
        ("u_1", "search", 7), ("u_1", "click", -1), ("u_1", "__total__", 6),
        ("u_2", "share", 1003), ("u_2", "__total__", 1003), ("", "", 4), ("", "__total__", 4),
    }


def test_total_equals_sum_of_actions(spark, small):
    found = counts.action_counts(event_table.events(spark, small))
    is_total = F.col("action") == "__total__"
    sums = found.groupBy("user_id").agg(
        F.sum(F.when(is_total, F.col("cnt"))).alias("total"), F.sum(F.when(~is_total, F.col("cnt"))).alias("parts")
    )
    assert sums.where("total <> parts").count() == 0 and sums.count() > 0


def test_counts_of_events_equal_counts_of_tuples(spark, small):
    events = event_table.events(spark, small)
    tuples = cleaning.emitted(events).select("user_id", "action", F.lit(1).cast("long").alias("cnt"))
    ours, theirs = counts.action_counts(events), counts.reduce_tuples(tuples)
    assert ours.exceptAll(theirs).count() == theirs.exceptAll(ours).count() == 0


def test_both_pivots_agree(spark, small):
    events = event_table.events(spark, small)
    ours, theirs = counts.user_action_pivot(events), counts.pivot_counts(counts.action_counts(events))
    assert ours.columns == theirs.columns
    assert ours.exceptAll(theirs).count() == theirs.exceptAll(ours).count() == 0


def test_actions_outside_the_pivot_count_in_the_total_only(spark):
    rows = [("u", "logout", 2), ("u", "login", 3), ("u", "__total__", 5)]
    row = counts.pivot_counts(spark.createDataFrame(rows, "user_id string, action string, cnt long")).first()
    assert (row.n_login, row.n_search, row.total_actions) == (3, 0, 5)


def test_runs(spark, small, tmp_path):
    path = str(tmp_path)
    whole = counts.action_counts(event_table.events(spark, small))
    counts_tsv.write_counts(whole, path, "20240101_000000")
    counts_tsv.write_counts(whole, path, "20240102_000000")
    # A run that never completed has no success marker and is not the latest.
    (tmp_path / "run_id=20240103_000000").mkdir()
    (tmp_path / "run_id=20240103_000000" / "part-00000").write_text("u_1\tsearch\t1\n")
    assert storage.latest_run(spark, path) == "run_id=20240102_000000"
    assert counts_tsv.read_latest_run(spark, path).exceptAll(whole).count() == 0
    assert counts_tsv.read_counts(spark, path).count() == 2 * whole.count() + 1


HOSTILE = ["a\tb", "a\nb", "a\rb", 'a"b', '"', "a\\b", "\\t", "\\\\n", " a ", "", "é"]


def test_hostile_ids_survive(spark, tmp_path):
    rows = spark.createDataFrame([(u, a, 3) for u in HOSTILE for a in ("click", "x\ty")], "user_id string, action string, cnt long")
    counts_tsv.write_counts(rows, str(tmp_path), "1")
    assert sorted(map(tuple, counts_tsv.read_counts(spark, str(tmp_path)).collect())) == sorted(map(tuple, rows.collect()))


def test_foreign_lines(spark, tmp_path):
    (tmp_path / "part-0").write_text('"lead\tclick\t3\n"q"\tclick\t 4\r\nbad\tclick\n\nu\tclick\tx\n')
    assert sorted(map(tuple, counts_tsv.read_counts(spark, str(tmp_path)).collect())) == [('"lead', "click", 3), ('"q"', "click", 4)]
    reasons = {r.reason: r.n for r in counts_tsv.reason_counts(counts_tsv.read_lines(spark, str(tmp_path))).collect()}
    assert reasons == {"ok": 2, "malformed_input": 1, "blank": 1, "bad_count": 1}


@pytest.mark.parametrize("producer", ["events", "tuples"])
def test_a_user_is_in_one_file(spark, small, tmp_path, producer):
    events = event_table.events(spark, small)
    found = counts.action_counts(events)
    if producer == "tuples":
        tuples = cleaning.emitted(events).select("user_id", "action", F.lit(1).cast("long").alias("cnt"))
        found = counts.reduce_tuples(tuples)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        counts_tsv.write_counts(found, str(tmp_path), "1")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = counts_tsv.read_lines(spark, str(tmp_path)).select(F.split("value", "\t")[0].alias("u"), F.input_file_name().alias("f"))
    assert rows.groupBy("u").agg(F.countDistinct("f").alias("n")).where("n > 1").count() == 0
    assert rows.select("f").distinct().count() > 1


def test_only_run_directories_are_runs(spark, tmp_path):
    for name in ("run_id=1", "tmp_sorted"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "_SUCCESS").touch()
    assert storage.latest_run(spark, str(tmp_path)) == "run_id=1"


def test_no_completed_run_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        storage.latest_run(spark, str(tmp_path))


def test_ids_survive_the_text_format(spark, tmp_path):
    ids = ["plain", "tab\tinside", 'quote"inside', '"quoted"', "back\\slash", " spaces ", ""]
    rows = spark.createDataFrame([(i, "search", 1) for i in ids], "user_id string, action string, cnt long")
    counts_tsv.write_counts(rows, str(tmp_path), "r")
    assert sorted(r.user_id for r in counts_tsv.read_counts(spark, str(tmp_path)).collect()) == sorted(ids)


def test_users_are_kept_together_and_sorted(spark, small, tmp_path):
    counts_tsv.write_counts(counts.action_counts(event_table.events(spark, small)), str(tmp_path), "r")
    seen = set()
    for file in tmp_path.glob("run_id=r/part-*"):
        keys = [tuple(line.split("\t")[:2]) for line in file.read_text().splitlines()]
        assert keys == sorted(keys)
        users = {user for user, _ in keys}
        assert not users & seen
        seen |= users


def test_foreign_fields_are_plain(spark, tmp_path):
    """Backslashes of other writers stay; own runs below the same directory are read with their escapes."""
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "b" / "part-0").write_text("u\\new\tclick\t3\nC:\\temp\tclick\t4\nu\\\\x\tclick\t5\n")
    (tmp_path / "loose").write_text("\\t\tclick\t6\n")
    foreign = [("u\\new", "click", 3), ("C:\\temp", "click", 4), ("u\\\\x", "click", 5), ("\\t", "click", 6)]
    assert sorted(map(tuple, counts_tsv.read_counts(spark, str(tmp_path)).collect())) == sorted(foreign)
    own = [("\\new", "click", 1), ("tab\t\\t", "click", 2), ("line\n", "click", 7)]
    counts_tsv.write_counts(spark.createDataFrame(own, "user_id string, action string, cnt long"), str(tmp_path / "a"), "1")
    assert sorted(map(tuple, counts_tsv.read_counts(spark, str(tmp_path)).collect())) == sorted(foreign + own)
    assert sorted(map(tuple, counts_tsv.read_latest_run(spark, str(tmp_path / "a")).collect())) == sorted(own)
    assert sorted(map(tuple, counts_tsv.read_counts(spark, str(tmp_path / "loose")).collect())) == [foreign[-1]]
    assert counts_tsv.read_counts(spark, str(tmp_path / "loose"), escaped=True).first().user_id == "\t"


def test_a_run_without_its_mark_is_not_complete(spark, tmp_path):
    rows = spark.createDataFrame([("u", "click", 1)], "user_id string, action string, cnt long")
    counts_tsv.write_counts(rows, str(tmp_path), "1")
    counts_tsv.write_counts(rows, str(tmp_path), "2")
    (tmp_path / "run_id=2" / "_SUCCESS").unlink()
    assert storage.latest_run(spark, str(tmp_path)) == "run_id=1"

"""Tab-separated count files: scan, validation, run directories."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.sources import storage

#: File that marks a run whose fields are escaped.
MARK = "_ESCAPED"
# What would end a field or a line, and the backslash itself, with their escapes; fixed values of the format.
_ESCAPES = [("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")]


def _escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for plain, written in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def _unescaped(text: Column) -> Column:
    def part(piece: Column) -> Column:
        for plain, written in _ESCAPES:
            piece = F.replace(piece, F.lit(written), F.lit(plain))
        return piece

    # Doubled backslashes first, so that what follows one isn't taken for an escape.
    pieces = F.transform(F.split(text, r"\\\\", -1), part)
    return F.when(F.contains(text, F.lit("\\")), F.array_join(pieces, "\\")).otherwise(text)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of all count files anywhere below a directory, in column ``value``."""
    return spark.read.options(recursiveFileLookup=True, lineSep="\n").text(path)


def read_counts(spark: SparkSession, path: str, escaped: bool | None = None) -> DataFrame:
    """Headerless (user_id, action, cnt) files anywhere below a directory: the union of all runs.

    Fields are plain text without quoting. Runs of this library are marked, and their escapes are undone; in all
    other files a backslash is a backslash. ``escaped`` says instead that all files are one or the other. Lines that aren't
    three fields with a count are left out; ``reason_counts`` of the lines says how many there are.
    """
    if escaped is None:
        own, foreign = storage.marked_directories(spark, path, MARK)
    else:
        own, foreign = ([path], []) if escaped else ([], [path])
    found = None
    for paths, undone in ((own, True), (foreign, False)):
        if paths:
            rows = valid_tuples(read_lines(spark, paths))
            if undone:
                rows = rows.withColumns({c: _unescaped(F.col(c)) for c in ("user_id", "action")})
            found = rows if found is None else found.unionByName(rows)
    return valid_tuples(read_lines(spark, path)) if found is None else found


def read_latest_run(spark: SparkSession, path: str) -> DataFrame:
    """Counts of the newest completed run only; runs are sub-directories that sort by time."""
    return read_counts(spark, f"{path}/{storage.latest_run(spark, path)}")


def write_counts(counts: DataFrame, path: str, run_id: str) -> None:
    """One directory per run, each user's rows together in one file and in action order.

    Counts come partitioned by user from all producers, so sorting within partitions is enough. Tabs, line ends and
    backslashes in names are escaped with a backslash. A file beside them marks the run as escaped, and only then as complete.
    """
    ordered = counts.select("user_id", "action", "cnt").sortWithinPartitions("user_id", "action")
    line = F.concat_ws("\t", _escaped(F.col("user_id")), _escaped(F.col("action")), F.col("cnt").cast("string"))
    writer = ordered.select(line.alias("value")).write.option("lineSep", "\n").option(storage.NO_SUCCESS_FILE, "false")
    writer.text(f"{path}/run_id={run_id}")
    storage.touch(counts.sparkSession, f"{path}/run_id={run_id}/{MARK}")
    storage.touch(counts.sparkSession, f"{path}/run_id={run_id}/_SUCCESS")


def validate_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Split tab-separated lines into (user_id, action, cnt) and say in ``reason`` what is wrong with the rest."""
    parts = F.split(F.col(column), "\t", -1)
    wide = lines.withColumn("parts", parts)
    three = F.size("parts") == 3

    def part(i: int) -> Column:
        return F.when(three, F.get("parts", F.lit(i)))

    # Digits may be grouped by single underscores and surrounded by white space.
    digits = F.regexp_replace(part(2), r"(?<=[0-9])_(?=[0-9])", "")
    count = F.when(digits.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.regexp_replace(digits, r"\s", "").try_cast("long"))
    reason = (
        F.when(F.col(column) == "", "blank")
        .when(~three, "malformed_input")
        .when(count.isNull(), "bad_count")
        .otherwise("ok")
    )
    kept = [c for c in lines.columns if c != column]
    return wide.select(
        *kept, part(0).alias("user_id"), part(1).alias("action"), count.alias("cnt"), reason.alias("reason")
    )


def valid_tuples(lines: DataFrame, column: str = "value") -> DataFrame:
    checked = validate_lines(lines, column)
    return checked.where(F.col("reason") == "ok").select("user_id", "action", "cnt")


def reason_counts(lines: DataFrame, column: str = "value") -> DataFrame:
    return validate_lines(lines, column).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))

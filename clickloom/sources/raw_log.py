"""Raw JSON-lines log, plain or gzip."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom import constants as C
from clickloom import schemas
from clickloom.functions import json_text
from clickloom.operators.cleaning import disposition
from clickloom.sources.spanning import read_lines as spanning_lines


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of all files below a directory.

    A gzip file is read by one task, so parallelism is the number of files; lines are not reshuffled.
    """
    return spark.read.option("recursiveFileLookup", "true").text(path).withColumnRenamed("value", "line")


def _is_text(document: Column, name: str) -> Column:
    return F.coalesce(json_text.type_of(document, name) == "STRING", F.lit(False))


def _ids_are_text(document: Column) -> Column:
    return _is_text(document, "user_id") & _is_text(document, "session_id") & _is_text(document, "timestamp")


def _has_only_raw(document: Column) -> Column:
    raw, user = (F.try_variant_get(document, f"$.{n}", "variant") for n in ("raw", "user_id"))
    return raw.isNotNull() & user.isNull()


def _flag_type(document: Column) -> Column:
    return F.coalesce(json_text.type_of(document, "is_bot_flag"), F.lit("VOID"))


def _judged(document: Column, record: T.StructType) -> Column:
    """What the disposition needs to know of a document, and its record."""
    return F.struct(
        _flag_type(document).alias("flag_type"),
        _ids_are_text(document).alias("ids_are_text"),
        (document.isNull() | _has_only_raw(document)).alias("corrupt"),
        F.try_variant_get(document, "$", record.simpleString()).alias("record"),
    )


def _status(judged: Column, min_dwell_ms: int, bot_pattern: str | None) -> Column:
    record = judged["record"]
    flag = json_text.truthy(record["is_bot_flag"], judged["flag_type"])
    return disposition(judged["corrupt"], judged["ids_are_text"], min_dwell_ms, bot_pattern, record, flag)


def _framed(line: Column, missing: Column, record: T.StructType, min_dwell_ms: int, bot_pattern: str | None) -> Column:
    """Of the objects on a line the first that is emitted; where the line starts with none, else the first of all."""
    def emitted(judged: Column) -> Column:
        return _status(judged, min_dwell_ms, bot_pattern) == "emitted"

    def chosen(found: Column) -> Column:
        return F.struct(F.get(F.filter(found, emitted), F.lit(0)).alias("emitted"), F.get(found, F.lit(0)).alias("first"))

    def cut(quotes: bool) -> Column:
        objects = F.transform(json_text.framed_objects(line, quotes), lambda document: _judged(document, record))
        # A list of one element binds the objects, so that they are looked for once.
        return F.get(F.transform(F.array(objects), chosen), F.lit(0))

    def best(by_quotes: Column) -> Column:
        def either(plain: Column) -> Column:
            return F.coalesce(plain["emitted"], F.when(missing, F.coalesce(by_quotes["first"], plain["first"])))

        return F.coalesce(by_quotes["emitted"], F.get(F.transform(F.array(cut(quotes=False)), either), F.lit(0)))

    return F.get(F.transform(F.array(cut(quotes=True)), best), F.lit(0))


def type_events(
    lines: DataFrame,
    min_dwell_ms: int = C.MIN_DWELL_MS,
    bot_pattern: str | None = None,
    record: T.StructType = schemas.RECORD,
) -> DataFrame:
    """Typed event columns and status for each line of column ``line``; other columns are kept.

    A line is parsed once, as the object that it starts with. Only if that one isn't emitted and text follows it, or if
    there is none, the line is cut into its objects, and the first one that is emitted counts. The typed record accepts
    any JSON type for text fields, so the type tests on the ids and the timestamp look at the document itself. ``record``
    names the fields to read; what it leaves out is not extracted.
    """
    kept = [c for c in lines.columns if c != "line"]
    parsed = lines.withColumn("parsed", json_text.parse_object(F.col("line")))
    # Records are unfolded by generators, and a filter on their fields or on the status stays above those.
    # Pushed below, the filter would extract the record once more for every field it looks at.
    once = parsed.select(
        *kept, "line", F.col("parsed").isNull().alias("missing"), F.inline(F.array(_judged(F.col("parsed"), record))),
    )
    own = F.struct("flag_type", "ids_are_text", "corrupt", "record")
    line, missing = F.col("line"), F.col("missing")
    rejected = _status(own, min_dwell_ms, bot_pattern) != "emitted"
    more = F.when(missing, F.contains(line, F.lit("{"))).otherwise(~json_text.is_alone(line))
    found = F.when(rejected & more, F.coalesce(_framed(line, missing, record, min_dwell_ms, bot_pattern), own)).otherwise(own)
    flat = once.select(
        *kept, (json_text.stripped(line) == "").alias("blank"), F.xxhash64("line").alias("line_hash"), F.inline(F.array(found)),
    ).select(*kept, "blank", "line_hash", "flag_type", "ids_are_text", "corrupt", "record.*")
    flat = flat.withColumn("is_bot_flag", json_text.truthy(F.col("is_bot_flag"), F.col("flag_type")))
    if "timestamp" in record.names:
        flat = flat.withColumn("ts", F.try_to_timestamp(F.col("timestamp")))
    if "event_order" in record.names:
        flat = flat.withColumn("event_order", F.coalesce("event_order", "line_hash"))
    status = F.when(F.col("blank"), "blank").otherwise(
        disposition(F.col("corrupt"), F.col("ids_are_text"), min_dwell_ms, bot_pattern)
    )
    columns = [c for c in schemas.EVENT_COLUMNS[:-1] if c in flat.columns]
    return flat.select(*kept, *columns, status.alias("status"))


def read_events(spark: SparkSession, path: str | list[str], spanning: bool = False, **options) -> DataFrame:
    """Typed events of a log with an object per line, or with ``spanning`` with objects that may span lines."""
    lines = spanning_lines(spark, path) if spanning else read_lines(spark, path)
    return type_events(lines, **options)

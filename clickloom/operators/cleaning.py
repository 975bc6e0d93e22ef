"""Disposition of log records and its counters."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom.functions import rules

# Counter name of each disposition, in report order.
COUNTERS = {
    "corrupt": "records_corrupt",
    "invalid": "records_invalid_action",
    "bot": "records_bot",
    "emitted": "records_emitted",
}


def disposition(
    corrupt: Column,
    ids_are_text: Column,
    min_dwell_ms: int = C.MIN_DWELL_MS,
    bot_pattern: str | None = None,
    record: Column | None = None,
    flag: Column | None = None,
) -> Column:
    """First of corrupt, invalid, bot, emitted that applies to a typed record.

    The record is a row's columns or, if given, a struct with its bot flag as truth value.
    """
    field = F.col if record is None else record.getField
    action = field("action")
    valid = ids_are_text & action.isin(C.ACTIONS) & ~rules.too_short(
        action, field("payload")["dwell_time_ms"], min_dwell_ms
    )
    bot = rules.is_bot(F.col("is_bot_flag") if flag is None else flag, field("client")["user_agent"], bot_pattern)
    return (
        F.when(corrupt, "corrupt")
        .when(~F.coalesce(valid, F.lit(False)), "invalid")
        .when(bot, "bot")
        .otherwise("emitted")
    )


def emitted(events: DataFrame) -> DataFrame:
    return events.where(F.col("status") == "emitted")


def counter_columns() -> list[Column]:
    """One count per counter; usable in ``agg`` and in ``observe``."""
    counts = [F.count(F.lit(1)).alias("records_in")]
    return counts + [F.count_if(F.col("status") == s).alias(name) for s, name in COUNTERS.items()]


def counters(events: DataFrame) -> DataFrame:
    """Rows (counter, n). Blank lines count as read and nothing else."""
    names = ["records_in", *COUNTERS.values()]
    return events.agg(*counter_columns()).unpivot([], names, "counter", "n")

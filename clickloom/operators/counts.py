"""Action counts per user."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom.operators.cleaning import emitted


def _per_user(events: DataFrame) -> DataFrame:
    """One row per user with a counter for each action.

    The set of actions is fixed, so counters sit side by side in one hash aggregate: a user costs one
    row per map task, whatever share of the log is theirs, and the total needs no second pass.
    """
    tallies = [F.count_if(F.col("action") == a).alias(a) for a in C.ACTIONS]
    return emitted(events).groupBy("user_id").agg(*tallies, F.count(F.lit(1)).alias(C.TOTAL_ACTION))


def _entry(action: str) -> Column:
    return F.struct(F.lit(action).alias("action"), F.col(action).alias("cnt"))


def action_counts(events: DataFrame) -> DataFrame:
    """(user_id, action, cnt) for every action a user has, plus a total row."""
    entries = F.array(*[_entry(a) for a in [*C.ACTIONS, C.TOTAL_ACTION]])
    return _per_user(events).select("user_id", F.inline(entries)).where(F.col("cnt") > 0)


def user_action_pivot(events: DataFrame) -> DataFrame:
    """Pivot straight from events, without the count table in between."""
    columns = [F.col(a).alias(f"n_{a}") for a in C.PIVOT_ACTIONS]
    return _per_user(events).select("user_id", *columns, F.col(C.TOTAL_ACTION).alias("total_actions"))


def reduce_tuples(tuples: DataFrame) -> DataFrame:
    """Sum (user_id, action, cnt) tuples of any origin and add the total row of each user.

    Actions are open here. Tuples are summed first; then a user has one row per action, and these come together for
    the total, which leaves the result partitioned by user.
    """
    summed = tuples.groupBy("user_id", "action").agg(F.sum("cnt").alias("cnt"))
    by_user = Window.partitionBy("user_id")
    first = F.row_number().over(by_user.orderBy("action")) == 1
    own = F.struct("action", "cnt")
    total = F.when(F.col("first"), F.struct(F.lit(C.TOTAL_ACTION).alias("action"), F.col("total").alias("cnt")))
    both = summed.withColumns({"first": first, "total": F.sum("cnt").over(by_user)})
    return both.select("user_id", F.inline(F.filter(F.array(own, total), lambda e: e.isNotNull())))


def pivot_counts(counts: DataFrame) -> DataFrame:
    """Pivot of a stored count table; absent actions are 0."""

    def total(action: str) -> Column:
        return F.sum(F.when(F.col("action") == action, F.col("cnt")).otherwise(0))

    columns = [total(a).alias(f"n_{a}") for a in C.PIVOT_ACTIONS]
    return counts.groupBy("user_id").agg(*columns, total(C.TOTAL_ACTION).alias("total_actions"))

"""Business rules as column expressions."""

from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickloom import constants as C


def contains_any(text: Column, terms: list[str]) -> Column:
    """Whether a text holds one of the terms, whatever its case; a missing text holds none.

    Byte search per term is several times faster than one regular expression over all of them.
    """
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return reduce(or_, [F.contains(lowered, F.lit(term)) for term in terms])


def is_bot(flag: Column, agent: Column, pattern: str | None = None) -> Column:
    """Flagged, or named by the agent: a bot term, or a match of ``pattern`` if one is given."""
    if pattern is None:
        named = contains_any(agent, C.BOT_AGENT_TERMS)
    else:
        named = F.coalesce(agent, F.lit("")).rlike(f"(?i)({pattern})")
    return F.coalesce(flag, F.lit(False)) | named


def too_short(action: Column, dwell_ms: Column, minimum: int = C.MIN_DWELL_MS) -> Column:
    """Dwell time below the minimum, for the checked actions only; a missing dwell time passes."""
    return action.isin(C.DWELL_CHECKED_ACTIONS) & F.coalesce(dwell_ms < minimum, F.lit(False))


def is_professional_search(action: Column, query: Column) -> Column:
    return (action == "search") & contains_any(query, C.PROFESSIONAL_TERMS)


def is_deep_click(action: Column, dwell_ms: Column) -> Column:
    return (action == "click") & F.coalesce(dwell_ms > C.DEEP_CLICK_MS, F.lit(False))


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """Double ratio, 0 where the denominator is not positive."""
    safe = F.when(denominator > 0, denominator.cast("double"))
    return F.coalesce(numerator.cast("double") / safe, F.lit(0.0))


def high_value(searches: Column, messages: Column, mean_minutes: Column) -> Column:
    met = (
        (searches >= C.LABEL_MIN_SEARCHES)
        & (messages >= C.LABEL_MIN_MESSAGES)
        & (mean_minutes >= C.LABEL_MIN_MINUTES)
    )
    return F.when(met, 1).otherwise(0)


def majority(votes: list[Column]) -> Column:
    """1 when strictly more than half of the 0/1 votes are 1; ties give 0."""
    return F.when(reduce(add, votes) > len(votes) / 2, 1.0).otherwise(0.0)


def archetype(cluster: Column, names: dict[int, str] | None = None) -> Column:
    """Cluster name from a small parameter table; unnamed clusters become ``Segment-<id>``."""
    pairs = (C.ARCHETYPES if names is None else names).items()
    fallback = F.concat(F.lit("Segment-"), cluster.cast("string"))
    return reduce(lambda named, pair: F.when(cluster == pair[0], pair[1]).otherwise(named), pairs, fallback)


def label_name(label: Column) -> Column:
    named = F.lit("unknown")
    for value, name in C.LABEL_NAMES.items():
        named = F.when(label == value, name).otherwise(named)
    return named


def in_training_set(user_id: Column, fraction: float = C.TRAIN_FRACTION) -> Column:
    """Split by the first hash byte of the id: the same whatever the partitioning, rerun or file order."""
    return F.substring(F.md5(user_id), 1, 2) < F.lit(f"{round(256 * fraction):02x}")

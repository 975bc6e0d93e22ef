"""Interaction audit of document filters: what each one removes at each step of every order.

A document is reduced to a mask with a bit for each filter that it fails, and the table to cells: counts of
documents by part and mask. From then on nothing grows with the documents. A recursive CTE starts with the empty prefix
of each part and extends prefixes by the letters that they lack; it joins the part's cells, carries the bits applied
so far, and each level of the recursion emits the metrics of that step.
"""

import math
from collections.abc import Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.llm import workspace

#: Filters, in the order of their bits.
LETTERS = "ABCDE"
#: Fewer words, a smaller percentage of different words or a larger one of capitals than these fail.
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 100, 80, 10
#: Characters that a text must not hold.
MARKS = "#$%&*|"

_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def failures(text: Column) -> list[Column]:
    """Whether a text has too few words, repeats them too often, has too many capitals, or holds a mark.

    Words are runs without ASCII white space, case counts, and lengths are in code points. A null text is empty.
    """
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return [
        F.size(words) < MIN_WORDS,
        100 * F.size(F.array_distinct(words)) < MIN_DISTINCT * F.size(words),
        100 * capitals > MAX_CAPITALS * F.length(text),
        text.rlike("[" + MARKS + "]"),
    ]


def cells(docs: DataFrame, labels: DataFrame, part: str = "lang", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and by the filters they fail, with those of good quality and the toxic ones.

    The last bit marks a text that a smaller id has too, anywhere in the table; a document without an id never does
    and marks no other. A null part is the empty one, a null text is empty. A document is good or toxic if any of its labels says so.
    Repeated rows count each. Texts stay where they are read: what is shuffled is a digest and counts, and rows
    of the same text are combined before they meet, so a text may be any share of the table.
    """
    mask = sum((F.when(fails, 1 << bit).otherwise(0) for bit, fails in enumerate(failures(F.col(text)))), F.lit(0))
    rows = docs.select(
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(doc_id).alias("doc_id"),
        F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)).alias("digest"), mask.alias("mask"),
    ).groupBy("digest", "part", "mask", "doc_id").agg(F.count("*").alias("n"))
    marked = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("labelled")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    joined = rows.join(marked, rows["doc_id"] == marked["labelled"], "left").drop("labelled").fillna(False, ["good", "toxic"])
    # One row per text, part and labels, with the smallest id and how often it occurs there.
    kinds = joined.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
    )
    # A text has as many of these rows as there are parts and kinds of labels.
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    spared = F.col("nameless") + F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(0)
    split = kinds.withColumn("spared", spared).withColumn("sides", F.array(
        F.struct(F.col("mask"), F.col("spared").alias("n")),
        F.struct(F.col("mask").bitwiseOR(F.lit(1 << (len(LETTERS) - 1))).alias("mask"), (F.col("n") - F.col("spared")).alias("n")),
    )).select("part", "good", "toxic", F.inline("sides")).where("n > 0")
    return split.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


#: Metrics of a step: what is summed, over the cells for which a condition holds.
_METRICS: Mapping[str, tuple[str, str]] = {
    "kept": ("n", "c.mask & (w.applied | l.bit) = 0"),
    "removed": ("n", "c.mask & l.bit <> 0 AND c.mask & w.applied = 0"),
    "redundant": ("n", "c.mask & l.bit <> 0 AND c.mask & w.applied <> 0"),
    "unique_fails": ("n", "c.mask = l.bit"),
    "good_lost": ("good", "c.mask & l.bit <> 0 AND c.mask & w.applied = 0"),
    "toxic_lost": ("toxic", "c.mask & l.bit <> 0 AND c.mask & w.applied = 0"),
}


@contextmanager
def _any_number_of_rows(spark: SparkSession):
    """Recursion without a bound on its rows; they grow with the number of parts."""
    before = spark.conf.get(_ROW_LIMIT)
    spark.conf.set(_ROW_LIMIT, "-1")
    try:
        yield
    finally:
        spark.conf.set(_ROW_LIMIT, before)


def prefixes(counted: DataFrame, letters: str = LETTERS) -> DataFrame:
    """(part, prefix, step, metrics) of every sequence of different letters; bit i of a mask is the i-th letter."""
    parts = workspace.stage(
        counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")), "cells",
    )
    all_letters = ", ".join(f"named_struct('letter', '{x}', 'bit', {1 << i})" for i, x in enumerate(letters))
    metrics = ", ".join(
        f"aggregate(p.cells, 0L, (s, c) -> s + IF({condition}, c.{what}, 0L)) AS {name}"
        for name, (what, condition) in _METRICS.items()
    )
    zeros = ", ".join("0L" for _ in _METRICS)
    walked = counted.sparkSession.sql(f"""
        WITH RECURSIVE walk (part, prefix, applied, step, {", ".join(_METRICS)}) AS (
          SELECT part, '', 0, 0, {zeros} FROM {{parts}}
          UNION ALL
          SELECT w.part, concat(w.prefix, l.letter), w.applied | l.bit, w.step + 1, {metrics}
          FROM walk w JOIN {{parts}} p ON p.part = w.part
            LATERAL VIEW inline(filter(array({all_letters}), x -> x.bit & w.applied = 0)) l AS letter, bit
        )
        SELECT part, prefix, step, {", ".join(_METRICS)} FROM walk WHERE step > 0
    """, parts=parts)
    with _any_number_of_rows(counted.sparkSession):
        return workspace.stage(walked, "prefixes")


def audit(counted: DataFrame, letters: str = LETTERS) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley), long counts.

    One row per part, order of all letters and step, whose filter is the order's letter at that place. Metrics are of the
    documents of the part: ``kept`` after the step, ``removed`` in it, ``redundant`` failed its filter and were
    removed before, ``unique_fails`` fail its filter alone. ``shapley`` is what its filter removes, summed over all orders.
    Every part has all rows, with zeros where nothing happens; an empty table has none.
    """
    found = prefixes(counted, letters)
    # A prefix begins as many orders as there are arrangements of the letters it lacks.
    orders = F.element_at(F.array(*[F.lit(math.factorial(len(letters) - s)).cast("long") for s in range(1, len(letters) + 1)]), F.col("step"))
    credit = found.groupBy("part", F.right("prefix", F.lit(1)).alias("letter")).agg(F.sum(F.col("removed") * orders).alias("shapley"))
    whole = found.where(F.col("step") == len(letters)).select("part", F.col("prefix").alias("filter_order"))
    steps = whole.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))))
    steps = steps.withColumn("prefix", F.substring("filter_order", F.lit(1), F.col("step")))
    return steps.join(found.drop("step"), ["part", "prefix"]).withColumn("letter", F.right("prefix", F.lit(1))).join(
        credit, ["part", "letter"],
    ).select("part", "filter_order", "step", *_METRICS, "shapley")

import itertools
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickloom.llm import filter_audit

from .conftest import prose


def mask(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    fails = [
        len(words) < 100, 100 * len(set(words)) < 80 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 10 * len(text), bool(re.search(r"[#$%&*|]", text)),
    ]
    return sum(f << i for i, f in enumerate(fails))


def brute(docs, labels):
    """Every order applied to every document, one after the other."""
    good, toxic = {d for d, q, _ in labels if q == 1} - {None}, {d for d, _, t in labels if t == 1} - {None}
    judged = []
    for doc, text, part in docs:
        copy = any(other < doc for other, t, _ in docs if other is not None and doc is not None and (t or "") == (text or ""))
        judged.append((part or "", doc, mask(text) | 16 * copy))
    rows = {}
    for part in {p for p, _, _ in judged}:
        for order in map("".join, itertools.permutations("ABCDE")):
            left = [(d, m) for p, d, m in judged if p == part]
            gone = []
            for step, letter in enumerate(order, 1):
                bit = 1 << "ABCDE".index(letter)
                lost = [(d, m) for d, m in left if m & bit]
                redundant = sum(bool(m & bit) for _, m in gone)
                left = [(d, m) for d, m in left if not m & bit]
                gone += lost
                alone = sum(m == bit for p, _, m in judged if p == part)
                rows[part, order, step] = [len(left), len(lost), redundant, alone, sum(d in good for d, _ in lost), sum(d in toxic for d, _ in lost)]
    shapley = Counter()
    for (part, order, step), metrics in rows.items():
        shapley[part, order[step - 1]] += metrics[1]
    return sorted((*key, *metrics, shapley[key[0], key[1][key[2] - 1]]) for key, metrics in rows.items())


def found(spark, docs, labels):
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return sorted(tuple(r) for r in filter_audit.audit(filter_audit.cells(table, marked)).collect())


def test_as_brute_force(spark):
    """Texts that fail any filters, copies across parts, null and repeated ids, null and empty texts, repeated labels."""
    many = " ".join(f"w{n}" for n in range(120))
    texts = [many, many + " #", many.upper(), "short", "SHORT #", prose(1, 300), "x " * 120, "Á " + many, None, "", "a" * 9 + "B", "a" * 8 + "BC", many + "\x0bend"]
    docs = [(n, t, ("en", "de", None, "")[n % 4]) for n, t in enumerate(texts * 3)]
    docs += [(None, many, "en"), (None, None, "fr"), (0, many, "en"), (0, many, "en"), (0, "other", "en"), (5, texts[5], "de"), (7, prose(3, 20_000), "xx")]
    labels = [(n, n % 2, int(n % 5 == 0)) for n in range(30)] + [(3, 0, 1), (3, None, None), (None, 1, 1), (999, 1, 1)]
    assert found(spark, docs, labels) == brute(docs, labels)


def test_distinct_share_and_capitals_at_the_limits(spark):
    rows = [("a b c d e", False, False), ("a a b c d", False, False), ("a a b c c", True, False), ("B" + "a" * 9, False, False), ("BB" + "a" * 9, False, True), ("", False, False)]
    table = spark.createDataFrame([(t,) for t, _, _ in rows], "text string")
    got = table.select("text", *[f.alias(f"f{i}") for i, f in enumerate(filter_audit.failures(F.col("text")))]).collect()
    assert [(r.text, r.f1, r.f2) for r in got] == rows
    assert all(r.f0 for r in got)


def test_without_rows(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert found(spark, [], []) == []
    docs = edge_docs.withColumnRenamed("source", "lang").withColumns({c: F.lit("x") for c in ("digest", "mask", "n", "first", "good", "toxic", "part", "cells")})
    rows = filter_audit.audit(filter_audit.cells(docs, none.withColumn("part", F.lit("x")))).collect()
    assert sorted(tuple(r) for r in rows) == brute([(r.doc_id, r.text, r.lang) for r in docs.collect()], [])


@pytest.mark.parametrize("letters", ["A", "XYZ"])
def test_other_numbers_of_filters(spark, letters):
    counted = spark.createDataFrame([("p", 1, 3, 1, 0), ("p", 0, 2, 2, 2)], "part string, mask int, n long, good long, toxic long")
    rows = filter_audit.audit(counted, letters).collect()
    orders = list(itertools.permutations(letters))
    assert len(rows) == len(orders) * len(letters)
    assert all(r.removed == (3 if r.filter_order[r.step - 1] == letters[0] else 0) for r in rows)
    assert {r.shapley for r in rows if r.filter_order[r.step - 1] == letters[0]} == {3 * len(orders)}

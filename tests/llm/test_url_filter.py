import math
import re
from collections import Counter

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from clickloom.llm import queries, url_filter
from clickloom.llm.queries import URL_RULES

URLS = [
    (1, "https://A.Example.NET/en/x?q=1#t", "a.example.net", "/en/x", "example.net/en/", "allow"),
    (2, "http://example.net", "example.net", "", None, None),
    (3, "http://example.net/", "example.net", "/", "net/", "block"),
    (4, "http://badexample.com/de/1", "badexample.com", "/de/1", None, None),
    (5, "http://x.example.com/de/1", "x.example.com", "/de/1", "example.com/de/", "block"),
    (6, "http://org/fr/", "org", "/fr/", "org/fr/", "allow"),
    (7, "ftp://a.org/FR/", "a.org", "/FR/", None, None),
    (8, "no scheme.net/", "", "", None, None),
    (9, None, "", "", None, None),
    (10, "", "", "", None, None),
    (11, "http://h.net?x=/y://z", "h.net", "", None, None),
    (12, "x://ÀB.net/a\nb?c", "Àb.net", "/a\nb", "net/", "block"),
    (12, "x://ÀB.net/a\nb?c", "Àb.net", "/a\nb", "net/", "block"),
    (13, "://net/" + "9" * 20_000, "net", "/" + "9" * 20_000, "net/", "block"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(i, u, "h", 1.0) for i, u, *_ in URLS], "page_id long, url string, host string, score double")


def test_rules(pages):
    for constant, own in ((1.0, "block"), (0.0, "allow")):
        found = url_filter.judge(pages, URL_RULES, url_filter.Model(constant)).collect()
        got = sorted((r.page_id, r.host, r.path, str(r.rule), r.verdict) for r in found)
        assert got == sorted((i, h, p, str(rule), v or own) for i, _, h, p, rule, v in URLS)


def test_no_rules_and_no_rows(pages):
    assert {r.rule for r in url_filter.judge(pages, {}, url_filter.Model(1.0)).collect()} == {None}
    assert url_filter.judge(pages.where("false"), URL_RULES, url_filter.Model(1.0)).count() == 0


def test_entropy_and_counts(spark):
    row = url_filter.lexical(spark.createDataFrame([("http://ab.c/d/e?x=1&y=2",)], "url string")).first()
    assert (row.f_depth, row.f_parameters, row.f_labels, row.suffix_1, row.suffix_2) == (2, 2, 2, "c", "ab.c")
    assert spark.range(1).select(url_filter._entropy(F.lit("aabb"))).first()[0] == 1.0


def test_trees_learn_what_no_rule_says(spark):
    rows = [(f"http://site{i % 7}.com/{'9' * 12 if i % 2 else 'word'}/{i}", i % 2) for i in range(400)]
    labelled = spark.createDataFrame(rows[:300] + [("http://x.com/", None)], "url string, label int")
    model = url_filter.fit(labelled)
    rest = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows[300:])], "page_id long, url string")
    found = {r.page_id: r.verdict for r in url_filter.judge(rest, {}, model).collect()}
    right = [found[i] == ("block" if label else "allow") for i, (_, label) in enumerate(rows[300:])]
    assert sum(right) / len(right) > 0.95


@pytest.mark.parametrize("labels,constant", [([], 0.0), ([("http://a.b/", 1)], 1.0), ([("http://a.b/", 0), (None, 0)], 0.0)])
def test_too_few_labels(spark, labels, constant):
    assert url_filter.fit(spark.createDataFrame(labels, "url string, label int")).constant == constant


def test_counts_of_all_labelled_urls(spark):
    """Suffixes outside the sample are counted, and neither a hot URL nor a rare class is lost to it."""
    rows = [("http://hot.com/", 1)] * 200 + [(f"http://b{i}.com/{i}", 1) for i in range(50)] + [("http://rare.org/", 0)] * 2
    model = url_filter.fit(spark.createDataFrame(rows, "url string, label int"), sample_rows=10)
    assert model.trees is not None
    times = {r.suffix_2: round(math.expm1(r.f_times_2)) for r in model.suffixes[1].collect()}
    assert times == {"hot.com": 200, "rare.org": 2, **{f"b{i}.com": 1 for i in range(50)}}


# The query in plain Python, but for the walk down the trees.


def parts(url):
    rest = (url or "").split("://", 1)
    if len(rest) < 2:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest[1]).groups()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), path


def rule(url):
    host, path = parts(url)
    fitting = [r for r in URL_RULES for own, _, rest in [r.partition("/")]
               if (host == own or host.endswith("." + own)) and path.startswith("/" + rest)]
    return max(fitting, key=len, default=None)


def entropy(text):
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def share(text, kept):
    return len(re.findall(f"[{kept}]", text)) / max(len(text), 1)


def suffixes(url):
    labels = parts(url)[0].split(".")
    return [(n, ".".join(labels[-n:])) for n in (1, 2)]


def described(url, blocked, seen):
    (host, path), text = parts(url), url or ""
    query = re.search(r"\?([^#]*)", text)
    found = [
        len(text), len(host), len(path), path.count("/"), share(text, "0-9"), share(host, "0-9"), share(text, "A-Za-z"), entropy(text),
        entropy(host), query.group(1).count("=") if query else 0, host.count(".") + 1, host.count("-"), text.startswith("https"), "#" in text,
    ]
    for suffix in suffixes(url):
        n = seen[suffix]
        found += [(blocked[suffix] + 1) / (n + 2) if n else 0.5, math.log1p(n)]
    return [float(x) for x in found]


def judged(urls, trees):
    """(rule, verdict, score) of each URL."""
    blocked, seen = Counter(), Counter()
    for url in urls:
        if rule(url):
            for suffix in suffixes(url):
                seen[suffix] += 1
                blocked[suffix] += URL_RULES[rule(url)] == "block"
    scores = {u: float(trees.predictProbability(Vectors.dense(described(u, blocked, seen)))[1]) for u in set(urls)}
    return [(rule(u), URL_RULES[rule(u)] if rule(u) else "block" if scores[u] >= 0.5 else "allow", scores[u]) for u in urls]


def test_query_equals_plain_form(spark, small, monkeypatch):
    """Every row of the pages: features, suffix counts over all labelled URLs, rules and verdicts."""
    models, fit = [], url_filter.fit
    monkeypatch.setattr(url_filter, "fit", lambda *args: models.append(fit(*args)) or models[-1])
    pages = queries.table(spark, small, "pages").select("page_id", "url").collect()
    found = {r.page_id: r for r in queries.QUERIES["op2_boosted_url_filter"](spark, small).collect()}
    assert len(found) == len(pages)
    for page, (name, verdict, score) in zip(pages, judged([p.url for p in pages], models[0].trees), strict=True):
        row = found[page.page_id]
        assert (row.host, row.path, row.rule, row.verdict) == (*parts(page.url), name, verdict)
        assert row.score == pytest.approx(score, abs=1e-9)
    assert {r.verdict for r in found.values() if r.rule is None} == {"block", "allow"}

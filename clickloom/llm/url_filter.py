"""URL verdicts: rules on host and path, and gradient-boosted trees on lexical features where no rule fits."""

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm import workspace

#: Different labelled URLs that the trees are fitted on at most, half of them of each class.
SAMPLE_ROWS = 20_000
TREES, DEPTH = 20, 4

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """Host, with A-Z in lower case, and path; both empty without ``://`` or for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _UPPER.lower()), path


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, else null. A rule is a host, which stands for its subdomains too, and a path."""
    fits = []
    for rule in sorted(rules, key=len, reverse=True):
        name, slash, rest = rule.partition("/")
        fits.append(F.when(((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest), F.lit(rule)))
    return F.coalesce(*fits, F.lit(None).cast("string"))


def _ratio(text: Column, kept: str) -> Column:
    """Share of the characters of ``text`` that the class keeps."""
    return F.length(F.regexp_replace(text, f"[^{kept}]", "")) / F.greatest(F.length(text), F.lit(1))


def _entropy(text: Column) -> Column:
    """Bits per character."""
    share = lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / F.length(text)
    letters = F.filter(F.array_distinct(F.split(text, "")), lambda c: c != "")
    return F.aggregate(letters, F.lit(0.0), lambda sum_, c: sum_ - share(c) * F.log2(share(c)))


def lexical(urls: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` with lexical features under ``f_`` names and the suffixes of the host; null counts as empty."""
    text = F.coalesce(F.col(url), F.lit(""))
    host, path = host_and_path(url)
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    return urls.withColumns({
        "f_length": F.length(text), "f_host_length": F.length(host), "f_path_length": F.length(path),
        "f_depth": F.length(F.regexp_replace(path, "[^/]", "")), "f_digits": _ratio(text, "0-9"), "f_host_digits": _ratio(host, "0-9"),
        "f_letters": _ratio(text, "A-Za-z"), "f_entropy": _entropy(text), "f_host_entropy": _entropy(host),
        "f_parameters": F.length(F.regexp_replace(query, "[^=]", "")), "f_labels": F.size(F.split(host, r"\.")),
        "f_hyphens": F.length(F.regexp_replace(host, "[^-]", "")), "f_secure": text.startswith("https").cast("int"),
        "f_fragment": text.contains("#").cast("int"),
        "suffix_1": F.substring_index(host, ".", -1), "suffix_2": F.substring_index(host, ".", -2),
    })


LEXICAL = ["f_length", "f_host_length", "f_path_length", "f_depth", "f_digits", "f_host_digits", "f_letters", "f_entropy",
           "f_host_entropy", "f_parameters", "f_labels", "f_hyphens", "f_secure", "f_fragment"]
SUFFIX = ["f_rate_1", "f_times_1", "f_rate_2", "f_times_2"]


@dataclass
class Model:
    """Trees with the suffix statistics of all labelled URLs, or a constant score."""

    constant: float | None
    trees: GBTClassificationModel | None = None
    suffixes: tuple[DataFrame, DataFrame] | None = None


def _with_suffixes(rows: DataFrame, suffixes: tuple[DataFrame, DataFrame]) -> DataFrame:
    """Add how often a suffix was blocked and how often it was seen; an unknown one has rate 1/2."""
    for number, table in enumerate(suffixes, start=1):
        rows = rows.join(table, f"suffix_{number}", "left").withColumns({
            f"f_rate_{number}": F.coalesce(f"f_rate_{number}", F.lit(0.5)), f"f_times_{number}": F.coalesce(f"f_times_{number}", F.lit(0.0)),
        })
    return VectorAssembler(inputCols=[*LEXICAL, *SUFFIX], outputCol="f_vector").transform(rows)


def fit(labelled: DataFrame, url: str = "url", label: str = "label", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Trees from URLs with label 1 (block) or 0 (allow); other labels are ignored.

    Suffixes are counted over all rows. The sample takes ``sample_rows`` different URLs at most, up to half of them of each
    class, least hash first; weights restore how many rows each class has. Without labels the score is 0, with one class
    only it is that class.
    """
    known = labelled.select(F.col(url).alias("url"), F.col(label).cast("double").alias("label")).where("label in (0, 1)")
    counted = workspace.stage(known.groupBy("url", "label").agg(F.count("*").alias("times")), "labelled_urls")
    classes = {r.label: r.n for r in counted.groupBy("label").agg(F.sum("times").alias("n")).collect()}
    if len(classes) < 2:
        return Model(min(classes, default=0.0))
    whole = lexical(counted)
    suffixes = tuple(
        workspace.stage(whole.groupBy(f"suffix_{n}").agg(
            ((F.sum(F.col("label") * F.col("times")) + 1) / (F.sum("times") + 2)).alias(f"f_rate_{n}"),
            F.log1p(F.sum("times").cast("double")).alias(f"f_times_{n}"),
        ), "suffixes") for n in (1, 2)
    )
    sample = _sample(counted, 0.0, sample_rows // 2).unionByName(_sample(counted, 1.0, sample_rows // 2))
    rows = workspace.stage(lexical(sample), "sampled_urls")
    taken = {r.label: r.n for r in rows.groupBy("label").agg(F.sum("times").alias("n")).collect()}
    restored = F.when(F.col("label") == 1, classes[1.0] / taken[1.0]).otherwise(classes[0.0] / taken[0.0])
    weighted = _with_suffixes(rows, suffixes).select("f_vector", "label", (F.col("times") * restored).alias("weight"))
    trees = GBTClassifier(featuresCol="f_vector", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, seed=1)
    return Model(None, trees.fit(workspace.stage(weighted, "url_features").coalesce(4).cache()), suffixes)


def _sample(counted: DataFrame, label: float, size: int) -> DataFrame:
    """Different URLs of a class, least hash first."""
    return counted.where(F.col("label") == label).orderBy(F.xxhash64("url"), "url").limit(size)


def judge(urls: DataFrame, rules: dict[str, str], model: Model, row_id: str = "page_id", url: str = "url") -> DataFrame:
    """(row id, host, path, rule, verdict, score) per row; the rule's verdict, else block from a score of 0.5.

    Null URLs and those without ``://`` have no host, fit no rule and are judged by the model. Repeated rows are
    judged each; other columns are ignored.
    """
    rows = urls.select(F.col(row_id).alias(row_id), F.col(url).alias("url"))
    if model.trees is None:
        scored = rows.withColumn("score", F.lit(model.constant))
    else:
        probability = vector_to_array("probability")[1]
        scored = model.trees.transform(_with_suffixes(lexical(rows), model.suffixes)).withColumn("score", probability)
    host, path = host_and_path("url")
    verdicts = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair]) if rules else F.lit(None)
    named = scored.select(row_id, host.alias("host"), path.alias("path"), "score").withColumn(
        "rule", rule_of(F.col("host"), F.col("path"), rules),
    )
    own = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    given = F.element_at(verdicts, F.col("rule")) if rules else F.lit(None).cast("string")
    return named.select(row_id, "host", "path", "rule", F.coalesce(given, own).alias("verdict"), "score")

"""URL filter: allow and block rules first, gradient-boosted trees on lexical features for the rest.

Column functions and MLlib's DataFrame estimators only. The trees are trained on labelled URLs; where
no other labels are given, those are the URLs that a rule decides.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import LOWER, UPPER, seeded_sample, stored

#: The rules of the crawl.
RULES = (
    "allow org/",
    "block example.org/es/",
    "block example.org/en/1",
    "allow com/fr/",
    "block com/de/",
)
#: Labelled URLs that the trees are fitted on, at most, and the trees' shape.
TRAINING_ROWS = 10_000
TREES, DEPTH, SEED = 20, 4, 11
#: A suffix's share of blocked URLs is drawn towards the overall share by this many URLs.
PRIOR_URLS = 20.0
FEATURES = (
    "url_length", "host_length", "path_length", "host_depth", "path_depth", "digit_ratio",
    "entropy", "parameters", "hyphens", "suffix_share", "suffix_log_count", "ending_share",
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null url or one without `://`."""
    after = F.when(url.contains("://"), F.substring(url, F.locate("://", url) + 3, F.length(url)))
    rest = F.coalesce(after, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _parts(rule: str) -> tuple[str, str, str, str]:
    verdict, _, text = rule.partition(" ")
    host, slash, path = text.partition("/")
    return verdict, text, host, slash + path


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, or nulls; of equally long ones the last by text.

    A rule list is a parameter that people write; its length does not grow with the pages.
    """
    which, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for word, text, of_host, of_path in sorted(map(_parts, rules), key=lambda r: (len(r[1]), r[1])):
        fits = ((host == of_host) | host.endswith("." + of_host)) & path.startswith(of_path)
        which, verdict = F.when(fits, text).otherwise(which), F.when(fits, word).otherwise(verdict)
    return which, verdict


def by_rules(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, url, host, path, rule, by_rule (its verdict) of every page; nulls where no rule fits."""
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, by_rule = rule_columns(F.col("host"), F.col("path"), rules)
    return parsed.withColumns({"rule": rule, "by_rule": by_rule})


def _entropy(text: Column) -> Column:
    """Bits per character of the character distribution."""
    size = F.length(text).cast("double")
    count = lambda c: (size - F.length(F.replace(text, c, F.lit("")))) / size
    chars = F.array_distinct(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)))
    return F.aggregate(chars, F.lit(0.0), lambda total, c: total - count(c) * F.log2(count(c)))


def _occurrences(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def lexical(urls: DataFrame) -> DataFrame:
    """The features that a URL alone gives, for a frame with url, host and path."""
    url = F.coalesce(F.col("url"), F.lit(""))
    longest = F.greatest(F.length(url), F.lit(1))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    labels = F.split("host", r"\.")
    name = F.element_at(F.split("path", "/"), -1)
    return urls.withColumns(
        {
            "url_length": F.length(url),
            "host_length": F.length("host"),
            "path_length": F.length("path"),
            "host_depth": F.size(labels),
            "path_depth": _occurrences(F.col("path"), "/"),
            "digit_ratio": _occurrences(url, "0123456789") / longest,
            "entropy": _entropy(url),
            "parameters": F.when(query != "", _occurrences(query, "&") + 1).otherwise(0),
            "hyphens": _occurrences(F.col("host"), "-"),
            "suffix": F.element_at(labels, -1),
            "ending": F.when(name.contains("."), F.substring_index(name, ".", -1)).otherwise(""),
        }
    )


def _shares(labelled: DataFrame, key: str) -> DataFrame:
    overall = labelled.agg(F.avg("label").alias("overall"))
    share = (F.sum("label") + PRIOR_URLS * F.max("overall")) / (F.count("*") + PRIOR_URLS)
    return (
        labelled.crossJoin(F.broadcast(overall))  # one row
        .groupBy(key)
        .agg(share.alias(f"{key}_share"), F.log1p(F.count("*")).alias(f"{key}_log_count"))
    )


class UrlModel:
    """Trees with the suffix statistics of their training URLs; or a constant, without two classes."""

    def __init__(self, suffixes: DataFrame | None, endings: DataFrame | None, overall: float, trees):
        self.suffixes, self.endings, self.overall, self.trees = suffixes, endings, overall, trees

    def _features(self, urls: DataFrame) -> DataFrame:
        # Broadcast if Spark finds them small; adaptive execution splits a frequent suffix otherwise.
        joined = lexical(urls).join(self.suffixes, "suffix", "left").join(self.endings, "ending", "left")
        unknown = {"suffix_share": self.overall, "ending_share": self.overall, "suffix_log_count": 0.0}
        return joined.fillna(unknown)

    def blocked(self, urls: DataFrame) -> DataFrame:
        """`urls` with 1.0 or 0.0 in `prediction`."""
        if self.trees is None:
            return urls.withColumn("prediction", F.lit(float(self.overall >= 0.5)))
        return self.trees.transform(self._features(urls))


def fit(labelled: DataFrame, rows: int = TRAINING_ROWS) -> UrlModel:
    """Train on at most `rows` labelled URLs (url, host, path, label 1 for block), chosen by hash.

    A URL counts once, with its lowest label. Suffix statistics are over all labelled URLs, trees are
    fitted on the sample. Runs jobs. Without two classes the model is a constant: the one class there
    is, else allow.
    """
    once = labelled.groupBy("url", "host", "path").agg(F.min("label").alias("label"))
    every = stored(once, "labelled-urls")
    overall = every.agg(F.avg("label")).first()[0]
    if overall is None or overall in (0.0, 1.0):
        return UrlModel(None, None, overall or 0.0, None)
    sample = stored(seeded_sample(every, "url", rows, SEED), "urls")
    marked = lexical(every)
    suffixes = stored(_shares(marked, "suffix"), "suffixes")
    endings = stored(_shares(marked, "ending"), "endings").drop("ending_log_count")
    model = UrlModel(suffixes, endings, overall, None)
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, checkpointInterval=-1)
    fitted: GBTClassificationModel = trees.fit(vectors.transform(model._features(sample)))
    model.trees = PipelineModel([vectors, fitted])
    return model


def judge(pages: DataFrame, rules=RULES, labelled: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict (allow or block) of every page.

    `labelled` (url, label) are the training URLs; without it the pages that a rule decides are. Null
    and empty urls have an empty host and path and are judged by the trees like all others. Repeated
    rows are judged alike; other columns are not read.
    """
    ruled = by_rules(pages, rules)
    host, path = host_and_path(F.col("url"))
    if labelled is None:
        known = ruled.filter("rule IS NOT NULL").withColumn("label", (F.col("by_rule") == "block").cast("double"))
    else:
        known = labelled.select("url", host.alias("host"), path.alias("path"), F.col("label").cast("double"))
    scored = fit(known).blocked(ruled)
    by_trees = F.when(F.col("prediction") == 1.0, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("by_rule", by_trees).alias("verdict"))

"""URL filters: rules by host and path, and gradient-boosted trees on lexical features for the rest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let, named
from .common import ascii_lower, free_name, saved

MAX_LABELLED = 20_000
TREES, DEPTH = 20, 3
PRIOR_WEIGHT = 20.0
# Words in a host that mark a URL as blocked when no labels are at hand.
BLOCKED_WORDS = (
    "adult", "ads", "bet", "bets", "betting", "casino", "loan", "loans", "pills", "poker",
    "porn", "sex", "spam", "viagra", "warez", "win", "xxx",
)
_LEXICAL = (
    "url_chars", "host_chars", "labels", "longest_label", "hyphens", "host_digits",
    "depth", "path_chars", "digit_share", "parameters", "entropy",
)
_SUFFIXES = ("suffix1", "suffix2")


@dataclass(frozen=True)
class UrlRule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null URL or one without ``://``."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_of(host: Column, path: Column, rules: list[UrlRule]) -> Column:
    """struct<size, rule, verdict> of the longest rule that fits, or null.

    A rule fits its host and all subdomains where the path starts with the rule's. Of two equally
    long ones, the name that sorts last wins.
    """
    if not rules:
        return F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    fits = [
        F.when(
            ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
            F.struct(F.lit(len(r.name)).alias("size"), F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in rules
    ]
    return F.array_max(F.array(*fits))


def _entropy(text: Column) -> Column:
    """Bits per character of a text."""
    n = F.char_length(text)

    def part(c: Column) -> Column:
        share = (n - F.char_length(F.replace(text, c, F.lit("")))) / n
        return -share * F.log2(share)

    parts = F.transform(F.array_distinct(F.split(text, "")), part)
    return F.when(n > 0, F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)).otherwise(0.0)


def with_features(df: DataFrame) -> DataFrame:
    """The lexical features and host suffixes of (url, host, path, *)."""
    url, host, path = F.col("url"), F.col("host"), F.col("path")
    digits = F.char_length(F.regexp_replace(url, r"[^0-9]", ""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    labels = F.split(host, r"\.")
    return df.withColumns(
        {
            "url_chars": F.char_length(url),
            "host_chars": F.char_length(host),
            "labels": F.size(labels),
            "longest_label": F.array_max(F.transform(labels, lambda x: F.char_length(x))),
            "hyphens": F.char_length(F.regexp_replace(host, r"[^-]", "")),
            "host_digits": F.char_length(F.regexp_replace(host, r"[^0-9]", "")),
            "depth": F.size(F.filter(F.split(path, "/"), lambda x: x != "")),
            "path_chars": F.char_length(path),
            "digit_share": digits / F.greatest(F.char_length(url), F.lit(1)),
            "parameters": F.size(F.filter(F.split(query, "&"), lambda x: x != "")),
            "entropy": _entropy(url),
            "suffix1": F.substring_index(host, ".", -1),
            "suffix2": F.substring_index(host, ".", -2),
        }
    ).withColumns({c: F.col(c).cast("double") for c in _LEXICAL})


@dataclass
class UrlModel:
    """Trees, and how often labelled URLs of each host suffix are blocked. ``trees`` is None when
    the labels held one class, which is then ``prior``."""

    trees: GBTClassificationModel | None
    suffixes: DataFrame
    prior: float

    def probabilities(self, df: DataFrame) -> DataFrame:
        """The input (with url, host, path) and ``p``, the probability that a URL is to be blocked."""
        if self.trees is None:
            return df.withColumn("p", F.lit(self.prior))
        rows = _with_suffix_shares(with_features(df), self.suffixes, self.prior)
        scored = self.trees.transform(_assembled(rows))
        return scored.select(*df.columns, vector_to_array("probability")[1].alias("p"))


def _with_suffix_shares(df: DataFrame, suffixes: DataFrame, prior: float) -> DataFrame:
    # The table has at most two rows for each labelled URL, of which there are MAX_LABELLED.
    for c in _SUFFIXES:
        own = suffixes.where(F.col("kind") == c).select(F.col("suffix").alias(c), F.col("share").alias(f"{c}_share"))
        df = df.join(F.broadcast(own), c, "left").withColumn(
            f"{c}_share", F.coalesce(f"{c}_share", F.lit(prior))
        )
    return df


def _assembled(df: DataFrame) -> DataFrame:
    return VectorAssembler(
        inputCols=[*_LEXICAL, *[f"{c}_share" for c in _SUFFIXES]], outputCol="features"
    ).transform(df)


def labelled_by_words(pages: DataFrame, url: str = "url", words: tuple[str, ...] = BLOCKED_WORDS) -> DataFrame:
    """(url, label): 1 where a part of the host between dots and hyphens is one of ``words``, else 0."""
    source = pages.select(named(url).cast("string").alias("url"))
    host, _ = host_and_path(F.col("url"))
    hit = F.arrays_overlap(F.split(host, r"[.\-]"), F.array(*[F.lit(w) for w in words]))
    return source.where(host != "").select("url", hit.cast("int").alias("label"))


def train(labelled: DataFrame, max_labelled: int = MAX_LABELLED) -> UrlModel:
    """A model from (url, label), label 1 for blocked; other labels and null URLs are passed over.

    At most ``max_labelled`` distinct rows, those of the smallest hash, are used.
    """
    host, path = host_and_path(F.col("url"))
    sample = saved(
        labelled.where(F.col("label").isin(0, 1) & F.col("url").isNotNull())
        .select("url", F.col("label").cast("int").alias("label"))
        .distinct()
        .orderBy(F.xxhash64("url", "label"))
        .limit(max_labelled)
        .select("url", "label", host.alias("host"), path.alias("path")),
        "labelled-urls",
    )
    n, blocked = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    prior = blocked / n if n else 0.0
    featured = with_features(sample)
    counts = None
    for c in _SUFFIXES:
        part = featured.groupBy(F.lit(c).alias("kind"), F.col(c).alias("suffix")).agg(
            F.sum("label").alias("blocked"), F.count(F.lit(1)).alias("n")
        )
        counts = part if counts is None else counts.union(part)
    suffixes = saved(
        counts.select(
            "kind",
            "suffix",
            ((F.col("blocked") + F.lit(PRIOR_WEIGHT * prior)) / (F.col("n") + F.lit(PRIOR_WEIGHT))).alias("share"),
        ),
        "url-suffixes",
    )
    if blocked in (0, n):
        return UrlModel(None, suffixes, prior)
    rows = saved(
        _with_suffix_shares(featured.coalesce(4), suffixes, prior).select(
            F.col("label").cast("double").alias("label"), *_LEXICAL, *[f"{c}_share" for c in _SUFFIXES]
        ),
        "url-features",
    )
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7, cacheNodeIds=False).fit(_assembled(rows))
    return UrlModel(trees, suffixes, prior)


def judge_urls(pages: DataFrame, model: UrlModel, rules: list[UrlRule], url: str = "url") -> DataFrame:
    """The input and host, path, rule, verdict and p (under free names).

    The verdict is that of the longest rule that fits, else block where ``p``, the model's
    probability, is a half or more. A null URL has an empty host and path and is judged as an
    empty text; repeated rows are judged alike; an empty table gives an empty table.
    """
    host, path = host_and_path(F.col("url"))
    work = pages.select(
        F.struct(*[named(c) for c in pages.columns]).alias("row"),
        F.coalesce(named(url).cast("string"), F.lit("")).alias("url"),
    ).select("row", "url", host.alias("host"), path.alias("path"))
    scored = model.probabilities(work)
    fit = rule_of(F.col("host"), F.col("path"), rules)
    names = {c: free_name(pages, c) for c in ("host", "path", "rule", "verdict", "p")}
    return scored.withColumn("fit", fit).select(
        *[F.col("row").getField(c).alias(c) for c in pages.columns],
        F.col("host").alias(names["host"]),
        F.col("path").alias(names["path"]),
        F.col("fit.rule").alias(names["rule"]),
        F.coalesce(F.col("fit.verdict"), F.when(F.col("p") >= 0.5, "block").otherwise("allow")).alias(names["verdict"]),
        F.col("p").alias(names["p"]),
    )

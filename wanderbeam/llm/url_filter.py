"""URL verdicts: rules first, gradient-boosted trees on lexical features for the rest."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wanderbeam.llm.text import let, lower_ascii
from wanderbeam.operators.skew import lookup_join
from wanderbeam.session import materialise

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("org", "/", ALLOW),
    Rule("example.org", "/es/", BLOCK),
    Rule("example.org", "/en/1", BLOCK),
    Rule("com", "/fr/", ALLOW),
    Rule("com", "/de/", BLOCK),
)
NUMBERS = (
    "url_length", "host_length", "path_length", "depth", "host_labels", "digit_ratio", "host_digit_ratio",
    "entropy", "host_entropy", "parameters", "hyphens", "capitals", "longest_segment", "suffix1_rate", "suffix2_rate",
)


@dataclass(frozen=True)
class Bound:
    """Most training URLs of each verdict, taken in the order of a hash of the URL."""

    per_class: int = 10_000
    prior: float = 20.0
    trees: int = 20
    depth: int = 4
    seed: int = 7


def parsed(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``; both are empty without a ``://``."""
    text = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise("")
    return df.withColumn("host", lower_ascii(F.regexp_extract(rest, "^([^/?#]*)", 1))).withColumn(
        "path", F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    )


def rule_columns(rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits, NULL where none does; one CASE, no join."""
    name = verdict = None
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        fits = (F.col("host") == rule.host) | F.endswith(F.col("host"), F.lit("." + rule.host))
        fits &= F.startswith(F.col("path"), F.lit(rule.path))
        name = F.when(fits, rule.name) if name is None else name.when(fits, rule.name)
        verdict = F.when(fits, rule.verdict) if verdict is None else verdict.when(fits, rule.verdict)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, verdict)


def _entropy(text: Column) -> Column:
    """Bits per character, from the counts of the distinct ones."""

    def of(chars: Column) -> Column:
        n = F.size(chars)
        shares = F.transform(F.array_distinct(chars), lambda c: F.size(F.filter(chars, lambda x: x == c)) / n)
        return F.aggregate(shares, F.lit(0.0), lambda acc, p: acc - p * F.log2(p))

    return F.when(F.length(text) > 0, let(F.split(text, ""), of)).otherwise(0.0)


def _ratio(text: Column, pattern: str) -> Column:
    return F.when(F.length(text) > 0, F.regexp_count(text, F.lit(pattern)) / F.length(text)).otherwise(0.0)


def lexical(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds the numeric features of the URL, and its last one and two host labels."""
    df = parsed(df, url)
    text, host, path = F.coalesce(F.col(url), F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    labels = F.split(host, r"\.")
    return df.withColumns(
        {
            "url_length": F.length(text).cast("double"),
            "host_length": F.length(host).cast("double"),
            "path_length": F.length(path).cast("double"),
            "depth": F.size(segments).cast("double"),
            "host_labels": F.size(labels).cast("double"),
            "digit_ratio": _ratio(text, "[0-9]"),
            "host_digit_ratio": _ratio(host, "[0-9]"),
            "entropy": _entropy(text),
            "host_entropy": _entropy(host),
            "parameters": F.size(F.filter(F.split(query, "&"), lambda p: p != "")).cast("double"),
            "hyphens": F.regexp_count(text, F.lit("-")).cast("double"),
            "capitals": _ratio(text, "[A-Z]"),
            "longest_segment": F.coalesce(F.array_max(F.transform(segments, lambda s: F.length(s))), F.lit(0)).cast("double"),
            "suffix1": F.element_at(labels, -1),
            "suffix2": F.array_join(F.slice(labels, -F.least(F.size(labels), F.lit(2)), 2), "."),
        }
    )


@dataclass
class UrlModel:
    """Trees, the block rates of the host suffixes of all labelled URLs, and the overall rate."""

    trees: GBTClassificationModel | None
    rates: DataFrame | None
    overall: float

    def with_rates(self, df: DataFrame) -> DataFrame:
        """Adds the suffix statistics; they are broadcast only if they are measured to be small."""
        for name in ("suffix1", "suffix2"):
            side = self.rates.select(F.col("suffix").alias(name), F.col("rate").alias(f"{name}_rate"))
            df = lookup_join(df, side, name, "left").fillna(self.overall, [f"{name}_rate"])
        return df

    def scored(self, df: DataFrame, url: str = "url") -> DataFrame:
        """Adds ``block_score``, the probability of block; without trees it is the share of blocks."""
        if self.trees is None:
            return df.withColumn("block_score", F.lit(self.overall))
        ready = _vectors(self.with_rates(lexical(df, url)))
        scored = self.trees.transform(ready)
        return scored.select(*[F.col(f"`{c}`") for c in df.columns], vector_to_array("probability")[1].alias("block_score"))


def _vectors(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(NUMBERS), outputCol="__features").transform(df)


def fit_urls(labelled: DataFrame, bound: Bound = Bound()) -> UrlModel:
    """Trees from rows with ``url`` and ``label`` (1: block), a bounded sample of each label.

    A sampled row weighs as many as the distinct labelled URLs of its label that it stands for, so the shares of the labels
    are those of all labelled URLs, whatever their number. Suffixes are counted over all of them. NULL urls and other labels are left out. With one label only its
    share is every score.
    """
    usable = labelled.where(F.col("url").isNotNull() & F.col("label").isin(0, 1)).select("url", F.col("label").cast("int").alias("label")).distinct()
    usable = materialise(usable, "url-labelled")
    counts = dict(usable.groupBy("label").count().collect())
    total = sum(counts.values())
    overall = counts.get(1, 0) / total if total else 0.0
    if len(counts) < 2:
        return UrlModel(None, None, overall)
    order = F.xxhash64("url", F.lit(bound.seed))
    parts = [
        usable.where(F.col("label") == c).orderBy(order, "url").limit(bound.per_class).withColumn("weight", F.lit(n / min(n, bound.per_class)))
        for c, n in sorted(counts.items())
    ]
    sample = materialise(lexical(parts[0].union(parts[1])), "url-sample")
    suffixes = lexical(usable).select(F.explode(F.array_distinct(F.array("suffix1", "suffix2"))).alias("suffix"), "label")
    rate = (F.sum("label") + F.lit(bound.prior * overall)) / (F.count(F.lit(1)) + F.lit(bound.prior))
    model = UrlModel(None, materialise(suffixes.groupBy("suffix").agg(rate.alias("rate")), "url-suffixes"), overall)
    ready = materialise(_vectors(model.with_rates(sample)).select("__features", "label", "weight").coalesce(4), "url-vectors")
    trees = GBTClassifier(
        featuresCol="__features", labelCol="label", weightCol="weight", maxIter=bound.trees, maxDepth=bound.depth, stepSize=0.3, seed=bound.seed
    )
    model.trees = trees.fit(ready)
    return model


def page_verdicts(pages: DataFrame, rules: Sequence[Rule] = RULES, bound: Bound = Bound(), threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict and block_score of every page.

    The labelled URLs to learn from are those that a rule decides; the trees extend them to the rest by
    what URLs look like. NULL urls and urls without ``://`` have an empty host and path, fit no rule and are
    judged by the trees; with no labelled URL all of them are allowed. Repeated rows are judged each;
    an empty table gives no rows.
    """
    name, verdict = rule_columns(rules)
    judged = parsed(pages.select("page_id", "url")).withColumn("rule", name).withColumn("__verdict", verdict)
    labelled = judged.where("__verdict is not null").select("url", (F.col("__verdict") == BLOCK).cast("int").alias("label"))
    model = fit_urls(labelled, bound)
    open_ones = F.when(F.col("block_score") >= threshold, BLOCK).otherwise(ALLOW)
    return model.scored(judged.select("page_id", "url", "rule", "__verdict")).transform(parsed).select(
        "page_id", "host", "path", "rule", F.coalesce("__verdict", open_ones).alias("verdict"), "block_score"
    )

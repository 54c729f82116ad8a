"""URL filters: host and path rules, and boosted trees on lexical features for URLs that no rule covers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pledgekit.operators.evaluation import auc_roc
from pledgekit.runtime import stage

#: About so many labelled URLs are used to grow trees; statistics of suffixes cover all labelled URLs.
FIT_ROWS = 20_000
ROUNDS, DEPTH, SEED = 12, 3, 42
#: Weight of the overall share in the share of a suffix.
PRIOR_WEIGHT = 20.0
#: Parts of the labelled URLs, by host; a labelled URL's statistics come from the other parts.
FOLDS = 5


@dataclass(frozen=True)
class UrlRule:
    """``place`` is a host and a path prefix; it fits the host and all its subdomains."""

    verdict: str
    place: str

    @property
    def host(self) -> str:
        return self.place.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.place.split("/", 1)[1]


# The rules.
RULES = (
    UrlRule("allow", "org/"),
    UrlRule("block", "example.org/es/"),
    UrlRule("block", "example.org/en/1"),
    UrlRule("allow", "com/fr/"),
    UrlRule("block", "com/de/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(rules: tuple[UrlRule, ...], host: str = "host", path: str = "path") -> tuple[Column, Column]:
    """Place and verdict of the longest rule that fits, null if none does; of equals the first given wins."""
    place, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # Later ones overrule, so the longest comes last, and of equals the first given.
    for rule in sorted(reversed(rules), key=lambda r: len(r.place)):
        at = (F.col(host) == rule.host) | F.col(host).endswith("." + rule.host)
        fits = at & F.col(path).startswith(rule.path)
        place = F.when(fits, F.lit(rule.place)).otherwise(place)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return place, verdict


def lexical_features(df: DataFrame, url: str = "url", host: str = "host", path: str = "path") -> DataFrame:
    """``df`` with lengths, depth, digit share, entropy and parameter counts of the URL, and its suffixes."""
    whole = F.coalesce(F.col(url), F.lit(""))
    size = F.length(whole)
    chars = F.array_distinct(F.split(whole, ""))
    # Share of each character from what the text loses without it.
    share = F.transform(
        F.filter(chars, lambda c: c != ""),
        lambda c: (size - F.length(F.replace(whole, c))) / size,
    )
    entropy = F.aggregate(share, F.lit(0.0), lambda total, p: total - p * F.log2(p))
    labels = F.split(F.col(host), r"\.")
    return df.withColumns(
        {
            "url_length": size.cast("double"),
            "host_length": F.length(host).cast("double"),
            "host_labels": F.size(labels).cast("double"),
            "depth": F.regexp_count(F.col(path), F.lit("/")).cast("double"),
            "digit_share": F.regexp_count(whole, F.lit("[0-9]")) / F.greatest(size, F.lit(1)),
            "host_digit_share": F.regexp_count(F.col(host), F.lit("[0-9]")) / F.greatest(F.length(host), F.lit(1)),
            "entropy": F.when(size > 0, entropy).otherwise(0.0),
            "n_params": F.regexp_count(whole, F.lit("[?&][^=&#]*=")).cast("double"),
            "n_hyphens": F.regexp_count(whole, F.lit("[-_%]")).cast("double"),
            "has_fragment": F.contains(whole, F.lit("#")).cast("double"),
            "suffix": F.substring_index(host, ".", -1),
            "domain": F.substring_index(host, ".", -2),
            "section": F.regexp_extract(F.col(path), "^/([^/0-9.]*)", 1),
        }
    )


SUFFIXES = ("suffix", "domain", "section")
FEATURES = (
    "url_length host_length host_labels depth digit_share host_digit_share entropy n_params n_hyphens has_fragment"
).split() + [f"{s}_share" for s in SUFFIXES]


def with_suffix_statistics(df: DataFrame, label: str = "blocked", fold: str = "fold") -> DataFrame:
    """``df`` with the smoothed share of blocked URLs per suffix, over all rows with a ``label``.

    A labelled row's own ``fold`` is left out of its shares, so its label is no part of its features. Counts are
    aggregated before the shuffle and joined by key, so neither a common nor many suffixes matter.
    """
    labelled = df.filter(F.col(label).isNotNull())
    overall = F.lit(labelled.agg(F.coalesce(F.avg(label), F.lit(0.0))).first()[0])
    parts = [F.col(fold) == f for f in range(FOLDS)]
    own = F.when(F.col(label).isNotNull(), F.col(fold))
    for name in SUFFIXES:
        counts = labelled.groupBy(F.col(name).alias("_member")).agg(
            F.count(F.lit(1)).alias("_n"),
            F.sum(label).alias("_blocked"),
            F.array(*[F.count_if(p) for p in parts]).alias("_ns"),
            F.array(*[F.sum(F.when(p, F.col(label)).otherwise(0.0)) for p in parts]).alias("_blockeds"),
        )
        df = df.join(counts, F.col(name) == F.col("_member"), "left")
        n = F.coalesce("_n", F.lit(0)) - F.coalesce(F.get("_ns", own), F.lit(0))
        blocked = F.coalesce("_blocked", F.lit(0.0)) - F.coalesce(F.get("_blockeds", own), F.lit(0.0))
        df = df.withColumn(f"{name}_share", (blocked + overall * PRIOR_WEIGHT) / (n + PRIOR_WEIGHT))
        df = df.drop("_member", "_n", "_blocked", "_ns", "_blockeds")
    return df


def url_features(df: DataFrame, url: str, key: str, rules: tuple[UrlRule, ...]) -> DataFrame:
    """Key, host, path, rule, its verdict, lexical features, fold, and ``blocked`` (1 or 0; null where no rule fits)."""
    base = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").alias("url"))
    placed = base.select("key", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    place, verdict = matching_rule(rules)
    ruled = placed.withColumns({"rule": place, "_verdict": verdict})
    features = lexical_features(ruled).drop("url").withColumn("blocked", (F.col("_verdict") == "block").cast("double"))
    return features.withColumn("fold", F.pmod(F.xxhash64("host", F.lit("fold")), F.lit(FOLDS)).cast("int"))


def score_urls(features: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``features`` with ``blocked_score``, from trees that are grown on the rows with a label."""
    n, blocked = features.filter(F.col("blocked").isNotNull()).agg(F.count(F.lit(1)), F.coalesce(F.sum("blocked"), F.lit(0.0))).first()
    if not 0 < blocked < n:
        return features.withColumn("blocked_score", F.lit(blocked / n if n else 0.0))
    full = with_suffix_statistics(features)
    chosen = F.xxhash64("host", "path", "key") % 1_000_000 / 1_000_000.0
    sample = full.filter(F.col("blocked").isNotNull() & (F.abs(chosen) < fit_rows / n))
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    rows = stage(assembler.transform(sample).select("features", "blocked").coalesce(4), "url-sample")
    trees = GBTClassifier(
        labelCol="blocked", maxIter=ROUNDS, maxDepth=DEPTH, maxBins=64, seed=SEED, cacheNodeIds=False
    ).fit(rows)
    return trees.transform(assembler.transform(full)).withColumn("blocked_score", vector_to_array("probability")[1])


def held_out_auc(
    df: DataFrame, url: str = "url", key: str = "page_id", rules: tuple[UrlRule, ...] = RULES, fit_rows: int = FIT_ROWS
) -> DataFrame:
    """(model, auc): how well the trees rank the labelled URLs of the hosts of one fold, whose rules they are not shown."""
    features = stage(url_features(df, url, key, rules), "url-features")
    hidden = features.withColumns({"label": F.col("blocked"), "blocked": F.when(F.col("fold") > 0, F.col("blocked"))})
    scored = score_urls(hidden, fit_rows).filter((F.col("fold") == 0) & F.col("label").isNotNull())
    return auc_roc(scored.select(F.lit("trees").alias("model"), "label", "blocked_score"), score="blocked_score")


def filter_urls(
    df: DataFrame,
    url: str = "url",
    key: str = "page_id",
    rules: tuple[UrlRule, ...] = RULES,
    fit_rows: int = FIT_ROWS,
    threshold: float = 0.5,
) -> DataFrame:
    """Key, host, path, rule, ``blocked_score`` and verdict of every URL.

    URLs that a rule covers are the labelled ones: they keep the rule's verdict and train the trees, which
    judge the rest. Statistics of suffixes come from all labelled URLs, for a labelled one from other hosts than its own;
    trees grow on about ``fit_rows`` of them, chosen by a hash of the URL, and never see which rule fits.

    A null URL or one without ``://`` has empty host and path and is judged by the trees as an empty text.
    Repeated rows are judged each. Without URLs of both verdicts to learn from, the score of all URLs is the share
    of blocked ones among the labelled (0 if there are none); an empty table gives no rows.
    """
    features = stage(url_features(df, url, key, rules), "url-features")
    return score_urls(features, fit_rows).select(
        F.col("key").alias(key),
        "host",
        "path",
        "rule",
        "blocked_score",
        F.coalesce("_verdict", F.when(F.col("blocked_score") > threshold, "block").otherwise("allow")).alias("verdict"),
    )

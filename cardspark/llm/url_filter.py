"""URL filters: host and path rules, and gradient-boosted trees for the URLs that no rule knows.

The trees learn from the URLs that rules have judged. Their features are
lexical: lengths, depth, digit ratio, character entropy, parameters, and suffix
statistics, i.e. how often rules block URLs with the same last host label, last
two host labels or first path segment. These statistics cover all labelled
URLs and are kept by hash bucket, so that they have `BUCKETS` rows at most; the
trees are fitted on at most `max_train` labelled URLs.
"""

from __future__ import annotations


from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardspark.session import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BUCKETS = 1024
MAX_TRAIN = 20_000
SUFFIXES = ("tld", "domain", "segment")
FEATURES = ["url_length", "host_length", "labels", "depth", "digit_ratio", "entropy", "parameters", "hyphens", "escapes",
            *[f"{s}_odds" for s in SUFFIXES], *[f"{s}_seen" for s in SUFFIXES]]


def url_host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty if there is none."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, else nulls; rules are (host, path, verdict)."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, outcome in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(outcome)).otherwise(verdict)
    return name, verdict


def _entropy(text: Column) -> Column:
    size = F.length(text)
    share = F.transform(
        F.array_distinct(F.split(text, "")),
        lambda c: (size - F.length(F.replace(text, c, F.lit("")))) / size)
    terms = F.filter(share, lambda p: p > 0)
    return F.when(size > 0, F.aggregate(terms, F.lit(0.0), lambda total, p: total - p * F.log2(p))).otherwise(0.0)


def lexical(urls: DataFrame) -> DataFrame:
    """`urls` (url, host, path) with the features that need no statistics, and the buckets of the suffixes."""
    url, host = F.coalesce("url", F.lit("")), F.col("host")
    size = F.length(url)
    labels = F.split(host, r"\.")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    suffixes = {
        "tld": F.element_at(labels, -1),
        "domain": F.concat_ws(".", F.slice(labels, -F.least(F.size(labels), F.lit(2)), 2)),
        "segment": F.regexp_extract("path", "^/([^/]*)", 1),
    }
    return urls.withColumns({
        "url_length": size, "host_length": F.length(host), "labels": F.size(labels),
        "depth": F.regexp_count("path", F.lit("/")),
        "digit_ratio": F.when(size > 0, F.regexp_count(url, F.lit("[0-9]")) / size).otherwise(0.0),
        "entropy": _entropy(url),
        "parameters": F.when(query == "", 0).otherwise(F.regexp_count(query, F.lit("&")) + 1),
        "hyphens": F.regexp_count(url, F.lit("[-_]")), "escapes": F.regexp_count(url, F.lit("%")),
        **{s: F.pmod(F.xxhash64(F.lit(s), c), F.lit(BUCKETS)) for s, c in suffixes.items()},
    })


def suffix_statistics(labelled: DataFrame) -> DataFrame:
    """(kind, bucket, odds, seen): smoothed log odds of block among the labelled URLs of each suffix bucket."""
    kinds = F.explode(F.array(*[F.struct(F.lit(s).alias("kind"), F.col(s).alias("bucket")) for s in SUFFIXES]))
    blocked = F.count_if(F.col("label") == 1)
    return labelled.select(kinds.alias("s"), "label").groupBy("s.kind", "s.bucket").agg(
        F.log((blocked + 0.5) / (F.count("*") - blocked + 0.5)).alias("odds"), F.log1p(F.count("*")).alias("seen"))


def _with_statistics(rows: DataFrame, statistics: DataFrame) -> DataFrame:
    for s in SUFFIXES:
        own = statistics.filter(F.col("kind") == s).select(
            F.col("bucket").alias(s), F.col("odds").alias(f"{s}_odds"), F.col("seen").alias(f"{s}_seen"))
        rows = rows.join(F.broadcast(own), s, "left")  # at most BUCKETS rows
    return rows.fillna(0.0, [f"{s}_{x}" for s in SUFFIXES for x in ("odds", "seen")])


def fit(labelled: DataFrame, statistics: DataFrame, max_train: int = MAX_TRAIN, trees: int = 10, depth: int = 3,
        seed: int = 17) -> GBTClassificationModel | None:
    """Trees from at most `max_train` labelled URLs, those lowest in hash order; None without both labels."""
    chosen = labelled.orderBy(F.xxhash64("url"), "url").limit(max_train)
    train = written(
        VectorAssembler(inputCols=FEATURES, outputCol="features").transform(_with_statistics(chosen, statistics)).select(
            "features", F.col("label").cast("double").alias("label")), "url-train")
    if train.select("label").distinct().count() < 2:
        return None
    return GBTClassifier(maxIter=trees, maxDepth=depth, seed=seed, stepSize=0.3).fit(train)


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]], url_col: str = "url", id_col: str = "page_id",
                max_train: int = MAX_TRAIN) -> DataFrame:
    """Per page: id, host, path, rule (else null), verdict (allow or block) and score (the trees' share for block).

    A null url or one without `://` has an empty host and path and is judged by
    the trees. If the labelled URLs do not show both verdicts, there are no
    trees: the score is then 1 if all are blocked, else 0. A score of 0.5 or
    more blocks. Equal URLs are judged equally; other columns are ignored; no
    rows give no rows.
    """
    urls = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url")).withColumns(
        {"host": url_host(F.col("url")), "path": url_path(F.col("url"))})
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    rows = lexical(urls.withColumns({"rule": rule, "known": verdict}))
    labelled = rows.filter("known IS NOT NULL").withColumn("label", (F.col("known") == "block").cast("int"))
    statistics = written(suffix_statistics(labelled), "url-suffixes")
    model = fit(labelled, statistics, max_train)
    if model is None:
        only = labelled.agg(F.coalesce(F.min("label"), F.lit(0))).first()[0]
        scored = rows.withColumn("score", F.lit(float(only)))
    else:
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(_with_statistics(rows, statistics))
        scored = model.transform(vectors).withColumn("score", vector_to_array("probability")[1])
    judged = F.coalesce("known", F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    return scored.select(F.col("id").alias(id_col), "host", "path", "rule", judged.alias("verdict"), "score")

"""URL filters: host and path rules, and gradient-boosted trees on lexical features for the rest.

Only DataFrame functions and Spark's own machine-learning library are used. Features of a url:
length, path depth, digit ratio, character entropy, number of parameters, hyphens and labels of
the host, and statistics of the host's suffixes (how many labelled urls end so, and the smoothed share of
blocked ones). Trees are fitted on about ``sample`` labelled urls at most (chosen by hash, so reruns
agree); suffix statistics are taken over all labelled urls; every url is scored.

Defined results: a null url or one without ``://`` has empty host and path, matches no rule, and
is scored by its lexical features like any other; when no labelled url of either class exists there is nothing
to learn and such urls are allowed with score null.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statmart.llm.common import bounded_sample
from statmart.session import materialize

#: (verdict, host, path): the rule fits the host and its subdomains where the path starts so.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
SAMPLE = 50_000
TREES, DEPTH, SEED = 12, 3, 7
SMOOTHING = 10.0
FEATURES = ("f_length", "f_depth", "f_digits", "f_entropy", "f_parameters", "f_hyphens", "f_labels",
            "f_suffix_seen", "f_suffix_share", "f_domain_seen", "f_domain_share")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def after_scheme(url: Column) -> Column:
    """What follows the first ``://`` (empty where there is none)."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct(size, verdict, rule) of the longest rule that fits, or null. The list of rules is
    part of the plan, so it is meant for hundreds, not millions."""
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
                   F.struct(F.lit(len(h) + len(p)).alias("size"), F.lit(verdict).alias("verdict"), F.lit(h + p).alias("rule")))
            for verdict, h, p in rules]
    return F.array_max(F.array_compact(F.array(*fits)))


def lexical_features(urls: DataFrame) -> DataFrame:
    """``urls`` (url, host, path) with the lexical features and the two suffixes of the host."""
    url = F.coalesce(F.col("url"), F.lit(""))
    size = F.greatest(F.length(url), F.lit(1)).cast("double")
    counted = F.transform(F.array_distinct(F.split(url, "")), lambda c: F.when(
        c == "", F.lit(0.0)).otherwise((F.length(url) - F.length(F.replace(url, c, F.lit("")))) / size))
    entropy = F.aggregate(counted, F.lit(0.0), lambda s, p: s - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    labels = F.split("host", r"\.")
    return urls.withColumns({
        "f_length": F.length(url).cast("double"),
        "f_depth": F.regexp_count("path", F.lit("/[^/]")).cast("double"),
        "f_digits": F.regexp_count(url, F.lit("[0-9]")) / size,
        "f_entropy": entropy,
        "f_parameters": F.when(query == "", 0.0).otherwise(F.size(F.split(query, "&")).cast("double")),
        "f_hyphens": F.regexp_count("host", F.lit("-")).cast("double"),
        "f_labels": F.size(labels).cast("double"),
        "suffix": F.substring_index("host", ".", -1),
        "domain": F.substring_index("host", ".", -2),
    })


def _with_suffixes(urls: DataFrame, labelled: DataFrame) -> DataFrame:
    """Adds how often a host's last and last two labels occur among labelled urls, and their share of label 1."""
    overall = labelled.agg(F.avg("label")).first()[0]
    for column, name in (("suffix", "f_suffix"), ("domain", "f_domain")):
        seen = labelled.groupBy(column).agg(F.count(F.lit(1)).alias("seen"), F.sum("label").alias("ones"))
        seen = seen.select(column, F.log1p("seen").alias(f"{name}_seen"),
                           ((F.col("ones") + SMOOTHING * overall) / (F.col("seen") + SMOOTHING)).alias(f"{name}_share"))
        urls = urls.join(seen, column, "left")
    return urls.fillna(0.0, ["f_suffix_seen", "f_domain_seen"]).fillna(0.5, ["f_suffix_share", "f_domain_share"])


def score_urls(urls: DataFrame, labelled: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``urls`` (url, host, path, ...) with ``score``, the trees' probability of label 1, learnt
    from ``labelled`` (url, host, path, label); null where there is nothing to learn from."""
    known = materialize(lexical_features(labelled.where("label IS NOT NULL").select(
        "url", "host", "path", F.col("label").cast("double").alias("label"))), "labelled-urls")
    if known.agg(F.count_distinct("label")).first()[0] < 2:
        return urls.withColumn("score", F.lit(None).cast("double"))
    vector = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    chosen = bounded_sample(known, sample, "url")
    training = materialize(vector.transform(_with_suffixes(chosen, known)).select("features", "label"), "training-urls")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED).fit(training.coalesce(1))
    ready = vector.transform(_with_suffixes(lexical_features(urls), known))
    scored = model.transform(ready)
    return scored.withColumn("score", vector_to_array("probability")[1]).select(*urls.columns, "score")


def judge_urls(pages: DataFrame, rules=RULES, sample: int = SAMPLE) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for every row of ``pages`` (page_id, url).

    Urls that a rule decides are the labelled ones (block: 1); the trees judge the others.
    """
    ruled = (pages.select("page_id", "url").withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
             .withColumn("hit", rule_of(F.col("host"), F.col("path"), rules)))
    labelled = ruled.where("hit IS NOT NULL").withColumn("label", F.when(F.col("hit.verdict") == "block", 1.0).otherwise(0.0))
    scored = score_urls(ruled, labelled, sample)
    own = F.when(F.col("score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select("page_id", "host", "path", F.col("hit.rule").alias("rule"),
                         F.coalesce(F.col("hit.verdict"), own).alias("verdict"), "score")

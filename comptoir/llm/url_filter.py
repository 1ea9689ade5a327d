"""URL filters: rules, and gradient-boosted trees on lexical features (operator 3).

Rules decide the urls that they fit; the longest fitting rule wins. Urls that a
rule decides are the labelled ones: a bounded sample of them (``most_labelled``
rows, by hash) trains the trees, which decide all others.

Features of a url: lengths of url, host and path; host labels; path depth; share of
digits in host and path; entropy of the host's characters; number of parameters and
whether there is a fragment; and statistics of the host's suffix (its last
label): how many urls have it, and the share that labelled urls with it are
blocked, drawn towards the overall share. They are DataFrame expressions; the trees are
Spark ML's, trained by Spark. Suffix statistics are combined before the shuffle, so a host with
a third of all urls sends one row a task.

Defined results: host and path of a null url, or one without ``://``, are empty and no
rule fits; the trees decide it by its features like any other. With labelled urls of one verdict only,
every url gets that verdict; with none, all are allowed. Repeated rows are judged each on its own. An empty
table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comptoir.llm.common import stage

#: (verdict, rule): host, and path from the first slash on.
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
MOST_LABELLED = 20_000
FEATURES = ["url_length", "host_length", "path_length", "host_labels", "depth", "digit_share", "host_digit_share",
            "entropy", "n_params", "has_fragment", "suffix_log_count", "suffix_blocked"]
_SCHEME = "://"


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parsed(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, path)."""
    url = F.coalesce(F.col("url"), F.lit(""))
    at = F.instr(url, _SCHEME)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract("rest", "^[^/?#]*", 0)
    path = F.regexp_extract(F.expr("substring(rest, char_length(raw_host) + 1)"), "^[^?#]*", 0)
    return (pages.select("page_id", url.alias("url"), rest.alias("rest")).withColumn("raw_host", host)
            .select("page_id", "url", _ascii_lower(F.col("raw_host")).alias("host"), path.alias("path")))


def with_rules(urls: DataFrame, rules: list[tuple[str, str]] | None = None) -> DataFrame:
    """``urls`` with ``rule`` and ``rule_verdict``, null where no rule fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, rule in sorted(RULES if rules is None else rules, key=lambda r: len(r[1])):  # a longer one overrides
        domain, path = rule.split("/", 1)
        fits = (((F.col("host") == domain) | F.col("host").endswith("." + domain))
                & F.col("path").startswith("/" + path))
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, v).otherwise(verdict)
    return urls.withColumns({"rule": name, "rule_verdict": verdict})


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def _digits(c: Column) -> Column:
    return F.length(F.regexp_replace(c, "[^0-9]", "")).cast("double")


def features(urls: DataFrame) -> DataFrame:
    """``urls`` with the features that a url has by itself, and ``suffix``."""
    host, path, url = F.col("host"), F.col("path"), F.col("url")
    n = F.length(host).cast("double")
    letters = F.split(host, "")
    counts = F.transform(F.array_distinct(letters),
                         lambda x: F.size(F.filter(letters, lambda y: y == x)).cast("double"))
    entropy = F.when(n > 0, F.aggregate(counts, F.lit(0.0), lambda s, k: s - k / n * F.log2(k / n))).otherwise(0.0)
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    params = F.when(query == "", 0).otherwise(F.size(F.split(query, "&")))
    segments = F.size(F.filter(F.split(path, "/"), lambda x: x != ""))
    both = F.concat(host, path)
    return urls.withColumns({
        "url_length": F.length(url).cast("double"), "host_length": n, "path_length": F.length(path).cast("double"),
        "host_labels": F.size(F.split(host, r"\.")).cast("double"), "depth": segments.cast("double"),
        "digit_share": _share(_digits(both), F.length(both)), "host_digit_share": _share(_digits(host), n),
        "entropy": entropy, "n_params": params.cast("double"), "has_fragment": url.contains("#").cast("double"),
        "suffix": F.substring_index(host, ".", -1)})


def with_suffixes(urls: DataFrame) -> DataFrame:
    """``urls`` with the suffix statistics. The two kinds of rows are counted over all urls."""
    blocked = F.when(F.col("rule_verdict") == "block", 1.0).when(F.col("rule_verdict") == "allow", 0.0)
    mean = urls.agg(F.coalesce(F.avg(blocked), F.lit(0.5)).alias("m")).first()["m"]
    stats = urls.groupBy("suffix").agg(
        F.log1p(F.count("*")).alias("suffix_log_count"),
        ((F.coalesce(F.sum(blocked), F.lit(0.0)) + F.lit(10.0 * mean)) / (F.count(blocked) + 10)).alias("suffix_blocked"))
    return urls.join(stats, "suffix")


def train(urls: DataFrame, most_labelled: int = MOST_LABELLED, rounds: int = 12, depth: int = 4):
    """Trees from a bounded sample of the urls that rules decide; a verdict if there is only one kind of them."""
    sample = stage(urls.where(F.col("rule_verdict").isNotNull())
                   .orderBy(F.xxhash64("url", "page_id"), "url", "page_id").limit(most_labelled)
                   .withColumn("label", (F.col("rule_verdict") == "block").cast("double")).select("label", *FEATURES),
                   "labelled_urls")
    kinds = [r["label"] for r in sample.select("label").distinct().collect()]
    if len(kinds) < 2:
        return "block" if kinds == [1.0] else "allow"
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample)
    return GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=7).fit(vectors)


def judge(urls: DataFrame, model) -> DataFrame:
    """``urls`` with ``p_block``, the trees' probability of block."""
    if isinstance(model, str):
        return urls.withColumn("p_block", F.lit(1.0 if model == "block" else 0.0))
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(urls)
    return (model.transform(vectors).withColumn("p_block", vector_to_array("probability")[1])
            .drop("features", "rawPrediction", "probability", "prediction"))


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]] | None = None,
                most_labelled: int = MOST_LABELLED) -> DataFrame:
    """(page_id, host, path, rule, verdict, p_block) of every row."""
    urls = stage(with_suffixes(features(with_rules(parsed(pages), rules))), "urls")
    verdict = F.coalesce("rule_verdict", F.when(F.col("p_block") >= 0.5, "block").otherwise("allow"))
    return (judge(urls, train(urls, most_labelled))
            .select("page_id", "host", "path", "rule", verdict.alias("verdict"), "p_block"))

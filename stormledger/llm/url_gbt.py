"""URL verdicts: longest-fitting rules first, gradient-boosted trees for the rest.

Host and path are cut by plain string functions. A rule names a host and the
beginning of a path; it fits the host and all its subdomains. The rules' own
verdicts label the URLs they fit; boosted trees learn them from lexical features
and judge the URLs that no rule fits. The features say nothing of the rules:
lengths, depth, digit and punctuation shares, entropy of host and path,
parameter counts, and statistics of the host's last labels over all URLs.

Fitting uses at most `SAMPLE` labelled rows of either verdict, by a hash of the
URL; suffix statistics and verdicts cover all rows.

Defined cases: a null URL or one without `://` has an empty host and path, fits
no rule, and is judged by the trees like any other; with labels of one verdict
alone, or none, the rest gets that verdict, or `allow`; repeated rows give
repeated results; an empty table gives an empty result; other columns stay out.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormledger import session
from stormledger.llm import texts

#: Host, beginning of the path, verdict.
RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
)
SAMPLE = 20_000
TREES, DEPTH, SEED = 12, 4, 10

NUMBERS = [
    "url_length", "host_length", "path_length", "query_length", "depth", "labels", "digits", "host_digits", "hyphens",
    "marks", "uppers", "params", "fragment", "secure", "host_entropy", "path_entropy", "longest_label", "extension",
    "suffix_urls", "suffix_length", "suffix_depth", "suffix_params",
]


def host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path(url: Column) -> Column:
    """From the host's end up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule(host: Column, path: Column, rules=RULES) -> Column:
    """The fitting rule with the longest host, then the longest path; null if none fits. A literal list, no join."""
    order = sorted(rules, key=lambda r: (-len(r[0]), -len(r[1]), r))
    found = None
    for name, begin, _ in order:
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(begin)
        label = F.lit(name + begin)
        found = F.when(fits, label) if found is None else found.when(fits, label)
    return found if found is not None else F.lit(None).cast("string")


def verdict_of(rule: Column, rules=RULES) -> Column:
    """The verdict of a rule's name."""
    out = F.lit(None).cast("string")
    for name, begin, verdict in rules:
        out = F.when(rule == name + begin, F.lit(verdict)).otherwise(out)
    return out


def entropy(text: Column) -> Column:
    """Bits per character of a text's own character distribution."""
    letters = F.split(text, "")
    each = F.transform(F.array_distinct(letters), lambda c: F.length(text) - F.length(F.replace(text, c, F.lit(""))))
    share = lambda n: n / F.length(text)
    return F.when(F.length(text) > 0, F.aggregate(each, F.lit(0.0), lambda total, n: total - F.when(n > 0, share(n) * F.log2(share(n))).otherwise(0.0))).otherwise(0.0)


def _count(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, "")) * -1 + F.length(text)


def lexical(pages: DataFrame, key: str = "page_id", url: str = "url", rules=RULES) -> DataFrame:
    """Host, path, rule, and the features of every URL but the suffix statistics."""
    rows = pages.select(pages[key].alias("page_id"), pages[url].cast("string").alias("url"))
    rows = rows.withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url")))
    rows = rows.withColumn("rule", rule(F.col("host"), F.col("path"), rules))
    u, h, p = F.coalesce(F.col("url"), F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(u, r"(?s)\?([^#]*)", 1)
    labels = F.split(h, r"\.")
    return rows.select(
        "page_id", "url", "host", "path", "rule",
        F.element_at(F.split(h, r"\."), -1).alias("suffix"),
        F.length(u).alias("url_length"), F.length(h).alias("host_length"), F.length(p).alias("path_length"), F.length(query).alias("query_length"),
        F.size(F.filter(F.split(p, "/"), lambda x: x != "")).alias("depth"), F.size(labels).alias("labels"),
        (_count(u, "[0-9]") / F.greatest(F.length(u), F.lit(1))).alias("digits"),
        (_count(h, "[0-9]") / F.greatest(F.length(h), F.lit(1))).alias("host_digits"),
        _count(u, "-").alias("hyphens"), _count(u, "[_%~@!$,;+*']").alias("marks"), _count(u, "[A-Z]").alias("uppers"),
        F.size(F.filter(F.split(query, "[&;]"), lambda x: x != "")).alias("params"), u.contains("#").cast("int").alias("fragment"),
        u.startswith("https:").cast("int").alias("secure"), entropy(h).alias("host_entropy"), entropy(p).alias("path_entropy"),
        F.array_max(F.transform(labels, F.length)).alias("longest_label"),
        F.length(F.regexp_extract(p, r"\.([A-Za-z0-9]+)$", 1)).alias("extension"),
    )


def with_suffixes(rows: DataFrame) -> DataFrame:
    """Statistics of each suffix over all URLs; a stored table, which Spark broadcasts if its size allows."""
    by_suffix = rows.groupBy("suffix").agg(
        F.log2(F.count("*") + 1.0).alias("suffix_urls"), F.round(F.avg("url_length"), 6).alias("suffix_length"),
        F.round(F.avg("depth"), 6).alias("suffix_depth"), F.round(F.avg("params"), 6).alias("suffix_params"))
    return rows.join(session.materialize(by_suffix, "suffixes"), "suffix")


def fit(rows: DataFrame, rules=RULES, sample: int = SAMPLE, trees: int = TREES, depth: int = DEPTH) -> GBTClassificationModel | str:
    """Trees from the URLs that rules judge; if these have one verdict, that verdict."""
    labelled = rows.filter(F.col("rule").isNotNull()).withColumn("label", (verdict_of(F.col("rule"), rules) == "block").cast("double"))
    drawn, there = None, []
    for label in (0.0, 1.0):
        own = labelled.filter(F.col("label") == label)
        own = texts.smallest_hashes(own, ["url"], sample)
        own = session.materialize(own.select("label", *[F.col(c).cast("double").alias(c) for c in NUMBERS]), "urls")
        if not own.isEmpty():
            there.append(label)
        drawn = own if drawn is None else drawn.unionByName(own)
    if len(there) < 2:
        return "block" if there == [1.0] else "allow"
    vectors = VectorAssembler(inputCols=NUMBERS, outputCol="features").transform(drawn).select("label", "features")
    return GBTClassifier(maxIter=trees, maxDepth=depth, seed=SEED, stepSize=0.3, maxBins=32, maxMemoryInMB=64).fit(vectors)


def judge(pages: DataFrame, key: str = "page_id", url: str = "url", rules=RULES) -> DataFrame:
    """Host, path, fitting rule, and verdict of every URL, with the trees' probability of `block`."""
    rows = with_suffixes(lexical(pages, key, url, rules))
    model = fit(rows, rules)
    ruled = verdict_of(F.col("rule"), rules)
    if isinstance(model, str):
        out = rows.withColumn("block_score", F.lit(None).cast("double")).withColumn("verdict", F.coalesce(ruled, F.lit(model)))
    else:
        from pyspark.ml.functions import vector_to_array

        plain = rows.select("page_id", "host", "path", "rule", *[F.col(c).cast("double").alias(c) for c in NUMBERS])
        scored = model.transform(VectorAssembler(inputCols=NUMBERS, outputCol="features").transform(plain))
        out = scored.withColumn("block_score", vector_to_array("probability")[1])
        out = out.withColumn("verdict", F.coalesce(ruled, F.when(F.col("prediction") > 0.5, "block").otherwise("allow")))
    return out.select(F.col("page_id").alias(key), "host", "path", "rule", "verdict", "block_score")

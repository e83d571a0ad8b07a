"""URL filters: listed rules first, then gradient-boosted trees on lexical features.

A rule is a host and the start of a path (``example.net/en/``); it fits its host and all subdomains
of it where the URL's path starts with the rule's; the longest fitting rule decides. URLs that a
rule decides are the labelled ones: a bounded sample of them (at most ``per_label`` of each verdict,
1000 at most, those of smallest hash) trains Spark ML's gradient-boosted trees, which decide the
others. Features: lengths, depth, digit ratio, entropy, parameters, marks, labels of the host, and
suffix statistics: of all rule-decided URLs with the same last two host labels the share that is
blocked (smoothed) and their number. In training, a row's suffix statistics come from the other half
of those URLs, so a row doesn't see its own label. The table of suffixes is broadcast where it is
counted to have at most :data:`BROADCAST_ROWS` rows, and joined by shuffle otherwise.

Defined cases: a null URL, or one without ``://``, has an empty host and path, no rule, and is judged
by its features; without a sample of both verdicts the undecided get the one verdict that there is,
or ``allow``; rows are judged one by one, so repeated rows and ids make no difference.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waveband.llm import samples
from waveband.llm.shared import written

#: The contract's rules.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
FEATURES = (
    "url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "entropy", "parameters", "hyphens", "has_fragment",
    "has_file", "secure", "suffix_share", "suffix_count",
)
#: so many suffixes are some MB
BROADCAST_ROWS = 50_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(text, parts, 1), _UPPER, _LOWER), F.regexp_extract(text, parts, 2)


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; both null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for text, decides in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, decides).otherwise(verdict)
    return rule, verdict


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    n = F.size(chars).cast("double")
    each = F.transform(F.array_distinct(chars), lambda c: F.size(F.filter(chars, lambda x: x == c)) / n)
    return F.aggregate(each, F.lit(0.0), lambda total, p: total - p * F.log2(p))


def with_features(rows: DataFrame) -> DataFrame:
    """``rows(url, host, path)`` with the lexical features and ``suffix``."""
    url, host, path = F.coalesce(F.col("url"), F.lit("")), F.col("host"), F.col("path")
    number = {
        "url_length": F.length(url), "host_length": F.length(host), "path_length": F.length(path),
        "depth": F.size(F.filter(F.split(path, "/"), lambda p: p != "")), "labels": F.size(F.split(host, r"\.")),
        "digit_ratio": _count(url, "[0-9]") / F.greatest(F.length(url), F.lit(1)), "entropy": _entropy(url),
        "parameters": F.when(url.contains("?"), F.size(F.split(F.regexp_extract(url, r"(?s)\?([^#]*)", 1), "&"))).otherwise(0),
        "hyphens": _count(host, "-"), "has_fragment": url.contains("#").cast("int"), "has_file": path.rlike(r"\.[A-Za-z0-9]{1,5}$").cast("int"),
        "secure": url.startswith("https://").cast("int"),
    }
    return rows.withColumns({n: c.cast("double") for n, c in number.items()} | {"suffix": _suffix(host)})


def _suffix(host: Column) -> Column:
    return F.regexp_extract(host, r"([^.]*\.)?[^.]*$", 0)


def _with_suffix(rows: DataFrame, stats: DataFrame, on: list[str], small: bool) -> DataFrame:
    joined = rows.join(F.broadcast(stats) if small else stats, on, "left")
    total, blocked = F.coalesce("total", F.lit(0)), F.coalesce("blocked", F.lit(0))
    return joined.withColumns({"suffix_share": (blocked + 1.0) / (total + 2.0), "suffix_count": F.log1p(total.cast("double"))})


def judge(pages: DataFrame, keep: tuple[str, ...] = ("page_id",), key: str = "page_id", url: str = "url",
          rules: tuple[tuple[str, str], ...] = RULES, per_label: int = 1000, trees: int = 20, depth: int = 4, threshold: float = 0.5) -> DataFrame:
    """Columns ``keep`` of every row, with ``host``, ``path``, ``rule``, ``verdict`` and ``block_score`` (null where a rule decides)."""
    host, path = host_and_path(F.col(url))
    rows = pages.select(*(F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)), F.col(key).alias("key"), F.col(url).alias("url"), host.alias("host"), path.alias("path"))
    rule, decided = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "decided": decided})

    labelled = rows.where(F.col("decided").isNotNull())
    ordered = F.xxhash64("url", F.coalesce(F.col("key").cast("string"), F.lit("")))
    learnt = {"label": (F.col("decided") == "block").cast("double"), "fold": F.pmod(F.xxhash64("url"), F.lit(2))}
    sample = written(with_features(samples.smallest(labelled, "decided", ordered, per_label)), "labelled").withColumns(learnt)
    verdicts = sorted(r[0] for r in sample.select("decided").distinct().collect())
    of_rule = F.col("decided")
    if len(verdicts) < 2:
        only = F.lit(verdicts[0] if verdicts else "allow")
        result = rows.withColumns({"verdict": F.coalesce(of_rule, only), "block_score": F.lit(None).cast("double")})
    else:
        counted = labelled.select(_suffix(F.col("host")).alias("suffix"), "url", "decided").withColumns(learnt)
        stats = written(counted.groupBy("suffix", "fold").agg(F.count("*").alias("total"), F.sum("label").alias("blocked")), "suffixes")
        small = stats.count() <= BROADCAST_ROWS
        other = stats.withColumn("fold", 1 - F.col("fold"))
        every = stats.groupBy("suffix").agg(F.sum("total").alias("total"), F.sum("blocked").alias("blocked"))
        vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        train = vectors.transform(_with_suffix(sample, other, ["suffix", "fold"], small)).select("label", "features").repartition(4, "features")
        model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=7).fit(train)
        undecided = _with_suffix(with_features(rows), every, ["suffix"], small)
        scored = model.transform(vectors.transform(undecided))
        score = F.when(of_rule.isNull(), vector_to_array("probability")[1])
        result = scored.withColumn("block_score", score).withColumn(
            "verdict", F.coalesce(of_rule, F.when(F.col("block_score") >= threshold, "block").otherwise("allow")))
    return result.select(*(F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)), "host", "path", "rule", "verdict", "block_score")

"""Judge URLs: rules by host and path first, gradient-boosted trees for the rest.

The URLs that a rule decides are the labelled ones.  Trees are trained on a bounded
sample of them, on lexical features: lengths, depth, digit ratio, entropy, parameter
counts, and how often URLs with the same host suffix or first path segment are blocked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeflow.llm.common import in_share, landed

#: (verdict, rule); a rule is a host and the beginning of a path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

#: Labelled URLs that the trees are trained on, at most about this many.
SAMPLE = 20_000
#: Weight of the overall rate in a suffix's rate, in URLs.
SMOOTH = 10.0

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = (
    "f_length", "f_host_length", "f_path_length", "f_depth", "f_labels", "f_hyphens",
    "f_digits", "f_host_digits", "f_entropy", "f_parameters", "f_parameter_length", "f_extension",
)
#: What block rates are learnt by.
GROUPS = ("g_top", "g_domain", "g_segment", "g_domain_segment")


def with_parts(urls: DataFrame, url: str = "url") -> DataFrame:
    """Adds host and path; both are empty for a null URL or one without "://"."""
    at = F.locate("://", F.col(url))
    rest = F.when(at > 0, F.col(url).substr(at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return urls.withColumns({"host": host, "path": F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)})


def rule_column(rules: Sequence[tuple[str, str]], value: int) -> Column:
    """The longest fitting rule (value 1) or its verdict (0), else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        domain, slash, rest = rule[1].partition("/")
        fits = (F.col("host") == domain) | F.col("host").endswith("." + domain)
        out = F.when(fits & F.col("path").startswith(slash + rest), F.lit(rule[value])).otherwise(out)
    return out


def with_features(parts: DataFrame, url: str = "url") -> DataFrame:
    text = F.coalesce(F.col(url), F.lit(""))
    size = F.greatest(F.length(text), F.lit(1))
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    segment = F.regexp_extract("path", "^/([^/]*)", 1)
    count = lambda c, pattern: F.regexp_count(c, F.lit(pattern)).cast("double")
    chars = F.array_distinct(F.split(text, ""))
    parts_of = F.transform(chars, lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / size)
    entropy = F.aggregate(
        F.filter(parts_of, lambda p: p > 0), F.lit(0.0), lambda total, p: total - p * F.log2(p)
    )
    return parts.withColumns(
        {
            "f_length": F.length(text).cast("double"),
            "f_host_length": F.length("host").cast("double"),
            "f_path_length": F.length("path").cast("double"),
            "f_depth": count(F.col("path"), "/[^/]"),
            "f_labels": count(F.col("host"), "[^.]+"),
            "f_hyphens": count(F.col("host"), "-"),
            "f_digits": count(text, "[0-9]") / size,
            "f_host_digits": count(F.col("host"), "[0-9]"),
            "f_entropy": entropy,
            "f_parameters": count(query, "[^&]+"),
            "f_parameter_length": F.length(query).cast("double"),
            "f_extension": F.col("path").rlike(r"\.[A-Za-z0-9]{1,5}$").cast("double"),
            "g_top": F.xxhash64(F.substring_index("host", ".", -1)),
            "g_domain": F.xxhash64(F.substring_index("host", ".", -2)),
            "g_segment": F.xxhash64(segment),
            "g_domain_segment": F.xxhash64(F.substring_index("host", ".", -2), segment),
        }
    )


def with_rates(rows: DataFrame, rates: dict[str, DataFrame], prior: float, own: Column | None) -> DataFrame:
    """Adds the smoothed block rate of each group; ``own`` is a row's own label, left out."""
    for group in GROUPS:
        # At most SAMPLE rows of three numbers each.
        rows = rows.join(F.broadcast(rates[group]), group, "left")
        n = F.coalesce(F.col("n"), F.lit(0)) - (0 if own is None else 1)
        blocked = F.coalesce(F.col("blocked"), F.lit(0.0)) - (F.lit(0.0) if own is None else own)
        rows = rows.withColumn(f"r_{group}", (blocked + prior * SMOOTH) / (n + SMOOTH)).drop("n", "blocked")
    return rows


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    sample: int = SAMPLE,
    trees: int = 20,
    depth: int = 4,
    id_column: str = "page_id",
) -> DataFrame:
    """page_id, url, host, path, rule, verdict, score of every row.

    ``score`` is the trees' probability of "block", and decides from 0.5 up where no rule
    fits.  Where the rules label no URL at all, nothing is blocked beyond them (score 0);
    where all labels agree, that label holds.  Null and empty URLs and those without
    "://" have an empty host and path and are judged like any other.  Repeated rows are
    judged alike.  Columns other than the id and ``url`` are ignored.
    """
    rows = with_parts(pages.select(F.col(id_column).alias("page_id"), "url"))
    rows = rows.withColumns({"rule": rule_column(rules, 1), "ruled": rule_column(rules, 0)})
    label = (F.col("ruled") == "block").cast("double").alias("label")
    labelled = rows.filter(F.col("rule").isNotNull()).select("url", "host", "path", label)
    # Equal URLs have equal features and labels: each counts once.
    chosen = labelled.filter(in_share(sample / max(1, labelled.count()), "url"))
    train = landed(with_features(chosen.distinct().coalesce(1)))
    total = train.agg(F.count("*").alias("n"), F.sum("label").alias("blocked")).first()
    if not total.n or total.blocked in (0, total.n):
        score = F.lit(1.0 if total.n and total.blocked else 0.0)
        return rows.select("page_id", "url", "host", "path", "rule", _verdict(score), score.alias("score"))
    prior = total.blocked / total.n
    rates = {
        g: landed(train.groupBy(g).agg(F.count("*").alias("n"), F.sum("label").alias("blocked"))) for g in GROUPS
    }
    inputs = [*FEATURES, *(f"r_{g}" for g in GROUPS)]
    assembler = VectorAssembler(inputCols=inputs, outputCol="features")
    learn = assembler.transform(with_rates(train, rates, prior, F.col("label"))).select("features", "label")
    model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=7).fit(landed(learn.coalesce(1)))
    judged = model.transform(assembler.transform(with_rates(with_features(rows), rates, prior, None)))
    score = vector_to_array("probability")[1]
    return judged.select("page_id", "url", "host", "path", "rule", _verdict(score), score.alias("score"))


def _verdict(score: Column) -> Column:
    learnt = F.when(score >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return F.coalesce(F.col("ruled"), learnt).alias("verdict")

"""URL verdicts: rules where one fits, else gradient-boosted trees on lexical features.

The urls that a rule decides are the labelled ones; the trees learn from them what blocked
urls look like and judge the rest.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelflens.operators.keep import keep

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Characters whose shares make up the entropy; all others count as one more kind.
KINDS = LOWER + "0123456789" + "-._~/?=&%#:+@"
#: Labelled urls that the trees are fitted on at most: those with the smallest hashes.
TRAINING_ROWS = 20_000
#: Suffixes with statistics up to which these are broadcast; beyond, rows are dealt out by salt.
BROADCAST_SUFFIXES = 100_000
SALTS = 64
FEATURES = [
    "f_length", "f_host_length", "f_labels", "f_depth", "f_digits", "f_entropy", "f_parameters",
    "f_query_length", "f_hyphens", "f_suffix_length", "f_suffix_rate", "f_suffix_known",
]


@dataclass(frozen=True)
class Rule:
    """Fits a host and its subdomains where the url's path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host (A-Z lower-cased) and path; empty for a null url or one without ``://``."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    empty = F.lit("")
    host = F.coalesce(F.regexp_extract(url, parts, 1), empty)
    return F.translate(host, UPPER, LOWER), F.coalesce(F.regexp_extract(url, parts, 2), empty)


def rule_for(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Text and verdict of the longest rule that fits, else null. The list is part of the plan."""
    longest = sorted(rules, key=lambda r: (-len(r.text), r.text))
    fits = [
        F.when(
            ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
            F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in longest
    ]
    return F.coalesce(*fits)


def occurrences(text: Column, character: str) -> Column:
    return F.length(text) - F.length(F.translate(text, character, ""))


def entropy(text: Column) -> Column:
    """Shannon entropy in bits over ``KINDS``: a fixed number of passes, each linear in the text."""
    n = F.greatest(F.length(text), F.lit(1)).cast("double")

    def part(count: Column) -> Column:
        return F.when(count > 0, -(count / n) * F.log2(count / n)).otherwise(F.lit(0.0))

    counts = [occurrences(text, c) for c in KINDS] + [F.length(F.translate(text, KINDS, ""))]
    return reduce(lambda a, b: a + b, [part(c) for c in counts])


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    whole = F.translate(F.coalesce(url, F.lit("")), UPPER, LOWER)
    query = F.regexp_extract(whole, r"\?([^#]*)", 1)
    length = F.length(whole)
    return {
        "f_length": length.cast("double"),
        "f_host_length": F.length(host).cast("double"),
        "f_labels": (occurrences(host, ".") + 1).cast("double"),
        "f_depth": occurrences(path, "/").cast("double"),
        "f_digits": (length - F.length(F.translate(whole, "0123456789", ""))) / F.greatest(length, F.lit(1)),
        "f_entropy": entropy(whole),
        "f_parameters": F.when(F.length(query) > 0, occurrences(query, "&") + 1).otherwise(0).cast("double"),
        "f_query_length": F.length(query).cast("double"),
        "f_hyphens": occurrences(host, "-").cast("double"),
    }


def with_statistics(rows: DataFrame, suffixes: DataFrame, most: int = BROADCAST_SUFFIXES) -> DataFrame:
    """Each row with the counts of its suffix, if there are any.

    A suffix may be that of a third of all rows. Few suffixes are broadcast, their number
    checked; of more, each is copied once per salt, so that no key holds more than its share.
    """
    if suffixes.limit(most + 1).count() <= most:
        return rows.join(F.broadcast(suffixes), "_suffix", "left")
    salted = suffixes.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64("page_id", "path", "f_entropy"), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, ["_suffix", "_salt"], "left").drop("_salt")


def judge(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    rules: tuple[Rule, ...] = RULES,
    training_rows: int = TRAINING_ROWS,
    trees: int = 12,
    depth: int = 3,
) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, score``.

    ``score`` is the trees' probability of block, also where a rule decides; null if no trees
    could be fitted. A null url, or one without ``://``, has an empty host and path, fits no
    rule, and is judged by its remaining features. Without labelled urls all is allowed; if
    all labels are one verdict, that is given. Repeated rows are judged alike; other columns
    are ignored; an empty table gives no rows. Suffix statistics are taken over every other
    labelled url, the row's own label left out; the trees are fitted on at most
    ``training_rows`` of them.
    """
    host, path = host_and_path(F.col("_url"))
    rows = (
        pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("_url"))
        .select("page_id", "_url", host.alias("host"), path.alias("path"))
        .withColumn("_rule", rule_for(F.col("host"), F.col("path"), rules))
        .select(
            "page_id", "host", "path",
            F.col("_rule.rule").alias("rule"),
            F.col("_rule.verdict").alias("_ruled"),
            F.substring_index("host", ".", -1).alias("_suffix"),
            *[c.alias(n) for n, c in lexical(F.col("_url"), F.col("host"), F.col("path")).items()],
        )
    )
    rows = keep(rows)
    label = (F.col("_ruled") == "block").cast("double")
    labelled = rows.filter("_ruled is not null").withColumn("label", label)
    suffixes = keep(
        labelled.groupBy("_suffix").agg(F.count("label").alias("_n"), F.sum("label").alias("_blocked"))
    )
    # A labelled row is one of those counted: its own label must not tell it.
    others = F.coalesce("_n", F.lit(0)) - F.col("label").isNotNull().cast("int")
    blocked = F.coalesce("_blocked", F.lit(0.0)) - F.coalesce("label", F.lit(0.0))
    rows = (
        with_statistics(rows.withColumn("label", label), suffixes)
        .withColumn("f_suffix_length", F.length("_suffix").cast("double"))
        .withColumn("f_suffix_rate", (blocked + 1) / (others + 2))
        .withColumn("f_suffix_known", F.log1p(others.cast("double")))
    )
    sample = keep(
        rows.filter("label is not null")
        .select("label", *FEATURES, F.xxhash64("page_id").alias("_order"))
        .orderBy("_order", *FEATURES)
        .limit(training_rows)
    )
    classes = sorted(r["label"] for r in sample.select("label").distinct().collect())
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="_features")
    if len(classes) == 2:
        boosting = GBTClassifier(
            featuresCol="_features", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=1, maxBins=64
        )
        model = boosting.fit(assembler.transform(sample).select("_features", "label"))
        judged = model.transform(assembler.transform(rows))
        judged = judged.withColumn("score", vector_to_array("probability")[1])
    else:
        judged = rows.withColumn("score", F.lit(classes[0] if classes else None).cast("double"))
    verdict = F.coalesce("_ruled", F.when(F.col("score") > 0.5, "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")

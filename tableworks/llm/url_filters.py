"""URL filters: rules by host and path, and gradient-boosted trees on lexical features.

Everything here is DataFrame functions and Spark's own tree learner. Features of a URL are its
lengths, depth, digit ratio, character entropy, parameter counts, and statistics of its host's
suffix: how many URLs share it and how many labelled ones are blocked.

No label gets into its own features. Where a label column is given, the suffix statistics come from
the sites of one half and the trees from the other half. Where the rules are the labels, a domain's
URLs say nothing of the domain but what its rules say anyway, so the blocked shares leave the URL's
own domain out: what the trees learn has to hold beyond it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableworks.session import stored

from .shared import hashed_sample
from .texts import quoted

#: Labelled URLs that training may use, and the size of the trees.
SAMPLE_URLS, TREES, DEPTH, SEED = 20_000, 20, 4, 3
#: Weight of the overall rate in a suffix's own rate, as a number of URLs.
PRIOR = 20.0

LEXICAL = (
    "url_chars", "host_chars", "path_chars", "query_chars", "depth", "host_labels", "digit_ratio",
    "host_digits", "hyphens", "entropy", "parameters", "longest_label", "secure", "fragment",
)
SUFFIX = ("suffix_count", "suffix_blocked", "domain_count", "domain_blocked")


# ---------------------------------------------------------------- parts and rules


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A to Z in lower case."""
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    """Null URLs and those without ``://`` give the empty text."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise("")


@dataclass(frozen=True)
class Rule:
    """Holds for a host and its subdomains and for paths that start with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | F.endswith(host, F.lit("." + self.host))) & F.startswith(
            path, F.lit(self.path)
        )


def rule_of(rules: list[Rule], host: Column, path: Column) -> Column:
    """Name and verdict of the longest rule that fits, as a struct; null if none does.

    Of rules of equal length the first listed wins.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(reversed(rules), key=lambda rule: len(rule.name)):
        own = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(rule.fits(host, path), own).otherwise(found)
    return found


# ---------------------------------------------------------------- features


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Features of one URL by itself, all of them doubles; a null URL is an empty one."""
    url = F.coalesce(url, F.lit(""))
    size = F.greatest(F.length(url), F.lit(1))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    letters = F.split(url, "")
    # Entropy over the characters, from their counts.
    entropy = F.aggregate(
        F.array_distinct(letters),
        F.lit(0.0),
        lambda total, letter: total + _surprise(
            F.size(F.filter(letters, lambda x: x == letter)) / F.size(letters)
        ),
    )
    labels = F.split(host, r"\.")
    values = (
        F.length(url), F.length(host), F.length(path), F.length(query),
        F.size(F.filter(F.split(path, "/"), lambda part: part != "")),
        F.size(labels),
        F.length(F.regexp_replace(url, "[^0-9]", "")) / size,
        F.length(F.regexp_replace(host, "[^0-9]", "")),
        F.length(F.regexp_replace(host, "[^-]", "")),
        entropy,
        F.when(query == "", 0).otherwise(F.size(F.split(query, "[&;]"))),
        F.array_max(F.transform(labels, F.length)),
        F.startswith(url, F.lit("https")).cast("int"),
        F.contains(url, F.lit("#")).cast("int"),
    )
    return {name: value.cast("double") for name, value in zip(LEXICAL, values, strict=True)}


def _surprise(share: Column) -> Column:
    return -share * F.log2(share)


def suffix(host: Column, labels: int) -> Column:
    """The last ``labels`` labels of a host."""
    parts = F.split(host, r"\.")
    first = F.greatest(F.size(parts) - labels + 1, F.lit(1))
    return F.array_join(F.slice(parts, first, labels), ".")


def suffix_statistics(pages: DataFrame, own_left_out: bool) -> DataFrame:
    """``_domain`` (the last two labels of a host) and ``SUFFIX``, a stored row per domain.

    Counts are of all URLs; blocked shares are of the labelled ones in the first half, or, with
    ``own_left_out``, of all labelled ones outside the domain: none for the domain itself. A suffix
    is added up from its domains, so that no row of ``pages`` is shuffled by it.
    """
    taught = F.col("_label").isNotNull() & (F.lit(own_left_out) | ~F.col("_second"))
    counts = pages.groupBy("_domain").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(taught, 1)).alias("known"),
        F.count(F.when(taught & (F.col("_label") == 1.0), 1)).alias("blocked"),
    )
    domains = stored(counts.withColumn("_suffix", F.substring_index("_domain", ".", -1)), "domains")
    sums = [F.sum(name).alias(f"all_{name}") for name in ("n", "known", "blocked")]
    suffixes = stored(domains.groupBy("_suffix").agg(*sums), "suffixes")

    def share(blocked: Column, known: Column) -> Column:
        return (blocked + PRIOR / 2) / (known + PRIOR)

    if own_left_out:
        above = share(F.col("all_blocked") - F.col("blocked"), F.col("all_known") - F.col("known"))
        own = share(F.lit(0), F.lit(0))
    else:
        above, own = share(F.col("all_blocked"), F.col("all_known")), share(F.col("blocked"), F.col("known"))
    values = (F.log1p("all_n"), above, F.log1p("n"), own)
    return stored(
        domains.join(suffixes, "_suffix").select("_domain", *[v.alias(k) for k, v in zip(SUFFIX, values, strict=True)]),
        "suffix-statistics",
    )


# ---------------------------------------------------------------- the model


def train(labelled: DataFrame, rows: int = SAMPLE_URLS) -> GBTClassificationModel | float:
    """Trees from about ``rows`` labelled rows drawn by a hash; a constant if all labels agree.

    ``labelled`` has ``_url``, the features, and ``_label`` (1 is block).
    """
    drawn = hashed_sample(labelled.select("_url", "_label", *LEXICAL, *SUFFIX), rows)
    kept = stored(drawn.drop("_url"), "labelled-urls")
    found = [row[0] for row in kept.select("_label").distinct().collect()]
    if len(found) < 2:
        return found[0] if found else 0.0
    packed = VectorAssembler(inputCols=[*LEXICAL, *SUFFIX], outputCol="_features").transform(kept)
    learner = GBTClassifier(
        featuresCol="_features", labelCol="_label", maxIter=TREES, maxDepth=DEPTH, seed=SEED
    )
    return learner.fit(packed.select("_features", "_label").repartition(1))


def judge_urls(pages: DataFrame, rules: list[Rule], url: str = "url", label: str | None = None) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict`` and ``score``.

    ``verdict`` is the rule's, else the trees' (block from a score of 0.5). Labels are the column
    ``label`` (1 for block), or, without one, the verdicts of the rules on the URLs that they
    cover. Null URLs and those without ``://`` have an empty host and path. Without any label
    nothing is blocked beyond the rules. Columns of these names give way.
    """
    new = ("host", "path", "rule", "verdict", "score")
    others = [name for name in pages.columns if name.lower() not in new]
    value = quoted(url).cast("string")
    cut = pages.withColumns({"_url": value, "_host": host_of(value), "_path": path_of(value)})
    ruled = cut.withColumn("_rule", rule_of(rules, F.col("_host"), F.col("_path")))
    known = F.when(F.col("_rule").isNotNull(), (F.col("_rule.verdict") == "block").cast("double"))
    if label is not None:
        known = (quoted(label) > 0).cast("double")
    marked = ruled.withColumns(
        {
            "_label": known,
            # Halves by site, so that one site's pages are all in the same.
            "_second": F.pmod(F.xxhash64("_host"), F.lit(2)) == 1,
            "_domain": suffix(F.col("_host"), 2),
            **lexical(F.col("_url"), F.col("_host"), F.col("_path")),
        }
    )
    own_left_out = label is None
    full = marked.join(suffix_statistics(marked, own_left_out), "_domain")
    model = train(full.where(F.col("_label").isNotNull() & (F.lit(own_left_out) | F.col("_second"))))
    if isinstance(model, float):
        scored = full.withColumn("_score", F.lit(model))
    else:
        packed = VectorAssembler(inputCols=[*LEXICAL, *SUFFIX], outputCol="_features").transform(full)
        model.setRawPredictionCol("").setPredictionCol("").setProbabilityCol("_probability")
        scored = model.transform(packed).withColumn("_score", vector_to_array("_probability")[1])
    own = F.when(F.col("_score") >= 0.5, "block").otherwise("allow")
    return scored.select(
        *[quoted(name) for name in others],
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", own).alias("verdict"),
        F.col("_score").alias("score"),
    )

"""URL filter: allow and block rules first, gradient-boosted trees on lexical features for the rest.

A rule such as ``example.org/es/`` fits its host and all subdomains where the path starts with the
rule's; the longest fitting rule wins, then the one with the longer host. URLs that a rule fits are
the labelled ones. Trees are trained on all of them and judge the URLs that no rule fits. Their
features are lengths, depth, digits, entropy, parameters and, from all labelled rows, how often each
host suffix and file suffix was blocked. Numbers enter the trees as ranks among the borders of
``BINS`` ranges of the labelled rows, found exactly, so that no split is looked for in a sample.

All of this is DataFrame code with SQL functions and ``pyspark.ml``.

Defined cases: a NULL URL or one without ``://`` has an empty host and path and the features of the
empty text; with labelled URLs of one verdict only, or none, the rest gets that verdict or ``allow``;
repeated rows are judged alike; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import stored

#: Ranges of each feature; MLlib looks at all of them, where it would look for borders in a sample.
BINS = 32
TREES, DEPTH, SEED = 20, 4, 17
#: Weight of the overall rate in a suffix's rate, in rows.
PRIOR_ROWS = 20.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host):]

    def fits(self) -> F.Column:
        host = F.col("host")
        return ((host == self.host) | host.endswith(f".{self.host}")) & F.startswith(
            F.col("path"), F.lit(self.path))


RULES = (
    Rule("allow", "org/"), Rule("block", "example.org/es/"), Rule("block", "example.org/en/1"),
    Rule("allow", "com/fr/"), Rule("block", "com/de/"),
)


def with_parts(pages: DataFrame, url_col: str) -> DataFrame:
    """Adds ``url``, ``host``, ``path`` and ``rest``, what follows the path."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    at = F.instr(url, "://")
    after = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract("after", "^[^/?#]*", 0)
    path = F.regexp_extract("tail", "^[^?#]*", 0)
    split = pages.withColumns({"url": url, "after": after}).withColumn("raw_host", host).withColumn(
        "tail", F.substr("after", F.length("raw_host") + 1)).withColumn("path", path)
    return split.withColumns({
        "host": F.translate("raw_host", UPPER, LOWER),
        "rest": F.substr("tail", F.length("path") + 1)}).drop("after", "raw_host", "tail")


def _count(text: str | F.Column, what: str) -> F.Column:
    column = F.col(text) if isinstance(text, str) else text
    return F.length(column) - F.length(F.replace(column, F.lit(what), F.lit("")))


def _entropy(text: str) -> F.Column:
    """Shannon entropy of the characters, in nats."""
    total = F.greatest(F.length(text), F.lit(1)).cast("double")
    share = F.transform(F.array_distinct(F.split(text, "")), lambda c: (
        F.length(text) - F.length(F.replace(F.col(text), c, F.lit("")))) / total)
    return F.aggregate(F.filter(share, lambda p: p > 0), F.lit(0.0),
                       lambda a, p: a - p * F.ln(p))


FEATURES = ("length", "host_length", "path_length", "depth", "labels", "digits", "host_digits",
            "entropy", "host_entropy", "parameters", "has_fragment", "hyphens", "is_https",
            "host_rate", "host_rows", "file_rate", "file_rows")


def with_features(parts: DataFrame) -> DataFrame:
    def digits(text: str) -> F.Column:
        return (F.length(text) - F.length(F.translate(F.col(text), "0123456789", ""))
                ) / F.greatest(F.length(text), F.lit(1))

    query = F.regexp_extract("rest", r"^\?([^#]*)", 1)
    return parts.withColumns({
        "length": F.length("url"), "host_length": F.length("host"),
        "path_length": F.length("path"), "depth": _count("path", "/"),
        "labels": _count("host", ".") + 1, "digits": digits("url"), "host_digits": digits("host"),
        "entropy": _entropy("url"), "host_entropy": _entropy("host"),
        "parameters": F.when(query == "", 0).otherwise(_count(query, "&") + 1),
        "has_fragment": F.contains("rest", F.lit("#")).cast("int"),
        "hyphens": _count("url", "-"), "is_https": F.startswith(
            F.col("url"), F.lit("https://")).cast("int"),
        "host_suffix": F.substring_index("host", ".", -1),
        "file_suffix": F.lower(F.regexp_extract("path", r"(\.[A-Za-z0-9]{1,5}|/|[0-9])$", 1)),
    })


def _ranks(train: DataFrame) -> list[F.Column]:
    """Each feature as the number of its range, below ``BINS``, that holds about as many rows.

    Borders are exact percentiles of values with few digits, so that the counts by value which they
    are taken from stay small. The ranks are declared as categories, whose order MLlib learns.
    """
    bins = min(BINS, train.count())  # MLlib takes no more categories than rows
    shares = [i / bins for i in range(1, bins)]

    def short(name: str) -> F.Column:
        value = F.col(name).cast("double")
        return F.round(F.log2(value + 1) if name.endswith("_rows") else value, 2)

    borders = train.agg(*[
        F.percentile(short(name), shares).alias(name) for name in FEATURES]).first()
    kind = {"ml_attr": {"type": "nominal", "num_vals": bins}}

    def rank(name: str) -> F.Column:
        value, limits = short(name), [F.lit(limit) for limit in sorted(set(borders[name]))]
        below = F.filter(F.array(*limits), lambda limit: limit <= value)
        return F.size(below).cast("double").alias(f"{name}_rank", metadata=kind)

    return [rank(name) for name in FEATURES]


def _rates(train: DataFrame, suffix: str, name: str) -> DataFrame:
    """Per suffix the smoothed share of blocked rows among all labelled ones, and their number."""
    rate = (F.sum("label") + 0.5 * PRIOR_ROWS) / (F.count("*") + PRIOR_ROWS)
    return train.groupBy(suffix).agg(
        rate.alias(f"{name}_rate"), F.count("*").cast("double").alias(f"{name}_rows"))


def judged(
    pages: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """Per page: id, ``host``, ``path``, ``rule`` (or NULL) and ``verdict``."""
    ranked = sorted(rules, key=lambda r: (len(r.text), len(r.host)), reverse=True)
    parts = with_parts(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("given")),
                       "given").drop("given")
    rule = F.coalesce(*(F.when(r.fits(), F.lit(r.text)) for r in ranked), F.lit(None))
    by_rule = F.coalesce(*(F.when(F.col("rule") == r.text, F.lit(r.verdict)) for r in ranked),
                         F.lit(None))
    ruled = parts.withColumn("rule", rule).withColumn("by_rule", by_rule)
    train = stored(with_features(ruled.where("rule is not null")).withColumn(
        "label", (F.col("by_rule") == "block").cast("double")))
    seen = {row["by_rule"] for row in train.select("by_rule").distinct().collect()}
    if len(seen) < 2:
        rest = F.lit(next(iter(seen), "allow"))
        return ruled.select(F.col("id").alias(id_col), "host", "path", "rule",
                            F.coalesce("by_rule", rest).alias("verdict"))
    host = stored(_rates(train, "host_suffix", "host"))
    file = stored(_rates(train, "file_suffix", "file"))
    rated = {"host_rate": 0.5, "host_rows": 0.0, "file_rate": 0.5, "file_rows": 0.0}

    def rated_rows(rows: DataFrame) -> DataFrame:
        return rows.join(host, "host_suffix", "left").join(file, "file_suffix", "left").fillna(rated)

    ranks = _ranks(rated_rows(train))

    def assembled(rows: DataFrame) -> DataFrame:
        return VectorAssembler(inputCols=[f"{name}_rank" for name in FEATURES], outputCol="features"
                               ).transform(rated_rows(rows).select("*", *ranks))

    model = GBTClassifier(
        maxIter=TREES, maxDepth=DEPTH, maxBins=BINS, seed=SEED, featuresCol="features", labelCol="label").fit(
            assembled(train).select("features", "label"))
    scored = model.transform(assembled(with_features(ruled)))
    by_model = F.when(F.col("prediction") > 0.5, "block").otherwise("allow")
    return scored.select(F.col("id").alias(id_col), "host", "path", "rule",
                         F.coalesce("by_rule", by_model).alias("verdict"))

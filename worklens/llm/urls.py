"""URL filter: host and path rules, then gradient-boosted trees over lexical features.

Everything is DataFrame functions and Spark's own tree learner; no Python runs on the executors.
Rules decide first (the longest that fits). Other URLs are judged by trees over length, depth, digit
ratio, entropy, parameter counts and the statistics of the host's suffix, learned from labelled URLs.

Defined results: a NULL URL and one without ``://`` have an empty host and path, fit no rule and are
judged by the trees like any other; equal URLs get equal results; other columns pass through; no
rows give no rows; without labelled URLs every URL that no rule fits is allowed, and with one label
only, that label holds.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from worklens.llm.common import few_rows, hash_sample, saved


class Rule(NamedTuple):
    verdict: str
    rule: str  # host/path


#: Rules of the registered query.
RULES = (
    Rule("allow", "com/"), Rule("block", "example.com/en/"), Rule("allow", "www.example.com/en/"),
    Rule("block", "net/es/"), Rule("block", "net/fr/"),
)
#: Words that, as a part of a host, label a URL as unwanted.
UNWANTED = (
    "ad", "ads", "adult", "bet", "bets", "betting", "casino", "click", "crack", "dating", "farm",
    "jackpot", "loan", "lottery", "malware", "phishing", "pills", "pharma", "poker", "popup", "porn",
    "sex", "spam", "torrent", "track", "tracker", "viagra", "warez", "xxx",
)
#: Labelled URLs that the trees are fitted on, those of the smallest hash.
SAMPLE = 20_000
TREES, DEPTH = 15, 4
#: Blocked share given to a suffix as if seen so many times more.
PRIOR_ROWS = 20
#: Rows of suffix statistics that may be broadcast, some 100 bytes each.
SUFFIXES = 100_000


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def matching_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """``struct<rule, verdict>`` of the longest rule that fits, else NULL."""
    found = None
    for verdict, rule in sorted(rules, key=lambda r: (-len(r.rule), r.rule)):
        of, slash, below = rule.partition("/")
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(slash + below)
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return found


def label_of(host: Column) -> Column:
    """1 where a part of the host is an unwanted word, else 0."""
    parts = F.split(host, r"[.\-_]")
    return F.arrays_overlap(parts, F.array(*map(F.lit, UNWANTED))).cast("double")


def suffix_of(host: Column) -> Column:
    """The host's last two labels."""
    return F.substring_index(host, ".", -2)


def lexical_features(url: Column, host: Column, path: Column) -> list[Column]:
    text = F.coalesce(url, F.lit(""))
    n = F.greatest(F.length(text), F.lit(1)).cast("double")

    def share(column: Column, pattern: str, of: Column) -> Column:
        return F.regexp_count(column, F.lit(pattern)) / of

    letters = F.array_distinct(F.split(text, ""))
    entropy = F.aggregate(
        F.transform(letters, lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n),
        F.lit(0.0), lambda total, p: total - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    name = F.substring_index(host, ".", -3)
    return [
        F.length(text), F.length(host), F.length(path),
        F.regexp_count(path, F.lit("/")), F.regexp_count(host, F.lit(r"\.")),
        share(text, r"\d", n), entropy,
        F.regexp_count(text, F.lit(r"[?&][^=&#]+=")), F.regexp_count(host, F.lit("[-_]")),
        share(name, "[aeiou]", F.greatest(F.length(name), F.lit(1))),
        F.regexp_count(host, F.lit("[bcdfghjklmnpqrstvwxz]{4}")),
        F.length(F.regexp_extract(path, r"\d+", 0)),
        F.startswith(text, F.lit("https")).cast("int"),
    ]


def with_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host`` and ``path``."""
    return pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})


def half_of(host: Column) -> Column:
    """0 or 1, the same for all URLs of a host."""
    return F.pmod(F.xxhash64(host), F.lit(2))


def with_features(urls: DataFrame, suffixes: DataFrame, base: float, url: str = "url",
                  halves: bool = False) -> DataFrame:
    """``urls`` (with host and path) with ``features``.

    A suffix without statistics has the share ``base``. With ``halves`` the statistics are those of
    the hosts in the half that a row's own host is not in.
    """
    fits = suffix_of(F.col("host")) == F.col("suffix")
    if halves:
        fits = fits & (half_of(F.col("host")) != F.col("half"))
    seen = urls.join(few_rows(suffixes, SUFFIXES), fits, "left")
    values = lexical_features(F.col(url), F.col("host"), F.col("path")) + [
        F.coalesce("blocked_share", F.lit(base)), F.log1p(F.coalesce("seen", F.lit(0)))]
    vector = array_to_vector(F.array(*(v.cast("double") for v in values)))
    return seen.withColumn("features", vector).drop("suffix", "half", "blocked_share", "seen")


def train(labelled: DataFrame, sample: int = SAMPLE):
    """(model, suffix statistics, base rate) from ``url, label``.

    Copies of a URL with the same label count once. The model is the label itself where there is one
    only, and NULL without labels. The trees are fitted on the ``sample`` distinct URLs of the
    smallest hash; the statistics cover all distinct URLs. A row is fitted with the statistics of the hosts in the other half, counted double to
    stand for the whole, so that neither it nor its host gives its own label away.
    """
    known = saved(labelled.select("url", "label").where("label is not null").distinct())
    rows = saved(with_parts(hash_sample(known, sample, "url", "label")))
    host = host_of(F.col("url"))
    counts = saved(known.groupBy(suffix_of(host).alias("suffix"), half_of(host).alias("half")).agg(
        F.sum("label").alias("bad"), F.count(F.lit(1)).alias("n")))
    n, bad = counts.agg(F.sum("n"), F.sum("bad")).first()
    base = bad / n if n else 0.0

    def statistics(of: DataFrame) -> DataFrame:
        share = (F.col("bad") + PRIOR_ROWS * F.lit(base)) / (F.col("n") + PRIOR_ROWS)
        return saved(of.withColumn("blocked_share", share).withColumnRenamed("n", "seen").drop("bad"))

    suffixes = statistics(counts.groupBy("suffix").agg(
        F.sum("bad").alias("bad"), F.sum("n").alias("n")))
    if not n or base in (0.0, 1.0):
        return (base if n else None), suffixes, base
    halves = statistics(counts.withColumns({"bad": 2 * F.col("bad"), "n": 2 * F.col("n")}))
    learner = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7, labelCol="label",
                            featuresCol="features", stepSize=0.2)
    fitted = with_features(rows, halves, base, halves=True)
    return learner.fit(fitted.select("features", "label")), suffixes, base


def judge(pages: DataFrame, labelled: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``blocked_score`` and ``verdict``.

    Columns of these names are replaced.
    """
    made = ("host", "path", "rule", "blocked_score", "verdict", "features", "rawPrediction",
            "probability", "prediction", "suffix", "half", "blocked_share", "seen", "_matched")
    rest = pages.drop(*made)
    names = [F.col(f"`{c}`") for c in rest.columns]
    model, suffixes, base = train(labelled)
    parts = with_parts(rest)
    if model is None or isinstance(model, float):
        scored = parts.withColumn("blocked_score", F.lit(float(model or 0.0)))
    else:
        scored = model.transform(with_features(parts, suffixes, base)).withColumn(
            "blocked_score", vector_to_array("probability")[1])
    method = F.when(F.col("blocked_score") >= 0.5, "block").otherwise("allow")
    matched = scored.withColumn("_matched", matching_rule(F.col("host"), F.col("path"), rules))
    return matched.select(
        *names, "host", "path", F.col("_matched.rule").alias("rule"), "blocked_score",
        F.coalesce(F.col("_matched.verdict"), method).alias("verdict"))


def labelled_by_host(pages: DataFrame) -> DataFrame:
    """(url, label): labels of a table's own URLs by the words in their hosts."""
    return with_parts(pages.select("url").where("url is not null")).select(
        "url", label_of(F.col("host")).alias("label"))

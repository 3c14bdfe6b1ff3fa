"""URL verdicts: explicit rules first, then empirical-Bayes reputation of the host.

Labelled page outcomes are counted per host. A host's rate of bad pages is drawn towards that of its registered domain,
that one towards its public suffix and that one towards all pages, by beta priors whose strength comes from how far the
children of one parent lie apart. A host is blocked if a lower bound of its posterior rate is above a threshold. All of
it is DataFrame operations; hosts are aggregated before anything is joined.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# (verdict, host, path): fixed values of the query's contract
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
# Suffixes of two labels under which names are registered, unless a caller gives its own; any other suffix is the last label.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.jp", "co.nz", "co.uk", "com.au", "com.br", "gov.uk", "org.uk")
THRESHOLD = 0.5
Z = 1.645
LEAST_STRENGTH = 1.0
MOST_STRENGTH = 10_000.0

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """From the first ``://`` to the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    found = F.coalesce(F.regexp_extract(url, _URL, 1), F.lit(""))
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _suffix_labels(host: Column, suffixes: Sequence[str]) -> Column:
    """Number of labels of the longest of ``suffixes`` that the host ends in; 1 without one."""
    labels = F.lit(1)
    for size in sorted({s.count(".") + 1 for s in suffixes}):
        own = [s for s in suffixes if s.count(".") + 1 == size]
        labels = F.when(F.substring_index(host, ".", -size).isin(*own), F.lit(size)).otherwise(labels)
    return labels


def suffix_of(host: Column, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> Column:
    return _last_labels(host, _suffix_labels(host, suffixes))


def domain_of(host: Column, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> Column:
    """The suffix and one label before it."""
    return _last_labels(host, _suffix_labels(host, suffixes) + 1)


def _last_labels(host: Column, count: Column) -> Column:
    labels = F.split(host, r"\.", -1)
    return F.array_join(F.slice(labels, -F.least(count, F.size(labels)), count), ".")


def rule_columns(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits host and path, and its verdict; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r)):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def _strength(children: DataFrame, parent: list[str]) -> DataFrame:
    """Per parent: ``n``, ``bad`` and the strength of the prior that it gives its children, by moments."""
    sums = children.groupBy(*parent).agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum(F.col("n") * F.col("n")).alias("squares"),
        F.sum(F.coalesce(F.try_divide(F.col("bad") * F.col("bad"), F.col("n")), F.lit(0.0))).alias("spread"),
        F.sum(F.when(F.col("n") > 0, F.lit(1)).otherwise(F.lit(0))).alias("seen"),
    )
    # Null wherever a parent has no labelled page: such expressions may be computed before a condition is looked at.
    n = F.nullif(F.col("n"), F.lit(0))
    rate = F.col("bad") / n
    chance = rate * (1 - rate)
    size = F.nullif(F.col("n") - F.col("squares") / n, F.lit(0.0))
    between = (F.col("spread") - F.col("bad") * rate - (F.col("seen") - 1) * chance) / size
    apart = F.try_divide(chance, F.nullif(between, F.lit(0.0))) - 1
    fitted = F.when(between > 0, F.least(F.greatest(apart, F.lit(LEAST_STRENGTH)), F.lit(MOST_STRENGTH))).when(
        size > 0, F.lit(MOST_STRENGTH)
    ).otherwise(F.lit(LEAST_STRENGTH))
    return sums.select(*parent, "n", "bad", fitted.alias("strength"))


def host_reputation(outcomes: DataFrame, *, z: float = Z, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> DataFrame:
    """``(host, n, bad, posterior, lower)`` from ``(host, n, bad)``, one row per host; ``n`` may be 0.

    Without any labelled page the rate of all pages counts as one half, with the least strength.
    """
    host = F.col("host")
    hosts = outcomes.select("host", domain_of(host, suffixes).alias("domain"), suffix_of(host, suffixes).alias("suffix"), "n", "bad")
    domains = _strength(hosts, ["domain", "suffix"])
    suffixes = _strength(domains, ["suffix"])
    overall = _strength(suffixes.withColumn("all", F.lit(1)), ["all"]).select(
        "all", F.col("strength").alias("top_strength"), ((F.col("bad") + 1) / (F.col("n") + 2)).alias("top_rate")
    )
    suffix_rates = suffixes.withColumn("all", F.lit(1)).join(overall, "all").select(
        "suffix", F.col("strength").alias("suffix_strength"),
        ((F.col("bad") + F.col("top_strength") * F.col("top_rate")) / (F.col("n") + F.col("top_strength"))).alias("suffix_rate"),
    )
    domain_rates = domains.join(suffix_rates, "suffix").select(
        "domain", "suffix", F.col("strength").alias("domain_strength"),
        ((F.col("bad") + F.col("suffix_strength") * F.col("suffix_rate")) / (F.col("n") + F.col("suffix_strength"))).alias("domain_rate"),
    )
    alpha = F.col("bad") + F.col("domain_strength") * F.col("domain_rate")
    weight = F.col("n") + F.col("domain_strength")
    mean = alpha / weight
    return hosts.join(domain_rates, ["domain", "suffix"]).select(
        "host", "n", "bad", mean.alias("posterior"),
        (mean - F.lit(z) * F.sqrt(mean * (1 - mean) / (weight + 1))).alias("lower"),
    )


def url_verdicts(
    pages: DataFrame, labels: DataFrame, *, id: str = "page_id", url: str = "url",
    label_id: str = "label_id", rules: Sequence[tuple[str, str, str]] = RULES,
    threshold: float = THRESHOLD, z: float = Z, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES,
) -> DataFrame:
    """``(id, host, path, rule, verdict, posterior, lower)`` for every row of ``pages``.

    ``labels`` has one row per ``label_id``, a number that stands second in the path of a labelled page, and ``bad``, 0 or
    1; rows with nulls there label nothing. ``suffixes`` are the ones of several labels under which names are registered, such
    as the entries of a public list. A null url has an empty host and path. Repeated rows stay, other columns of ``pages``
    are not read.
    """
    parsed = pages.select(F.col(id).alias(id), F.col(url).cast("string").alias("_url")).select(
        id, host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path")
    )
    number = F.regexp_extract("path", r"^/[^/]*/([0-9]{1,18})", 1)
    counted = parsed.groupBy("host", F.when(number != "", number.cast("long")).alias("_number")).agg(F.count("*").alias("pages"))
    known = labels.filter(F.col(label_id).isNotNull() & F.col("bad").isNotNull()).groupBy(
        F.col(label_id).alias("_number")
    ).agg(F.max("bad").cast("long").alias("bad"))
    outcomes = counted.join(known, "_number", "left").groupBy("host").agg(
        F.coalesce(F.sum(F.when(F.col("bad").isNotNull(), F.col("pages"))), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.col("bad") * F.col("pages")), F.lit(0)).alias("bad"),
    )
    reputation = host_reputation(outcomes, z=z, suffixes=suffixes).select("host", "posterior", "lower")
    rule, ruled = rule_columns(F.col("host"), F.col("path"), rules)
    return parsed.join(reputation, "host").select(
        id, "host", "path", rule.alias("rule"),
        F.coalesce(ruled, F.when(F.col("lower") > threshold, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "posterior", "lower",
    )

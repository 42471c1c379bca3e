"""URL filter by rules and by empirical-Bayes host reputation.

Labelled outcomes of pages are counted per host. The bad rate of a host is shrunk by a beta-binomial
prior towards that of its registered domain, that in turn towards its public suffix, and
that towards all pages. The strength of each level's prior is estimated from the
counts themselves, by the moments of the beta-binomial (how much more the rates of
its groups vary than chance alone would make them). A host without labels
has the prior of its domain.

A page is blocked when the lower bound of its host's posterior bad rate lies above
`THRESHOLD`; a rule that fits the page comes first. Only DataFrame functions are
used. Counts are aggregated before they are shuffled, and the join with the hosts is
split by adaptive execution where one host has very many pages.

Defined cases: a NULL url, or one without `://`, has an empty host and path; these pages
share the reputation of the empty host. Repeated rows are judged alike. Labels that
repeat an id count once (the worst). Extra columns are ignored; an empty table
gives an empty result, empty labels leave all unruled pages allowed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from keelstone.llm.shared import stage

THRESHOLD = 0.5
Z = 1.645  # one-sided 95 %
STRENGTH = (1.0, 1000.0)  # bounds of a prior's strength, in pages

#: Suffixes of two labels under which domains are registered; all others have one.
TWO_LABEL_SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "org.uk", "co.jp", "or.jp", "com.au", "net.au", "org.au", "co.nz",
    "com.br", "com.cn", "co.in", "co.kr", "co.za", "com.mx", "com.tr", "com.tw",
)


@dataclass(frozen=True)
class Rule:
    """`host/path-prefix`; fits the host and its subdomains."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


RULES = (
    Rule("net/", "block"), Rule("example.net/en/", "allow"), Rule("example.com/de/", "block"),
    Rule("org/fr/", "allow"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    has = F.coalesce(F.contains(url, F.lit("://")), F.lit(False))
    rest = F.substring_index(url, "://", 1)
    rest = F.substring(url, F.length(rest) + 4, F.length(url))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(has, host).otherwise(""), F.when(has, path).otherwise("")


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    """Registered domain and public suffix of a host, without its port."""
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":\d*$", "")
    two = F.substring_index(bare, ".", -2)
    three = F.substring_index(bare, ".", -3)
    numeric = bare.rlike(r"^[0-9.]+$") | bare.contains("[")
    long_suffix = two.isin(*TWO_LABEL_SUFFIXES)
    domain = F.when(numeric, bare).when(long_suffix, three).otherwise(two)
    suffix = F.when(numeric, "").when(long_suffix, two).otherwise(F.substring_index(bare, ".", -1))
    return domain, suffix


def rule_and_verdict(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; NULL if none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = (
            ((host == rule.host) | F.endswith(host, F.lit("." + rule.host)))
            & F.startswith(path, F.lit(rule.path))
        )
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def _strength(groups: DataFrame) -> float:
    """Strength of the beta prior that the rates of `groups` (n, bad) come from, by moments."""
    row = groups.where("n > 0").agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum("bad").alias("bad"),
        F.sum(F.col("n") * F.col("n")).alias("nn"), F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("s"),
    ).first()
    if not row["n"] or row["k"] < 2:
        return STRENGTH[1]
    mean = row["bad"] / row["n"]
    between = row["s"] - row["n"] * mean * mean  # sum of n (rate - mean)^2
    chance = (row["k"] - 1) * mean * (1 - mean)
    spread = (between - chance) / (row["n"] - row["nn"] / row["n"] - (row["k"] - 1) or 1)
    if spread <= 0:
        return STRENGTH[1]
    return min(max(mean * (1 - mean) / spread - 1, STRENGTH[0]), STRENGTH[1])


def reputation(hosts: DataFrame, z: float = Z) -> DataFrame:
    """(host, rate, lower) from counts per host: host, n (labelled pages) and bad.

    rate is the posterior mean, lower its lower bound.
    """
    domain, suffix = domain_and_suffix(F.col("host"))
    hosts = hosts.select("host", "n", "bad", domain.alias("domain"), suffix.alias("suffix"))
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    total = suffixes.agg(F.sum("n"), F.sum("bad")).first()
    overall = ((total[1] or 0) + 0.5) / ((total[0] or 0) + 1.0)
    by_suffix, by_domain, by_host = _strength(suffixes), _strength(domains), _strength(hosts)

    def shrunk(prior: Column | float, strength: float) -> Column:
        prior = F.lit(prior) if isinstance(prior, float) else prior
        return (F.col("bad") + strength * prior) / (F.col("n") + strength)

    suffixes = suffixes.select("suffix", shrunk(overall, by_suffix).alias("suffix_rate"))
    domains = domains.join(suffixes, "suffix").select(
        "domain", "suffix", shrunk(F.col("suffix_rate"), by_domain).alias("domain_rate")
    )
    rate = shrunk(F.col("domain_rate"), by_host)
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + by_host + 1))
    return (
        hosts.join(domains, ["domain", "suffix"])
        .select("host", "n", rate.alias("rate"))
        .select("host", "rate", F.greatest(F.lit(0.0), F.col("rate") - z * deviation).alias("lower"))
    )


def judge(
    pages: DataFrame, labels: DataFrame, rules: Sequence[Rule] = RULES, threshold: float = THRESHOLD
) -> DataFrame:
    """(page_id, host, path, rule, verdict, bad_rate, lower_bound) of every page.

    `labels` has doc_id, quality (0: bad) and toxic (1: bad); the document of a page is the
    number in the last part of its path.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    number = F.regexp_extract("path", r"/(\d{1,18})[^/]*/?$", 1).try_cast("bigint")
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    outcomes = (
        labels.where("quality is not null or toxic is not null")
        .groupBy(F.col("doc_id").alias("_doc")).agg(F.max(bad).alias("is_bad"))
    )
    counted = (
        rows.select("host", number.alias("_doc"))
        .join(outcomes, "_doc", "left")
        .groupBy("host")
        .agg(F.count("is_bad").alias("n"), F.count_if("is_bad").alias("bad"))
    )
    # Written once: the three priors and the rates all read these few rows.
    known = reputation(stage(counted, "host_counts"))
    rule, ruled = rule_and_verdict(F.col("host"), F.col("path"), rules)
    judged = F.when(F.col("lower") > threshold, "block").otherwise("allow")
    return rows.join(known, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(ruled, judged).alias("verdict"),
        F.col("rate").alias("bad_rate"), F.col("lower").alias("lower_bound"),
    )

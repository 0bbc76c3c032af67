"""URL filter: explicit rules, else empirical-Bayes host reputation.

A page is bad if its label says low quality or toxic.  The labels name
documents; a page's label is that of the document with its id (the tables have
no other labelled outcome for pages).  Bad rates are shrunk
through beta-binomial priors down the chain all pages -> suffix -> registered
domain -> host: a group's prior mean is its parent's posterior mean, and the
level's prior strength comes from the data (moment estimate of the
over-dispersion of its groups' outcomes).  A host is blocked if the lower
posterior bound of its bad rate (mean minus Z standard deviations) exceeds
``LIMIT``: one half, where a page of the host is more likely bad than good and
blocking costs fewer good pages than it stops bad ones.  Hosts without labelled pages take their domain's or suffix's
posterior as prior and are blocked by the same bound.

Outcome counts are aggregated per host before any other step (a host with a
third of all pages is one row from then on) and written once; the levels above
are aggregates of those rows, written too, and a level's strength is one
number on the driver.  Pages are scanned twice.  Pages meet their host's verdict in one equi-join on the host,
which adaptive execution splits where a host is hot.  DataFrame functions
only.

Null urls and urls without ``://`` have empty host and path, form one host
group, and are judged like any other.  Repeated labels of one page count once
(bad if any of them is).  Repeated pages are rows of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: Allow or block, host, path; the longest fitting rule wins.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
LIMIT = 0.5
Z = 1.645
#: Suffixes of two labels; every other suffix is the last label.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "co.jp", "com.br", "co.nz", "co.in", "co.za")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"^(?s:.*?)://([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    u = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(u, _URL, 1), _UPPER, _LOWER), F.regexp_extract(u, _URL, 2)


def suffix_and_domain(host: Column) -> tuple[Column, Column]:
    """Suffix and registered domain (suffix plus one label) of a host; the port is left out."""
    labels = F.split(F.regexp_replace(host, ":[0-9]*$", ""), r"\.")
    two = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")
    three = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 2, F.lit(1)), 3), ".")
    long = two.isin(*TWO_LABEL_SUFFIXES)
    return F.when(long, two).otherwise(F.element_at(labels, -1)), F.when(long, three).otherwise(two)


def rule_verdict(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule as host + path, allow or block) of the longest rule that fits, else nulls."""
    name = what = None
    for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, F.lit(h + p)) if name is None else name.when(fits, F.lit(h + p))
        what = F.when(fits, F.lit(verdict)) if what is None else what.when(fits, F.lit(verdict))
    return (name, what) if rules else (F.lit(None).cast("string"),) * 2


def _strength(groups: DataFrame, prior: str) -> float:
    """The level's prior strength: moment estimate of the over-dispersion of
    its groups' outcomes (columns n and bad) around their prior means."""
    m, n = F.col(prior), F.col("n").cast("double")
    spread = m * (1 - m)
    over = groups.agg((F.sum(F.pow(F.col("bad") - n * m, F.lit(2.0)) - n * spread)).alias("x"), F.sum(n * (n - 1) * spread).alias("y"))
    rho = F.least(F.lit(0.9), F.greatest(F.lit(0.001), F.coalesce(F.try_divide("x", "y"), F.lit(0.5))))
    return over.select((1.0 / rho - 1.0).alias("s")).first()["s"]


def _shrink(groups: DataFrame, prior: str, out: str) -> DataFrame:
    """Posterior mean (``out``) and variance (``out_var``) of each group's bad
    rate under Beta(prior * s, (1 - prior) * s)."""
    s = F.lit(_strength(groups, prior))
    total = s + F.col("n").cast("double")
    mean = (F.col(prior) * s + F.col("bad")) / total
    return groups.withColumn(out, mean).withColumn(out + "_var", F.col(out) * (1 - F.col(out)) / (total + 1))


def host_reputation(pages: DataFrame, labels: DataFrame, page_id: str = "page_id", url_col: str = "url",
                    label_id: str = "doc_id") -> DataFrame:
    """One row per host of ``pages``: host, n, bad, bad_rate, bound."""
    bad = F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0))
    outcome = labels.filter(F.col(label_id).isNotNull()).groupBy(F.col(label_id).alias("_id")).agg(bad.alias("_bad"))
    seen = pages.select(F.col(page_id).alias("_id"), host_and_path(F.col(url_col))[0].alias("host"))
    suffix, domain = suffix_and_domain(F.col("host"))
    hosts = (seen.join(outcome, "_id", "left").groupBy("host").agg(F.count("_bad").alias("n"), F.coalesce(F.sum("_bad"), F.lit(0)).alias("bad"))
             .withColumn("suffix", suffix).withColumn("domain", domain))
    hosts = materialize(hosts, "hosts")
    domains = materialize(hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "domains")
    suffixes = materialize(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "suffixes")
    # half a bad and half a good page more than seen keep the top mean inside (0, 1)
    top = suffixes.agg(((F.coalesce(F.sum("bad"), F.lit(0)) + 0.5) / (F.coalesce(F.sum("n"), F.lit(0)) + 1.0)).alias("m")).first()["m"]
    s = _shrink(suffixes.withColumn("m0", F.lit(top)), "m0", "m1").select("suffix", "m1")
    d = materialize(_shrink(domains.join(s, "suffix"), "m1", "m2").select("suffix", "domain", "m2"), "domain_rates")
    h = _shrink(hosts.join(d, ["suffix", "domain"]), "m2", "bad_rate")
    return h.select("host", "n", "bad", "bad_rate", (F.col("bad_rate") - Z * F.sqrt("bad_rate_var")).alias("bound"))


def judge(pages: DataFrame, labels: DataFrame, page_id: str = "page_id", url_col: str = "url", rules=RULES,
          limit: float = LIMIT) -> DataFrame:
    """Per page row: page_id, host, path, rule, verdict, bad_rate, bound."""
    hosts = host_reputation(pages, labels, page_id, url_col)
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(page_id), host.alias("host"), path.alias("path"))
    rule, said = rule_verdict(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("bound") > limit, "block").otherwise("allow")
    return (rows.join(hosts, "host").select(page_id, "host", "path", rule.alias("rule"), F.coalesce(said, method).alias("verdict"),
                                            "bad_rate", "bound"))

"""URL verdicts from a list of rules and empirical-Bayes host reputation.

Rules decide first. Elsewhere a host's chance of a bad page is estimated from labelled pages: a beta-binomial
posterior whose prior is shrunk from the host to its registered domain, from there to its suffix and from there to
the whole. Prior strengths are estimated from the spread of the labelled groups at each level. Every host of the pages
has a posterior: without labelled pages it is its domain's, its suffix's or the whole's. A host is blocked where the
lower bound of its posterior lies above a limit, so that few labels do not block. The bound is the posterior's mean less a
multiple of its standard deviation: Spark has no beta quantile.

DataFrame functions only; nothing runs in Python on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage

#: Standard deviations below the posterior mean at which the bound lies, and the bad share it must exceed.
BOUND = 1.645
LIMIT = 0.5
#: Range of a prior's strength, in pages.
WEAKEST, STRONGEST = 2.0, 200.0
#: So many rules are compiled into one expression; more are a table that is joined to the suffixes of hosts.
COMPILED_RULES = 256
#: The suffix of all addresses, which have no domain above them.
ADDRESS = "[address]"

#: Common public suffixes of two labels. Any other suffix counts as one label.
SUFFIXES = tuple(
    f"{second}.{top}"
    for top, seconds in {
        "uk": "ac co gov ltd me net org plc", "au": "com edu gov id net org", "nz": "ac co geek govt net org", "za": "ac co gov net org", "jp": "ac co go ne or",
        "kr": "ac co go ne or", "in": "ac co edu gov net org", "il": "ac co gov net org", "br": "com edu gov net org", "ar": "com edu gob net org", "mx": "com edu gob net org",
        "tr": "com edu gov net org", "cn": "ac com edu gov net org", "tw": "com edu gov net org", "hk": "com edu gov net org", "sg": "com edu gov net org", "my": "com edu gov net org",
        "th": "ac co go in or", "id": "ac co go or web", "ua": "com edu gov net org", "pl": "com edu gov net org", "eg": "com edu gov net org", "tn": "com gov net org",
    }.items()
    for second in seconds.split()
)

LEVELS = ("suffix", "domain", "host")


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: Fixed values.
RULES = (
    UrlRule("block", "com", "/en/"),
    UrlRule("allow", "example.com", "/en/7"),
    UrlRule("allow", "net", "/de/"),
    UrlRule("block", "example.net", "/de/8"),
    UrlRule("block", "org", "/es/"),
)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """What stands after the first '://', up to '/', '?', '#' or the end, in lower case; '' without '://' or for null."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to '?', '#' or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def name_of(host: Column) -> Column:
    """host without credentials and port."""
    return F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")


def is_address(name: Column) -> Column:
    return name.rlike(r"^([0-9]{1,3}\.){3}[0-9]{1,3}$") | name.startswith("[")


def domain_of(host: Column) -> Column:
    """The registered domain: the suffix and the label before it; a host without one, or an address, itself."""
    name = name_of(host)
    last = F.substring_index(name, ".", -2)
    return F.when(is_address(name), name).when(last.isin(*SUFFIXES), F.substring_index(name, ".", -3)).otherwise(last)


def suffix_of(host: Column) -> Column:
    """The last two labels where they are among SUFFIXES, else the last one; ADDRESS for an address."""
    name = name_of(host)
    last = F.substring_index(name, ".", -2)
    return F.when(is_address(name), ADDRESS).when(last.isin(*SUFFIXES), last).otherwise(F.substring_index(name, ".", -1))


def fits(rule: UrlRule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def first_fit(rules: tuple[UrlRule, ...], host: Column, path: Column, value) -> Column:
    """value(rule) of the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), len(r.host))):
        out = F.when(fits(rule, host, path), F.lit(value(rule))).otherwise(out)
    return out


def rules_of_hosts(hosts: DataFrame, rules: tuple[UrlRule, ...]) -> DataFrame:
    """(host, fitting): for hosts that rules fit, those rules as structs, the longest first."""
    rows = [(r.host, -len(r.name), -len(r.host), -i, r.path, r.name, r.verdict) for i, r in enumerate(rules)]
    table = hosts.sparkSession.createDataFrame(rows, "of string, l int, h int, i int, path string, name string, verdict string")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda at: F.array_join(F.slice(labels, at, F.size(labels)), "."))
    fitting = F.array_sort(F.collect_list(F.struct("l", "h", "i", "path", "name", "verdict")))
    return hosts.select("host", F.explode(suffixes).alias("of")).join(table, "of").groupBy("host").agg(fitting.alias("fitting"))


def strength(groups: DataFrame) -> Column:
    """Prior strength by moments, from the groups' n and bad: how much their shares spread beyond what chance gives."""
    n, bad, g = F.sum("n"), F.sum("bad"), F.count("*")
    mean = F.try_divide(bad, n)
    # Sum of n (p - mean)^2, without a second pass.
    spread = F.sum(F.col("bad") * F.col("bad") / F.col("n")) - F.try_divide(bad * bad, n)
    within = mean * (1 - mean)
    between = F.try_divide(spread - (g - 1) * within, n - F.try_divide(F.sum(F.col("n") * F.col("n")), n))
    k = F.when(between > 0, F.try_divide(within - between, between)).otherwise(F.lit(STRONGEST))
    return F.greatest(F.lit(WEAKEST), F.least(F.lit(STRONGEST), F.coalesce(k, F.lit(STRONGEST))))


def reputation(outcomes: DataFrame) -> DataFrame:
    """One row for each host of outcomes (host, bad: 0, 1 or null for no label): host, n, bad_pages, mean, bound (of the chance of a bad page).

    Outcomes are summed to hosts before anything else, so that a hot host shuffles one row from each task.
    """
    hosts = cut_lineage(outcomes.groupBy("host").agg(F.count("bad").cast("double").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("bad")).select("host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"), "n", "bad"))
    domains = cut_lineage(hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")))
    suffixes = cut_lineage(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")))
    # One row each: sums over the level's groups.
    overall = suffixes.agg(F.coalesce(F.try_divide(F.sum("bad"), F.sum("n")), F.lit(0.0)).alias("m")).first()["m"]
    # Groups without labels tell nothing about the spread.
    k = {level: t.where("n > 0").agg(strength(t).alias("k")).first()["k"] for level, t in zip(LEVELS, (suffixes, domains, hosts), strict=True)}

    def shrunk(mean: Column, level: str) -> Column:
        return (F.col("bad") + F.lit(k[level]) * mean) / (F.col("n") + F.lit(k[level]))

    s = suffixes.select("suffix", shrunk(F.lit(overall), "suffix").alias("suffix_mean"))
    d = cut_lineage(domains.join(s, "suffix").select("domain", shrunk(F.col("suffix_mean"), "domain").alias("domain_mean")))
    mean = shrunk(F.col("domain_mean"), "host")
    sd = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + F.lit(k["host"]) + 1))
    return hosts.join(d, "domain").withColumn("mean", mean).select("host", F.col("n").cast("long").alias("n"), F.col("bad").cast("long").alias("bad_pages"), "mean", (F.col("mean") - BOUND * sd).alias("bound"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: tuple[UrlRule, ...] = RULES, url: str = "url", id: str = "page_id") -> DataFrame:
    """One row for each row of pages: its id, host, path, rule, verdict and bound.

    outcomes: (id, bad) for some pages, bad 0 or 1; nulls are left aside. A null url has an empty host and path
    and is judged as any host. A host without labelled pages has the bound of its domain's mean at n = 0.
    """
    read = pages.select(F.col(id).alias("page"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    labelled = outcomes.where(F.col("bad").isin(0, 1)).select(F.col(id).alias("page"), "bad")
    judged = read.select("page", "host").join(labelled, "page").select("host", "bad")
    # All hosts beside the labelled pages, so that no page is left out where its id is null or unlabelled.
    known = cut_lineage(reputation(judged.unionByName(read.select("host", F.lit(None).cast("int").alias("bad")))))
    known = known.select("host", "bound")
    if len(rules) <= COMPILED_RULES:
        rule = first_fit(rules, F.col("host"), F.col("path"), lambda r: r.name)
        ruled = first_fit(rules, F.col("host"), F.col("path"), lambda r: r.verdict)
    else:
        known = known.join(rules_of_hosts(known.select("host"), rules), "host", "left")
        longest = F.get(F.filter("fitting", lambda r: F.startswith(F.col("path"), r["path"])), F.lit(0))
        rule, ruled = longest["name"], longest["verdict"]
    method = F.when(F.col("bound") > LIMIT, "block").otherwise("allow")
    # Joined on both sides' own exchanges, so that adaptive execution can split a hot host.
    return read.join(known, "host", "left").select(F.col("page").alias(id), "host", "path", rule.alias("rule"), F.coalesce(ruled, method).alias("verdict"), "bound")

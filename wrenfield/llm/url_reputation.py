"""URL filter by empirical-Bayes reputation of hosts, with rules that come first. Spark expressions only.

Outcomes are labelled pages (1: bad). Counts per host are shrunk through beta-binomial priors in three steps:
a suffix (``org``) towards the overall rate, a registered domain (``example.org``) towards its suffix, a host
towards its domain. The weight of each prior is the moment estimate of the beta-binomial precision at that
level, kept within ``PRECISION``. A host is blocked if the lower posterior bound of its bad rate, mean less
``Z`` standard deviations of the beta posterior, is above ``LIMIT``; hosts without outcomes go by their domain.

Rules ``(verdict, "host/path")`` fit a host and its subdomains whose path starts with the rule's; the longest
fitting rule wins. Up to ``RULES_AT_MOST`` are compiled into one expression; longer lists are joined to the hosts by each of their domains, so that a page meets the rules of
its host only. Both give the same. A registered domain is the last label before a suffix and the suffix, which is the last label or one of ``SUFFIXES``; ports don't
count, and an address of numbers is its own domain and suffix.

A host may have a third of all pages: counts combine before the exchange and are joined back by salt. Nulls: a
url that is null or has no ``://`` has an empty host and path, fits no rule and goes by the overall rate; a null
label or id counts nowhere. Repeated rows each get a verdict. Empty tables give empty results or the prior. Very long urls are read whole. Other columns pass unchanged; input columns
``host``, ``path``, ``rule``, ``verdict`` and ``bad_bound`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import salted_join, stage

RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]
RULES_AT_MOST = 500
#: Suffixes of two labels; a parameter of the functions below.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "co.nz", "co.za", "com.br", "com.mx", "co.in", "com.tr")
PRECISION = (2.0, 200.0)
Z = 1.645
LIMIT = 0.2
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls."""
    named, said = [], []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        domain, _, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + rest)
        named.append(F.when(fits, F.lit(rule)))
        said.append(F.when(fits, F.lit(verdict)))
    return F.coalesce(*named, F.lit(None).cast("string")), F.coalesce(*said, F.lit(None).cast("string"))


def rules_of_hosts(hosts: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """(host, __rules): of each host that has some, the rules of it and its domains, longest first, as array<struct<order, rule, rest, verdict>>."""
    rows = [(d, r, "/" + rest, v, -len(r)) for v, r in rules for d, _, rest in [r.partition("/")]]
    table = hosts.sparkSession.createDataFrame(rows, "domain string, rule string, rest string, verdict string, order int")
    labels = F.expr("transform(sequence(1, size(split(host, '[.]'))), k -> substring_index(host, '.', -k))")
    met = hosts.select("host", F.explode(labels).alias("domain")).join(table, "domain")
    return met.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("order", "rule", "rest", "verdict"))).alias("__rules"))


def _precision(rows: DataFrame, name: str) -> DataFrame:
    """Moment estimate of the beta-binomial precision over the groups ``rows`` (n, bad)."""
    sums = rows.agg(F.count("*").alias("k"), F.sum("n").alias("sn"), F.sum("bad").alias("sb"), F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("q"))
    p = F.col("sb") / F.col("sn")
    # weighted variance of the groups' rates, and what chance alone explains of it
    spread = (F.col("q") - F.col("sb") * p) / F.col("sn")
    chance = p * (1 - p) * F.col("k") / F.col("sn")
    raw = (p * (1 - p) - spread) / (spread - chance)
    low, high = PRECISION
    fit = F.when(F.col("k") < 2, F.lit(high)).when(spread <= chance, F.lit(high)).otherwise(F.greatest(F.lit(low), F.least(F.lit(high), raw)))
    return sums.select(fit.alias(name), F.coalesce(p, F.lit(0.0)).alias(f"{name}_rate"))


def reputations(outcomes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """From (host, bad 0/1): posterior tables of hosts, domains, suffixes and overall (one row), each with a, b."""
    hosts = outcomes.groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    # counted once, a row for each host; what follows reads them several times
    hosts = stage(hosts.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host"))), "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    overall = _precision(suffixes, "s").select("s", F.col("s_rate").alias("rate"))
    post = lambda t, weight, mean: t.withColumn("a", F.col("bad") + F.col(weight) * F.col(mean)).withColumn("b", F.col("n") - F.col("bad") + F.col(weight) * (1 - F.col(mean)))
    mean = F.col("a") / (F.col("a") + F.col("b"))
    # the precisions are one row each; joined on a constant
    one = lambda t, row: t.join(F.broadcast(row))
    suffixes = post(one(suffixes, overall), "s", "rate").select("suffix", "a", "b", mean.alias("suffix_rate"))
    domains = one(domains.join(suffixes.select("suffix", "suffix_rate"), "suffix"), _precision(domains, "d"))
    domains = post(domains, "d", "suffix_rate").select("domain", "a", "b", mean.alias("domain_rate"))
    hosts = one(hosts.join(domains.select("domain", "domain_rate"), "domain"), _precision(hosts, "h"))
    hosts = post(hosts, "h", "domain_rate").select("host", "a", "b")
    return hosts, domains, suffixes, overall.select((F.col("rate") * F.col("s")).alias("a0"), ((1 - F.col("rate")) * F.col("s")).alias("b0"))


def _labels(host: Column, suffixes: tuple[str, ...], more: int) -> Column:
    bare = F.regexp_replace(host, r":\d*$", "")
    numbers = bare.rlike(r"^\d{1,3}(\.\d{1,3}){3}$")
    long = F.substring_index(bare, ".", -2).isin(*suffixes)
    return F.when(numbers, bare).when(long, F.substring_index(bare, ".", -2 - more)).otherwise(F.substring_index(bare, ".", -1 - more))


def domain_of(host: Column, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    """The registered domain: a label and the suffix."""
    return _labels(host, suffixes, 1)


def suffix_of(host: Column, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    return _labels(host, suffixes, 0)


def bound(a: Column, b: Column, z: float = Z) -> Column:
    mean = a / (a + b)
    return mean - z * F.sqrt(mean * (1 - mean) / (a + b + 1))


def judge(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str]] = RULES, limit: float = LIMIT, url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, verdict and bad_bound. ``outcomes``: (host, bad)."""
    hosts, domains, suffixes, overall = reputations(outcomes)
    named = pages.drop("host", "path", "rule", "verdict", "bad_bound").withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    # one row per host: its own posterior, else its domain's, its suffix's or the overall prior
    met = named.select("host").distinct().withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host")))
    met = met.join(hosts.toDF("host", "a3", "b3"), "host", "left")
    met = met.join(domains.select("domain", F.col("a").alias("a2"), F.col("b").alias("b2")), "domain", "left")
    met = met.join(suffixes.select("suffix", F.col("a").alias("a1"), F.col("b").alias("b1")), "suffix", "left").join(F.broadcast(overall))
    a, b = (F.coalesce(*(F.col(f"{x}{i}") for i in (3, 2, 1, 0))) for x in "ab")
    met = met.select("host", F.coalesce(bound(a, b), F.lit(0.0)).alias("bad_bound"))
    if len(rules) > RULES_AT_MOST:
        met = stage(met, "met")
        joined = salted_join(named, met.join(rules_of_hosts(met.select("host"), rules), "host", "left"), ["host"])
        first = F.filter("__rules", lambda r: F.startswith(F.col("path"), r["rest"]))
        top = F.try_element_at(first, F.lit(1))
        joined, rule, said = joined.withColumn("__top", top).drop("__rules"), F.col("__top.rule"), F.col("__top.verdict")
        own = F.when(F.col("bad_bound") > limit, F.lit("block")).otherwise(F.lit("allow"))
        return joined.withColumn("rule", rule).withColumn("verdict", F.coalesce(said, own)).drop("__top")
    joined = salted_join(named, met, ["host"])
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bad_bound") > limit, F.lit("block")).otherwise(F.lit("allow"))
    return joined.withColumn("rule", rule).withColumn("verdict", F.coalesce(said, own))


def op1_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes: the label of low quality of the document with the page's id."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality is not null").select(F.col("doc_id").alias("page_id"), (1 - F.col("quality")).cast("long").alias("bad"))
    outcomes = pages.join(labels, "page_id").select(host_of(F.col("url")).alias("host"), "bad").where("host <> ''")
    return judge(pages, outcomes).select("page_id", "host", "path", "rule", "verdict", F.round("bad_bound", 9).alias("bad_bound"))


_PRECISION_SQL = """
  SELECT CASE WHEN k < 2 OR v <= c THEN {high} ELSE greatest({low}, least({high}, (p * (1 - p) - v) / (v - c))) END AS w, coalesce(p, 0.0) AS rate
  FROM (SELECT k, p, (q - sb * p) / sn AS v, p * (1 - p) * k / sn AS c
        FROM (SELECT *, sb / sn AS p FROM (SELECT count(*) AS k, sum(n)::DOUBLE AS sn, sum(bad)::DOUBLE AS sb, sum(bad * bad / n) AS q FROM {table})))
"""


def _sql_labels(more: int) -> str:
    bare = "string_split(regexp_replace(host, ':[0-9]*$', ''), '.')"
    long = ", ".join(f"'{x}'" for x in SUFFIXES)
    return f"""CASE WHEN regexp_matches(host, '^[0-9]{{1,3}}([.][0-9]{{1,3}}){{3}}(:[0-9]*)?$') THEN regexp_replace(host, ':[0-9]*$', '')
      WHEN array_to_string({bare}[-2:], '.') IN ({long}) THEN array_to_string({bare}[-{2 + more}:], '.') ELSE array_to_string({bare}[-{1 + more}:], '.') END"""


SQL = f"""
WITH named AS (
  SELECT page_id, url, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
outcomes AS (SELECT host, 1 - quality AS bad FROM named JOIN labels ON doc_id = page_id WHERE quality IS NOT NULL AND host <> ''),
hosts AS (SELECT host, {_sql_labels(1)} AS domain, {_sql_labels(0)} AS suffix,
                 count(*)::DOUBLE AS n, sum(bad)::DOUBLE AS bad FROM outcomes GROUP BY host),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY ALL),
ws AS ({_PRECISION_SQL.format(table="suffixes", low=PRECISION[0], high=PRECISION[1])}),
wd AS ({_PRECISION_SQL.format(table="domains", low=PRECISION[0], high=PRECISION[1])}),
wh AS ({_PRECISION_SQL.format(table="hosts", low=PRECISION[0], high=PRECISION[1])}),
ps AS (SELECT suffix, bad + w * rate AS a, n - bad + w * (1 - rate) AS b FROM suffixes, ws),
pd AS (SELECT domain, d.bad + w * (a / (a + b)) AS a, d.n - d.bad + w * (1 - a / (a + b)) AS b FROM domains d JOIN ps USING (suffix), wd),
ph AS (SELECT host, h.bad + w * (a / (a + b)) AS a, h.n - h.bad + w * (1 - a / (a + b)) AS b FROM hosts h JOIN pd USING (domain), wh),
met AS (SELECT host, coalesce(ph.a, pd.a, ps.a, ws.w * ws.rate) AS a, coalesce(ph.b, pd.b, ps.b, ws.w * (1 - ws.rate)) AS b
        FROM (SELECT DISTINCT host FROM named) m LEFT JOIN ph USING (host)
        LEFT JOIN pd ON pd.domain = {_sql_labels(1)}
        LEFT JOIN ps ON ps.suffix = {_sql_labels(0)}, ws),
bounds AS (SELECT host, coalesce(a / (a + b) - {Z} * sqrt((a / (a + b)) * (1 - a / (a + b)) / (a + b + 1)), 0.0) AS bad_bound FROM met),
ruled AS (SELECT *, CASE {" ".join(f"WHEN (host = '{d}' OR ends_with(host, '.{d}')) AND starts_with(path, '/{r}') THEN '{v}|{d}/{r}'" for v, d, r in ((v, *x.split("/", 1)) for v, x in sorted(RULES, key=lambda r: (-len(r[1]), r[1]))))} END AS hit
          FROM named JOIN bounds USING (host))
SELECT page_id, host, path, string_split(hit, '|')[2] AS rule,
       coalesce(string_split(hit, '|')[1], CASE WHEN bad_bound > {LIMIT} THEN 'block' ELSE 'allow' END) AS verdict, round(bad_bound, 9) AS bad_bound
FROM ruled
"""

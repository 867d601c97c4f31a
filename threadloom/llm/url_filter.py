"""Host reputation by empirical Bayes.

Labelled page outcomes are counted by host, registered domain and suffix. Each level's rate is shrunk towards the
level above through a beta prior whose strength is fitted by moments; a host is blocked if the lower posterior bound
of its rate of bad pages is above LIFT times the rate of all pages with an outcome. Explicit rules come before the verdict of
the method. Levels are those of the name alone, without port and user; a numeric address is a domain and a suffix of its own.

Everything is DataFrame expressions. The page table is never shuffled with its contents: rates come from (host, counts) after
partial aggregation, so that a host with a third of all pages is one row for each task. Hosts then meet the pages' ids,
hosts and paths; hosts that are too many to broadcast are shuffled, and adaptive execution splits the pages of a hot one.

Defined results: a null url or one without ``://`` has an empty host and path, fits no rule and is judged by the rate of
all pages; outcomes for unknown pages, null outcomes and repeated outcomes of a page count as their share of bad ones;
without any outcome, or without a bad one, no host is blocked. Repeated pages give repeated rows, each with its outcome; an
empty table gives an empty one; urls of any length are read in whole; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import LOWER, UPPER, table

#: (host, path, verdict): fixed values of the query.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
#: Second-level labels under which names of a two-letter country domain are registered (co.uk, com.au and the like).
REGISTRIES = ["ac", "co", "com", "edu", "gob", "gouv", "gov", "ltd", "mil", "ne", "net", "nom", "or", "org", "plc", "sch"]
DOUBLE_SUFFIX = f"^({'|'.join(REGISTRIES)})[.][a-z][a-z]$"
ADDRESS = "^([0-9]+[.][0-9]+[.][0-9]+[.][0-9]+|\\[.*)$"
#: A host is blocked if ``mean - Z * sd`` of its posterior rate of bad pages is above LIFT times the rate of all pages.
Z, LIFT = 1.64, 1.0
#: Bounds and default of a prior's strength, in pseudo-pages.
WEAKEST, STRONGEST, DEFAULT = 2.0, 200.0, 20.0


def split_url(url: Column) -> tuple[Column, Column]:
    rest = F.expr("substring(_url, instr(_url, '://') + 3)")
    found = url.isNotNull() & (F.instr(url, "://") > 0)
    raw = F.regexp_extract(rest, "^([^/?#]*)", 1)
    host = F.when(found, F.translate(raw, UPPER, LOWER)).otherwise(F.lit(""))
    path = F.when(found, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))
    return host, path


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; nulls if none does."""
    name = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):  # a longer rule is asked before the shorter ones
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        name = F.when(fits, F.lit(h + p)).otherwise(name)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def levels(hosts: DataFrame) -> DataFrame:
    """Adds suffix and registered domain to a table with ``_host``."""
    name = F.regexp_replace(F.regexp_replace("_host", "^.*@", ""), ":[0-9]*$", "")
    two, address = F.substring_index(name, ".", -2), name.rlike(ADDRESS)
    double = two.rlike(DOUBLE_SUFFIX)
    suffix = F.when(address, name).when(double, two).otherwise(F.substring_index(name, ".", -1))
    return hosts.withColumn("_suffix", suffix).withColumn("_domain", F.when(address, name).when(double, F.substring_index(name, ".", -3)).otherwise(two))


def strength(units: DataFrame, name: str) -> DataFrame:
    """One row: the strength of the beta prior that the spread of the units' rates (``_n`` pages, ``_x`` bad) calls for."""
    n, x = F.sum("_n"), F.sum("_x")
    spread = F.sum(F.when(F.col("_n") > 0, F.col("_x") * F.col("_x") / F.col("_n")).otherwise(0.0))
    s = units.agg(n.alias("n"), x.alias("x"), spread.alias("q"), F.sum(F.when(F.col("_n") > 0, 1).otherwise(0)).alias("k"))
    total = F.nullif("n", F.lit(0.0))  # null, and so the default, without any outcome
    p = F.col("x") / total
    pq = p * (1 - p)
    var = F.col("q") / total - p * p
    excess = var - pq * F.col("k") / total
    fitted = F.when((F.col("n") > 0) & (pq > 0) & (F.col("k") > 1), F.when(excess > 0, F.greatest(F.lit(WEAKEST), F.least(F.lit(STRONGEST), (pq - var) / excess))).otherwise(F.lit(STRONGEST)))
    return s.select(F.coalesce(fitted, F.lit(DEFAULT)).alias(name))


def shrunk(units: DataFrame, parent: Column, m: str, name: str) -> DataFrame:
    return units.withColumn(name, (F.col(m) * parent + F.col("_x")) / (F.col(m) + F.col("_n")))


def host_reputation(pages: DataFrame, outcomes: DataFrame, z: float = Z, lift: float = LIFT) -> DataFrame:
    """``pages``: (_id, _host); ``outcomes``: (_id, _bad from 0 to 1). Returns a row for each host: ``_host, _mean, _low, _blocked``."""
    one = outcomes.where("_id is not null and _bad is not null").groupBy("_id").agg(F.avg("_bad").alias("_bad"))
    # Only pages that have an outcome meet it; a host's number of pages doesn't matter to its rate.
    judged = pages.where("_id is not null").join(one, "_id").groupBy("_host").agg(F.count(F.lit(1)).cast("double").alias("_n1"), F.sum("_bad").alias("_x1"))
    every = pages.groupBy("_host").agg(F.lit(1).alias("_one")).drop("_one")
    hosts = levels(every.join(judged, "_host", "left").select("_host", F.coalesce("_n1", F.lit(0.0)).alias("_n"), F.coalesce("_x1", F.lit(0.0)).alias("_x")))
    domains = hosts.groupBy("_suffix", "_domain").agg(F.sum("_n").alias("_n"), F.sum("_x").alias("_x"))
    suffixes = domains.groupBy("_suffix").agg(F.sum("_n").alias("_n"), F.sum("_x").alias("_x"))
    total = suffixes.agg(F.coalesce(F.when(F.sum("_n") > 0, F.sum("_x") / F.sum("_n")), F.lit(0.0)).alias("_p0"))
    # The strengths and the overall rate are single rows by construction.
    s = shrunk(suffixes.join(total).join(strength(suffixes, "_m0")), F.col("_p0"), "_m0", "_ps").select("_suffix", "_ps")
    d = shrunk(domains.join(s, "_suffix").join(strength(domains, "_m1")), F.col("_ps"), "_m1", "_pd").select("_suffix", "_domain", "_pd")
    h = hosts.join(d, ["_suffix", "_domain"]).join(strength(hosts, "_m2")).join(total)
    a, b = F.col("_m2") * F.col("_pd") + F.col("_x"), F.col("_m2") * (1 - F.col("_pd")) + F.col("_n") - F.col("_x")
    mean, var = a / (a + b), a * b / ((a + b) * (a + b) * (a + b + 1))
    low = mean - z * F.sqrt(F.greatest(var, F.lit(0.0)))
    return h.select("_host", mean.alias("_mean"), low.alias("_low"), ((F.col("_p0") > 0) & (low > lift * F.col("_p0"))).alias("_blocked"))


def filter_urls(pages: DataFrame, outcomes: DataFrame, page_id: str = "page_id", url: str = "url", rules: list[tuple[str, str, str]] | None = None, z: float = Z, lift: float = LIFT) -> DataFrame:
    """A row for each page: ``page_id, host, path, rule, verdict, bad_rate, bad_rate_low``. See the module for the method.

    ``outcomes``: (_id, _bad), any number of rows for a page.
    """
    cut = pages.select(F.col(page_id).alias("_id"), F.col(url).alias("_url"))
    host, path = split_url(F.col("_url"))
    cut = cut.select("_id", host.alias("_host"), path.alias("_path"))
    said = host_reputation(cut.select("_id", "_host"), outcomes, z, lift)
    rule, verdict = rule_of(F.col("_host"), F.col("_path"), RULES if rules is None else rules)
    method = F.when(F.col("_blocked"), F.lit("block")).otherwise(F.lit("allow"))
    return cut.join(said, "_host", "left").select(
        F.col("_id").alias("page_id"), F.col("_host").alias("host"), F.col("_path").alias("path"), rule.alias("rule"),
        F.coalesce(verdict, method).alias("verdict"), F.round("_mean", 6).alias("bad_rate"), F.round("_low", 6).alias("bad_rate_low"),
    )


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict. A page's outcome is that of the label under its id: bad if toxic or of low quality."""
    labels = table(spark, sf_dir, "labels")
    bad = F.when(F.col("toxic").isNull() & F.col("quality").isNull(), None).otherwise(F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1.0).otherwise(0.0))
    return filter_urls(table(spark, sf_dir, "pages"), labels.select(F.col("doc_id").alias("_id"), bad.alias("_bad")))


SQL = """
WITH cut AS (
  SELECT page_id,
    CASE WHEN url IS NOT NULL AND contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
p AS (
  SELECT page_id,
    CASE WHEN rest IS NULL THEN '' ELSE translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END AS host,
    CASE WHEN rest IS NULL THEN '' ELSE regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) END AS path FROM cut),
one AS (
  SELECT doc_id, avg(CASE WHEN toxic IS NULL AND quality IS NULL THEN NULL WHEN toxic = 1 OR quality = 0 THEN 1.0 ELSE 0.0 END) AS bad
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
judged AS (SELECT host, count(bad)::DOUBLE AS n, coalesce(sum(bad), 0.0) AS x FROM p LEFT JOIN one ON doc_id = page_id GROUP BY host),
hosts AS (
  SELECT host, n, x,
    CASE WHEN address THEN name WHEN two_parts THEN two ELSE parts[-1] END AS suffix,
    CASE WHEN address THEN name WHEN two_parts THEN array_to_string(parts[-3:], '.') ELSE two END AS domain
  FROM (SELECT *, regexp_matches(name, '{address}') AS address, regexp_matches(two, '{double}') AS two_parts
    FROM (SELECT *, string_split(name, '.') AS parts, array_to_string(string_split(name, '.')[-2:], '.') AS two
      FROM (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS name FROM judged)))),
domains AS (SELECT suffix, domain, sum(n) AS n, sum(x) AS x FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(x) AS x FROM domains GROUP BY ALL),
total AS (SELECT coalesce(CASE WHEN sum(n) > 0 THEN sum(x) / sum(n) END, 0.0) AS p0 FROM suffixes),
units AS (
  SELECT 0 AS level, n, x FROM suffixes UNION ALL SELECT 1, n, x FROM domains UNION ALL SELECT 2, n, x FROM hosts),
moments AS (
  SELECT level, sum(n) AS n, sum(x) / nullif(sum(n), 0) AS p, sum(CASE WHEN n > 0 THEN x * x / n ELSE 0 END) AS q,
    sum(CASE WHEN n > 0 THEN 1 ELSE 0 END) AS k FROM units GROUP BY level),
m AS (
  SELECT level, coalesce(CASE WHEN n > 0 AND p * (1 - p) > 0 AND k > 1 THEN
    CASE WHEN q / n - p * p - p * (1 - p) * k / n > 0
      THEN greatest({weakest}, least({strongest}, (p * (1 - p) - (q / n - p * p)) / (q / n - p * p - p * (1 - p) * k / n)))
      ELSE {strongest} END END, {default}) AS m FROM moments),
s AS (SELECT suffix, (m * p0 + x) / (m + n) AS ps FROM suffixes, total, m WHERE level = 0),
d AS (SELECT suffix, domain, (m * ps + x) / (m + n) AS pd FROM domains JOIN s USING (suffix), m WHERE level = 1),
h AS (SELECT host, m * pd + x AS a, m * (1 - pd) + n - x AS b FROM hosts JOIN d USING (suffix, domain), m WHERE level = 2),
said AS (SELECT host, p0, a / (a + b) AS mean, a / (a + b) - {z} * sqrt(greatest(a * b / ((a + b) * (a + b) * (a + b + 1)), 0.0)) AS low FROM h, total)
SELECT page_id, host, path,
  CASE {rules} END AS rule,
  CASE {verdicts} WHEN p0 > 0 AND low > {lift} * p0 THEN 'block' ELSE 'allow' END AS verdict,
  round(mean, 6) AS bad_rate, round(low, 6) AS bad_rate_low
FROM p LEFT JOIN said USING (host)
""".strip()


def sql() -> str:
    by_length = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    fits = [f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN " for h, p, _ in by_length]
    return SQL.format(
        double=DOUBLE_SUFFIX, address=ADDRESS, weakest=WEAKEST, strongest=STRONGEST, default=DEFAULT, z=Z, lift=LIFT,
        rules=" ".join(f"{f}'{h}{p}'" for f, (h, p, _) in zip(fits, by_length)), verdicts=" ".join(f"{f}'{v}'" for f, (_, _, v) in zip(fits, by_length)),
    )

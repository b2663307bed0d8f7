"""Operator 2: URL filter by rules and, where none fits, by the host's empirical-Bayes reputation.

Labelled page outcomes (good or not) are counted by host, registered domain and suffix. Each level is a beta-binomial
with the level above as its prior mean: the prior's strength is estimated from how much groups of that level differ more
than chance lets them (moment estimator of the intraclass correlation). A host passes if the lower bound of its posterior
does; a host without outcomes stands on its domain's, suffix's or the whole corpus's, whose mean starts from one good page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

#: (verdict, host, path): a rule fits its host and all subdomains where the path starts with its path; the longest wins.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
#: Lower bound = mean - BOUND * standard deviation; a host passes from THRESHOLD on. Limits of a prior's strength.
BOUND, THRESHOLD, STRENGTH = 1.645, 0.5, (1.0, 1000.0)
#: Labels under which a country's registry takes names: with a country code of two letters behind them they are a suffix.
#: Fixed values. Any other suffix is the last label.
REGISTRY = "ac|co|com|edu|go|gob|gov|ltd|me|mil|ne|net|nom|or|org|plc|sch"
SECOND = rf"^({REGISTRY})\.[a-z]{{2}}$"
NUMERIC = r"^[0-9.]+$"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, with A-Z in lower case; empty for null or without ://."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def name_of(host: Column) -> Column:
    """The host without what a url may put around its name: user@ and :port."""
    return F.regexp_replace(host, r"^.*@|:[0-9]*$", "")


def suffix_of(host: Column) -> Column:
    """The suffix under which names are registered; a numeric address is one of its own."""
    name = name_of(host)
    two = F.substring_index(name, ".", -2)
    return F.when(name.rlike(NUMERIC), name).when(two.rlike(SECOND), two).otherwise(F.substring_index(name, ".", -1))


def domain_of(host: Column) -> Column:
    """The registered domain: the suffix and the label before it; a numeric address is its own."""
    name = name_of(host)
    two = F.substring_index(name, ".", -2)
    return F.when(name.rlike(NUMERIC), name).when(two.rlike(SECOND), F.substring_index(name, ".", -3)).otherwise(two)


def _matched(host: Column, path: Column, rules: list[tuple[str, str, str]], value) -> Column:
    out = F.lit(None).cast("string")
    for verdict, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is tested first
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        out = F.when(fits, F.lit(value(verdict, name + start))).otherwise(out)
    return out


def _strength(groups: DataFrame) -> tuple[float, int, int]:
    """(n, good) of a level's groups -> strength of the prior above it, and the level's totals."""
    s = groups.agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.sum("good").alias("g"), F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"), F.sum(F.col("good").cast("double") * F.col("good") / F.col("n")).alias("gg")).first()
    k, n, g = s["k"], s["n"] or 0, s["g"] or 0
    low, high = STRENGTH
    if not 0 < g < n or k < 2 or n - s["nn"] / n - (k - 1) <= 0:
        return high, n, g
    p = g / n
    rho = ((s["gg"] - n * p * p) / (p * (1 - p)) - (k - 1)) / (n - s["nn"] / n - (k - 1))
    return (high if rho <= 0 else min(high, max(low, (1 - rho) / rho))), n, g


def host_bounds(hosts: DataFrame, outcomes: DataFrame) -> DataFrame:
    """hosts (host), outcomes (host, good 0 or 1) -> (host, bound): the posterior's lower bound for every distinct host.

    Hosts share work by host, domain and suffix only; the driver sees five sums for each of the three levels.
    """
    by_host = written(outcomes.groupBy("host").agg(F.count("*").alias("n"), F.sum("good").alias("good")).withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))}), "by-host")
    by_domain = written(by_host.groupBy("domain", "suffix").agg(F.sum("n").alias("domain_n"), F.sum("good").alias("domain_good")), "by-domain")
    by_suffix = written(by_domain.groupBy("suffix").agg(F.sum("domain_n").alias("suffix_n"), F.sum("domain_good").alias("suffix_good")), "by-suffix")
    kh, n, g = _strength(by_host)
    kd, _, _ = _strength(by_domain.select(F.col("domain_n").alias("n"), F.col("domain_good").alias("good")))
    ks, _, _ = _strength(by_suffix.select(F.col("suffix_n").alias("n"), F.col("suffix_good").alias("good")))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double")
    known = written(hosts.groupBy("host").agg(F.lit(1).alias("one")).select("host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix")), "hosts")
    suffix = by_suffix.select("suffix", ((F.col("suffix_good") + F.lit(ks * ((g + 1.0) / (n + 1.0)))) / (F.col("suffix_n") + F.lit(ks))).alias("suffix_mean"))
    domain = by_domain.join(suffix, "suffix").select("domain", ((F.col("domain_good") + F.lit(kd) * F.col("suffix_mean")) / (F.col("domain_n") + F.lit(kd))).alias("domain_mean"))
    joined = known.join(written(suffix, "suffix-means"), "suffix", "left").join(written(domain, "domain-means"), "domain", "left").join(by_host.select("host", "n", "good"), "host", "left")
    mean = F.coalesce("domain_mean", "suffix_mean", F.lit((g + 1.0) / (n + 1.0)))
    a = F.lit(kh) * mean + zero("good")
    b = F.lit(kh) * (1 - mean) + zero("n") - zero("good")
    return joined.select("host", (a / (a + b) - F.lit(BOUND) * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))).alias("bound"))


def judge_urls(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url", *, label_id: str = "doc_id", label_col: str = "quality", rules: list[tuple[str, str, str]] = RULES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of pages: id_col, host, path, rule, verdict.

    A page's outcome is its label (1 good, 0 not) by equal id; pages, ids and labels that are null or without partner
    teach nothing, and an id that is labelled twice has its smaller label. A null url, or one without ://, has an empty
    host and path; the empty host has a reputation like any other. Numeric addresses stand for themselves alone. Very long
    urls are urls like any other. Repeated rows are judged, and teach, each. Other columns
    are neither read nor returned. An empty table gives an empty result; without any outcome every host passes.
    """
    own = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    known = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(label_id).alias("id")).agg(F.min(label_col).cast("int").alias("good"))
    bounds = written(host_bounds(own.select("host"), own.join(known, "id").select("host", "good")), "host-bounds")
    rule = _matched(F.col("host"), F.col("path"), rules, lambda verdict, name: name)
    ruled = _matched(F.col("host"), F.col("path"), rules, lambda verdict, name: verdict)
    method = F.when(F.col("bound") >= threshold, "allow").otherwise("block")
    return own.join(bounds, "host").select(F.col("id").alias(id_col), "host", "path", rule.alias("rule"), F.coalesce(ruled, method).alias("verdict"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def _rules_sql(value) -> str:
    cases = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    return "CASE " + " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{value(v, h + p)}'" for v, h, p in cases) + " END"


def _strength_sql(level: str, n: str, g: str) -> str:
    low, high = STRENGTH
    return f"""(SELECT CASE WHEN NOT (g > 0 AND g < n) OR k < 2 OR n - nn / n - (k - 1) <= 0 THEN {high}::DOUBLE
      WHEN ((gg - n * (g / n) * (g / n)) / ((g / n) * (1 - g / n)) - (k - 1)) / (n - nn / n - (k - 1)) <= 0 THEN {high}::DOUBLE
      ELSE least({high}::DOUBLE, greatest({low}::DOUBLE, 1 / (((gg - n * (g / n) * (g / n)) / ((g / n) * (1 - g / n)) - (k - 1)) / (n - nn / n - (k - 1))) - 1)) END
    FROM (SELECT count(*) AS k, coalesce(sum({n}), 0)::DOUBLE AS n, coalesce(sum({g}), 0)::DOUBLE AS g, sum({n}::DOUBLE * {n}) AS nn, sum({g}::DOUBLE * {g} / {n}) AS gg FROM {level}))"""


_NAME = "regexp_replace(host, '^.*@|:[0-9]*$', '', 'g')"
_TWO = f"array_to_string(list_slice(string_split({_NAME}, '.'), -2, -1), '.')"
ORACLE_SQL = f"""
WITH own AS (SELECT page_id, translate(coalesce(regexp_extract(url, '^(?:.|\\n)*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
                    coalesce(regexp_extract(url, '^(?:.|\\n)*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
names AS (SELECT DISTINCT host,
            CASE WHEN regexp_matches({_NAME}, '{NUMERIC}') THEN {_NAME} WHEN regexp_matches({_TWO}, '{SECOND}') THEN array_to_string(list_slice(string_split({_NAME}, '.'), -3, -1), '.') ELSE {_TWO} END AS domain,
            CASE WHEN regexp_matches({_NAME}, '{NUMERIC}') THEN {_NAME} WHEN regexp_matches({_TWO}, '{SECOND}') THEN {_TWO} ELSE string_split({_NAME}, '.')[-1] END AS suffix FROM own),
known AS (SELECT doc_id, min(quality) AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
by_host AS (SELECT host, count(*) AS n, sum(good) AS good FROM own JOIN known ON page_id = doc_id GROUP BY host),
by_domain AS (SELECT domain, suffix, sum(n) AS n, sum(good) AS good FROM by_host JOIN names USING (host) GROUP BY domain, suffix),
by_suffix AS (SELECT suffix, sum(n) AS n, sum(good) AS good FROM by_domain GROUP BY suffix),
k AS (SELECT {_strength_sql("by_host", "n", "good")} AS kh, {_strength_sql("by_domain", "n", "good")} AS kd, {_strength_sql("by_suffix", "n", "good")} AS ks,
             (SELECT (coalesce(sum(good), 0) + 1.0::DOUBLE) / (coalesce(sum(n), 0) + 1.0::DOUBLE) FROM by_suffix) AS m),
suffix_means AS (SELECT suffix, (good + ks * m) / (n + ks) AS mean FROM by_suffix, k),
domain_means AS (SELECT domain, (good + kd * mean) / (n + kd) AS mean FROM by_domain JOIN suffix_means USING (suffix), k),
ab AS (SELECT names.host, kh * coalesce(d.mean, s.mean, m) + coalesce(h.good, 0) AS a, kh * (1 - coalesce(d.mean, s.mean, m)) + coalesce(h.n, 0) - coalesce(h.good, 0) AS b
       FROM names LEFT JOIN suffix_means s ON names.suffix = s.suffix LEFT JOIN domain_means d ON names.domain = d.domain LEFT JOIN by_host h ON names.host = h.host, k)
SELECT page_id, host, path, {_rules_sql(lambda v, r: r)} AS rule,
       coalesce({_rules_sql(lambda v, r: v)}, CASE WHEN a / (a + b) - {BOUND} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) >= {THRESHOLD} THEN 'allow' ELSE 'block' END) AS verdict
FROM own JOIN ab USING (host)
"""

"""URL filter by empirical-Bayes host reputation (operator 4).

A page's outcome is the label of the document that its url numbers: bad if quality is 0 or toxic is 1. Outcomes are
counted by host. Beta-binomial priors shrink suffix rates to the overall rate, registered-domain rates to their
suffix's and host rates to their domain's; the strength of each level's prior is a moment estimate from the spread of
its rates. A host is blocked if the lower posterior bound of its bad rate exceeds a threshold.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.llm.common import ascii_lower, stored, table


@dataclass(frozen=True)
class Rule:
    """``verdict`` for urls of ``host`` and its subdomains whose path starts with ``path`` (begins with /)."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"), Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or where no ``://`` occurs."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.coalesce(ascii_lower(F.regexp_extract(rest, r"\A([^/?#]*)", 1)), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1), F.lit(""))
    return host, path


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        name, verdict = F.when(fits, F.lit(r.name)).otherwise(name), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def _domain(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def _suffix(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def _strength(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """One row with ``k``: the prior's strength, from the spread of the children's rates about their parents' means.

    Method of moments for a beta-binomial: the mean square between children, over what a binomial of the parent's mean
    gives, exceeds 1 by (n0 - 1) x the correlation; k = 1 / correlation - 1, kept within 1 and 10,000.
    """
    x = children.join(parents.select(key, F.col("mean").alias("m")), key).filter("n > 0")
    sums = x.agg(
        F.count(F.lit(1)).alias("c"),
        F.countDistinct(key).alias("p"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("n")).alias("n2"),
        F.sum(F.col("n") * F.pow(F.col("b") / F.col("n") - F.col("m"), F.lit(2.0)) / (F.col("m") * (1 - F.col("m")))).alias("s"),
    )
    free = F.greatest(F.col("c") - F.col("p"), F.lit(1))
    n0 = (F.col("n") - F.col("n2") / F.col("n")) / free
    rho = (F.col("s") / free - 1) / F.greatest(n0 - 1, F.lit(1.0))
    k = F.when(F.coalesce(rho, F.lit(0.0)) <= 0, F.lit(10000.0)).otherwise(1 / rho - 1)
    return sums.select(F.greatest(F.lit(1.0), F.least(F.lit(10000.0), k)).alias("k"))


def reputations(outcomes: DataFrame, *, z: float = 1.645) -> DataFrame:
    """Of outcomes ``host, n, b`` (pages with a known outcome, and the bad ones): ``host, n, b, mean, bound``.

    ``outcomes`` has one row per host, hosts without known outcomes included (n = 0): they get their domain's mean. The
    bound is the posterior mean less ``z`` posterior standard deviations. Sums over all hosts feed one-row tables only.
    """
    own = outcomes.select("host", "n", "b", _domain(F.col("host")).alias("domain"), _suffix(F.col("host")).alias("suffix"))
    total = own.agg(((F.coalesce(F.sum("b"), F.lit(0)) + 1.0) / (F.coalesce(F.sum("n"), F.lit(0)) + 2.0)).alias("mean")).withColumn("root", F.lit(0))
    suffixes = own.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("b").alias("b")).withColumn("root", F.lit(0))
    domains = own.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))

    def shrunk(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
        k = _strength(children, parents, key)
        x = children.join(parents.select(key, F.col("mean").alias("prior")), key).join(F.broadcast(k))
        a, b = F.col("k") * F.col("prior") + F.col("b"), F.col("k") * (1 - F.col("prior")) + F.col("n") - F.col("b")
        x = x.withColumn("__a", a).withColumn("__b", b).withColumn("mean", F.col("__a") / (F.col("__a") + F.col("__b")))
        return x

    suffixes = shrunk(suffixes, total, "root").select("suffix", "n", "b", "mean")
    domains = shrunk(domains, suffixes, "suffix").select("domain", "n", "b", "mean")
    hosts = shrunk(own, domains, "domain")
    sd = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("__a") + F.col("__b") + 1))
    return hosts.select("host", "n", "b", "mean", (F.col("mean") - F.lit(z) * sd).alias("bound"))


def judge_pages(pages: DataFrame, labels: DataFrame, *, rules: Sequence[Rule] = RULES, z: float = 1.645, max_bound: float = 0.5) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict`` and ``bad_mean, bad_bound`` of its host.

    The longest rule that fits decides; without one the page is blocked if its host's lower posterior bound exceeds
    ``max_bound``. The outcome of a page comes from the labels of the document numbered by the first all-digit start of
    a path segment; a null or repeated label counts as bad if any of its rows is. Repeated pages are judged alike, null
    urls have an empty host and path, which form a host of their own. Empty tables give no rows; without labels every
    host has the prior mean. Other columns are ignored.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id").alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("__doc", F.regexp_extract("path", r"/([0-9]{1,18})", 1).try_cast("long"))
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)
    known = labels.filter("doc_id is not null and (quality is not null or toxic is not null)").groupBy(F.col("doc_id").alias("__doc")).agg(F.max(bad).alias("bad"))
    counted = rows.groupBy("host", "__doc").agg(F.count(F.lit(1)).alias("pages")).join(known, "__doc", "left")
    outcomes = counted.groupBy("host").agg(
        F.coalesce(F.sum(F.when(F.col("bad").isNotNull(), F.col("pages"))), F.lit(0)).alias("n"), F.coalesce(F.sum(F.col("pages") * F.col("bad")), F.lit(0)).alias("b")
    )
    judged = reputations(stored(outcomes, "url-outcomes"), z=z)
    rule, decided = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("bound") > max_bound, F.lit("block")).otherwise(F.lit("allow"))
    return rows.join(judged, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(decided, method).alias("verdict"), F.col("mean").alias("bad_mean"), F.col("bound").alias("bad_bound")
    )


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_pages(table(spark, sf_dir, "pages").select("page_id", "url"), table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))
    return judged.select("page_id", "host", "path", "rule", "verdict", F.round("bad_bound", 6).alias("bad_bound"))


OP4_SQL = r"""
WITH raw AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages
), p AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(rest, '\A([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '\A[^/?#]*([^?#]*)', 1), '') AS path
  FROM raw
), q AS (
  SELECT *, try_cast(nullif(regexp_extract(path, '/([0-9]{1,18})', 1), '') AS BIGINT) AS doc FROM p
), l AS (
  SELECT doc_id AS doc, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels WHERE doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL) GROUP BY 1
), own AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS b,
         array_to_string((string_split(host, '.'))[-2:], '.') AS domain, list_extract(string_split(host, '.'), -1) AS suffix
  FROM q LEFT JOIN l USING (doc) GROUP BY host
), total AS (SELECT (coalesce(sum(b), 0) + 1.0::DOUBLE) / (coalesce(sum(n), 0) + 2.0::DOUBLE) AS mean FROM own),
s0 AS (SELECT suffix, sum(n)::DOUBLE AS n, sum(b)::DOUBLE AS b FROM own GROUP BY 1),
d0 AS (SELECT domain, suffix, sum(n)::DOUBLE AS n, sum(b)::DOUBLE AS b FROM own GROUP BY ALL),
ks0 AS (SELECT greatest(count(*) - 1, 1) AS free, sum(n) AS n, sum(n * n) AS n2, sum(n * power(b / n - mean, 2) / (mean * (1 - mean))) AS s FROM s0, total WHERE n > 0),
ks AS (SELECT (s / free - 1) / greatest((n - n2 / n) / free - 1, 1.0) AS rho FROM ks0),
k1 AS (SELECT greatest(1.0, least(10000.0, CASE WHEN coalesce(rho, 0) <= 0 THEN 10000.0 ELSE 1 / rho - 1 END))::DOUBLE AS k FROM ks),
s1 AS (SELECT suffix, (k * mean + b) / (k + n) AS mean FROM s0, total, k1),
kd0 AS (SELECT greatest(count(*) - count(DISTINCT suffix), 1) AS free, sum(n) AS n, sum(n * n) AS n2, sum(n * power(b / n - mean, 2) / (mean * (1 - mean))) AS s
        FROM d0 JOIN s1 USING (suffix) WHERE n > 0),
kd AS (SELECT (s / free - 1) / greatest((n - n2 / n) / free - 1, 1.0) AS rho FROM kd0),
k2 AS (SELECT greatest(1.0, least(10000.0, CASE WHEN coalesce(rho, 0) <= 0 THEN 10000.0 ELSE 1 / rho - 1 END))::DOUBLE AS k FROM kd),
d1 AS (SELECT domain, (k * mean + b) / (k + n) AS mean FROM d0 JOIN s1 USING (suffix), k2),
kh0 AS (SELECT greatest(count(*) - count(DISTINCT domain), 1) AS free, sum(n)::DOUBLE AS n, sum(n * n)::DOUBLE AS n2,
               sum(n * power(b::DOUBLE / n - mean, 2) / (mean * (1 - mean))) AS s
        FROM own JOIN d1 USING (domain) WHERE n > 0),
kh AS (SELECT (s / free - 1) / greatest((n - n2 / n) / free - 1, 1.0) AS rho FROM kh0),
k3 AS (SELECT greatest(1.0, least(10000.0, CASE WHEN coalesce(rho, 0) <= 0 THEN 10000.0 ELSE 1 / rho - 1 END))::DOUBLE AS k FROM kh),
h1 AS (SELECT host, k + n AS t, (k * mean + b) / (k + n) AS mean FROM own JOIN d1 USING (domain), k3),
h2 AS (SELECT host, mean - 1.645::DOUBLE * sqrt(mean * (1 - mean) / (t + 1)) AS bound FROM h1),
r AS (
  SELECT page_id, host, path, bound, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM q JOIN h2 USING (host)
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN bound > 0.5 THEN 'block' ELSE 'allow' END AS verdict,
       round(bound, 6) AS bad_bound
FROM r
"""

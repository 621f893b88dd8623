"""URL filters: path rules first, then a host's reputation shrunk by empirical Bayes.

Labelled outcomes of pages (1 bad, 0 good) are counted per host. A host's bad share has a
beta prior whose mean is the shrunk share of its registered domain, whose own prior is that of
its suffix, whose prior is the overall share. The strength of each level's prior is estimated
from the data by the method of moments. A host is blocked when even the lower bound of its
posterior share exceeds the tolerated share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiofact.llm.base import query, table

#: Fixed values: (verdict, rule) pairs of the url filter.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
#: Public suffixes of two labels.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "co.nz", "co.jp", "com.br")
#: Tolerated bad share, and standard deviations from the mean to the lower bound.
TOLERATED, DEVIATIONS = 0.25, 1.645


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(rest, upper, lower), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    """Last label of the host without its port, or the last two for known suffixes."""
    bare = F.regexp_replace(host, r":\d*$", "")
    two = F.substring_index(bare, ".", -2)
    return F.when(two.isin(*SUFFIXES), two).otherwise(F.substring_index(bare, ".", -1))


def domain_of(host: Column) -> Column:
    """The suffix and one label before it."""
    bare, suffix = F.regexp_replace(host, r":\d*$", ""), suffix_of(host)
    labels = F.when(F.contains(suffix, F.lit(".")), 3).otherwise(2)
    return F.when(labels == 3, F.substring_index(bare, ".", -3)).otherwise(
        F.substring_index(bare, ".", -2)
    )


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, else null."""
    fitting = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        domain, _, start = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + start)
        found = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        fitting = F.when(fits, found).otherwise(fitting)
    return fitting


def _shrunk(groups: DataFrame, prior: str) -> DataFrame:
    """Add the strength of a level's prior, and each group's posterior a and b.

    ``groups`` holds n, bad and the prior mean in column ``prior``. The strength follows from
    how much the shares differ from their prior means beyond binomial noise; with no excess it
    is the largest allowed, 1000 outcomes. No prior is stronger than what its own level knows,
    which column ``certain`` holds.
    """
    share = F.when(F.col("n") > 0, F.col("bad") / F.col("n"))
    noise = F.col(prior) * (1 - F.col(prior))
    moments = groups.filter(F.col("n") > 1).agg(
        # in whole millionths, so that the order of summation does not matter
        F.sum(F.round(1e6 * F.col("n") * noise).cast("bigint")).alias("v"),
        F.sum(F.round(1e6 * F.col("n") * (share - F.col(prior)) ** 2).cast("bigint")).alias("d"),
        F.sum(F.round(1e6 * noise).cast("bigint")).alias("w"),
    )
    # d = w + rho * (v - w) in expectation, and rho = 1 / (strength + 1)
    rho = (F.col("d") - F.col("w")) / (F.col("v") - F.col("w"))
    strength = F.when((F.col("v") > F.col("w")) & (rho > 0.001), F.greatest(1 / rho - 1, F.lit(1.0)))
    one_row = moments.select(F.coalesce(strength, F.lit(1000.0)).alias("strength"))
    weight = F.least("strength", "certain")
    return groups.crossJoin(F.broadcast(one_row)).withColumns({
        "a": F.col(prior) * weight + F.col("bad"),
        "b": (1 - F.col(prior)) * weight + F.col("n") - F.col("bad"),
    })


def reputations(outcomes: DataFrame) -> DataFrame:
    """host, n, bad, mean and lower bound of the bad share, for all hosts of ``outcomes``.

    ``outcomes`` has host and bad (1, 0, or null for an unlabelled page). Hosts without
    outcomes have their domain's mean. With no outcome at all every mean is 0. Rows are summed
    per host before anything is joined, so a host with most of the pages is one row.
    """
    hosts = outcomes.groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
    )
    hosts = hosts.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    overall = suffixes.agg(
        F.coalesce(F.sum("bad") / F.nullif(F.sum("n"), F.lit(0)), F.lit(0.0)).alias("overall")
    )
    weight = F.col("a") + F.col("b")
    level = _shrunk(suffixes.crossJoin(F.broadcast(overall)).withColumn("certain", F.lit(1000.0)), "overall")
    level = level.select("suffix", (F.col("a") / weight).alias("suffix_mean"), weight.alias("certain"))
    level = _shrunk(domains.join(level, "suffix"), "suffix_mean")
    level = level.select("domain", (F.col("a") / weight).alias("domain_mean"), weight.alias("certain"))
    level = _shrunk(hosts.join(level, "domain"), "domain_mean")
    a, b = F.col("a"), F.col("b")
    mean = a / (a + b)
    deviation = F.sqrt(mean * (1 - mean) / (a + b + 1))
    return level.select("host", "n", "bad", mean.alias("mean"), (mean - DEVIATIONS * deviation).alias("lower"))


def judge(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict and lower of every url.

    ``labels`` (page_id, bad) holds outcomes; of repeated labels of a page the worst counts.
    A null url, or one without ``://``, has empty host and path and the verdict of its
    (empty) host's reputation. A null page_id is judged like any other and has no label.
    """
    urls = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"))
    urls = urls.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    outcome = labels.filter("page_id is not null").groupBy("page_id").agg(F.max("bad").alias("bad"))
    known = reputations(urls.join(outcome, "page_id", "left").select("host", "bad"))
    bad = F.when(F.col("lower") > TOLERATED, "block").otherwise("allow")
    by_host = known.select(F.col("host").alias("known_host"), bad.alias("reputation"), "lower")
    found = urls.withColumn("fit", rule_of(F.col("host"), F.col("path")))
    joined = found.join(by_host, F.col("host") == F.col("known_host"))
    return joined.select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", "reputation").alias("verdict"),
    )


#: The same as SQL for the labels of the test tables.
SQL = f"""
WITH urls AS (
    SELECT page_id, COALESCE(lower(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)), '') AS host,
           COALESCE(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages
), outcome AS (
    SELECT doc_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad
    FROM labels GROUP BY doc_id
), hosts AS (
    SELECT host, count(bad) AS n, COALESCE(sum(bad), 0) AS bad,
           regexp_replace(host, ':[0-9]*$', '') AS bare
    FROM urls LEFT JOIN outcome ON page_id = doc_id GROUP BY host
), named AS (
    SELECT *, CASE WHEN list_aggregate(string_split(bare, '.')[-2:], 'string_agg', '.') IN
        ({", ".join(f"'{s}'" for s in SUFFIXES)}) THEN 2 ELSE 1 END AS k FROM hosts
), h AS (
    SELECT host, n, bad, list_aggregate(string_split(bare, '.')[-k:], 'string_agg', '.') AS suffix,
           list_aggregate(string_split(bare, '.')[-(k + 1):], 'string_agg', '.') AS domain
    FROM named
), d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY ALL),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY ALL),
o AS (SELECT COALESCE(sum(bad) / NULLIF(sum(n), 0), 0.0) AS p FROM s),
s1 AS (SELECT s.*, p, 1000.0 AS certain FROM s, o),
{{suffix_level}},
d1 AS (SELECT d.*, s2.m AS p, s2.a + s2.b AS certain FROM d JOIN s2 USING (suffix)),
{{domain_level}},
h1 AS (SELECT h.*, d2.m AS p, d2.a + d2.b AS certain FROM h JOIN d2 USING (domain)),
{{host_level}},
judged AS (
    SELECT host, CASE WHEN m - {DEVIATIONS} * sqrt(m * (1 - m) / (a + b + 1)) > {TOLERATED}
                      THEN 'block' ELSE 'allow' END AS reputation FROM h2
), ruled AS (
    SELECT *, CASE
        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
        WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
        WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule
    FROM urls
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/es/', 'example.org/en/1', 'com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            ELSE reputation END AS verdict
FROM ruled JOIN judged USING (host)
"""


def _level_sql(name: str) -> str:
    """Moments, strength and posterior of one level, over ``{name}1`` with prior mean p."""
    return f"""{name}m AS (
    SELECT sum(CAST(round(1e6 * n * (p * (1 - p))) AS BIGINT)) AS v,
           sum(CAST(round(1e6 * n * pow(bad / n - p, 2)) AS BIGINT)) AS d,
           sum(CAST(round(1e6 * (p * (1 - p))) AS BIGINT)) AS w FROM {name}1 WHERE n > 1
), {name}k AS (
    SELECT COALESCE(CASE WHEN v > w AND (d - w) / (v - w) > 0.001
                         THEN greatest((v - w) / (d - w) - 1, 1.0) END, 1000.0) AS k FROM {name}m
), {name}2 AS (
    SELECT *, a / (a + b) AS m FROM (
        SELECT *, p * least(k, certain) + bad AS a, (1 - p) * least(k, certain) + n - bad AS b
        FROM {name}1, {name}k)
)"""


ORACLE = SQL.format(
    suffix_level=_level_sql("s"), domain_level=_level_sql("d"), host_level=_level_sql("h")
)


@query(ORACLE)
def op7_url_filter(spark, sf_dir):
    """Verdicts of all pages; a page's outcome is the label of the document of its number."""
    labels = table(spark, sf_dir, "labels")
    bad = F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).otherwise(0)
    outcomes = labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return judge(table(spark, sf_dir, "pages"), outcomes)

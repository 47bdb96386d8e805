"""URL filters with empirical-Bayes host reputation, in DataFrame functions only.

Rules judge the urls they fit. Labelled outcomes (here: what the rules said) are counted by host;
their rates are shrunk by beta-binomial priors along suffix, registered domain and host, where
each level's prior strength comes from how much the rates of its groups differ. A url without a
rule is allowed if the lower bound of its host's posterior reaches a limit.

Counting combines before its shuffle, so a host with a third of all pages sends one row a task.
The reputations have one row a host; joining them back leaves the pages' hot host to Spark's
splitting of skewed partitions.

Cases: a null url, or one without ``://``, has an empty host and path, fits no rule and is judged
by the prior of the empty host; repeated pages each count; columns beside id and url are ignored;
without any outcome all rates are one half.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparklake.llm.arrays import stored

# (verdict, host, path)
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
# fixed values: second levels under which domains are registered, as in "co.uk"
SECOND = ["ac", "co", "com", "edu", "gov", "net", "org"]
Z = 1.0  # the bound lies so many standard deviations below the mean
LIMIT = 0.3
WEAKEST, STRONGEST = 1.0, 1000.0  # prior strengths, in pages

_HOST = r"^[\s\S]*?://([^/?#]*)"
_PATH = r"^[\s\S]*?://[^/?#]*([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _HOST, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From there up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PATH, 1)


def matching(rules: list[tuple[str, str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """The text and the verdict of the longest rule that fits, or nulls."""
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    fits = [((host == h) | host.endswith(f".{h}")) & path.startswith(p) for _, h, p in ranked]
    text = [F.when(f, F.lit(h + p)) for f, (_, h, p) in zip(fits, ranked, strict=True)]
    verdict = [F.when(f, F.lit(v)) for f, (v, _, _) in zip(fits, ranked, strict=True)]
    return F.coalesce(*text), F.coalesce(*verdict)


def domain_of(host: str = "host") -> Column:
    """The registered domain: the last two labels, or three under a second level."""
    labels = F.split(host, r"\.")
    deep = (F.size(labels) >= 3) & (F.length(F.element_at(labels, -1)) == 2) & F.get(labels, F.size(labels) - 2).isin(SECOND)
    return F.when(deep, F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def suffix_of(domain: str = "domain") -> Column:
    """What lies above the registered domain; nothing for a host of one label."""
    return F.when(F.instr(domain, ".") > 0, F.regexp_replace(domain, r"^[^.]*\.", "")).otherwise(F.lit(""))


def strength(counts: DataFrame, level: str) -> float:
    """How many pages the prior of this level weighs, by the groups' variance.

    With rates p of groups of n pages around the mean m, the spread beyond chance is
    rho = (sum n (p - m)^2 / N - m (1 - m) G / N) / (m (1 - m)), and the strength 1 / rho - 1.
    Four sums come back from the cluster.
    """
    groups = counts.groupBy(level).agg(F.sum("good").alias("g"), F.sum("n").alias("n")).where("n > 0")
    n, g, k, q = groups.agg(
        F.sum("n").cast("double"),
        F.sum("g").cast("double"),
        F.count("*"),
        F.sum(F.round(F.col("g") * F.col("g") / F.col("n"), 6).cast("decimal(28,6)")).cast("double"),
    ).first()
    chance = g / n * (1 - g / n) if n else 0.0
    spread = (q / n - g / n * (g / n) - chance * k / n) / chance if chance > 0 else 0.0
    return STRONGEST if spread <= 0 else min(STRONGEST, max(WEAKEST, 1 / spread - 1))


def reputations(pages: DataFrame, good: str = "good", host: str = "host", z: float = Z) -> DataFrame:
    """(host, mean, bound) for every host of ``pages``; ``good`` is 1, 0 or null (no label)."""
    counts = pages.groupBy(F.col(host).alias("host")).agg(
        F.coalesce(F.sum(good), F.lit(0)).cast("bigint").alias("good"), F.count(good).alias("n")
    )
    counts = stored(counts, "host-counts").withColumn("domain", domain_of()).withColumn("suffix", suffix_of())
    by_suffix, by_domain, by_host = (strength(counts, x) for x in ("suffix", "domain", "host"))
    g, n = counts.agg(F.coalesce(F.sum("good"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    rows = counts
    for x in ("domain", "suffix"):
        rows = rows.join(counts.groupBy(x).agg(F.sum("good").alias(f"{x}_good"), F.sum("n").alias(f"{x}_n")), x)
    suffix = (F.col("suffix_good") + by_suffix * ((g + 1) / (n + 2))) / (F.col("suffix_n") + by_suffix)
    domain = (F.col("domain_good") + by_domain * suffix) / (F.col("domain_n") + by_domain)
    size = F.col("n") + by_host
    rows = rows.select("host", size.alias("size"), ((F.col("good") + by_host * domain) / size).alias("mean"))
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("size") + 1))
    return rows.select("host", "mean", (F.col("mean") - z * deviation).alias("bound"))


def judged(pages: DataFrame, url: str = "url", rules=RULES, limit: float = LIMIT) -> DataFrame:
    """``row`` (a struct of all columns) with host, path, rule, verdict, ``mean`` and ``bound``."""
    df = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"),
        host_of(F.col(f"`{url}`")).alias("host"),
        path_of(F.col(f"`{url}`")).alias("path"),
    )
    rule, said = matching(rules, F.col("host"), F.col("path"))
    df = df.withColumns({"rule": rule, "said": said})
    known = reputations(df.withColumn("good", F.when(F.col("said") == "allow", 1).when(F.col("said") == "block", 0)))
    method = F.when(F.round("bound", 9) >= limit, F.lit("allow")).otherwise(F.lit("block"))
    return df.join(known, "host").withColumn("verdict", F.coalesce("said", method))


def op9(pages: DataFrame) -> DataFrame:
    """The registered query."""
    return judged(pages.select("page_id", "url")).select("row.page_id", "host", "path", "rule", "verdict")


def _rules_sql() -> str:
    ranked = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r))
    fits = [f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))" for _, h, p in ranked]
    rule = " ".join(f"WHEN {f} THEN '{h + p}'" for f, (_, h, p) in zip(fits, ranked, strict=True))
    said = " ".join(f"WHEN {f} THEN '{v}'" for f, (v, _, _) in zip(fits, ranked, strict=True))
    return f"CASE {rule} END AS rule, CASE {said} END AS said"


def _strength_sql(level: str) -> str:
    return f"""(SELECT CASE WHEN n IS NULL OR g / n * (1 - g / n) <= 0 THEN {STRONGEST}
      WHEN (q / n - g / n * (g / n) - g / n * (1 - g / n) * k / n) / (g / n * (1 - g / n)) <= 0 THEN {STRONGEST}
      ELSE least({STRONGEST}, greatest({WEAKEST}, 1 / ((q / n - g / n * (g / n) - g / n * (1 - g / n) * k / n) / (g / n * (1 - g / n))) - 1)) END
    FROM (SELECT CAST(sum(g) AS DOUBLE) AS g, CAST(sum(n) AS DOUBLE) AS n, CAST(count(*) AS DOUBLE) AS k,
        CAST(sum(CAST(round(g * g / n, 6) AS DECIMAL(28, 6))) AS DOUBLE) AS q
      FROM (SELECT {level}, CAST(sum(good) AS DOUBLE) AS g, CAST(sum(n) AS DOUBLE) AS n FROM counts GROUP BY {level}) WHERE n > 0))"""


_SECOND = ", ".join(f"'{x}'" for x in SECOND)
ORACLE = f"""
WITH u AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '^[\\s\\S]*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '^[\\s\\S]*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
r AS (SELECT *, {_rules_sql()} FROM u),
l AS (SELECT *, string_split(host, '.') AS p FROM (
  SELECT host, count(*) FILTER (said = 'allow') AS good, count(said) AS n FROM r GROUP BY host)),
counts AS (
  SELECT *, CASE WHEN position('.' IN domain) > 0 THEN substr(domain, position('.' IN domain) + 1) ELSE '' END AS suffix
  FROM (SELECT host, good, n, CASE
      WHEN len(p) >= 3 AND length(p[-1]) = 2 AND p[-2] IN ({_SECOND}) THEN array_to_string(p[-3:], '.')
      ELSE array_to_string(p[-2:], '.') END AS domain FROM l)),
t AS (SELECT (coalesce(sum(good), 0) + 1) / (coalesce(sum(n), 0) + 2) AS top,
  {_strength_sql("suffix")} AS ks, {_strength_sql("domain")} AS kd, {_strength_sql("host")} AS kh FROM counts),
ds AS (SELECT domain, sum(good) AS g, sum(n) AS n FROM counts GROUP BY domain),
ss AS (SELECT suffix, sum(good) AS g, sum(n) AS n FROM counts GROUP BY suffix),
m AS (
  SELECT host, counts.n + kh AS size,
    (counts.good + kh * ((ds.g + kd * ((ss.g + ks * top) / (ss.n + ks))) / (ds.n + kd))) / (counts.n + kh) AS mean
  FROM counts JOIN ds USING (domain) JOIN ss USING (suffix) CROSS JOIN t)
SELECT page_id, r.host, path, rule, coalesce(said,
  CASE WHEN round(mean - {Z} * sqrt(mean * (1 - mean) / (size + 1)), 9) >= {LIMIT} THEN 'allow' ELSE 'block' END) AS verdict
FROM r JOIN m USING (host)
"""

"""URL allow and block rules by hashed host-suffix / path-prefix expressions.

A rule is a host (it also covers all subdomains) and a path prefix.  Each distinct URL
is expanded into the expressions that any rule could have: one for every host suffix of
as many labels, with every path prefix of as many characters, as some rule has.  The
expressions meet the rules on a short prefix of their SHA-256; full digests confirm, and
the longest rule wins.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finfilings.llm.common import small_side, table
from finfilings.llm.registry import query

#: Characters of a hex digest on which expressions and rules meet (32 bits).
PREFIX = 8
#: More shapes (labels, path length) than this would expand a URL too far.
MAX_SHAPES = 20_000

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, UPPER.lower())


def url_host(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end; empty without it."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules ``(verdict, host, path)`` as a table, without leaving the JVM."""
    rows = [F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _expression(host: Column, path: Column) -> Column:
    return F.concat(host, F.lit("\n"), path)


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` plus ``host, path, rule, verdict``.

    ``rules`` has ``verdict, host, path``.  Of the rules that fit the longest host wins,
    then the longest path, then block before allow for a rule given twice.  ``rule`` is
    host and path together, null where no rule fits, and the verdict is then ``default``.

    A null URL, one without ``://`` and an empty one have an empty host and path and fit
    no rule.  Rules with a null part, or an empty host, never fit.  Repeated pages are
    judged alike, each row once.  Without rules every page gets the default; an empty
    table of pages gives an empty result.  Columns of ``pages`` with one of the four names
    are replaced; all others pass through unchanged.
    """
    known = rules.where("host is not null and host <> '' and path is not null and verdict is not null").select(
        lower_ascii(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"), "verdict",
    ).withColumns({
        "labels": F.size(F.split("rule_host", r"\.")), "chars": F.length("rule_path"),
        "digest": F.sha2(_expression(F.col("rule_host"), F.col("rule_path")), 256),
    }).groupBy("digest", "rule_host", "rule_path", "labels", "chars").agg(F.max("verdict").alias("verdict"))
    # which (labels, path length) occur: a bounded summary of the rules, not of the pages
    shapes = [tuple(r) for r in known.select("labels", "chars").distinct().orderBy("labels", "chars").limit(MAX_SHAPES + 1).collect()]
    if len(shapes) > MAX_SHAPES:
        raise ValueError(f"the rules have more than {MAX_SHAPES} shapes of host and path")
    bare = pages.drop("host", "path", "rule", "verdict")
    parts = bare.withColumns({"host": url_host(F.col(url)), "path": url_path(F.col(url))})
    if not shapes:
        return parts.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    # the verdict follows from host and path, so each pair is expanded once
    pairs = parts.select("host", "path").where("host <> ''").distinct()
    shape = F.array(*[F.struct(F.lit(n).alias("labels"), F.lit(c).alias("chars")) for n, c in shapes])
    labelled = pairs.withColumn("parts", F.split("host", r"\."))
    expanded = labelled.select(
        "host", "path", "parts",
        F.explode(F.filter(shape, lambda s: (s.labels <= F.size("parts")) & (s.chars <= F.length("path")))).alias("s"),
    ).select(
        "host", "path",
        F.sha2(_expression(
            F.array_join(F.slice("parts", F.size("parts") - F.col("s.labels") + 1, F.col("s.labels")), "."),
            F.expr("substring(path, 1, s.chars)"),
        ), 256).alias("digest"),
    )
    short = F.substring("digest", 1, PREFIX)
    side = small_side(known.select(
        short.alias("short"), F.col("digest").alias("rule_digest"), "rule_host", "rule_path", "verdict",
    ))
    fits = expanded.withColumn("short", short).join(side, "short").where("digest = rule_digest")
    best = fits.groupBy("host", "path").agg(F.max(F.struct(
        F.length("rule_host").alias("h"), F.length("rule_path").alias("p"), "verdict",
        F.concat("rule_host", "rule_path").alias("rule"),
    )).alias("best")).select(
        F.col("host").alias("best_host"), F.col("path").alias("best_path"),
        F.col("best.rule").alias("rule"), F.col("best.verdict").alias("found"),
    )
    joined = parts.join(best, (F.col("host") == F.col("best_host")) & (F.col("path") == F.col("best_path")), "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in bare.columns], "host", "path", "rule", F.coalesce("found", F.lit(default)).alias("verdict"),
    )


# fixed values: the rules of the query
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

SQL = """
WITH parts AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
rules(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
best AS (
  SELECT host, path, max_by(h || p, length(h) * 1000000 + length(p)) AS rule, max_by(v, length(h) * 1000000 + length(p)) AS v
  FROM (SELECT DISTINCT host, path FROM parts) u JOIN rules ON (u.host = h OR ends_with(u.host, '.' || h)) AND starts_with(u.path, p)
  GROUP BY host, path)
SELECT page_id, parts.host, parts.path, rule, coalesce(v, 'allow') AS verdict
FROM parts LEFT JOIN best ON parts.host = best.host AND parts.path = best.path
"""


@query("op7_url_filters", SQL)
def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, rule_table(spark, RULES)).select("page_id", "host", "path", "rule", "verdict")

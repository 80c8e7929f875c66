"""URL filters: host suffixes and path prefixes, joined with the rules on short hash prefixes.

Each url becomes the expressions `host suffix + path prefix` that a rule could name. Expressions and
rules meet on the first 32 bits of their SHA-256, the full digest confirms, and the longest rule decides.
Path prefixes are taken at every length that a rule path has, so a rule path may end anywhere.

Defined cases: a null url or one without `://` has an empty host and path, fits no rule and gets the
default verdict; of rules of equal length the blocking one wins; a rule given twice counts once; repeated
pages keep one row each; an empty table gives an empty result, an empty rule table the default verdict
everywhere; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgate.session import constant_rows

#: (verdict, host, path), as the query's contract gives them. Fixed values.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """Between the first `://` and the next `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_suffixes(name: Column) -> Column:
    """The host and everything after each of its dots."""
    labels = F.split(name, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."),
    )


def short(digest: Column) -> Column:
    """First 32 bits of a hex SHA-256, as a number."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = tuple(RULES)) -> DataFrame:
    """A small rule list as a table (verdict, host, path)."""
    return constant_rows(spark, list(rules), verdict="string", host="string", path="string")


def judged(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow"
) -> DataFrame:
    """(id, host, path, rule, verdict) for every row. ``rules``: (verdict, host, path).

    Rows are shuffled once by id and url and the expressions are grouped in place: Spark broadcasts a
    rule table that its own size check allows, and splits hot expressions of a sort-merge join otherwise.
    """
    text = F.concat(F.col("host"), F.col("path"))
    named = rules.select("verdict", F.col("host"), F.col("path")).dropna().distinct()
    keyed = named.select(
        short(F.sha2(text, 256)).alias("short"),
        F.sha2(text, 256).alias("digest"),
        text.alias("rule"),
        F.length(text).alias("size"),
        (F.col("verdict") == "block").cast("int").alias("blocks"),
        F.length("host").alias("host_size"),
        F.col("verdict").alias("says"),
    )
    # distinct lengths of rule paths: no more numbers than the longest path has characters
    lengths = [r[0] for r in named.select(F.length("path")).distinct().collect()]
    urls = pages.groupBy(F.col(id_col).alias("id"), F.col(url_col).alias("url")).agg(F.count("*").alias("copies"))
    parts = urls.select("*", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    wanted = F.filter(F.array([F.lit(n).cast("int") for n in sorted(lengths)]).cast("array<int>"), lambda n: n <= F.length("path"))
    expressions = F.flatten(
        F.transform(
            host_suffixes(F.col("host")),
            lambda h: F.transform(wanted, lambda n: F.concat(h, F.substring(F.col("path"), F.lit(1), n))),
        )
    )
    spread = parts.withColumn("expression", F.explode_outer(F.array_distinct(expressions)))
    digests = spread.withColumn("digest", F.sha2("expression", 256)).withColumn("short", short(F.col("digest")))
    met = digests.join(keyed.withColumnRenamed("digest", "full"), "short", "left")
    confirmed = (F.col("digest") == F.col("full")) & (F.col("expression") == F.col("rule"))
    rank = F.when(confirmed, F.struct("size", "blocks", "host_size", "rule", "says"))
    best = met.groupBy("id", "url").agg(
        F.max(rank).alias("best"), F.first("host").alias("host"), F.first("path").alias("path"), F.first("copies").alias("copies")
    )
    rows = best.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return rows.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.says"), F.lit(default)).alias("verdict"),
    )


def allowed(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """The pages whose verdict is allow, with all their columns: urls are judged once and joined back."""
    marked = pages.select(F.col(f"`{url_col}`").alias("u")).distinct()
    good = judged(marked.withColumn("i", F.col("u")), rules, "i", "u", default).where("verdict = 'allow'").select(F.col("i").alias("good"))
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("page"))
    return rows.join(good, F.col(f"page.`{url_col}`").eqNullSafe(F.col("good")), "left_semi").select("page.*")


ORACLE = r"""
WITH rules(verdict, rhost, rpath) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, lower(regexp_extract(rest, '^[^/?#]*')) AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM cut
), numbered AS (SELECT row_number() OVER (ORDER BY page_id) AS n, * FROM parts
), fits AS (
  SELECT n, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY n ORDER BY length(rhost || rpath) DESC, verdict DESC) AS place
  FROM numbered JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM numbered LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (n)
"""

"""URL filters: host-suffix and path-prefix expressions, equi-joined to rules on short hash prefixes.

Each URL becomes every dot-separated suffix of its host that has no more labels than some rule's host and is
followed by every prefix of its path that is as long as some rule's path. Expressions meet rules on the first 8
hex digits of their SHA-256; full digests confirm, and the longest rule wins (of two of the same length, the
smaller one). All of it is DataFrame code.

Defined cases: a null url, or one without `://`, has an empty host and path and no rule; an empty table
gives no rows; repeated rows are judged each by itself; further columns stay out of the result; a host of very
many labels has no more expressions than the rules' longest host asks for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower

#: (host, path, verdict)
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
#: Rule tables of more rows are joined by a shuffle on the hash prefix instead.
BROADCAST_RULES = 100_000
PREFIX_DIGITS = 8


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring({_name(url)}, instr({_name(url)}, '://') + 3)")).otherwise("")
    return ascii_lower(F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring({_name(url)}, instr({_name(url)}, '://') + 3)")).otherwise("")
    return F.regexp_extract(F.regexp_replace(F.coalesce(rest, F.lit("")), r"^[^/?#]*", ""), r"^[^?#]*", 0)


def _name(c: Column) -> str:
    return "`" + c._jc.toString().strip("`").replace("`", "``") + "`"


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """The rules as literals, so that no Python runs on executors: prefix, digest, rule, verdict."""
    quote = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    rows = ", ".join(f"({quote(h + p)}, {quote(v)})" for h, p, v in rules) or "('', '')"
    t = spark.sql(f"SELECT rule, rule_verdict FROM VALUES {rows} AS t(rule, rule_verdict) WHERE rule != ''")
    digest = F.sha2(F.col("rule"), 256)
    return t.select(F.substring(digest, 1, PREFIX_DIGITS).alias("prefix"), digest.alias("rule_digest"), "rule", "rule_verdict")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, default: str = "allow", key: str = "page_id", url: str = "url") -> DataFrame:
    """key, host, path, rule and verdict of each row; `default` where no rule fits.

    Expressions are folded per row before and after the one narrow shuffle; rows never meet in groups
    larger than one url's expressions, so a hot host is no hot key.
    """
    lengths = sorted({len(p) for _, p, _ in rules})
    rows = pages.select(F.col(key), F.col(url).alias("_url")).withColumn("_row", F.monotonically_increasing_id())
    rows = rows.select("_row", key, host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"))
    labels = F.split("host", r"\.")
    longest = max((h.count(".") + 1 for h, _, _ in rules), default=1)
    tail = F.slice(labels, F.greatest(F.size(labels) - longest + 1, F.lit(1)), longest)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(tail)), lambda i: F.array_join(F.slice(tail, i, longest), "."))
    prefixes = F.filter(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]), lambda x: x.isNotNull())
    every = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    told = rows.select("_row", key, "host", "path", F.explode_outer(every).alias("_x")).withColumn("_digest", F.sha2("_x", 256))
    told = told.withColumn("prefix", F.substring("_digest", 1, PREFIX_DIGITS))
    table = rule_table(pages.sparkSession, rules)
    met = told.join(F.broadcast(table) if len(rules) <= BROADCAST_RULES else table, "prefix", "left")
    fits = F.when(F.col("rule_digest") == F.col("_digest"), F.struct((-F.length("rule")).alias("n"), F.col("rule"), F.col("rule_verdict")))
    best = met.groupBy("_row", key, "host", "path").agg(F.min(fits).alias("_best"))
    return best.select(key, "host", "path", F.col("_best.rule").alias("rule"), F.coalesce("_best.rule_verdict", F.lit(default)).alias("verdict"))


def judge_sql(rules: Sequence[tuple[str, str, str]] = RULES, default: str = "allow") -> str:
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)
    return f"""
WITH u AS (SELECT row_number() OVER () AS n, page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (SELECT n, page_id, coalesce(regexp_extract(rest, '^[^/?#]*'), '') AS raw, coalesce(rest, '') AS rest FROM u),
p AS (SELECT n, page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM s),
r(rhost, rpath, rverdict) AS (VALUES {values}),
m AS (SELECT n, rhost || rpath AS rule, rverdict, row_number() OVER (PARTITION BY n ORDER BY length(rhost || rpath) DESC, rhost || rpath) AS k
      FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(rverdict, '{default}') AS verdict FROM p LEFT JOIN (SELECT * FROM m WHERE k = 1) USING (n)"""

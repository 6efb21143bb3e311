"""Mixing sources to target weights by hierarchical budgeting over a domain-language-source tree.

A budget of tokens flows down the tree: at each node it is shared among the children by weight, and no
child gets more than its subtree can supply (its tokens times the most epochs). What a child cannot use
goes to its siblings by weight first; only what the whole subtree cannot supply is left to the siblings
of the parent, one level up. The shares have a closed form over children sorted by supply per weight, so
each level is one window over the tree's nodes, in whole numbers.

A leaf whose budget is A and whose documents hold N tokens takes A div N whole epochs and, of one more
epoch in an order seeded by (seed, epoch, doc_id), the longest prefix of at most A mod N tokens. The
prefix is found from sums per hash bucket (at most 16 ** DIGITS a leaf); only the one bucket in which it ends
is ordered row by row, so that a leaf with a third of all documents is spread over all tasks. What comes out is
one row per leaf: whole epochs, and the place in the seeded order up to which documents enter. Documents meet
that small table, and are not dealt anew themselves.

Everything is DataFrame code. Defined cases: null language or source form their own branch `none`; a branch of
weight 0 gets and supplies nothing; null and empty texts have 0 tokens; very long texts count whole; rows with
equal doc_id enter a prefix together or not at all; an empty table gives no rows; columns other than doc_id,
text, lang and source are ignored by mixture() and kept by select().
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace

LEVELS = ["domain", "lang", "source"]
DIGITS = 4


@dataclass(frozen=True)
class Mixture:
    """Whole-number weights; a node that is not named weighs `other`."""

    domain: dict[str, int] = field(default_factory=lambda: {"d0": 4, "d1": 3, "d2": 2, "d3": 1})
    lang: dict[str, int] = field(default_factory=lambda: {"en": 5, "de": 2, "fr": 2, "es": 2})
    source: dict[str, int] = field(default_factory=dict)
    other: int = 1
    percent: int = 80
    epochs: int = 2
    seed: int = 42

    def weight(self, level: str) -> Column:
        out = F.lit(self.other)
        for name, w in getattr(self, level).items():
            out = F.when(F.col(level) == name, w).otherwise(out)
        return out.cast("long")

    def weight_sql(self, level: str) -> str:
        cases = " ".join(f"WHEN {level} = '{n}' THEN {w}" for n, w in getattr(self, level).items())
        return f"CASE {cases} ELSE {self.other} END" if cases else str(self.other)


def levels() -> list[Column]:
    """The three levels of a document. A source's domain is its number modulo 4, which its last two digits tell."""
    source = F.coalesce(F.col("source"), F.lit("none"))
    number = F.regexp_extract(source, r"(\d+)", 1)
    domain = F.when(number == "", "none").otherwise(F.concat(F.lit("d"), (F.substring(number, -2, 2).cast("int") % 4).cast("string")))
    return [domain.alias("domain"), F.coalesce(F.col("lang"), F.lit("none")).alias("lang"), source.alias("source")]


def narrow(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, the three levels and the number of words of the whole text."""
    tokens = F.size(F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+"), ""))
    return docs.select("doc_id", *levels(), tokens.cast("long").alias("tokens"))


def share(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """nodes(parent..., name, budget of the parent, supply, weight) with budget replaced by the node's own."""
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = by.orderBy(F.try_divide(F.col("supply"), F.col("weight")), name)
    before = F.coalesce(F.sum("supply").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    onward = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    t = nodes.withColumn("_full", F.col("supply") * onward <= (F.col("budget") - before) * F.col("weight"))
    left = F.col("budget") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("supply"))).over(by), F.lit(0))
    open_ = F.sum(F.when(~F.col("_full"), F.col("weight"))).over(by)
    t = t.withColumn("_left", left).withColumn("_open", open_)
    return t.withColumn("budget", F.when(F.col("_full"), F.col("supply")).otherwise(F.expr("(_left * weight) div _open"))).drop("_full", "_left", "_open")


def budgets(leaves: DataFrame, mix: Mixture) -> DataFrame:
    """domain, lang, source, total and budget of each leaf, from domain, lang, source and total."""
    weighs = F.greatest(*[(mix.weight(x) == 0).cast("int") for x in LEVELS]) == 0
    leaves = leaves.withColumn("supply", F.when(weighs, F.col("total") * mix.epochs).otherwise(0))
    keys: list[str] = []
    for level in LEVELS:
        nodes = leaves.groupBy(*keys, level).agg(F.sum("supply").alias("supply"), F.sum("total").alias("total")).withColumn("weight", mix.weight(level))
        if keys:
            nodes = nodes.join(parents, keys)
        else:  # the domains share what the whole corpus allows
            nodes = nodes.withColumn("_all", F.sum("total").over(Window.partitionBy(F.lit(0)))).withColumn("budget", F.expr(f"(_all * {mix.percent}) div 100")).drop("_all")
        got = share(nodes, keys, level)
        keys = [*keys, level]
        parents = got.select(*keys, "budget")
    return got.select(*LEVELS, "total", "budget")


def order_digest(mix: Mixture) -> Column:
    """A document's place in its leaf's last, partial epoch."""
    return F.md5(F.concat_ws(":", F.lit(str(mix.seed)), F.col("_whole").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))


def bucket_of(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("int")


def cuts(rows: DataFrame, mix: Mixture, work: Workspace) -> DataFrame:
    """Of each leaf of narrow() rows: the levels, leaf_budget, _whole epochs, and _upto, the last digest of the
    partial epoch's prefix ('' if it is empty, '~' if it holds all)."""
    leaves = work.keep(budgets(rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("total")), mix))
    part = lambda op: F.expr(f"CASE WHEN total > 0 THEN budget {op} total ELSE 0 END")
    leaves = leaves.select(*LEVELS, F.col("budget").alias("leaf_budget"), part("div").alias("_whole"), part("%").alias("_rest"))
    rows = rows.join(leaves, LEVELS).withColumn("_md5", order_digest(mix)).withColumn("_bucket", bucket_of(F.col("_md5")))
    sums = rows.groupBy(*LEVELS, "_rest", "_bucket").agg(F.sum("tokens").alias("_sum"))
    upto = F.sum("_sum").over(Window.partitionBy(*LEVELS).orderBy("_bucket"))
    ends = sums.withColumn("_upto", upto).filter(F.col("_upto") > F.col("_rest"))
    ends = ends.groupBy(*LEVELS).agg(F.min(F.struct("_bucket", (F.col("_upto") - F.col("_sum")).alias("before"))).alias("_end"))
    ends = work.keep(ends.select(*LEVELS, F.col("_end._bucket").alias("_last"), F.col("_end.before").alias("_before")))
    edge = rows.join(ends, LEVELS).filter(F.col("_bucket") == F.col("_last"))
    so_far = F.col("_before") + F.sum("tokens").over(Window.partitionBy(*LEVELS, "_bucket").orderBy("_md5"))  # ties enter together
    found = edge.withColumn("_in", so_far <= F.col("_rest")).groupBy(*LEVELS).agg(F.max(F.when(F.col("_in"), F.col("_md5"))).alias("_found"))
    # where the bucket's first document is too much already, the prefix ends with the bucket before
    start = F.lpad(F.lower(F.hex("_last")), DIGITS, "0")
    ends = work.keep(ends.join(found, LEVELS).select(*LEVELS, F.coalesce("_found", start).alias("_upto")))
    return work.keep(leaves.drop("_rest").join(ends, LEVELS, "left").withColumn("_upto", F.coalesce("_upto", F.lit("~"))))


def copies(mix: Mixture) -> Column:
    return (F.col("_whole") + (order_digest(mix) <= F.col("_upto")).cast("long")).alias("copies")


def mixture(docs: DataFrame, mix: Mixture = Mixture(), text: str = "text") -> DataFrame:
    """doc_id, the levels, tokens, leaf_budget and copies (how often the document is used) of every row."""
    work = Workspace(docs.sparkSession)
    rows = work.keep(narrow(docs, text))
    return rows.join(cuts(rows, mix, work), LEVELS).select("doc_id", *LEVELS, "tokens", "leaf_budget", copies(mix))


def select(docs: DataFrame, mix: Mixture = Mixture(), text: str = "text") -> DataFrame:
    """The rows of docs that are used at least once, columns as they are."""
    work = Workspace(docs.sparkSession)
    told = cuts(work.keep(narrow(docs, text)), mix, work)
    told = told.select(*[F.col(c).alias(f"_{c}") for c in LEVELS], "_whole", "_upto")
    keyed = docs.withColumns({f"_{c}": v for c, v in zip(LEVELS, levels(), strict=True)})
    return keyed.join(told, [f"_{c}" for c in LEVELS]).filter(copies(mix) > 0).select(*docs.columns)


def mixture_sql(mix: Mixture = Mixture()) -> str:
    def level(n: int) -> str:
        keys, name = LEVELS[:n], LEVELS[n]
        by = "PARTITION BY " + (", ".join(keys) or "0")
        link = f"JOIN g{n - 1} USING ({', '.join(keys)})" if keys else ", top"
        cols = ", ".join([*keys, name])
        return f"""
n{n} AS (SELECT {cols}, sum(total * {mix.epochs})::BIGINT AS supply, ({mix.weight_sql(name)})::BIGINT AS weight FROM leaves GROUP BY {cols}),
f{n} AS (SELECT *, supply * sum(weight) OVER ({by} ORDER BY supply / weight, {name} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
         <= (budget - coalesce(sum(supply) OVER ({by} ORDER BY supply / weight, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight AS full_ FROM n{n} {link}),
g{n} AS (SELECT {cols}, (CASE WHEN full_ THEN supply ELSE ((budget - coalesce(sum(CASE WHEN full_ THEN supply END) OVER ({by}), 0)) * weight) // sum(CASE WHEN NOT full_ THEN weight END) OVER ({by}) END)::BIGINT AS budget FROM f{n}),"""

    return f"""
WITH d AS (SELECT doc_id, coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source,
     len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''))::BIGINT AS tokens FROM documents),
r AS (SELECT *, CASE WHEN regexp_extract(source, '(\\d+)') = '' THEN 'none' ELSE 'd' || (regexp_extract(source, '(\\d+)')::BIGINT % 4) END AS domain FROM d),
leaves AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS total FROM r GROUP BY ALL),
top AS (SELECT (sum(total) * {mix.percent}) // 100 AS budget FROM leaves),{level(0)}{level(1)}{level(2)}
w AS (SELECT r.*, budget AS leaf_budget, CASE WHEN total > 0 THEN budget // total ELSE 0 END AS whole, CASE WHEN total > 0 THEN budget % total ELSE 0 END AS rest
      FROM r JOIN leaves USING (domain, lang, source) JOIN g2 USING (domain, lang, source)),
c AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('{mix.seed}:' || whole || ':' || coalesce(doc_id::VARCHAR, 'null'))) AS upto FROM w)
SELECT doc_id, domain, lang, source, tokens, leaf_budget, (whole + CASE WHEN upto <= rest THEN 1 ELSE 0 END)::BIGINT AS copies FROM c"""

"""Aggregates over cells and masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Names of the eight sectors, clockwise from north.
SECTORS = ["N", "NE", "E", "SE", "S", "SW", "W", "NW"]
PERCENTILES = (5, 25, 50, 75, 95)
BUCKETS = 4096


def finite(c: Column) -> Column:
    """NaN becomes null, so that comparisons and averages never see one."""
    return F.when(~F.isnan(c), c)


def moments(c: Column) -> list[Column]:
    """count, min, mean, max and population std of the known values."""
    d = finite(c.cast("double"))
    return [F.count(d).alias("count"), F.min(d).alias("min"), F.avg(d).alias("mean"), F.max(d).alias("max"), F.stddev_pop(d).alias("std")]


def quantiles(df: DataFrame, c: Column, ps: dict[str, float]) -> DataFrame:
    """One row with the exact linear quantile of the known values for each name.

    Values are counted in equal buckets over their range, which tells the buckets that hold the wanted ranks; only
    those are put in order, by distinct value. So no task holds all values, or a map of them."""
    v = df.select(finite(c.cast("double")).alias("v")).filter("v IS NOT NULL").withColumn("_one", F.lit(1))
    span = v.groupBy("_one").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n"))
    share = F.try_divide(F.col("v") - F.col("lo"), F.col("hi") - F.col("lo"))
    bucket = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * BUCKETS), F.lit(BUCKETS - 1)).cast("int")
    t = v.join(F.broadcast(span), "_one").withColumn("bucket", bucket)
    per = t.groupBy("bucket").agg(F.count("*").alias("k"), F.first("n").alias("n"))
    per = per.withColumn("upto", F.sum("k").over(Window.orderBy("bucket")))  # BUCKETS rows at most
    pos = {name: F.col("n").cast("double") * p - p for name, p in ps.items()}
    ranks = {(name, end): op(pos[name]).cast("long") for name in ps for end, op in (("lo", F.floor), ("hi", F.ceil))}
    tell = lambda r: F.struct("bucket", (F.col("upto") - F.col("k")).alias("before"), r.alias("rank"))
    wanted = per.agg(F.first("n").alias("n"), *[F.min(F.when(F.col("upto") > r, tell(r))).alias(f"{a}_{b}") for (a, b), r in ranks.items()])
    names = [f"{a}_{b}" for a, b in ranks]
    near = t.select("v", "bucket", "_one").join(F.broadcast(wanted.withColumn("_one", F.lit(1))), "_one")
    near = near.filter(F.array_contains(F.array(*[F.col(f"{x}.bucket") for x in names]), F.col("bucket")))
    near = near.groupBy("bucket", "v", "n", *names).agg(F.count("*").alias("k"))
    near = near.withColumn("_upto", F.sum("k").over(Window.partitionBy("bucket").orderBy("v")))
    hit = lambda x: (F.col("bucket") == F.col(f"{x}.bucket")) & (F.col("_upto") > F.col(f"{x}.rank") - F.col(f"{x}.before"))
    found = near.agg(F.first("n").alias("n"), *[F.min(F.when(hit(x), F.col("v"))).alias(x) for x in names])
    part = {name: pos[name] - F.floor(pos[name]) for name in ps}
    return found.select(*[(F.col(f"{x}_lo") + part[x] * (F.col(f"{x}_hi") - F.col(f"{x}_lo"))).alias(x) for x in ps])


def beside(*frames: DataFrame) -> DataFrame:
    """Frames of one row each, side by side."""
    out = frames[0].withColumn("_one", F.lit(1))
    for f in frames[1:]:
        out = out.join(F.broadcast(f.withColumn("_one", F.lit(1))), "_one")
    return out.drop("_one")


def describe(c: Column, percentiles: tuple[int, ...] = PERCENTILES) -> list[Column]:
    """moments() and linear percentiles as aggregates, for groups of bounded size; see summary() for whole relations."""
    d = finite(c.cast("double"))
    return [*moments(c), *[F.percentile(d, F.lit(p / 100)).alias(f"p{p}") for p in percentiles]]


def summary(df: DataFrame, c: Column, percentiles: tuple[int, ...] = PERCENTILES) -> DataFrame:
    """One row: count, min, mean, max, population std and linear percentiles of the known values."""
    return beside(df.agg(*moments(c)), quantiles(df, c, {f"p{p}": p / 100 for p in percentiles}))


def circular_mean(c: Column) -> Column:
    return F.pmod(F.degrees(F.atan2(F.avg(F.sin(F.radians(c))), F.avg(F.cos(F.radians(c))))), F.lit(360.0))


def sector(c: Column) -> Column:
    return F.floor(F.pmod(c + 22.5, F.lit(360.0)) / 45).cast("int")


def aspect_distribution(df: DataFrame, c: Column) -> DataFrame:
    """sector, name, n and fraction of each of the eight sectors, zero if absent."""
    rows = ", ".join(f"({i}, '{n}')" for i, n in enumerate(SECTORS))
    dim = df.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS d(sector, name)")
    n = df.select(finite(c).alias("a")).filter("a IS NOT NULL").groupBy(sector(F.col("a")).alias("sector")).agg(F.count("*").alias("n"))
    t = F.broadcast(dim).join(n, "sector", "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))  # eight rows
    return t.withColumn("fraction", F.coalesce(F.try_divide(F.col("n"), total), F.lit(0.0)))


def coverage(c: Column) -> Column:
    """Share of cells with a value; 0 where there are no cells."""
    return F.coalesce(F.try_divide(F.count(finite(c)), F.count("*")), F.lit(0.0))


def shares(df: DataFrame, key: str, names: dict[int, str]) -> DataFrame:
    """class_id, class_name, n and fraction of each named class, zero if absent."""
    rows = ", ".join(f"({i}, '{n}')" for i, n in names.items())
    dim = df.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS d(class_id, class_name)")
    n = df.groupBy(F.col(key).cast("int").alias("class_id")).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("total"))
    t = F.broadcast(dim).join(n, "class_id", "left").withColumn("_one", F.lit(1)).join(total.withColumn("_one", F.lit(1)), "_one")
    n0 = F.coalesce("n", F.lit(0)).cast("long")
    return t.select("class_id", "class_name", n0.alias("n"), F.coalesce(F.try_divide(n0, F.col("total")), F.lit(0.0)).alias("fraction"))


def agreement(predicted: Column, reference: Column) -> list[Column]:
    """IoU, recall, precision and the two fractions; 0 where a denominator is."""
    both, either = F.count_if(predicted & reference), F.count_if(predicted | reference)
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return [ratio(both, either).alias("iou"), ratio(both, F.count_if(reference)).alias("recall"), ratio(both, F.count_if(predicted)).alias("precision"), ratio(F.count_if(predicted), F.count("*")).alias("predicted_fraction"), ratio(F.count_if(reference), F.count("*")).alias("reference_fraction")]


def best_shift(cells: DataFrame, predicted: str, reference: str, height: int, width: int, most: int) -> DataFrame:
    """d_row, d_col and score of the circular shift with the largest overlap; the first in scan order of equal ones."""
    span = F.sequence(F.lit(-most), F.lit(most))
    moved = cells.filter(predicted).select("row", "col", F.explode(span).alias("d_row")).select("*", F.explode(span).alias("d_col"))
    moved = moved.select("d_row", "d_col", F.pmod(F.col("row") + F.col("d_row"), F.lit(height)).alias("row"), F.pmod(F.col("col") + F.col("d_col"), F.lit(width)).alias("col"))
    hits = moved.join(cells.filter(reference).select("row", "col"), ["row", "col"]).groupBy("d_row", "d_col").agg(F.count("*").alias("score"))
    every = cells.sparkSession.range(1).select(F.explode(span).alias("d_row")).select("*", F.explode(span).alias("d_col"))
    return every.join(hits, ["d_row", "d_col"], "left").withColumn("score", F.coalesce("score", F.lit(0)).cast("long")).orderBy(F.desc("score"), "d_row", "d_col").limit(1)


def block_majority(cells: DataFrame, mask: str, factor: int, height: int, width: int) -> DataFrame:
    """Blocks of factor x factor cells of which more than half are set; a remainder at the edge is trimmed."""
    inside = (F.col("row") < height // factor * factor) & (F.col("col") < width // factor * factor)
    return cells.filter(inside).groupBy(F.expr(f"row div {factor}").cast("int").alias("row"), F.expr(f"col div {factor}").cast("int").alias("col")).agg((F.avg(F.col(mask).cast("int")) > 0.5).alias(mask))

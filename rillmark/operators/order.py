"""Exact order statistics and systematic samples without a task that sees all rows.

Both place rows in bins of a value first. The bins only balance the work: counts of each bin tell which one holds the
rank that is asked for, and only inside a bin are rows put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS, SPREAD = 1024, 16


def quantiles(df: DataFrame, value: str, shares: tuple[float, ...], by: tuple[str, ...] = (), bins: int = BINS) -> DataFrame:
    """(by..., q0, q1, ...): exact quantiles with linear interpolation; nulls do not count; a group without values has no row.

    Equal values are counted first, so repeated ones cost one row and the input is read once; then values are counted by
    equal-width bins of each group, and the bins that hold the ranks are read. A group's values lie in SPREAD tasks.
    """
    keys = [F.col(k) for k in by]
    one = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("v")).na.drop(subset=list(by) or ["v"])
    one = one.groupBy(*by, "v").agg(F.count("*").alias("rows"))
    range_ = one.groupBy(*by).agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("rows").alias("n")).where("n > 0")
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.when(F.col("hi") > F.col("lo"), F.least(F.floor((F.col("v") - F.col("lo")) / width), F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")
    if by:
        part, parts = F.pmod(F.xxhash64("v"), F.lit(SPREAD)).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)))
        binned = one.withColumn("_part", part).join(range_.withColumn("_part", parts), [*by, "_part"]).drop("_part")
    else:
        binned = one.crossJoin(range_)  # one row
    binned = binned.withColumn("bin", place)
    order = Window.partitionBy(*by, F.lit(0)).orderBy("bin")
    counts = binned.groupBy(*by, "bin", "n").agg(F.sum("rows").alias("rows")).withColumn("before", F.sum("rows").over(order) - F.col("rows"))  # bins rows a group
    at = [(F.col("n") - 1) * F.lit(float(s)) for s in shares]
    ranks = F.array_distinct(F.flatten(F.array(*(F.array(F.floor(a), F.ceil(a)) for a in at))))
    wanted = counts.withColumn("ranks", F.filter(ranks, lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("rows")))).where(F.size("ranks") > 0)
    inside = binned.drop("n").join(wanted.select(*keys, "bin", "n", "before", "ranks"), [*by, "bin"])
    upto = F.sum("rows").over(Window.partitionBy(*by, "bin").orderBy("v")) + F.col("before")
    hit = inside.withColumn("upto", upto).withColumn("rank", F.explode(F.filter("ranks", lambda r: (r < F.col("upto")) & (r >= F.col("upto") - F.col("rows")))))
    found = hit.groupBy(*by, "n").agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("m"))
    def between(a):
        low, high = F.col("m")[F.floor(a)], F.col("m")[F.ceil(a)]
        return low + (high - low) * (a - F.floor(a))

    return found.select(*keys, *(between(a).alias(f"q{i}") for i, a in enumerate(at)))


def _among(value: Column, cuts: list[float], before: int = 0) -> Column:
    """How many of the ordered cuts lie below value: halved until one is left, so a row meets few of them."""
    if not cuts:
        return F.lit(before)
    i = len(cuts) // 2
    return F.when(value > cuts[i], _among(value, cuts[i + 1 :], before + i + 1)).otherwise(_among(value, cuts[:i], before))


def every_nth(df: DataFrame, n: int, *order: str, bins: int = 256) -> DataFrame:
    """Rows 0, n, 2n, ... of the order, which must be total and begin with a number that is never null."""
    first = F.col(order[0])
    cuts = df.agg(F.percentile_approx(first.cast("double"), [i / bins for i in range(1, bins)], 10 * bins)).first()[0] or []  # bins - 1 numbers
    placed = df.withColumn("_bin", _among(first, sorted(set(map(float, cuts)))))
    counts = placed.groupBy("_bin").agg(F.count("*").alias("_n"))
    starts = counts.withColumn("_start", F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_bin")) - F.col("_n")).drop("_n")  # a row a bin
    at = F.row_number().over(Window.partitionBy("_bin").orderBy(*order)) - 1
    return placed.join(starts, "_bin").withColumn("_at", at + F.col("_start")).where(F.pmod("_at", F.lit(n)) == 0).drop("_bin", "_start", "_at")

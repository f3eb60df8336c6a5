"""Order statistics of many groups at once, without a group in one task.

Histograms of a group are refined around the rank that is wanted: each pass counts the values between two bounds in
BUCKETS of equal width and goes on with the bucket that holds the rank, until few values are left, or equal ones, or
the rank lies between two buckets. Counts combine before they move, so a group of any size spreads over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataline.session import discard, materialise

#: Buckets of a pass, and values that are gathered for one group.
BUCKETS, GATHERED = 1_024, 1_024


def interpolated(values: Column, share: float | Column, before: Column | int = 0, n: Column | None = None) -> Column:
    """The quantile of a group of ``n`` values, of which ``values`` (ascending) are those after the first ``before``:
    between two neighbours in proportion."""
    rank = (F.size(values) if n is None else n).cast("double") - 1
    rank = rank * share
    low, high = F.floor(rank), F.ceil(rank)
    a, b = (F.get(values, (x - before).cast("int")) for x in (low, high))
    return a + (b - a) * (rank - low)


def quantiles(rows: DataFrame, key: str, value: str, share: float) -> DataFrame:
    """``key`` and q, the quantile of its values, linear between neighbours. Nulls do not count; NaN is the largest."""
    x = F.nanvl(F.col(value).cast("double"), F.lit(float("inf")))
    slim = materialise(rows.filter(F.col(value).isNotNull()).select(F.col(key).alias("k"), x.alias("x")), "quantile-values")
    state = slim.groupBy("k").agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
    state = materialise(state.select("k", "n", "low", "high", F.lit(0).cast("bigint").alias("before"), F.col("n").alias("left"), F.lit(None).cast("double").alias("q")), "quantile-state")
    rank = (F.col("n") - 1) * share
    first, second = F.floor(rank), F.ceil(rank)
    ended, wide = [], F.col("q").isNull() & (F.col("left") > GATHERED)
    while not (open_ := state.filter(wide)).isEmpty():
        bounds = open_.select(F.col("k").alias("s_k"), "n", "low", "high", "before")
        here = slim.join(bounds, F.col("k").eqNullSafe(F.col("s_k"))).filter("x BETWEEN low AND high")
        even = F.floor((F.col("x") - F.col("low")) / (F.col("high") - F.col("low")) * BUCKETS)
        bucket = F.when(F.col("x") >= F.col("high"), BUCKETS - 1).otherwise(F.least(even, F.lit(BUCKETS - 1)))
        counts = here.groupBy("k", "n", "before", bucket.alias("bucket")).agg(F.count("*").alias("c"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        upto = F.col("before") + F.sum("c").over(W.partitionBy("k").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0))
        run = counts.withColumn("upto", upto)
        there = F.struct("bucket", "lo", "hi", "c", "upto")
        found = run.groupBy("k", "n").agg(F.min(F.when(F.col("upto") > first, there)).alias("a"), F.min(F.when(F.col("upto") > second, there)).alias("b"))
        apart = (F.col("a.bucket") != F.col("b.bucket")) | (F.col("a.lo") == F.col("a.hi"))
        between = F.when(F.col("a.bucket") != F.col("b.bucket"), F.col("a.hi") + (F.col("b.lo") - F.col("a.hi")) * (rank - first)).otherwise(F.col("a.lo"))
        new = found.select("k", "n", F.col("a.lo").alias("low"), F.col("a.hi").alias("high"), (F.col("a.upto") - F.col("a.c")).alias("before"), F.col("a.c").alias("left"), F.when(apart, between).alias("q"))
        ended.append(state)
        state = materialise(state.filter(~wide).unionByName(new), "quantile-state")
    few = state.filter("q IS NULL").select(F.col("k").alias("s_k"), "n", "low", "high", "before")
    here = slim.join(few, F.col("k").eqNullSafe(F.col("s_k"))).filter("x BETWEEN low AND high")
    gathered = here.groupBy("k", "n", "before").agg(F.array_sort(F.collect_list("x")).alias("v")).select("k", interpolated(F.col("v"), share, F.col("before"), F.col("n")).alias("q"))
    out = materialise(state.filter("q IS NOT NULL").select("k", "q").unionByName(gathered), "quantiles")
    discard(slim, state, *ended)
    back = F.when(F.col("q") == float("inf"), F.lit(float("nan"))).otherwise(F.col("q"))
    return out.select(F.col("k").alias(key), back.alias("q"))

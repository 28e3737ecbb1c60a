"""Exact quantiles at scale and median imputation.

``F.median``/``F.percentile`` are exact but keep a value->count map that is
merged in ONE task for a global aggregate: fine for low-cardinality values,
unbounded for continuous measures over 100 TB.  ``ranked_quantile`` computes
the same exact, linearly interpolated quantile fully distributed:

1. value counts (partial aggregation; a hot value becomes one row);
2. ranges of the distinct values, cut at their approximate quantiles;
3. totals of each range (a few rows) -> the ranges that hold the wanted ranks;
4. a running count inside those ranges only (partitioned window);
5. the two rows bracketing the target rank -> interpolate.

No step sorts more than the ranges that hold a result, nothing is checkpointed
and nothing but one row reaches the driver (through a scalar subquery).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PARTS = 64  # ranges that a column is cut into


def ranked_table(df: DataFrame, cols: Sequence[str], probs: Sequence[float], partitions: int = PARTS) -> DataFrame:
    """``cid, prob, q``: the exact quantile of every column at every probability
    (NULLs skipped; ``percentile_cont``: h = (N-1)p,
    v[floor h] + (h - floor h)(v[ceil h] - v[floor h])) in one lazy plan.

    The columns are stacked as (column id, value) rows and counted by value.  Approximate
    quantiles of the distinct values cut each column into ``partitions`` ranges; only their sums
    are needed to know which range holds a wanted rank, and only
    those ranges (one or two a quantile) are sorted for a running count."""
    cols = list(cols)
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("cid"), F.col(c).cast("double").alias("v")) for i, c in enumerate(cols)])).alias("s"))
    counts = (stacked.select("s.cid", "s.v").where(F.col("v").isNotNull())
              .groupBy("cid", "v").agg(F.count(F.lit(1)).alias("cnt")))
    cuts = counts.groupBy("cid").agg(F.percentile_approx("v", [i / partitions for i in range(1, partitions)], 20 * partitions).alias("cuts"))
    ranged = (counts.join(F.broadcast(cuts), "cid")   # one row a column
              .select("cid", "v", "cnt", F.size(F.filter("cuts", lambda c: c < F.col("v"))).alias("pid")))
    # at most partitions x len(cols) rows
    sums = ranged.groupBy("cid", "pid").agg(F.sum("cnt").alias("pcnt"))
    by_range = Window.partitionBy("cid").orderBy("pid")
    spans = (sums.withColumn("upto", F.sum("pcnt").over(by_range.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
             .withColumn("n", F.sum("pcnt").over(Window.partitionBy("cid")))
             .withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
             .withColumn("h", (F.col("n") - 1) * F.col("prob"))
             .where((F.col("upto") - F.col("pcnt") < F.ceil("h") + 1) & (F.col("upto") >= F.floor("h") + 1))
             .select("cid", "pid", "prob", "h", (F.col("upto") - F.col("pcnt")).alias("off")))
    running = Window.partitionBy("cid", "pid", "prob").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = (ranged.join(F.broadcast(spans), ["cid", "pid"])   # two rows a quantile at most
           .withColumn("hi", F.col("off") + F.sum("cnt").over(running))   # 1-based rank of the last copy
           .withColumn("lo", F.col("hi") - F.col("cnt") + 1))             # 1-based rank of the first copy
    k_lo, k_hi = F.floor("h") + 1, F.ceil("h") + 1
    at_lo = (F.col("lo") <= k_lo) & (F.col("hi") >= k_lo)
    at_hi = (F.col("lo") <= k_hi) & (F.col("hi") >= k_hi)
    return (cum.where(at_lo | at_hi).groupBy("cid", "prob")
            .agg(F.min(F.when(at_lo, F.col("v"))).alias("v_lo"), F.max(F.when(at_hi, F.col("v"))).alias("v_hi"),
                 F.first(F.col("h") - F.floor("h")).alias("frac"))
            .select("cid", "prob", (F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * F.col("frac")).alias("q")))


def ranked_quantiles(df: DataFrame, cols: Sequence[str], p: float, partitions: int = PARTS) -> DataFrame:
    """One-row DataFrame with the exact quantile at ``p`` of every column in ``cols``."""
    q = ranked_table(df, cols, [p], partitions)
    return q.agg(*[F.max(F.when(F.col("cid") == i, F.col("q"))).alias(c) for i, c in enumerate(cols)])


def count_quantiles(df: DataFrame, c: str, probs: Sequence[float]) -> DataFrame:
    """One-row DataFrame ``(qs)``: the exact quantiles of a column of group sizes, in the order of ``probs``.

    Sizes that add up to N have at most about sqrt(2N) different values, so their histogram, one
    partially aggregated pass, is small enough for a running sum in one window."""
    hist = df.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("k"))
    cum = hist.select("v", F.sum("k").over(Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("upto"),
                      F.sum("k").over(Window.partitionBy()).alias("n"))
    rank = lambda p: (F.col("n") - 1) * F.lit(float(p))
    at = lambda r: F.min(F.when(F.col("upto") >= r + 1, F.col("v")))
    ends = cum.agg(F.max("n").alias("n"), *[at(r).alias(f"{name}{i}") for i, p in enumerate(probs) for name, r in (("lo", F.floor(rank(p))), ("hi", F.ceil(rank(p))))])
    mix = lambda i, p: F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * (rank(p) - F.floor(rank(p)))
    return ends.select(F.array(*[mix(i, p) for i, p in enumerate(probs)]).alias("qs"))


def ranked_quantile(df: DataFrame, c: str, p: float, partitions: int = PARTS) -> DataFrame:
    """One-row DataFrame ``(q)``: exact quantile of non-NULL ``c`` at ``p``."""
    return ranked_quantiles(df, [c], p, partitions).toDF("q")


def median_of(df: DataFrame, c: str, method: str = "ranked") -> Column:
    """Exact median of ``c`` as a scalar-subquery Column."""
    if method == "ranked":
        return ranked_quantile(df, c, 0.5).scalar()
    if method == "percentile":
        return df.agg(F.median(c)).scalar()
    raise ValueError(method)


def impute_median(df: DataFrame, cols: Sequence[str], method: str = "ranked") -> DataFrame:
    """Replace NULLs in each column by the column's exact median (of the
    non-NULL values); one ``withColumns`` block.  With ``method="ranked"`` all
    columns' medians come from one distributed pass and one scalar subquery."""
    cols = list(cols)
    if method == "ranked":
        med = ranked_quantiles(df, cols, 0.5)
        m = med.select(F.struct(*cols).alias("m")).scalar()
        return df.withColumns({c: F.coalesce(F.col(c), m[c]) for c in cols})
    return df.withColumns({c: F.coalesce(F.col(c), median_of(df, c, method)) for c in cols})

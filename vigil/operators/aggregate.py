"""Aggregations.

Every aggregate is a ``groupBy().agg()`` with built-in functions, so Spark
plans a partial (map-side) aggregate before the shuffle: a hot category is
reduced to one row per map task before it reaches its reducer.  Grand totals
are scalar subqueries (one row, computed once and inlined as a literal), never
an unpartitioned window over data whose row count grows with the input.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.strings import ColumnOrName, col


# A1 ---------------------------------------------------------------------------
def count_by(df: DataFrame, keys: Sequence[ColumnOrName], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def grand_total(df: DataFrame, c: str) -> Column:
    """Scalar subquery ``(SELECT sum(c) FROM df)`` as a Column."""
    return df.agg(F.sum(c)).scalar()


# A2 -----------------------------------------------------------------------------
def count_share(df: DataFrame, keys: Sequence[ColumnOrName], n: str = "n",
                name: str = "percent") -> DataFrame:
    """Count per group and its share of all rows (``proprow``)."""
    counts = count_by(df, keys, n)
    return counts.withColumn(name, F.try_divide(F.col(n), grand_total(counts, n)))


# A3 / A4 ----------------------------------------------------------------------
def n_distinct(df: DataFrame, c: str, count_missing: bool = True, name: str = "n") -> DataFrame:
    """Number of distinct values; as in the reference's distinct count, a missing value
    counts as one more value when ``count_missing``."""
    e = F.count_distinct(F.col(c))
    if count_missing:
        e = e + F.max(F.col(c).isNull().cast("int"))
    return df.agg(e.cast("bigint").alias(name))


def distinct_per_group(df: DataFrame, group: Sequence[ColumnOrName], entity: ColumnOrName,
                       name: str = "n") -> DataFrame:
    """Distinct entities per group ("agencies active per year")."""
    return df.groupBy(*group).agg(F.count_distinct(col(entity)).alias(name))


# A5 / A8 / A9 -----------------------------------------------------------------
def sum_default(c: ColumnOrName, default=1) -> Column:
    return F.sum(F.coalesce(col(c), F.lit(default)))


def count_if(cond: Column) -> Column:
    return F.count_if(cond)


# A10 --------------------------------------------------------------------------
def mean_of_group_rates(df: DataFrame, group: ColumnOrName, success: Column,
                        n: str = "n", hits: str = "survival", rate: str = "percent") -> tuple[DataFrame, DataFrame]:
    """Per-group (hits, n, rate) and the unweighted means of n and rate.
    Returns ``(per_group, summary)``."""
    per = (df.groupBy(group).agg(F.count_if(success).alias(hits), F.count(F.lit(1)).alias(n))
           .withColumn(rate, F.try_divide(F.col(hits), F.col(n))))
    summary = per.agg(F.avg(n).alias(f"mean_{n}"), F.avg(rate).alias("mean_pct"))
    return per, summary


# A13 --------------------------------------------------------------------------
def with_total_row(df: DataFrame, label_col: str, label: str, totals: Mapping[str, Column]) -> DataFrame:
    """Append one summary row below a (small) table: ``totals`` gives the
    aggregate for each column, missing columns become NULL."""
    tot = df.agg(*[e.alias(k) for k, e in totals.items()]).withColumn(label_col, F.lit(label))
    return df.unionByName(tot, allowMissingColumns=True)


# A14 --------------------------------------------------------------------------
def lump_small(df: DataFrame, cat: str, count_col: str, k: int = 6, other: str = "Other") -> DataFrame:
    """Categories with count < k become ``other`` and are re-summed.  Adds
    ``__first`` = smallest original count in the merged group, the order in
    which groups first appear when the input is sorted by count."""
    lumped = df.withColumn(cat, F.when(F.col(count_col) < k, F.lit(other)).otherwise(F.col(cat)))
    return lumped.groupBy(cat).agg(F.sum(count_col).alias(count_col), F.min(count_col).alias("__first"))


# A16 --------------------------------------------------------------------------
def levels(df: DataFrame, c: str) -> DataFrame:
    """Distinct sorted category list (NULL last)."""
    return df.select(c).distinct().orderBy(F.asc_nulls_last(c))

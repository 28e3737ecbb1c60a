"""Order-aware deduplication and key checks.

Spark DataFrames are unordered, so "keep the first row per key" needs an
explicit total order.  ``keep_first`` is ``row_number() == 1``: Catalyst
rewrites it into a partial ``WindowGroupLimit`` BEFORE the shuffle, so each
map task forwards at most one row per key -- a key holding a third of the
table costs one row per map task on the wire, not a third of the table.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.strings import ColumnOrName


def order_columns(order_by: Sequence[ColumnOrName]) -> list[Column]:
    """Plain names sort ascending with NULLs last (the reference's order);
    Column expressions are taken as given."""
    return [F.asc_nulls_last(c) if isinstance(c, str) else c for c in order_by]


def _sortable(t: T.DataType) -> bool:
    if isinstance(t, T.ArrayType):
        return _sortable(t.elementType)
    if isinstance(t, T.StructType):
        return all(_sortable(f.dataType) for f in t)
    return not isinstance(t, (T.MapType, T.VariantType))


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[ColumnOrName]) -> DataFrame:
    """First row per key under ``order_by`` (all columns kept).  Every other
    sortable column follows ``order_by`` as a tie-breaker, so the order is
    total: rows that still tie are equal, and the result doesn't depend on
    how the input is partitioned."""
    if not order_by:
        raise ValueError("keep_first needs an explicit order_by")
    named = {c for c in order_by if isinstance(c, str)} | set(keys)
    rest = [f.name for f in df.schema if f.name not in named and _sortable(f.dataType)]
    w = Window.partitionBy(*keys).orderBy(*order_columns(order_by), *order_columns([F.col(f"`{c}`").asc_nulls_last() for c in rest]))
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def key_counts(dim: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return dim.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def duplicate_keys(dim: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Keys that occur more than once in a dimension (fan-out sources)."""
    return key_counts(dim, keys, name).filter(F.col(name) > 1)


def fanout_report(fact: DataFrame, dim: DataFrame, fact_keys: Sequence[str], dim_keys: Sequence[str],
                  name: str = "n_matches") -> DataFrame:
    """Fact keys that a join to ``dim`` would multiply, with their match count.

    The dimension is reduced to its duplicated keys first (an aggregate), so
    only those -- usually few -- are joined back to the fact keys."""
    dups = duplicate_keys(dim, dim_keys, name)
    cond = [fact[f] == dups[d] for f, d in zip(fact_keys, dim_keys)]
    fk = fact.select(*fact_keys).distinct()
    return fk.join(dups, cond, "inner").select(*[fk[f] for f in fact_keys], dups[name])


def assert_unique_key(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a key repeats (one small aggregate job, no collect of data)."""
    bad = duplicate_keys(df, keys).limit(5).collect()
    if bad:
        raise ValueError(f"key {list(keys)} is not unique, e.g. {[r.asDict() for r in bad]}")

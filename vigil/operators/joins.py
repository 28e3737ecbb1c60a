"""Joins (J1, J3, J4, F8).

No join here forces a broadcast: Catalyst and AQE broadcast a side by its
estimated or measured size, and otherwise shuffle (with skew splitting).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _private(dim: DataFrame, cols: Sequence[str], tag: str) -> tuple[DataFrame, dict[str, str]]:
    """The dimension's needed columns under private names: joins then refer
    to columns by name only, so a dimension that shares lineage with the
    fact side (a self-join in disguise) is never ambiguous."""
    names = {c: f"__{tag}_{c}" for c in dict.fromkeys(cols)}
    return dim.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), names


def _cond(left_keys: Sequence[str], right_names: Sequence[str], null_safe: bool) -> Column:
    out = None
    for a, b in zip(left_keys, right_names):
        left = F.col(f"`{a}`")
        e = left.eqNullSafe(F.col(b)) if null_safe else (left == F.col(b))
        out = e if out is None else out & e
    return out


NULL_PLACES = 64   # places that rows without a key are dealt to


def _null_place(keys: Sequence[Column], others: Sequence[Column]) -> Column:
    """0 for a row with all its keys, else a place picked by its other columns."""
    missing = keys[0].isNull()
    for k in keys[1:]:
        missing = missing | k.isNull()
    return F.when(missing, F.pmod(F.xxhash64(*others), F.lit(NULL_PLACES)) + 1).otherwise(F.lit(0).cast("bigint"))


def left_lookup(df: DataFrame, dim: DataFrame, left_key: str | Sequence[str], right_key: str | Sequence[str],
                keep: Sequence[str] | None = None, null_safe: bool = False) -> DataFrame:
    """Left join a dimension on differently named keys; the dimension's key
    columns are dropped, its ``keep`` columns appended.

    Rows whose key is NULL match nothing, and would all meet in one task where the dimension is too large to broadcast: a
    second join key, derived from their other columns, deals them to ``NULL_PLACES`` places."""
    lk = [left_key] if isinstance(left_key, str) else list(left_key)
    rk = [right_key] if isinstance(right_key, str) else list(right_key)
    keep = [c for c in (keep or dim.columns) if c not in rk]
    d, n = _private(dim, rk + keep, "lk")
    on = _cond(lk, [n[k] for k in rk], null_safe)
    left = df
    if not null_safe:
        hashable = [F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
        left = df.withColumn("__lk_place", _null_place([F.col(f"`{k}`") for k in lk], hashable))
        d = d.withColumn("__lk_zero", F.when(F.col(n[rk[0]]).isNull(), F.lit(-1)).otherwise(0).cast("bigint"))
        on = on & (F.col("__lk_place") == F.col("__lk_zero"))
    out = left.join(d, on, "left")
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *[F.col(n[c]).alias(c) for c in keep])


def right_lookup(measure: DataFrame, boundary: DataFrame, measure_key: str, boundary_key: str,
                 keep: Sequence[str] | None = None) -> DataFrame:
    """Right join: every boundary row is kept, measure columns NULL where no
    measure exists.  Output = boundary columns + ``keep`` measure columns."""
    keep = [c for c in (keep or measure.columns) if c != measure_key]
    m, n = _private(measure, [measure_key, *keep], "rl")
    out = m.join(boundary, F.col(n[measure_key]) == F.col(f"`{boundary_key}`"), "right")
    return out.select(*[F.col(f"`{c}`") for c in boundary.columns], *[F.col(n[c]).alias(c) for c in keep])


def anti_join(df: DataFrame, other: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str],
              null_safe: bool = False) -> DataFrame:
    o, n = _private(other, right_keys, "aj")
    return df.join(o, _cond(left_keys, [n[k] for k in right_keys], null_safe), "left_anti")


def exclude_pairs(df: DataFrame, exclusions: DataFrame, on: Sequence[str],
                  exclusion_cols: Sequence[str] | None = None) -> DataFrame:
    """Drop rows whose ``on`` values equal one of the exclusion rows (a literal
    table is a local relation, which Catalyst broadcasts by its size)."""
    return anti_join(df, exclusions, list(on), list(exclusion_cols or on))

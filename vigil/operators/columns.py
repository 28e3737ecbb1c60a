"""Column layout helpers (P4, P7, F4, F5).  Metadata-only except ``pull``."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def relocate(df: DataFrame, cols: str | Sequence[str], before: str | None = None,
             after: str | None = None) -> DataFrame:
    """Move ``cols`` before/after an anchor column (default: to the front)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    rest = [c for c in df.columns if c not in cols]
    if before is None and after is None:
        order = cols + rest
    else:
        anchor = before or after
        i = rest.index(anchor) + (0 if before else 1)
        order = rest[:i] + cols + rest[i:]
    return df.select(*order)


def apply_layout(df: DataFrame, moves: Sequence[tuple]) -> DataFrame:
    """A sequence of ``(cols, "before"|"after", anchor)`` relocations in ONE
    final select; moves whose columns or anchor are absent are skipped."""
    order = list(df.columns)
    for cols, where, anchor in moves:
        cols = [cols] if isinstance(cols, str) else list(cols)
        if anchor not in order or not all(c in order for c in cols) or anchor in cols:
            continue
        rest = [c for c in order if c not in cols]
        i = rest.index(anchor) + (0 if where == "before" else 1)
        order = rest[:i] + cols + rest[i:]
    return df.select(*order)


def pull(df: DataFrame, c: str) -> list:
    """A column as a driver list (what the operation is): for names of an
    administrative domain, such as counties.  Lists that grow with the data
    stay DataFrames and are joined."""
    return [r[0] for r in df.select(c).collect()]


def drop_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def count_missing(df: DataFrame, c: str) -> DataFrame:
    return df.agg(F.count_if(F.col(c).isNull()).alias("n_missing"))


# O1-O3 --------------------------------------------------------------------------
def arrange(df: DataFrame, *cols: str, desc: bool = False) -> DataFrame:
    """Sort with the reference's NULL placement: ascending puts NULL last,
    descending (``rev=true``) puts NULL first."""
    order = [F.desc_nulls_first(c) if desc else F.asc_nulls_last(c) for c in cols]
    return df.orderBy(*order)


def sort_all(df: DataFrame) -> DataFrame:
    """Bare ``sort(df)``: by every column, left to right."""
    return arrange(df, *df.columns)

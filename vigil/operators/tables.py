"""Report tables: shares, change, Pareto, quantile bins, pivots, outcome and
conditional tables (W2-W7, V1-V8, T14-T15).

Report tables are built from AGGREGATES.  Where a table's row count is
bounded by a categorical domain (years, call types, outcome levels, pivot
rows), whole-table windows run on that small aggregate -- one tiny partition
after the big distributed aggregation.  Where the row count grows with the
data (per-customer, per-place counts), totals are scalar subqueries instead.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions import rules as R
from vigil.functions.strings import ColumnOrName, col, n_pct_label, pct_fixed
from vigil.operators.aggregate import grand_total, lump_small
from vigil.operators.impute import count_quantiles



def _whole():
    """Window over a whole table -- only ever applied to category-bounded
    aggregates (see module docstring)."""
    return Window.partitionBy()


# W4 / W5 ----------------------------------------------------------------------
def share(df: DataFrame, n: str = "n", name: str = "percent", by: Sequence[str] | None = None, bounded: bool = False) -> DataFrame:
    """Share of the grand total (or of the ``by`` partition).  The total is a
    scalar subquery, so no single task ever holds a data-sized table.  For an aggregate
    ``bounded`` by a category domain it is a window instead, and the plan below is there once."""
    if bounded:
        return df.withColumn(name, F.try_divide(F.col(n), F.sum(n).over(_whole())))
    if by:
        return df.withColumn(name, F.try_divide(F.col(n), F.sum(n).over(Window.partitionBy(*by))))
    return df.withColumn(name, F.try_divide(F.col(n), grand_total(df, n)))


# W2 / W3 ----------------------------------------------------------------------
def lag_change(df: DataFrame, order_col: str, value: str, change: str = "change",
               pct: str = "pct_change", base: str = "current",
               partition_by: Sequence[str] | None = None) -> DataFrame:
    """``change = x - lag(x)``; ``pct = change / x * 100`` (``base="current"``,
    as coded) or ``change / lag(x) * 100`` (``base="previous"``)."""
    w = (Window.partitionBy(*partition_by) if partition_by else _whole()).orderBy(F.asc_nulls_last(order_col))
    prev = F.lag(value).over(w)
    ch = F.col(value) - prev
    denom = F.col(value) if base == "current" else prev
    return df.withColumns({change: ch, pct: F.try_divide(ch, denom) * 100})


def pct_change(df: DataFrame, order_col: str, value: str, base: str = "current", name: str = "pct_change") -> DataFrame:
    """W3 alone: percent change against the current (as coded) or previous value."""
    return lag_change(df, order_col, value, change="__change", pct=name, base=base).drop("__change")


# W6 / A14 ---------------------------------------------------------------------
def pareto(df: DataFrame, cat: str, n: str = "count", lump_below: int | None = None,
           other: str = "Other", pct: str = "percent", cum: str = "cumpercent") -> DataFrame:
    """Category counts (optionally lumped) with share and cumulative share in
    ascending-count order; the lumped group sorts at the position of its
    smallest member, i.e. first.  Ties are broken by category name."""
    g = lump_small(df, cat, n, lump_below, other) if lump_below is not None else df.withColumn("__first", F.col(n))
    # running sum in two steps: over the distinct counts (with N rows behind the table there are at
    # most about sqrt(2 N) of them), then among the categories of one count
    before = Window.orderBy("__first").rowsBetween(Window.unboundedPreceding, -1)
    steps = (g.groupBy("__first").agg(F.sum(n).alias("__step"))
             .select(F.col("__first").alias("__f"), F.coalesce(F.sum("__step").over(before), F.lit(0)).alias("__before")))
    within = Window.partitionBy("__first").orderBy(cat).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = grand_total(df, n)
    return (g.join(steps, F.col("__first") == F.col("__f"))
            .withColumns({pct: F.try_divide(F.col(n), total), cum: F.try_divide(F.col("__before") + F.sum(n).over(within), total)})
            .drop("__first", "__f", "__before"))


# W7 ---------------------------------------------------------------------------
def quantile_bin(df: DataFrame, n: str = "n", bins=None, top=None,
                 code: str = "quantiles", label: str = "quantile_labels") -> DataFrame:
    """Size bins from exact quantiles of the group sizes ``n``: ``n <= q(0.8) -> 10``,
    ``n < q(0.9) -> 15``, ``n < q(0.99) -> 20``, else 25, with fixed labels.
    The three quantiles come from ONE scalar subquery over the histogram of ``n``, which plans ``df`` once
    more: a caller with a long plan below hands in a stored table."""
    bins = bins or R.QUANTILE_BINS
    top = top or R.QUANTILE_TOP
    qs = count_quantiles(df, n, [b[0] for b in bins]).scalar()
    x = F.col(n)
    c = None
    for i, (_, op, code_v, _lab) in enumerate(bins):
        q = F.element_at(qs, i + 1)
        cond = x <= q if op == "<=" else x < q
        c = F.when(cond, F.lit(code_v)) if c is None else c.when(cond, F.lit(code_v))
    c = c.otherwise(F.lit(top[0]))
    lab = None
    for (_, _, code_v, lab_v) in bins:
        lab = F.when(F.col(code) == code_v, F.lit(lab_v)) if lab is None else lab.when(F.col(code) == code_v, F.lit(lab_v))
    lab = lab.otherwise(F.lit(top[1]))
    return df.withColumn(code, c).withColumn(label, lab)


# V1 / V2 ----------------------------------------------------------------------
def pivot_counts(df: DataFrame, index: Sequence[ColumnOrName], names_from: str, levels: Sequence,
                 names: Mapping | None = None, weight: str | None = None) -> DataFrame:
    """Counts per (index, level) spread wide; ALWAYS with explicit levels (fixed
    schema, no extra job to discover them).  An absent cell is NULL.
    ``weight`` sums a count column of pre-aggregated rows instead."""
    agg = F.sum(weight) if weight else F.count(F.lit(1))
    p = df.groupBy(*index).pivot(names_from, list(levels)).agg(agg)
    if names:
        p = p.withColumnsRenamed({str(k).lower() if isinstance(k, bool) else str(k): v
                                  for k, v in names.items()})
    return p


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], variable: str = "variable",
            value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(values), variable, value)


# V3 / V8 ----------------------------------------------------------------------
def outcome_table(df: DataFrame, by: Sequence[ColumnOrName], outcome: str,
                  levels: Sequence[str] = ("Deceased", "Survived"),
                  total_of: Sequence[str] = ("Deceased", "Survived"), total: str = "Total",
                  pct: Mapping[str, str] | None = None, fill: Sequence[str] = (),
                  gap: str | None = None, weight: str | None = None) -> DataFrame:
    """Pivot of outcome counts + a total + per-outcome shares of that total.
    A missing cell leaves the total NULL unless the level is in ``fill``
    (filled with 0).  ``gap`` adds ``abs(first pct - second pct)``; ``weight`` sums a count
    column of pre-aggregated rows."""
    p = pivot_counts(df, by, outcome, levels, weight=weight)
    if fill:
        p = p.fillna(0, subset=list(fill))
    tot = None
    for c in total_of:
        tot = F.col(c) if tot is None else tot + F.col(c)
    p = p.withColumn(total, tot)
    pct = pct if pct is not None else {f"Pct_{lv}": lv for lv in ("Survived", "Deceased")}
    p = p.withColumns({name: F.try_divide(F.col(lv), F.col(total)) for name, lv in pct.items()})
    if gap:
        a, b = list(pct)[:2]
        p = p.withColumn(gap, F.abs(F.col(a) - F.col(b)))
    return p


# V4 ---------------------------------------------------------------------------
def two_way_table(df: DataFrame, row: str, column: str, levels: Sequence = (True, False),
                  names: Sequence[str] = ("true", "false"), total: str = "total",
                  total_label: str = "total", fill: str | None = None, weight: str | None = None) -> DataFrame:
    """Cross-tab with a row total ``"n (p%)"`` per row and a total row whose
    cells are ``"n (p%)"`` of all rows; every cell is text (mixed column).
    Totals count rows, so a cell without rows adds nothing; it shows as
    ``fill`` (NULL by default, as coded).  ``weight`` sums a count column of pre-aggregated rows."""
    a, b = names
    n = F.col(weight) if weight else F.lit(1).cast("bigint")
    cell = lambda level, name: F.coalesce(F.sum(F.when(F.col(column) == F.lit(level), n)), F.lit(0).cast("bigint")).alias(name)
    p = df.groupBy(row).agg(*[cell(lv, n) for lv, n in zip(levels, names)]).withColumn("__tot", F.col(a) + F.col(b)).where("__tot > 0")
    shown = lambda c: F.when(F.col(c) > 0, F.col(c).cast("string")).otherwise(F.lit(fill)).alias(c)
    body = p.select(F.col(row).cast("string").alias(row), shown(a), shown(b),
                    n_pct_label("__tot", F.try_divide(F.col("__tot"), F.sum("__tot").over(_whole()))).alias(total))
    sums = p.agg(F.sum(a).alias("sa"), F.sum(b).alias("sb"), F.sum("__tot").alias("sn"))
    tot = sums.select(F.lit(total_label).alias(row),
                      n_pct_label("sa", F.try_divide(F.col("sa"), F.col("sn"))).alias(a),
                      n_pct_label("sb", F.try_divide(F.col("sb"), F.col("sn"))).alias(b),
                      F.col("sn").cast("string").alias(total))
    return body.unionByName(tot)


# V5 / V6 ----------------------------------------------------------------------
def conditional_table(df: DataFrame, row: str, column: str, given: str = "row",
                      levels: Sequence = (True, False), names: Sequence[str] = ("true", "false"),
                      out_names: Sequence[str] = ("true_bcpr", "false_bcpr"),
                      as_coded: bool = False, weight: str | None = None) -> DataFrame:
    """Conditional shares as ``"n (p%)"`` text.  ``given="row"``: cell / row
    sum.  ``given="col"``: cell / column sum (``as_coded=True`` divides both
    columns by the first column's sum, as the reference does)."""
    p = pivot_counts(df, [row], column, levels, dict(zip(levels, names)), weight)
    a, b = names
    if given == "row":
        da = db = F.col(a) + F.col(b)
    elif given == "col":
        da = F.sum(a).over(_whole())
        db = da if as_coded else F.sum(b).over(_whole())
    else:
        raise ValueError(given)
    return p.select(F.col(row),
                    n_pct_label(a, F.try_divide(F.col(a), da)).alias(out_names[0]),
                    n_pct_label(b, F.try_divide(F.col(b), db)).alias(out_names[1]))


# V7 ---------------------------------------------------------------------------
def recode(c: ColumnOrName, mapping: Mapping[str, str], missing: str = "Unknown",
           other: str = "Unknown") -> Column:
    x = col(c)
    out = F.when(x.isNull(), F.lit(missing))
    for k, v in mapping.items():
        out = out.when(x == k, F.lit(v))
    return out.otherwise(F.lit(other))


def outcome_by_recode(df: DataFrame, group: str, outcome: str, mapping: Mapping[str, str],
                      label: str = "Sex", missing: str = "Unknown", other: str = "Unknown",
                      fill: Sequence[str] = ("Deceased",), weight: str | None = None) -> DataFrame:
    """Outcome by a recoded category (recoded BEFORE counting, so NULL and
    unmapped codes merge into one row), with text shares within the group and
    of the grand total."""
    x = df.withColumn(label, recode(group, mapping, missing, other))
    p = pivot_counts(x, [label], outcome, ["Survived", "Deceased"], weight=weight).fillna(0, subset=list(fill))
    s, d = F.col("Survived"), F.col("Deceased")
    overall = F.sum("Survived").over(_whole()) + F.sum("Deceased").over(_whole())
    return p.select(F.col(label), s, d, (d + s).alias("Total"),
                    pct_fixed(F.try_divide(s, s + d)).alias(f"Percent_Survived_By_{label}"),
                    pct_fixed(F.try_divide(s, overall)).alias("Percent_Survived_Overall"))

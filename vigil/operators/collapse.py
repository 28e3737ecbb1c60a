"""String aggregation and one-to-many collapse.

The reference joins each run's procedure and medication rows into ``", "``
separated text in ROW ORDER.  Spark rows have no order, so every side takes an
explicit order; each side's distinct sub-rows are gathered with
``collect_set(struct(order..., value...))`` (partial aggregation dedups
map-side), sorted with ``sort_array`` and joined with ``array_join``.

All sides group on the same key, so they are computed in ONE ``groupBy`` (one
shuffle) and joined to the base on that key; the aggregate's output is already
hash-partitioned by the key, so only the base side is exchanged for the join.
The joined text of one key is inherently one value: a key's group is held in
one task by construction of the result, never a category-level group.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.strings import safe_match
from vigil.operators.dedup import keep_first

SEP = ", "


@dataclass
class Side:
    """One one-to-many side: the distinct sub-rows over ``columns`` (order
    columns first), and for each output ``{out: (column, "all"|"distinct")}``.
    ``"all"`` joins every sub-row's value in order, ``"distinct"`` the values
    in order of first appearance."""
    columns: Sequence[str]
    outputs: Mapping[str, tuple[str, str]]
    order: Sequence[str] = field(default_factory=list)


def _field_text(arr: Column, name: str, missing_token: str | None) -> Column:
    vals = F.transform(arr, lambda s: s[name].cast("string"))
    if missing_token is not None:
        vals = F.transform(vals, lambda v: F.coalesce(v, F.lit(missing_token)))
    return vals


def side_aggregates(side: Side, alias: str) -> Column:
    """Distinct sub-rows as structs whose fields are the side's columns, order
    columns first (``sort_array`` then sorts by them)."""
    order = list(side.order) or list(side.columns)
    rest = [c for c in side.columns if c not in order]
    # sort_array (codegen'd comparator) orders the structs field by field; the
    # structs themselves are never NULL, so NULL placement of elements is moot
    return F.sort_array(F.collect_set(F.struct(*[F.col(c) for c in order + rest]))).alias(alias)


def side_outputs(side: Side, alias: str, missing_token: str | None = None, sep: str = SEP) -> dict[str, Column]:
    arr = F.col(alias)
    out = {}
    for name, (c, mode) in side.outputs.items():
        vals = _field_text(arr, c, missing_token)
        if mode == "distinct":
            vals = F.array_distinct(vals)
        elif mode != "all":
            raise ValueError(mode)
        # no non-missing value at all -> NULL (nothing recorded), not ""
        present = F.size(F.filter(vals, lambda v: v.isNotNull())) > 0
        out[name] = F.when(present, F.array_join(vals, sep))
    return out


def join_strings(rows: DataFrame, key: Sequence[str], side: Side, missing_token: str | None = None,
                 sep: str = SEP) -> DataFrame:
    """One row per key with the side's joined text columns."""
    g = rows.groupBy(*key).agg(side_aggregates(side, "__side"))
    return g.select(*key, *[v.alias(k) for k, v in side_outputs(side, "__side", missing_token, sep).items()])


def collapse_one_to_many(base: DataFrame, key: str, base_order: Sequence | None, rows: DataFrame,
                         sides: Sequence[Side], extra_aggs: Mapping[str, Column] | None = None,
                         missing_token: str | None = None, sep: str = SEP) -> DataFrame:
    """One row per ``key`` (A7): keep-first of the base (when ``base_order`` is
    given; pass None for an already unique base), plus every side's joined
    text and ``extra_aggs``, computed in one aggregation over ``rows`` and
    left-joined back (J2)."""
    b = keep_first(base, [key], base_order) if base_order else base
    aggs = [side_aggregates(s, f"__side{i}") for i, s in enumerate(sides)]
    aggs += [e.alias(n) for n, e in (extra_aggs or {}).items()]
    g = rows.groupBy(key).agg(*aggs)
    outs = {}
    for i, s in enumerate(sides):
        outs.update(side_outputs(s, f"__side{i}", missing_token, sep))
    g = g.select(key, *[v.alias(k) for k, v in outs.items()], *list(extra_aggs or {}))
    drop = [c for c in b.columns if c in outs or c in (extra_aggs or {})]
    return b.drop(*drop).join(g, on=key, how="left")


def first_row(columns: Sequence[str], order: Sequence[str]) -> Column:
    """The first row's ``columns`` under ``order`` (NULLs last) as an aggregate:
    the smallest struct of the order columns and then all others, so the order is
    total and each map task forwards one row per key."""
    rest = [c for c in columns if c not in order]
    ordered = [x for c in order for x in (F.col(c).isNull().alias(f"__null_{c}"), F.col(c))]
    return F.min(F.struct(*ordered, *[F.col(c) for c in rest]))


def collapse_rows(rows: DataFrame, key: str, base_order: Sequence[str], sides: Sequence[Side],
                  extra_aggs: Mapping[str, Column] | None = None, missing_token: str | None = None,
                  sep: str = SEP) -> DataFrame:
    """A7 where base and sides are the same rows: keep-first, every side's text
    and ``extra_aggs`` in ONE aggregation (one shuffle, no window, no join).
    Output: the rows' columns, those named by a side replaced by its text,
    and the extra aggregates."""
    columns = [c for c in rows.columns if c != key]
    g = rows.groupBy(key).agg(first_row(columns, base_order).alias("__first"),
                              *[side_aggregates(s, f"__side{i}") for i, s in enumerate(sides)],
                              *[e.alias(n) for n, e in (extra_aggs or {}).items()])
    outs: dict[str, Column] = {}
    for i, s in enumerate(sides):
        outs.update(side_outputs(s, f"__side{i}", missing_token, sep))
    kept = [c for c in columns if c not in outs]
    return g.select(key, *[F.col("__first")[c].alias(c) for c in kept], *[v.alias(k) for k, v in outs.items()], *(extra_aggs or {}))


def shock_rows(description: str, performed_at: str, attempts: str, pattern: str) -> Column:
    """The distinct defibrillation rows of a group, as an aggregate (for ``shock_count``)."""
    hit = safe_match(F.coalesce(F.col(description), F.lit("")), pattern, True)
    return F.collect_set(F.when(hit, F.struct(F.col(description).alias("d"), F.col(performed_at).alias("t"), F.col(attempts).alias("a"))))


def shock_count(rows: Column) -> Column:
    """X4's number of shocks: attempts of the distinct rows, a missing number counting 1; NULL without rows."""
    return F.when(F.size(rows) > 0, F.aggregate(rows, F.lit(0).cast("bigint"), lambda acc, r: acc + F.coalesce(r["a"], F.lit(1)).cast("bigint")))


def defibrillation_summary(rows: DataFrame, key: str, description: str, performed_at: str,
                           attempts: str, pattern: str, order: Sequence[str] | None = None,
                           shocks: str = "shocks", sep: str = SEP) -> DataFrame:
    """Rows whose procedure matches ``pattern`` (case-insensitive) ->
    distinct (key, description, time, attempts) -> missing text "" and
    missing attempts 1 -> per key: ``shocks = sum(attempts)`` and the three
    columns joined in ``order``."""
    d = (rows.select(key, description, performed_at, attempts)
         .filter(safe_match(F.coalesce(F.col(description), F.lit("")), pattern, True))
         .distinct()
         .withColumns({description: F.coalesce(F.col(description), F.lit("")),
                       performed_at: F.coalesce(F.col(performed_at).cast("string"), F.lit("")),
                       attempts: F.coalesce(F.col(attempts), F.lit(1))}))
    order = list(order or [performed_at, description, attempts])
    s = F.sort_array(F.collect_list(F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)],
                                             F.col(description).alias("d"), F.col(performed_at).alias("t"),
                                             F.col(attempts).alias("a"))))
    g = d.groupBy(key).agg(F.sum(attempts).alias(shocks), s.alias("__s"))
    return g.select(key, shocks,
                    F.array_join(F.transform("__s", lambda x: x["d"]), sep).alias(description),
                    F.array_join(F.transform("__s", lambda x: x["t"]), sep).alias(performed_at),
                    F.array_join(F.transform("__s", lambda x: x["a"].cast("string")), sep).alias(attempts))

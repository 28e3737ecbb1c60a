"""Date / time Column functions.

Time of day is carried as BIGINT microseconds since midnight (Spark's TIME
type is off by default and errors on overflow, while clock arithmetic must
wrap).  Timestamps are TIMESTAMP_NTZ (no zone), like the reference's DateTime.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil.functions.strings import ColumnOrName, bind, col

US_PER_SECOND = 1_000_000
US_PER_MINUTE = 60 * US_PER_SECOND
US_PER_DAY = 86_400 * US_PER_SECOND


def day_start(ts: ColumnOrName) -> Column:
    """Midnight of the timestamp's date, as TIMESTAMP_NTZ (zone independent)."""
    return col(ts).cast("date").cast("timestamp_ntz")


def time_of_day(ts: ColumnOrName) -> Column:
    """Microseconds since midnight of a timestamp."""
    return F.timestamp_diff("MICROSECOND", day_start(ts), col(ts).cast("timestamp_ntz"))


def clock(h: int, m: int = 0, s: int = 0, us: int = 0) -> Column:
    return F.lit(((h * 60 + m) * 60 + s) * US_PER_SECOND + us)


# D1 ---------------------------------------------------------------------------
def combine_date_time(d: ColumnOrName, tod_us: ColumnOrName) -> Column:
    """Date + time of day -> TIMESTAMP_NTZ; NULL if either is NULL."""
    return F.timestamp_add("MICROSECOND", col(tod_us), day_start(d))


# D2 ---------------------------------------------------------------------------
def correct_midnight_rollover(t1: ColumnOrName, t2: ColumnOrName, granularity: str = "hour") -> Column:
    """Move ``t2`` one day later when it is earlier on the clock than ``t1``.

    ``granularity="hour"`` compares hours only, as coded (23:50 -> 23:10 is
    not repaired); ``"micros"`` compares the full time of day."""
    a, b = col(t1), col(t2)
    if granularity == "hour":
        later = F.hour(a) > F.hour(b)
    elif granularity == "micros":
        later = time_of_day(a) > time_of_day(b)
    else:
        raise ValueError(granularity)
    cond = a.isNotNull() & b.isNotNull() & later
    return F.when(cond, F.timestamp_add("DAY", F.lit(1), b)).otherwise(b)


# D3 ---------------------------------------------------------------------------
def add_time_of_day(target_us: ColumnOrName, duration_us: ColumnOrName, missing: str = "null") -> Column:
    """Clock time + the whole hours/minutes/seconds of a duration, mod 24 h.

    ``missing="zero"`` treats a missing input as 00:00:00 (as coded, which
    turns a missing AED-on time into a bogus clock time); the default gives
    NULL when either input is missing."""
    t, d = col(target_us), col(duration_us)
    if missing == "zero":
        t, d = F.coalesce(t, F.lit(0)), F.coalesce(d, F.lit(0))
    elif missing != "null":
        raise ValueError(missing)
    whole = d - F.pmod(d, F.lit(US_PER_SECOND))
    return F.pmod(t + whole, F.lit(US_PER_DAY))


# D4 ---------------------------------------------------------------------------
def null_if_equal(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``b``, or NULL when it equals ``a`` (a zero-length use means unknown)."""
    return F.when(F.coalesce(col(a) == col(b), F.lit(False)), F.lit(None)).otherwise(col(b))


# D5 / D6 ----------------------------------------------------------------------
def minutes_between(end: ColumnOrName, start: ColumnOrName) -> Column:
    """Fractional minutes ``end - start`` (sign kept, exact microseconds)."""
    return F.timestamp_diff("MICROSECOND", col(start), col(end)) / float(US_PER_MINUTE)


def interval_columns(spec: dict[str, tuple[str, str]]) -> dict[str, Column]:
    """``{name: (start, end)}`` -> ``{name: minutes_between(end, start)}`` for
    one ``withColumns`` block."""
    return {name: minutes_between(end, start) for name, (start, end) in spec.items()}


def intervals(df, spec: dict[str, tuple[str, str]]):
    """D6 as a DataFrame operator: add every ``{name: (start, end)}`` interval
    in minutes in one ``withColumns`` block."""
    return df.withColumns(interval_columns(spec))


# D7 ---------------------------------------------------------------------------
def _year(y: Column) -> Column:
    """Four digits, or two digits of this century."""
    return y.cast("int") + F.when(F.length(y) == 2, 2000).otherwise(0)


def parse_mdy(c: ColumnOrName) -> Column:
    """``m/d/yyyy`` or ``m/d/yy`` text -> DATE; other text and impossible dates -> NULL.
    One pattern gates the text, which is split once a cell."""
    s = F.trim(col(c))
    parts = F.when(s.rlike(r"^\d{1,2}/\d{1,2}/(\d{4}|\d{2})$"), F.split(s, "/"))

    def build(p: Column) -> Column:
        return F.try_make_timestamp_ntz(_year(F.get(p, F.lit(2))), F.get(p, F.lit(0)).cast("int"), F.get(p, F.lit(1)).cast("int"), F.lit(0), F.lit(0), F.lit(0)).cast("date")
    return bind(parts, build)


def parse_mdy_hms(c: ColumnOrName) -> Column:
    """``m/d/yyyy h:mm[:ss][ AM|PM]`` text -> TIMESTAMP_NTZ; other text and
    impossible times -> NULL.  One pattern gates the text, which is split once a
    cell, and the wall-clock time is built without passing through a time zone."""
    s = F.trim(col(c))
    parts = F.when(s.rlike(r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}(:\d{2})?( [AaPp][Mm])?$"), F.split(s, "[/: ]"))

    def build(p: Column) -> Column:
        part = lambda k: F.get(p, F.lit(k)).cast("int")
        # month, day, year, hour, minute, then second and half of the day where they are written
        n = F.size(p)
        half = F.upper(F.get(p, n - 1))
        halved = half.isin("AM", "PM")
        hour = F.when(~halved, part(3)).when(part(3).between(1, 12), part(3) % 12 + F.when(half == "PM", 12).otherwise(0))   # else no such hour: NULL
        second = F.when(n - F.when(halved, 1).otherwise(0) == 6, part(5)).otherwise(0)
        return F.try_make_timestamp_ntz(part(2), part(0), part(1), hour, part(4), second)
    return bind(parts, build)


# D8 / D9 / D10 ----------------------------------------------------------------
def day_name(d: ColumnOrName) -> Column:
    return F.date_format(col(d), "EEEE")


def month_name(d: ColumnOrName) -> Column:
    return F.date_format(col(d), "MMMM")


def is_weekend(d: ColumnOrName) -> Column:
    return F.dayofweek(col(d)).isin(1, 7)


def season(d: ColumnOrName) -> Column:
    """Meteorological season; a missing date gives NULL (not "Fall")."""
    m = F.month(col(d))
    return (F.when(m.isNull(), F.lit(None))
            .when(m.isin(12, 1, 2), "Winter")
            .when(m.isin(3, 4, 5), "Spring")
            .when(m.isin(6, 7, 8), "Summer")
            .otherwise("Fall"))


# D11 --------------------------------------------------------------------------
def fiscal_year(d: ColumnOrName, start_month: int = 5, first_fy: int = 2022, last_fy: int = 2027,
                unknown: str = "Unknown", prefix: str = "FY") -> Column:
    """Fiscal year labelled by its ending year (FY2022 = 2021-05-01..2022-04-30).
    Dates before the first year, and NULL, give ``unknown``; every date from
    the start of ``last_fy`` on is capped to ``last_fy``."""
    x = col(d).cast("date")
    fy = F.year(x) + F.when(F.month(x) >= start_month, 1).otherwise(0)
    if start_month == 1:
        fy = F.year(x)
    return (F.when(x.isNull() | (fy < first_fy), F.lit(unknown))
            .when(fy >= last_fy, F.lit(f"{prefix}{last_fy}"))
            .otherwise(F.concat(F.lit(prefix), fy.cast("string"))))

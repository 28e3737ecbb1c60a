"""Missing-value, conditional and clinical-indicator Column functions.

Each function builds the evident intent by default; where the reference's
code does something else (operator precedence, dead branches, missing printed
as text) a keyword reproduces the as-coded behaviour.
"""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil.functions import rules as R
from vigil.functions.strings import ColumnOrName, col, flagged, pad_left, safe_match, text_length, to_text


# M1 ---------------------------------------------------------------------------
def default(c: ColumnOrName, value) -> Column:
    return F.coalesce(col(c), value if isinstance(value, Column) else F.lit(value))


# M4 ---------------------------------------------------------------------------
AGE_UNIT_DIVISORS = {"Days": 365.25, "Months": 12.0, "Weeks": 52.1786}
EXTRA_AGE_UNIT_DIVISORS = {"Hours": 24 * 365.25, "Minutes": 60 * 24 * 365.25}


def age_in_years(age: ColumnOrName, unit: ColumnOrName, extra_units: bool = False) -> Column:
    """Days/365.25, Months/12, Weeks/52.1786, anything else unchanged.  Hours
    and Minutes fall through as years unless ``extra_units=True``."""
    a, u = col(age), col(unit)
    divisors = dict(AGE_UNIT_DIVISORS)
    if extra_units:
        divisors.update(EXTRA_AGE_UNIT_DIVISORS)
    out = None
    for name, div in divisors.items():
        out = F.when(u == name, a / div) if out is None else out.when(u == name, a / div)
    return out.otherwise(a.cast("double"))


# M5 ---------------------------------------------------------------------------
def age_band(years: ColumnOrName, width: int = 5, top: int = 85) -> Column:
    """Upper-inclusive bands ``00-04``, ``05-09`` ... and ``{top}+``; a
    fractional age belongs to the band whose upper bound it does not exceed
    (4.5 -> ``05-09``).  Missing stays missing."""
    y = col(years)
    out = F.when(y.isNull(), F.lit(None))
    for lo in range(0, top, width):
        hi = lo + width - 1
        out = out.when(y <= hi, F.lit(f"{lo:02d}-{hi:02d}"))
    return out.otherwise(F.lit(f"{top}+"))


# M6 ---------------------------------------------------------------------------
def utstein(bystander: ColumnOrName, witnessed: ColumnOrName, shocks: ColumnOrName,
            as_coded: bool = False) -> Column:
    """Bystander CPR, witnessed and shocked.  ``as_coded=True`` gives what the
    reference's precedence computes: bystander and witnessed and an ODD shock
    count."""
    b, w, s = col(bystander), col(witnessed), col(shocks)
    if as_coded:
        return (b == F.lit(True)) & (w == F.lit(True)) & (F.pmod(s, F.lit(2)) == 1)
    return (b == F.lit(True)) & (w == F.lit(True)) & (s > 0)


# M7 ---------------------------------------------------------------------------
def call_type(cardiac: ColumnOrName, overdose: ColumnOrName, other_case: ColumnOrName) -> dict[str, Column]:
    """Precedence Cardiac Arrest > Overdose > Other Cause > Unknown; an other
    cause is suppressed when the case is cardiac.  Returns the successive
    ``withColumns`` blocks as one dict of final expressions."""
    c = F.coalesce(col(cardiac), F.lit(False))
    o = F.coalesce(col(overdose), F.lit(False))
    other = col(other_case).isNotNull() & ~c
    ct = (F.when(c, "Cardiac Arrest").when(o, "Overdose").when(other, "Other Cause")
          .otherwise("Unknown"))
    return {"cardiac_episode": c, "od_case": o, "other_case_binary": other, "call_type": ct}


# M8 ---------------------------------------------------------------------------
def survival_from_flags(*flags: ColumnOrName) -> Column:
    """Any expired flag -> "Deceased", else "Survived" (flags default false)."""
    any_dead = None
    for f in flags:
        x = F.coalesce(col(f), F.lit(False))
        any_dead = x if any_dead is None else (any_dead | x)
    return F.when(any_dead, "Deceased").otherwise("Survived")


# M9 ---------------------------------------------------------------------------
def repair_outcome(outcome: ColumnOrName, disposition: ColumnOrName) -> Column:
    """Missing outcome, or "not applicable/recorded" with a dead disposition ->
    "Expired in the Field" (AND binds tighter than OR: a missing outcome is
    repaired whatever the disposition)."""
    o = col(outcome)
    cond = o.isNull() | (safe_match(o, R.OUTCOME_NA_PATTERN, True)
                         & safe_match(disposition, R.DISPOSITION_DEAD_PATTERN, True))
    return F.when(cond, F.lit(R.OUTCOME_REPAIRED)).otherwise(o)


# M10 --------------------------------------------------------------------------
def outcome_flags(outcome: ColumnOrName) -> dict[str, Column]:
    """Six substring flags plus ``survival = outcome does not mention expire``."""
    out = {name: safe_match(outcome, pat, True) for name, pat in R.OUTCOME_FLAG_PATTERNS.items()}
    out["survival"] = ~col(outcome).rlike(flagged(R.EXPIRE_PATTERN, True))
    return out


# M11 --------------------------------------------------------------------------
def cpr_prior_to_arrival(cpr: ColumnOrName, who_provided: ColumnOrName) -> Column:
    """Effective rule of the reference: "yes" when a provider is listed,
    otherwise the recorded value or "Not Recorded"."""
    return F.when(col(who_provided).isNotNull(), F.lit("yes")).otherwise(
        F.coalesce(col(cpr), F.lit(R.NOT_RECORDED)))


# M12 --------------------------------------------------------------------------
def witnessed_from_text(witnessed_by: ColumnOrName) -> Column:
    """Witnessed unless the text mentions "not" (missing text -> witnessed)."""
    return ~safe_match(witnessed_by, R.NOT_WITNESSED_PATTERN, True)


# M13 --------------------------------------------------------------------------
def county_id(county_code: ColumnOrName, width: int = 3) -> Column:
    """County code padded to 3 digits; empty/missing -> NULL; longer kept."""
    s = to_text(county_code)
    n = text_length(F.coalesce(s, F.lit("")))
    return F.when(n == 0, F.lit(None)).when(n < width, pad_left(s, width)).otherwise(s)


def county_fips(state_code: ColumnOrName, county_code: ColumnOrName,
                missing_token: str | None = None) -> Column:
    """State code + padded county id.  Default NULL when either part is
    missing; ``missing_token="missing"`` gives the as-coded ``"19missing"``."""
    return F.concat(to_text(state_code, missing_token), to_text(county_id(county_code), missing_token))


# J7 ---------------------------------------------------------------------------
def code_map(c: ColumnOrName, mapping: Mapping, default=None) -> Column:
    """Category -> code through a literal CASE chain (small fixed maps; use a
    broadcast join for large ones).  Unmapped values give ``default``."""
    x = col(c)
    out = None
    for k, v in mapping.items():
        out = F.when(x == F.lit(k), F.lit(v)) if out is None else out.when(x == F.lit(k), F.lit(v))
    return out.otherwise(F.lit(default))

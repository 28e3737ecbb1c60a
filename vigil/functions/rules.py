"""Ordered rule tables (T13): the first rule whose pattern matches decides.

``apply_rules`` folds a rule list into one ``CASE WHEN`` chain, which Catalyst
evaluates row by row in generated code.  NULL input never matches a rule
(falls through to the default), as in the reference's ``case_when``.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil.functions.strings import ColumnOrName, col, flagged

Rule = tuple  # (pattern, value) or (pattern, value, ignore_case)


def apply_rules(c: ColumnOrName, rules: Sequence[Rule], default: Column | str | None = None,
                null_safe: bool = True) -> Column:
    """First matching regex wins; ``default`` (a Column, literal or NULL)
    otherwise.  ``value`` may be a literal or a Column."""
    x = col(c)
    out = None
    for rule in rules:
        pattern, value = rule[0], rule[1]
        ignore_case = rule[2] if len(rule) > 2 else False
        cond = x.rlike(flagged(pattern, ignore_case))
        if null_safe:
            cond = F.coalesce(cond, F.lit(False))
        v = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    d = default if isinstance(default, Column) else F.lit(default)
    return d if out is None else out.otherwise(d)


def rewrite_whole(c: ColumnOrName, pattern: str, value: str, ignore_case: bool = False) -> Column:
    """``value`` when ``pattern`` occurs anywhere in the text, else the text --
    as ONE ``regexp_replace`` (the input expression is referenced once, so a
    long chain of such steps does not duplicate its sub-expressions)."""
    flags = "(?ius)" if ignore_case else "(?s)"
    rep = value.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(col(c), f"{flags}^.*(?:{pattern}).*$", rep)


def chain_is_first_match(rules: Sequence[Rule]) -> bool:
    """True when no rule's value is matched by a LATER rule's pattern: then
    applying the rules one after another as whole-text rewrites gives the
    first-match-wins result."""
    import re
    for i, rule in enumerate(rules):
        for later in rules[i + 1:]:
            flags = re.I if (len(later) > 2 and later[2]) else 0
            if re.search(later[0], str(rule[1]), flags):
                return False
    return True


def apply_rules_chained(c: ColumnOrName, rules: Sequence[Rule]) -> Column:
    """First-match-wins rule table with the text itself as the default, built
    as successive whole-text rewrites (no sub-expression duplication).  Falls
    back to ``apply_rules`` when the chaining condition does not hold."""
    if not chain_is_first_match(rules):
        return apply_rules(c, rules, default=col(c))
    x = col(c)
    for rule in rules:
        x = rewrite_whole(x, rule[0], rule[1], len(rule) > 2 and rule[2])
    return x


# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# ---------------------------------------------------------------------------

# Agency type: case-sensitive patterns, first match wins, default "Unknown".
# "S0" (zero) is a deliberate alias of "SO".
AGENCY_TYPE_RULES: list[Rule] = [
    (r"ISP", "ISP"),
    (r"PD|West Des Moines", "PD"),
    (r"SO|S0", "SO"),
    (r"Cons", "Cons"),
    (r"IDNR\s(-\s)?Parks|Iowa DNR|Iowa Parks", "IDNR Parks"),
    (r"IDOT|MVE", "IDOT MVE"),
    (r"Fair", "Fairground LE"),
    (r"Iowa Department of Public Safety", "IDPS"),
]
AGENCY_TYPE_DEFAULT = "Unknown"

# Place-name repairs: case-insensitive substring patterns, first match wins,
# otherwise the cleaned text is kept.
PLACE_REPAIR_RULES: list[Rule] = [
    (r"altoona", "ALTOONA", True),
    (r"floyd", "FLOYD", True),
    (r"saylor township", "SAYLOR TOWNSHIP", True),
    (r"delaware", "DELAWARE", True),
    (r"INDEPENCE", "INDEPENDENCE", True),
    (r"AAMOSA", "ANAMOSA", True),
    (r"MEDIC AMBULANCE", "", True),
    (r"mount air", "MOUNT AYR", True),
    (r"nemha", "NEMAHA", True),
    (r"smithville", "MOUNT AYR", True),
    (r"st.*charles", "SAINT CHARLES", True),
    (r"odeboldt", "ODEBOLT", True),
    (r"kilduff", "KILLDUFF", True),
    (r"cresent", "CRESCENT", True),
    (r"melcher", "MELCHER-DALLAS", True),
]

# Single-value rewrites and removal patterns of the place-name chain, in
# chain order.
FAIR_GROUNDS_PATTERN = r"iowa state fair grounds"          # case-insensitive -> FAIR_GROUNDS_CITY
FAIR_GROUNDS_CITY = "Des Moines"
PLACE_QUALIFIER_PATTERN = r"Rural(?:\s)*|\bUrban\b(?:\s)*|Suburban(?:\s)*|-(?:\s)*|\(|\)"  # remove all, ci
FORT_PATTERN, FORT_VALUE = r"Ft\.", "Fort"                 # replace all, case-sensitive
COUNTY_SUFFIX_PATTERN = r"(?:\sCO|\sCOUNTY)$"
SERGEANT_PATTERN, SERGEANT_VALUE = r"SGT\.", "SERGEANT"    # replace first, case-sensitive
JUNK_TAIL_PATTERN = r"mucatine\sco\.|,\sia\s.+$|\sboone\smva$|\s?\bunty\b\s?|\s*hwy.*$"  # remove first, ci
DELAWARE_PATTERN, DELAWARE_VALUE = r"delaware", "DELAWARE"  # whole-value rewrite, ci
TOWNSHIP_PATTERN, TOWNSHIP_VALUE = r"(?:twn|town)ship|twnshp|twn", "TOWNSHIP"  # replace first, ci
MELCHER_PATTERN, MELCHER_VALUE = r"melcher", "MELCHER-DALLAS"  # whole-value rewrite, ci
NOT_RECORDED = "Not Recorded"

# Defibrillation procedures (case-insensitive alternation).  The reference
# leaves the parentheses unescaped, so the two "(physical object)" names and
# "(& defibrillation)" never match themselves; DEFIB_PATTERN_AS_CODED keeps
# that text, DEFIB_PATTERN (the default) escapes them.
DEFIB_PATTERN_AS_CODED = (
    r"automatic external cardiac defibrillator (physical object)|cv - automated external defibrillator|"
    r"automatic cardiac defibrillator (physical object)|cv - defibrillation - manual|defibrillation, aed|"
    r"electrical cardioversion (& defibrillation)|cv - cardioversion|cardiac resuscitation|"
    r"management of external defibrillation")
DEFIB_PATTERN = DEFIB_PATTERN_AS_CODED.replace("(", r"\(").replace(")", r"\)")

# Outcome texts (case-insensitive substrings).
OUTCOME_NA_PATTERN = r"not applicable|not recorded"
DISPOSITION_DEAD_PATTERN = r"dead"
OUTCOME_REPAIRED = "Expired in the Field"
OUTCOME_FLAG_PATTERNS = {
    "rosc_ed": r"rosc in the ed",
    "rosc_field": r"rosc in the field",
    "ongoing_resus_ems": r"ongoing resuscitation by other ems",
    "ongoing_resus_ed": r"ongoing resuscitation in ed",
    "expire_field": r"expired in the field",
    "expire_ed": r"expired in the ed",
}
EXPIRE_PATTERN = r"expire"
EMS_CPR_INITIATOR_PATTERN = r"responding ems personnel|first responder \(ems\)"
NOT_WITNESSED_PATTERN = r"not"

# Gazetteer: (city, county) pairs removed as wrong geonames assignments.
GAZETTEER_EXCLUSIONS = [
    ("CENTERVILLE", "Boone"),
    ("PLEASANT HILL", "Van Buren"),
    ("HOLY CROSS", "Delaware"),
    ("FOREST CITY", "Howard"),
    ("GENEVA", "Benton"),
    ("WESTFIELD", "Poweshiek"),
    ("TROY", "Lucas"),
    ("WASHINGTON", "Woodbury"),
    ("WEBSTER", "Madison"),
    ("RIVERSIDE", "Woodbury"),
    ("WASHINGTON", "Franklin"),
    ("VAN", "Marshall"),
]

# The state whose counties and places are reported.
STATE_FIPS = "19"

# State FIPS codes outside the continental US, dropped from state maps.
NON_CONTINENTAL_STATE_FIPS = ["02", "11", "15", "60", "66", "69", "72", "78"]

# Surrogate incident id seed.
INCIDENT_ID_SEED = 10232015

# Quantile size bins for point maps: (upper quantile, comparison, code, label).
QUANTILE_BINS = [(0.8, "<=", 10, "01-06"), (0.9, "<", 15, "06-11"), (0.99, "<", 20, "11-47")]
QUANTILE_TOP = (25, "47+")

# Report constants.
CITY_REPORT_MIN_N = 46
LUMP_BELOW = 6
CALL_TYPE_CODES = {"Cardiac Arrest": 1, "Overdose": 2, "Other Cause": 3}

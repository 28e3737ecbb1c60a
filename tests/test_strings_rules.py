import re

import pytest
from pyspark.sql import functions as F

from vigil.functions import rules as R
from vigil.functions import strings as S
from vigil.functions.rules import apply_rules
from vigil.operators.places import clean_place, fair_grounds_city


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr.alias("y")).first()[0]


def test_squish(spark):
    assert one(spark, S.squish("x"), "  a \t b\n\nc  ") == "a b c"


@pytest.mark.parametrize("text,pat,rep", [
    ("aXbXc", "X", "-"), ("no match", "Z", "-"), ("X at start X", "X", ""), ("a.b.c", r"\.", "$"),
    ("Ames, IA 50010, IA x", r",\sia\s.+$", ""),
])
def test_replace_first_matches_python(spark, text, pat, rep):
    expected = re.sub(pat, rep.replace("\\", "\\\\"), text, count=1, flags=re.I)
    assert one(spark, S.replace_first("x", pat, rep, ignore_case=True), text) == expected


def test_replace_all_vs_first(spark):
    assert one(spark, S.replace_all("x", "a", "b"), "aaa") == "bbb"
    assert one(spark, S.replace_first("x", "a", "b"), "aaa") == "baa"


def test_extract_first_null_on_no_match(spark):
    assert one(spark, S.extract_first("x", r"\d+"), "abc") is None
    assert one(spark, S.extract_first("x", r"\d+"), "a12b34") == "12"
    assert one(spark, S.extract_first("x", r"(?<=\.)\d+$"), "US.IA.153") == "153"


def test_pad_left_never_truncates(spark):
    assert one(spark, S.pad_left("x", 3), "7") == "007"
    assert one(spark, S.pad_left("x", 3), "19153") == "19153"
    assert one(spark, S.pad_left("x", 3), None) is None


def test_safe_match_false_on_null(spark):
    assert one(spark, S.safe_match("x", "a"), None) is False
    assert one(spark, S.safe_match("x", "A", ignore_case=True), "cat") is True


def test_code_length_missing_token(spark):
    assert one(spark, S.code_length_is("x", 7), None) is False
    assert one(spark, S.code_length_is("x", 7, missing_token="missing"), None) is True
    assert one(spark, S.code_length_is("x", 7), "1234567") is True


def test_alternation_regex_escapes_and_sorts():
    pat = S.alternation_regex(["St. Charles", "A+B", None, " ", "Ames"], ignore_case=False, trie=False)
    assert pat == r"\b(?:A\+B|Ames|St\. Charles)\b"
    tri = S.alternation_regex(["WEST", "WEST DES MOINES", "WESTFIELD"], ignore_case=False)
    assert tri == r"\b(?:WEST(?:| DES MOINES|FIELD))\b"
    assert re.search(tri, "WEST DES MOINES").group(0) == "WEST"
    assert re.search(pat, "in St. Charles today").group(0) == "St. Charles"
    assert re.search(pat, "in StX Charles") is None


def test_labels(spark):
    df = spark.createDataFrame([(1, 8), (100, 100), (1, 3)], "n long, d long")
    out = df.select(S.n_pct_label("n", F.col("n") / F.col("d")).alias("a"),
                    S.pct_fixed(F.col("n") / F.col("d")).alias("b")).collect()
    assert [tuple(r) for r in out] == [("1 (12.5%)", "12.50%"), ("100 (100.0%)", "100.00%"),
                                       ("1 (33.33%)", "33.33%")]


AGENCY_CASES = [
    ("Iowa ISP District 3", "ISP"), ("Ames PD", "PD"), ("West Des Moines Police", "PD"),
    ("Polk County SO", "SO"), ("Story County S0", "SO"), ("Conservation Board", "Cons"),
    ("IDNR - Parks", "IDNR Parks"), ("IDNR Parks", "IDNR Parks"), ("Iowa DNR", "IDNR Parks"),
    ("IDOT MVE", "IDOT MVE"), ("State Fair Security", "Fairground LE"),
    ("Iowa Department of Public Safety", "IDPS"), ("Not Recorded", "Unknown"),
    ("ames pd", "Unknown"),  # case-sensitive rules
]


def test_agency_rules_first_match_case_sensitive(spark):
    df = spark.createDataFrame(AGENCY_CASES, "agency string, expected string")
    out = df.select("expected", apply_rules("agency", R.AGENCY_TYPE_RULES, R.AGENCY_TYPE_DEFAULT).alias("got"))
    assert all(r.expected == r.got for r in out.collect())


def test_rules_null_falls_through(spark):
    assert one(spark, apply_rules("x", R.AGENCY_TYPE_RULES, "Unknown"), None) == "Unknown"


PLACE_CASES = [
    ("Iowa State Fair Grounds", "DES MOINES"), ("Ft. Madison", "FORT MADISON"),
    ("West Des Moines", "WEST DES MOINES"), ("Melcher-Dallas", "MELCHER-DALLAS"),
    ("Polk Co", ""), ("Des Moines - Rural", "DES MOINES"), ("Ames, IA 50010", "AMES"),
    ("St. Charles", "SAINT CHARLES"), (None, "NOT RECORDED"), ("MEDIC AMBULANCE", ""),
    ("Sgt. Bluff", "SERGEANT BLUFF"), ("Saylor Township", "SAYLOR TOWNSHIP"), ("Clive hwy 6", "CLIVE"),
    ("Delaware Twp", "DELAWARE"), ("Urbandale (Urban)", "URBANDALE"), ("Indepence", "INDEPENDENCE"),
]


def test_clean_place_chain(spark):
    df = spark.createDataFrame(PLACE_CASES, "raw string, expected string")
    out = df.select("raw", "expected", clean_place(fair_grounds_city("raw"), ["Polk", "Story"]).alias("got"))
    bad = [(r.raw, r.expected, r.got) for r in out.collect() if r.expected != r.got]
    assert not bad


def test_county_suffix_as_coded_never_matches_upper_text(spark):
    df = spark.createDataFrame([("Polk Co",)], "raw string")
    got = df.select(clean_place("raw", ["Polk"], as_coded=True).alias("y")).first()[0]
    assert got == "POLK CO"


def test_defib_pattern_as_coded_misses_parenthesised_names(spark):
    name = "Automatic external cardiac defibrillator (physical object)"
    assert one(spark, S.safe_match("x", R.DEFIB_PATTERN, True), name) is True
    assert one(spark, S.safe_match("x", R.DEFIB_PATTERN_AS_CODED, True), name) is False

"""Property tests: batches of generated values, one Spark job per example,
compared with plain-Python definitions."""
import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigil.functions import conditions as C
from vigil.functions import strings as S
from vigil.functions import times as TM

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
texts = st.lists(st.text(alphabet=" \t\nab-.X", max_size=14), min_size=1, max_size=60)


def run(spark, values, dtype, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")
    return [r.y for r in df.select("i", expr.alias("y")).orderBy("i").collect()]


@SETTINGS
@given(values=texts)
def test_squish(spark, values):
    assert run(spark, values, "string", S.squish("x")) == [" ".join(re.split(r"[ \t\n]+", v.strip(" \t\n"))) if v.strip(" \t\n") else "" for v in values]


@SETTINGS
@given(values=texts, pat=st.sampled_from(["a", "X", r"\.", "-+", "a|b", r"\s+"]), rep=st.sampled_from(["", "Z", "$1"]))
def test_replace_first_is_python_count_1(spark, values, pat, rep):
    exp = [re.sub(pat, rep.replace("\\", "\\\\"), v, count=1) for v in values]
    assert run(spark, values, "string", S.replace_first("x", pat, rep)) == exp


@SETTINGS
@given(values=st.lists(st.text(alphabet="0123456789", max_size=6), min_size=1, max_size=60), width=st.integers(1, 5))
def test_pad_left_never_truncates(spark, values, width):
    assert run(spark, values, "string", S.pad_left("x", width)) == [v.rjust(width, "0") for v in values]


def band(y):
    if y is None:
        return None
    for lo in range(0, 85, 5):
        if y <= lo + 4:
            return f"{lo:02d}-{lo + 4:02d}"
    return "85+"


@SETTINGS
@given(values=st.lists(st.one_of(st.none(), st.floats(-5, 120, allow_nan=False)), min_size=1, max_size=80))
def test_age_band(spark, values):
    assert run(spark, values, "double", C.age_band("x")) == [band(v) for v in values]


def fy(d, first=2022, last=2027):
    if d is None:
        return "Unknown"
    y = d.year + (1 if d.month >= 5 else 0)
    return "Unknown" if y < first else f"FY{min(y, last)}"


@SETTINGS
@given(values=st.lists(st.one_of(st.none(), st.dates(dt.date(2019, 1, 1), dt.date(2029, 12, 31))), min_size=1, max_size=80))
def test_fiscal_year(spark, values):
    assert run(spark, values, "date", TM.fiscal_year("x")) == [fy(v) for v in values]


@SETTINGS
@given(pairs=st.lists(st.tuples(st.integers(0, 86_399_999_999), st.integers(0, 10 * 86_400_000_000)), min_size=1, max_size=80))
def test_clock_addition_is_modular(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a long, b long")
    got = [r.y for r in df.select("i", TM.add_time_of_day("a", "b").alias("y")).orderBy("i").collect()]
    assert got == [(a + (b // 1_000_000) * 1_000_000) % 86_400_000_000 for a, b in pairs]

import datetime as dt

from pyspark.sql import functions as F

from vigil.functions import conditions as C
from vigil.functions import times as TM

US = 1_000_000


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_combine_and_time_of_day(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 2), (23 * 3600 + 50 * 60) * US + 7)], "d date, tod long")
    r = df.select(TM.combine_date_time("d", "tod").alias("t")).select("t", TM.time_of_day("t").alias("back")).first()
    assert r.t == ts("2024-01-02 23:50:00.000007") and r.back == (23 * 3600 + 50 * 60) * US + 7


def test_midnight_rollover_hour_rule(spark):
    rows = [(ts("2024-01-01 23:50:00"), ts("2024-01-01 00:10:00")),   # repaired
            (ts("2024-01-01 23:50:00"), ts("2024-01-01 23:10:00")),   # same hour: not repaired (as coded)
            (None, ts("2024-01-01 00:10:00")), (ts("2024-01-01 10:00:00"), None)]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    out = df.select(TM.correct_midnight_rollover("a", "b").alias("h"),
                    TM.correct_midnight_rollover("a", "b", "micros").alias("m")).collect()
    assert out[0].h == ts("2024-01-02 00:10:00")
    assert out[1].h == ts("2024-01-01 23:10:00") and out[1].m == ts("2024-01-02 23:10:00")
    assert out[2].h == ts("2024-01-01 00:10:00") and out[3].h is None


def test_rollover_never_lowers_interval_when_clock_wraps(spark):
    df = spark.range(0, 2000).select(
        TM.combine_date_time(F.lit(dt.date(2024, 1, 1)), (F.col("id") * 43 * 60 * US) % (86400 * US)).alias("a"),
        TM.combine_date_time(F.lit(dt.date(2024, 1, 1)), (F.col("id") * 97 * 60 * US) % (86400 * US)).alias("b"))
    out = df.select(TM.minutes_between("b", "a").alias("raw"),
                    TM.minutes_between(TM.correct_midnight_rollover("a", "b"), "a").alias("fixed"))
    assert out.where("fixed < raw").count() == 0


def test_add_time_of_day_wraps_and_drops_subseconds(spark):
    on = (23 * 3600 + 59 * 60 + 30) * US
    dur = (60 + 15) * US + 500_000
    df = spark.createDataFrame([(on, dur), (None, dur), (on, None)], "on long, dur long")
    out = df.select(TM.add_time_of_day("on", "dur").alias("n"), TM.add_time_of_day("on", "dur", "zero").alias("z")).collect()
    assert out[0].n == 45 * US
    assert out[1].n is None and out[1].z == 75 * US        # as coded: missing AED-on becomes 00:00 + duration
    assert out[2].n is None and out[2].z == on


def test_add_time_of_day_matches_modular_arithmetic(spark):
    df = spark.range(0, 500).select((F.col("id") * 7919 * US % (86400 * US)).alias("a"),
                                    (F.col("id") * 104729 * 1000 + F.col("id")).alias("d"))
    got = df.select("a", "d", TM.add_time_of_day("a", "d").alias("x")).collect()
    assert all(r.x == (r.a + (r.d // US) * US) % (86400 * US) for r in got)


def test_null_if_equal_and_minutes(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 2)], "a long, b long")
    assert [r[0] for r in df.select(TM.null_if_equal("a", "b")).collect()] == [None, 2, 2]
    df = spark.createDataFrame([(ts("2024-01-01 10:00:59"), ts("2024-01-01 10:01:00"))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(TM.minutes_between("b", "a")).first()[0] == 1 / 60
    assert df.select(TM.minutes_between("a", "b")).first()[0] == -1 / 60


def test_parse_mdy(spark):
    df = spark.createDataFrame([("1/2/2020", "1/2/2020 3:04:05"), ("12/31/2021", "12/31/2021 3:04:05 PM"),
                                ("junk", "13/45/2020 25:00:00"), (None, None)], "d string, t string")
    out = df.select(TM.parse_mdy("d").alias("d"), TM.parse_mdy_hms("t").alias("t")).collect()
    assert out[0].d == dt.date(2020, 1, 2) and out[0].t == ts("2020-01-02 03:04:05")
    assert out[1].d == dt.date(2021, 12, 31) and out[1].t == ts("2021-12-31 15:04:05")
    assert out[2].d is None and out[2].t is None and out[3].d is None


def test_calendar(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 6),), (dt.date(2024, 3, 4),), (dt.date(2024, 9, 4),), (None,)], "d date")
    out = df.select(TM.day_name("d"), TM.month_name("d"), TM.is_weekend("d"), TM.season("d")).collect()
    assert tuple(out[0]) == ("Saturday", "January", True, "Winter")
    assert tuple(out[1]) == ("Monday", "March", False, "Spring")
    assert out[2][3] == "Fall" and out[3][3] is None


def test_fiscal_year_bounds(spark):
    days = ["2021-04-30", "2021-05-01", "2022-04-30", "2022-05-01", "2026-04-30", "2026-05-01", "2030-01-01"]
    df = spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days] + [(None,)], "d date")
    got = [r[0] for r in df.select(TM.fiscal_year("d")).collect()]
    assert got == ["Unknown", "FY2022", "FY2022", "FY2023", "FY2026", "FY2027", "FY2027", "Unknown"]


def test_age(spark):
    rows = [(4.5, "Years"), (4.0, "Years"), (400.0, "Days"), (84.5, "Years"), (85.0, "Years"), (84.0, "Years"),
            (None, "Years"), (30.0, "Months"), (52.1786, "Weeks"), (12.0, "Hours")]
    df = spark.createDataFrame(rows, "age double, unit string")
    out = df.select(C.age_in_years("age", "unit").alias("y")).select("y", C.age_band("y").alias("b")).collect()
    assert [r.b for r in out] == ["05-09", "00-04", "00-04", "85+", "85+", "80-84", None, "00-04", "00-04", "10-14"]
    assert abs(out[2].y - 400 / 365.25) < 1e-12 and out[9].y == 12.0   # Hours fall through as years
    ex = df.select(C.age_in_years("age", "unit", extra_units=True)).collect()[9][0]
    assert abs(ex - 12 / (24 * 365.25)) < 1e-15


def test_utstein_as_coded_needs_odd_shocks(spark):
    df = spark.createDataFrame([(True, True, 2), (True, True, 3), (False, True, 1), (None, True, 1)],
                               "b boolean, w boolean, s int")
    out = df.select(C.utstein("b", "w", "s").alias("i"), C.utstein("b", "w", "s", as_coded=True).alias("c")).collect()
    assert [r.i for r in out] == [True, True, False, None]
    assert [r.c for r in out] == [False, True, False, None]


def test_call_type_precedence(spark):
    rows = [(True, True, "x"), (False, True, "x"), (None, None, "x"), (True, None, None), (None, None, None)]
    df = spark.createDataFrame(rows, "c boolean, o boolean, other string")
    cols = C.call_type("c", "o", "other")
    out = df.select(cols["call_type"], cols["other_case_binary"]).collect()
    assert [tuple(r) for r in out] == [("Cardiac Arrest", False), ("Overdose", True), ("Other Cause", True),
                                       ("Cardiac Arrest", False), ("Unknown", False)]


def test_outcome_repair_and_flags(spark):
    rows = [(None, "Transported"), ("Not Applicable", "Dead at Scene"), ("Not Applicable", "Transported"),
            ("ROSC in the Field", "Dead"), ("Expired in the ED", None)]
    df = spark.createDataFrame(rows, "o string, d string")
    x = df.select(C.repair_outcome("o", "d").alias("o"))
    x = x.select("o", *[v.alias(k) for k, v in C.outcome_flags("o").items()]).collect()
    assert [r.o for r in x] == ["Expired in the Field", "Expired in the Field", "Not Applicable",
                                "ROSC in the Field", "Expired in the ED"]
    assert [r.survival for r in x] == [False, False, True, True, False]
    assert x[3].rosc_field and x[4].expire_ed and not x[4].expire_field


def test_cpr_and_witnessed(spark):
    df = spark.createDataFrame([(None, "Bystander", "Not witnessed"), ("No", None, None), (None, None, "Family")],
                               "cpr string, who string, w string")
    out = df.select(C.cpr_prior_to_arrival("cpr", "who"), C.witnessed_from_text("w")).collect()
    assert [tuple(r) for r in out] == [("yes", False), ("No", True), ("Not Recorded", True)]


def test_county_fips(spark):
    df = spark.createDataFrame([("19", "7"), ("19", "53"), ("19", "153"), ("19", ""), ("19", None)], "s string, c string")
    out = df.select(C.county_id("c"), C.county_fips("s", "c"), C.county_fips("s", "c", missing_token="missing")).collect()
    assert [tuple(r) for r in out] == [("007", "19007", "19007"), ("053", "19053", "19053"), ("153", "19153", "19153"),
                                       (None, None, "19missing"), (None, None, "19missing")]


def test_code_map(spark):
    df = spark.createDataFrame([("Overdose",), ("Unknown",)], "c string")
    assert [r[0] for r in df.select(C.code_map("c", {"Cardiac Arrest": 1, "Overdose": 2})).collect()] == [2, None]

"""Registered queries: every operator family exercised on the driver tables.

Analogues (see README): incident = ``orders`` (outcome from o_orderstatus:
F -> Deceased, O -> Survived, P -> Unknown), one-to-many rows = ``lineitem``
by order, clock-time events = ``events``, two binary indicators = ``labels``,
places = ``nation``/``region``, free text = ``documents``/``conversations``/
``part.p_name``.  The driver tables hold no NULLs, so queries derive NULLs from
key arithmetic (both here and in the oracle SQL) to exercise the null paths;
every query reads its whole tables.

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions import conditions as C
from vigil.functions import rules as R
from vigil.functions import strings as S
from vigil.functions import times as TM
from vigil.functions.ids import spread, surrogate_id, with_surrogate_id
from vigil.functions.rules import apply_rules
from vigil.operators import aggregate as A
from vigil.operators import tables as TB
from vigil.operators import collapse as CL
from vigil.operators.collapse import Side, defibrillation_summary
from vigil.operators.columns import count_missing, drop_missing, pull, relocate, sort_all
from vigil.operators.dedup import duplicate_keys, keep_first
from vigil.operators.dedup import fanout_report as fanout_of
from vigil.operators.geo import collection_centroid, composite_fips
from vigil.operators.impute import impute_median
from vigil.operators.joins import exclude_pairs, left_lookup, right_lookup
from vigil.operators.places import clean_place, extract_dictionary, fair_grounds_city
from vigil.operators.text import sectionize, sectionize_rows
from vigil.sources.io import Tables, apply_type_spec, literal_table, rename_with

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# shared derivations ------------------------------------------------------------
def order_survival(status: str = "o_orderstatus") -> Column:
    s = F.col(status)
    return F.when(s == "F", "Deceased").when(s == "O", "Survived").otherwise("Unknown")


def year_of(c: str) -> Column:
    return F.year(c).cast("bigint")


OUTCOME_LEVELS = ("Deceased", "Survived", "Unknown")
TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def fmt_ts(c: Column | str) -> Column:
    return F.date_format(S.col(c), TS_FMT)


def indicator_labels(t: Tables) -> DataFrame:
    """labels as (witnessed, bystander_cpr); witnessed NULL for every 10th doc."""
    lab = t.labels.select(
        F.when(F.col("doc_id") % 10 == 0, F.lit(None)).otherwise(F.col("quality") == 1).alias("witnessed"),
        (F.col("toxic") == 1).alias("bystander_cpr"))
    return drop_missing(lab, ["witnessed", "bystander_cpr"])


# W1 A1 O1 ----------------------------------------------------------------------
@query
def count_by_year_keep_first(spark, sf_dir):
    t = Tables(spark, sf_dir)
    first = keep_first(t.lineitem, ["l_orderkey"],
                       ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])
    return A.count_by(first.select(year_of("l_shipdate").alias("year")), ["year"], "n").orderBy("year")


# J1 M1 A1 W4 -------------------------------------------------------------------
@query
def share_by_district(spark, sf_dir):
    """Orders per district (region); customers of a region without a district
    row (MIDDLE EAST) count as "Not Recorded".  Orders are pre-aggregated per
    customer before the customer join (the join then moves one row per
    customer, not per order)."""
    t = Tables(spark, sf_dir)
    per_cust = A.count_by(t.orders, ["o_custkey"], "n")
    districts = t.region.where(F.col("r_name") != "MIDDLE EAST")
    x = (per_cust.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
         .transform(lambda d: left_lookup(d, t.nation, "c_nationkey", "n_nationkey", ["n_regionkey"]))
         .transform(lambda d: left_lookup(d, districts, "n_regionkey", "r_regionkey", ["r_name"]))
         .withColumn("district", C.default(S.squish("r_name"), R.NOT_RECORDED)))
    agg = x.groupBy("district").agg(F.sum("n").alias("n"))
    return TB.share(agg, "n", "percent").orderBy(F.desc("percent"), "district")


# W4 F3 -------------------------------------------------------------------------
@query
def threshold_after_share(spark, sf_dir):
    """Share among ALL customers first, then the threshold (order matters)."""
    t = Tables(spark, sf_dir)
    per_cust = A.count_by(t.orders, ["o_custkey"], "n")
    return TB.share(per_cust, "n", "percent").where(F.col("n") > 15)


# A4 ----------------------------------------------------------------------------
@query
def agencies_per_year(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return A.distinct_per_group(t.orders, [year_of("o_orderdate").alias("year")], "o_custkey", "n").orderBy("year")


# W2 W3 -------------------------------------------------------------------------
@query
def yoy_change(spark, sf_dir):
    t = Tables(spark, sf_dir)
    by_year = A.count_by(t.orders.select(year_of("o_orderdate").alias("year")), ["year"], "count")
    return TB.lag_change(by_year, "year", "count")


# A1 F1 W5 ----------------------------------------------------------------------
@query
def calltype_share_within_year(spark, sf_dir):
    t = Tables(spark, sf_dir)
    x = t.orders.select(year_of("o_orderdate").alias("year"), F.col("o_orderpriority").alias("call_type"))
    counts = A.count_by(x, ["year", "call_type"], "count").where(F.col("call_type") != "4-NOT SPECIFIED")
    return TB.share(counts, "count", "percent", by=["year"])


# A2 ----------------------------------------------------------------------------
@query
def count_share_proprow(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return TB.share(A.count_by(t.events, ["event_type"], "count"), "count", "percent")


# V4 (A1 V1 A13 T14 U2) -------------------------------------------------------------
@query
def two_way_table(spark, sf_dir):
    return TB.two_way_table(indicator_labels(Tables(spark, sf_dir)), "witnessed", "bystander_cpr")


# V5 / V6 -----------------------------------------------------------------------
@query
def two_way_table_absent_cell(spark, sf_dir):
    """V4 where one cell has no rows (no part is huge without being big): the
    totals still count every row."""
    parts = Tables(spark, sf_dir).part.select((F.col("p_size") > 25).alias("big"), (F.col("p_size") > 40).alias("huge"))
    return TB.two_way_table(parts, "big", "huge")


@query
def conditional_given_row(spark, sf_dir):
    return TB.conditional_table(indicator_labels(Tables(spark, sf_dir)), "witnessed", "bystander_cpr", "row")


@query
def conditional_given_col(spark, sf_dir):
    return TB.conditional_table(indicator_labels(Tables(spark, sf_dir)), "witnessed", "bystander_cpr", "col")


# A14 W6 ------------------------------------------------------------------------
@query
def lump_and_pareto(spark, sf_dir):
    t = Tables(spark, sf_dir)
    cat = t.part.select(F.concat_ws(" ", "p_brand", "p_type").alias("category"))
    return TB.pareto(A.count_by(cat, ["category"], "count"), "category", "count", lump_below=10)


# V3 / V2 -----------------------------------------------------------------------
def _outcome_by_year(t: Tables) -> DataFrame:
    x = t.orders.select(year_of("o_orderdate").alias("year"), order_survival().alias("survival"))
    return TB.outcome_table(x, ["year"], "survival", OUTCOME_LEVELS)


@query
def outcome_by_year(spark, sf_dir):
    return _outcome_by_year(Tables(spark, sf_dir)).orderBy("year")


@query
def outcome_by_year_long(spark, sf_dir):
    wide = _outcome_by_year(Tables(spark, sf_dir))
    return TB.unpivot(wide, ["year"], ["Pct_Survived", "Pct_Deceased"]).orderBy("year", "variable")


# V7 ----------------------------------------------------------------------------
@query
def outcome_by_recode(spark, sf_dir):
    """Outcome by customer segment recoded (BUILDING -> Female, AUTOMOBILE ->
    Male, missing and other -> Unknown).  Orders are pre-aggregated per
    (customer, outcome) before the customer join."""
    t = Tables(spark, sf_dir)
    per = t.orders.groupBy("o_custkey", order_survival().alias("survival")).agg(F.count(F.lit(1)).alias("n"))
    cust = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 7 == 0, F.lit(None))
                             .otherwise(F.col("c_mktsegment")).alias("segment"))
    x = per.join(cust, F.col("o_custkey") == F.col("c_custkey"))
    return TB.outcome_by_recode(x, "segment", "survival", {"BUILDING": "Female", "AUTOMOBILE": "Male"},
                                weight="n")


# V3 V8 -------------------------------------------------------------------------
@query
def outcome_gap(spark, sf_dir):
    t = Tables(spark, sf_dir)
    x = t.orders.select(F.col("o_orderpriority").alias("call_type"), order_survival().alias("survival"))
    return (TB.outcome_table(x, ["call_type"], "survival", OUTCOME_LEVELS, total_of=("Survived", "Deceased"),
                             total="total", pct={"percent_survived_by_group": "Survived",
                                                 "percent_deceased_by_group": "Deceased"}, gap="line_length")
            .orderBy(F.desc("percent_survived_by_group")))


# A12 W7 ------------------------------------------------------------------------
@query
def quantile_bins(spark, sf_dir):
    t = Tables(spark, sf_dir)
    counts = A.count_by(t.lineitem, ["l_partkey"], "n")
    return TB.quantile_bin(counts, "n").orderBy("l_partkey")


# A11 W8 ------------------------------------------------------------------------
@query
def median_impute(spark, sf_dir):
    t = Tables(spark, sf_dir)
    x = t.events.select("event_id", "event_type",
                        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("value")).alias("value"))
    out = impute_median(x, ["value"])
    return out.select("event_id", "event_type", F.round("value", 6).alias("value"))


# A6 A7 J2 ----------------------------------------------------------------------
@query
def collapse_one_to_many(spark, sf_dir):
    t = Tables(spark, sf_dir)
    rows = t.lineitem.withColumn("ship_day", F.date_format("l_shipdate", "yyyy-MM-dd"))
    procedures = Side(columns=["l_linenumber", "ship_day", "l_returnflag", "l_linestatus"],
                      outputs={"complaint": ("l_returnflag", "distinct"),
                               "description": ("l_linestatus", "distinct"),
                               "performed_at": ("ship_day", "all"),
                               "attempts": ("l_linenumber", "all")})
    medications = Side(columns=["l_partkey", "l_suppkey"],
                       outputs={"medication": ("l_partkey", "all"), "response": ("l_suppkey", "all")})
    base = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return CL.collapse_one_to_many(base, "o_orderkey", None, rows.withColumnRenamed("l_orderkey", "o_orderkey"),
                                [procedures, medications])


# X4 (A5 A6 F7) -----------------------------------------------------------------
def procedure_rows(t: Tables) -> DataFrame:
    rf = F.col("l_returnflag")
    return t.lineitem.select(
        "l_orderkey",
        F.when(rf == "R", "Defibrillation, AED").when(rf == "A", "CV - Cardioversion")
        .otherwise("Airway - Suction").alias("description"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("performed_at"),
        F.when(F.col("l_linenumber") == 1, F.lit(None)).otherwise(F.col("l_linenumber")).alias("attempts"))


@query
def procedure_summary(spark, sf_dir):
    rows = procedure_rows(Tables(spark, sf_dir))
    return defibrillation_summary(rows, "l_orderkey", "description", "performed_at", "attempts",
                                  R.DEFIB_PATTERN, order=["performed_at", "description", "attempts"])


# D1 D2 D5 ----------------------------------------------------------------------
@query
def midnight_rollover(spark, sf_dir):
    t = Tables(spark, sf_dir)
    shift = ((F.col("event_id") % 180) - 30) * TM.US_PER_MINUTE
    tod2 = F.pmod(TM.time_of_day("ts") + shift, F.lit(TM.US_PER_DAY))
    x = t.events.select("event_id", F.col("ts").alias("t1"),
                        F.when(F.col("event_id") % 11 == 0, F.lit(None))
                        .otherwise(TM.combine_date_time(F.col("ts").cast("date"), tod2)).alias("t2"))
    x = x.withColumn("t2_fix", TM.correct_midnight_rollover("t1", "t2"))
    x = x.withColumn("minutes", TM.minutes_between("t2_fix", "t1"))
    return x.select("event_id", fmt_ts("t1").alias("t1"), fmt_ts("t2").alias("t2"),
                    fmt_ts("t2_fix").alias("t2_fix"), "minutes")


# D3 D4 -------------------------------------------------------------------------
@query
def time_of_day_add(spark, sf_dir):
    t = Tables(spark, sf_dir)
    e = F.col("event_id")
    x = t.events.select(
        "event_id",
        F.when(e % 13 == 0, F.lit(None)).otherwise(TM.time_of_day("ts")).alias("tod_on"),
        F.when(e % 17 == 0, F.lit(None)).when(e % 19 == 0, F.lit(0))
        .otherwise((e % 7200) * TM.US_PER_SECOND + e % 1000).alias("duration"))
    x = x.withColumn("tod_off", TM.add_time_of_day("tod_on", "duration"))
    return x.withColumn("tod_off", TM.null_if_equal("tod_on", "tod_off"))


# D6 ----------------------------------------------------------------------------
@query
def interval_family(spark, sf_dir):
    """Order -> first/last ship intervals; lineitem is reduced to one row per
    order BEFORE the join."""
    t = Tables(spark, sf_dir)
    ship = t.lineitem.groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_ship"),
                                                F.max("l_shipdate").alias("last_ship"))
    x = t.orders.select("o_orderkey", "o_orderdate").join(ship, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return x.select("o_orderkey", *[v.alias(k) for k, v in TM.interval_columns({
        "order_to_first_ship": ("o_orderdate", "first_ship"),
        "order_to_last_ship": ("o_orderdate", "last_ship"),
        "first_to_last_ship": ("first_ship", "last_ship")}).items()])


# D7 ----------------------------------------------------------------------------
@query
def parse_mdy(spark, sf_dir):
    t = Tables(spark, sf_dir)
    k = F.col("o_orderkey")
    x = t.orders.select(
        "o_orderkey",
        F.when(k % 13 == 0, F.lit("not a date")).otherwise(F.date_format("o_orderdate", "M/d/yyyy")).alias("date_text"),
        F.when(k % 11 == 0, F.lit("13/45/2020 25:00:00"))
        .otherwise(F.date_format(F.timestamp_add("SECOND", k % 86400, F.col("o_orderdate")), "M/d/yyyy H:mm:ss"))
        .alias("ts_text"))
    return x.select("o_orderkey", "date_text", "ts_text",
                    F.date_format(TM.parse_mdy("date_text"), "yyyy-MM-dd").alias("parsed_date"),
                    F.date_format(TM.parse_mdy_hms("ts_text"), "yyyy-MM-dd HH:mm:ss").alias("parsed_ts"))


# D8 D9 D10 ---------------------------------------------------------------------
@query
def calendar_features(spark, sf_dir):
    t = Tables(spark, sf_dir)
    d = F.when(F.col("o_orderkey") % 17 == 0, F.lit(None)).otherwise(F.col("o_orderdate").cast("date"))
    x = t.orders.select("o_orderkey", d.alias("incident_date"))
    x = x.withColumns({"incident_day": TM.day_name("incident_date"), "incident_month": TM.month_name("incident_date")})
    x = x.withColumns({"weekday_weekend": TM.is_weekend("incident_date"), "season": TM.season("incident_date")})
    return x.drop("incident_date")


# D11 A8 A10 --------------------------------------------------------------------
def _fy_rates(t: Tables):
    """X6 itself, over orders as incidents."""
    from vigil.plans.reports import fiscal_year_performance
    x = t.orders.select(F.col("o_orderkey").alias("unique_incident_id"), F.col("o_orderdate").alias("date_of_use"), order_survival().alias("survival"))
    per, summary = fiscal_year_performance(x, ["date_of_use"], start_month=5, first_fy=1996, last_fy=2001)
    return per.withColumnRenamed("fiscal_year", "fy"), summary


@query
def fiscal_year_table(spark, sf_dir):
    per, _ = _fy_rates(Tables(spark, sf_dir))
    return per.orderBy("fy")


@query
def fiscal_year_rates(spark, sf_dir):
    _, summary = _fy_rates(Tables(spark, sf_dir))
    return summary.select(F.round("mean_n", 9).alias("mean_n"), F.round("mean_pct", 12).alias("mean_pct"))


# M4 M5 -------------------------------------------------------------------------
@query
def age_bands(spark, sf_dir):
    t = Tables(spark, sf_dir)
    k, raw = F.col("c_custkey"), F.abs(F.col("c_acctbal")) / 100
    unit = (F.when(k % 5 == 0, "Days").when(k % 5 == 1, "Months").when(k % 5 == 2, "weeks")
            .when(k % 5 == 3, "Years").otherwise(F.lit(None)))
    age = (F.when(k % 13 == 0, F.lit(None)).when(k % 5 == 0, raw * 365).when(k % 5 == 1, raw * 12)
           .when(k % 5 == 2, raw * 52).otherwise(raw))
    x = t.customer.select("c_custkey", age.alias("age"), unit.alias("age_unit"))
    x = x.withColumn("age_unit", S.to_title(C.default("age_unit", R.NOT_RECORDED)))
    x = x.withColumn("age_years", C.age_in_years("age", "age_unit"))
    x = x.withColumn("age_range", C.age_band("age_years"))
    return x.select("c_custkey", "age_unit", F.round("age_years", 6).alias("age_years"), "age_range")


# T13 F7 ------------------------------------------------------------------------
PART_RULES = [
    (r"^PROMO", "Promotional"),
    (r"widget|gizmo", "Gadget"),
    (r"standard.*bolt", "Standard fastener", True),
    (r"ring|gear", "Mechanical"),
    (r"^(SMALL|LARGE) (hot|cold)", "Thermal"),
    (r"plate$", "Plate"),
]


@query
def rule_classify(spark, sf_dir):
    t = Tables(spark, sf_dir)
    x = t.part.select("p_partkey", F.concat_ws(" ", "p_type", "p_name").alias("descr"))
    return x.select("p_partkey", "descr", apply_rules("descr", PART_RULES, default="Unknown").alias("part_class"))


# T1-T3 T6 T16 T17 --------------------------------------------------------------
def place_texts(t: Tables) -> DataFrame:
    k = F.col("c_custkey") % 12
    n, r = F.col("n_name"), F.col("r_name")
    raw = (F.when(k == 0, F.lit(None))
           .when(k == 1, F.concat(F.lit("  Rural "), n, F.lit("  (north) ")))
           .when(k == 2, F.concat(F.lit("Ft. "), F.lower(n), F.lit(" hwy 30")))
           .when(k == 3, F.concat(n, F.lit(" "), F.initcap(r), F.lit(" County")))
           .when(k == 4, F.concat(F.lit("Sgt. "), n, F.lit(" Co")))
           .when(k == 5, F.concat(n, F.lit(", IA 50309")))
           .when(k == 6, F.concat(F.lit("delaware twp "), n))
           .when(k == 7, F.concat(n, F.lit(" Twnshp")))
           .when(k == 8, F.lit("Melcher-Dallas"))
           .when(k == 9, F.lit("Iowa State Fair Grounds"))
           .when(k == 10, F.col("c_name"))
           .otherwise(F.concat(F.lit("Medic Ambulance "), n)))
    c = t.customer.select("c_custkey", "c_name", "c_nationkey")
    c = c.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return c.select("c_custkey", raw.alias("place_raw"))


@query
def clean_place_chain(spark, sf_dir):
    t = Tables(spark, sf_dir)
    counties = pull(t.region.select(F.initcap("r_name").alias("county")), "county")
    x = place_texts(t)
    return x.select("c_custkey", "place_raw",
                    clean_place(fair_grounds_city("place_raw"), counties).alias("place_clean"))


# T11 J5 ------------------------------------------------------------------------
def _dictionary(t: Tables) -> DataFrame:
    """Nouns of every part name plus the full names of SMALL parts and the
    adjectives of LARGE parts (so one-word, two-word and prefix entries all
    occur)."""
    p = t.part
    nouns = p.select(F.upper(F.split("p_name", " ")[1]).alias("name"))
    full = p.where(F.col("p_type") == "SMALL").select(F.upper("p_name").alias("name"))
    adj = p.where(F.col("p_type") == "LARGE").select(F.upper(F.split("p_name", " ")[0]).alias("name"))
    return nouns.unionByName(full).unionByName(adj)


def _dictionary_texts(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.upper(F.concat_ws(" ", "p_name", "p_type")).alias("text"))


@query
def dictionary_extract(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return extract_dictionary(_dictionary_texts(t), "text", _dictionary(t), "name", "location", method="regex")


@query
def dictionary_extract_ngram(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return extract_dictionary(_dictionary_texts(t), "text", _dictionary(t), "name", "location",
                              method="ngram")


def _punctuated(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Names with hyphens, apostrophes and dots, and repeated texts that hold them."""
    words = F.split("p_name", " ")
    kind = F.col("p_partkey") % 4
    name = (F.when(kind == 0, F.concat_ws("-", words[0], words[1])).when(kind == 1, F.concat(F.lit("o'"), words[1]))
            .when(kind == 2, F.concat(F.lit("st. "), words[0])).otherwise(words[1]))
    names = t.part.select(F.upper(name).alias("name"))
    texts = t.part.select(F.upper(F.concat(F.lit("near "), name, F.lit(", "), F.col("p_type"))).alias("text"))
    return texts.unionAll(texts), names


@query
def dictionary_extract_punctuated(spark, sf_dir):
    """J5 through the n-gram join on names that span separators other than a space."""
    texts, names = _punctuated(Tables(spark, sf_dir))
    return extract_dictionary(texts, "text", names, "name", "location", method="ngram")


@query
def dictionary_extract_punctuated_regex(spark, sf_dir):
    """The same through the regex: both methods give the same answers."""
    texts, names = _punctuated(Tables(spark, sf_dir))
    return extract_dictionary(texts, "text", names, "name", "location", method="regex")


# T5 T8 -------------------------------------------------------------------------
@query
def code_parts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    k = F.col("n_nationkey")
    code = (F.when(k % 5 == 0, F.concat(F.lit("CA."), F.substring("r_name", 1, 2), F.lit("."), k.cast("string")))
            .when(k % 5 == 1, F.concat(F.lit("US."), S.pad_left(F.col("n_regionkey") + 10, 2), F.lit("."),
                                       k.cast("string")))
            .otherwise(F.concat(F.lit("US."), F.substring("r_name", 1, 2), F.lit("."), (k * 7).cast("string"))))
    x = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", code.alias("code"), F.concat(F.col("n_name"), F.lit(" County ")).alias("county_name"))
    x = x.withColumns({
        "country_code": S.squish(S.extract_first("code", r"^[^\.]+")),
        "state_code": S.extract_first("code", r"(?<=^[A-Z]{2}\.)(?:\d{2}|[A-Z]{2})"),
        "county_code": S.extract_first("code", r"(?<=\.)\d+$"),
        "name_county": S.squish(S.remove_first("county_name", r"\scounty", ignore_case=True))})
    return x.withColumn("county_padded", S.pad_left("county_code", 3)).drop("county_name")


# M13 T8 T9 ---------------------------------------------------------------------
@query
def fips_build(spark, sf_dir):
    t = Tables(spark, sf_dir)
    k = F.col("n_nationkey")
    raw = F.when(k % 6 == 0, F.lit("")).when(k % 7 == 0, F.lit(None)).otherwise((k * 7).cast("string"))
    x = t.nation.select("n_nationkey", raw.alias("county_raw"))
    return x.select("n_nationkey", "county_raw", C.county_id("county_raw").alias("county_id"),
                    C.county_fips(F.lit("19"), "county_raw").alias("county_fips"),
                    C.county_fips(F.lit("19"), "county_raw", missing_token="missing").alias("county_fips_as_coded"))


# F8 J4 -------------------------------------------------------------------------
EXCLUDED_NATION_REGION = [("NATION_1", "AMERICA"), ("NATION_7", "ASIA"), ("NATION_24", "MIDDLE EAST"),
                          ("NATION_3", "AFRICA")]


@query
def exclude_pairs_query(spark, sf_dir):
    t = Tables(spark, sf_dir)
    x = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    ex = literal_table(spark, EXCLUDED_NATION_REGION, "name string, county string")
    return exclude_pairs(x, ex, ["n_name", "r_name"], ["name", "county"])


# J3 ----------------------------------------------------------------------------
@query
def right_join_boundaries(spark, sf_dir):
    """Per-code measure (mean account balance) with non-continental codes
    removed, right-joined to every boundary row (nation)."""
    t = Tables(spark, sf_dir)
    m = (t.customer.withColumn("locationid", S.pad_left("c_nationkey", 2))
         .where(~F.col("locationid").isin(R.NON_CONTINENTAL_STATE_FIPS))
         .groupBy("locationid").agg(F.round(F.avg("c_acctbal"), 6).alias("data_value")))
    b = t.nation.select(S.pad_left("n_nationkey", 2).alias("STATEFP"), "n_name")
    return right_lookup(m, b, "locationid", "STATEFP", ["data_value"])


# S9 U1 -------------------------------------------------------------------------
MANUAL_PLACES = [("MANUAL TOWN A", 3), ("MANUAL TOWN B", 4), ("MANUAL TOWN C", 0)]


@query
def union_manual_rows(spark, sf_dir):
    t = Tables(spark, sf_dir)
    base = t.nation.select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"),
                           F.col("n_regionkey").alias("regionkey"), F.lit(None).cast("string").alias("admin3_code"))
    manual = literal_table(spark, MANUAL_PLACES, "name string, regionkey int")
    manual = manual.select(surrogate_id(["name"], R.INCIDENT_ID_SEED).alias("id"), "name", "regionkey",
                           F.lit(None).cast("string").alias("admin3_code"))
    return base.unionByName(manual)


# I1 ----------------------------------------------------------------------------
@query
def surrogate_ids(spark, sf_dir):
    """An id for every line, from composite text keys that hold the separator
    of naive concatenation, NULLs, and many repeated rows."""
    return with_surrogate_id(_repeated_lines(Tables(spark, sf_dir)), ["a", "b", "c"], R.INCIDENT_ID_SEED, "unique_incident_id")


def _repeated_lines(t: Tables) -> DataFrame:
    even = F.col("l_linenumber") % 2 == 0
    return t.lineitem.select(
        F.concat(F.col("l_orderkey").cast("string"), F.when(even, "|").otherwise("")).alias("a"),
        F.concat(F.when(even, "").otherwise("|"), (F.col("l_partkey") % 3).cast("string")).alias("b"),
        F.when(F.col("l_suppkey") % 4 == 0, F.lit(None)).otherwise(F.col("l_returnflag")).alias("c"))


@query
def surrogate_ids_unique(spark, sf_dir):
    """Rows, distinct ids and rows left by keep-first on the id: all equal, as no two rows share an id."""
    x = spread(with_surrogate_id(_repeated_lines(Tables(spark, sf_dir)), ["a", "b", "c"], R.INCIDENT_ID_SEED, "id"), ["id"])
    kept = keep_first(x, ["id"], ["a"]).agg(F.count(F.lit(1)).alias("n")).scalar()
    return x.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id").alias("n_ids")).withColumn("n_kept", kept)


# W9 ----------------------------------------------------------------------------
@query
def sectionize_text(spark, sf_dir):
    """Every turn opens with its ``role:`` header line, so the carry-forward is
    partitioned per (conversation, turn): exact, and a long conversation is
    spread over many window partitions."""
    t = Tables(spark, sf_dir)
    b = t.conversations.select("conv_id", "turn", F.concat(F.col("role"), F.lit(":\n"), F.col("text")).alias("block"))
    out = sectionize(b, ["conv_id", "turn"], ["conv_id", "turn"], "block")
    return out.withColumn("line_no", F.col("line_no").cast("bigint"))


@query
def sectionize_long_documents(spark, sf_dir):
    """W9 where a document arrives as many rows: four documents made of all turns; only every fifth turn opens
    with a header line of its own, which carries on into the turns after it."""
    t = Tables(spark, sf_dir)
    head = F.when((F.col("conv_id") + F.col("turn")) % 5 == 0, F.concat(F.lit("Turn "), F.col("conv_id").cast("string"), F.lit(":\n"))).otherwise("")
    rows = t.conversations.select((F.col("conv_id") % 4).alias("doc"), "conv_id", "turn", F.concat(head, "text", F.when(F.col("turn") == 3, "\nlast:").otherwise("")).alias("text"))
    return sectionize_rows(rows, ["doc"], ["conv_id", "turn"], "text").withColumn("line_no", F.col("line_no").cast("bigint"))


# M8-M12 ------------------------------------------------------------------------
@query
def outcome_flags(spark, sf_dir):
    t = Tables(spark, sf_dir)
    d = F.col("doc_id") % 6
    x = t.labels.join(t.documents.select("doc_id", "text"), "doc_id", "left")
    x = x.withColumns({
        "outcome_raw": (F.when(d == 0, F.lit(None)).when(d == 1, "ROSC in the ED").when(d == 2, "ROSC in the Field")
                        .when(d == 3, "Not Applicable").when(d == 4, "Expired in the ED")
                        .otherwise("Ongoing Resuscitation in ED")),
        "disposition": F.when(F.col("toxic") == 1, "Dead at Scene").otherwise("Transported"),
        "cpr_raw": F.when(F.col("doc_id") % 4 == 0, F.lit(None)).otherwise(F.lit("No")),
        "who_provided": F.when(F.col("quality") == 1, F.lit("Bystander")),
        "expired_scene": F.when(F.col("doc_id") % 9 == 0, F.lit(None)).otherwise(F.col("toxic") == 1),
        "expired_in_er": F.col("quality") == 0})
    x = x.withColumn("outcome", C.repair_outcome("outcome_raw", "disposition"))
    x = x.withColumns(C.outcome_flags("outcome"))
    x = x.withColumns({"witnessed": C.witnessed_from_text("text"),
                       "cpr": C.cpr_prior_to_arrival("cpr_raw", "who_provided"),
                       "survival_incident": C.survival_from_flags("expired_scene", "expired_in_er")})
    return x.select("doc_id", "outcome", *R.OUTCOME_FLAG_PATTERNS, "survival", "witnessed", "cpr",
                    "survival_incident")


# M7 ----------------------------------------------------------------------------
@query
def call_type_precedence(spark, sf_dir):
    t = Tables(spark, sf_dir)
    x = t.labels.join(t.documents.select("doc_id", "lang", "source"), "doc_id", "left")
    cardiac = F.when(F.col("doc_id") % 5 == 0, F.lit(None)).otherwise(F.col("quality") == 1)
    od = F.when(F.col("doc_id") % 7 == 0, F.lit(None)).otherwise(F.col("toxic") == 1)
    other = F.when(F.col("lang") == "fr", F.col("source"))
    cols = C.call_type(cardiac, od, other)
    return x.select("doc_id", *[v.alias(k) for k, v in cols.items()])


# J6 ----------------------------------------------------------------------------
@query
def fanout_report(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"], "n")


@query
def fanout_report_join(spark, sf_dir):
    """Orders that a join to their lines would multiply, with the number of matches."""
    t = Tables(spark, sf_dir)
    return fanout_of(t.orders, t.lineitem, ["o_orderkey"], ["l_orderkey"], "n_matches")


# A3 A16 F5 G4 -------------------------------------------------------------------
@query
def distinct_and_missing(spark, sf_dir):
    """Distinct values with a missing one counted, without, and the missing rows."""
    x = Tables(spark, sf_dir).customer.select(F.when(F.col("c_custkey") % 7 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("segment"))
    plain = A.n_distinct(x, "segment", count_missing=False).scalar()
    return A.n_distinct(x, "segment", name="n_with_missing").withColumns({"n_plain": plain, "n_missing": count_missing(x, "segment").scalar()})


@query
def category_levels(spark, sf_dir):
    x = Tables(spark, sf_dir).orders.select(F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.col("o_orderpriority")).alias("priority"))
    return A.levels(x, "priority")


@query
def composite_fips_codes(spark, sf_dir):
    x = Tables(spark, sf_dir).supplier.select("s_suppkey", F.col("s_nationkey").cast("string").alias("county"), (F.col("s_suppkey") % 60).cast("string").alias("state"))
    return x.select("s_suppkey", composite_fips("state", "county").alias("fips"))


# S1 S2 S6 S7 S8 -------------------------------------------------------------------
@query
def write_and_read_back(spark, sf_dir):
    """Orders written as CSV (create only, then replaced), read back with a header
    (S2) and as a delimited file under a schema (S1), stored (S6) and read again."""
    import uuid

    from vigil.session import checkpoint_dir
    from vigil.sources import io as IO
    folder = f"{checkpoint_dir(spark)}/round-trip-{uuid.uuid4().hex}"
    x = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", F.round("o_totalprice", 2).alias("o_totalprice"))
    schema = "o_orderkey long, o_orderstatus string, o_orderpriority string, o_totalprice double"
    IO.write_table(x, f"{folder}/csv", mode="errorifexists", fmt="csv")
    IO.write_table(x, f"{folder}/csv", mode="overwrite", fmt="csv")
    named = IO.read_csv(spark, f"{folder}/csv", schema).withColumn("how", F.lit("csv"))
    typed = IO.read_delimited(spark, f"{folder}/csv", schema, sep=",", header=True).withColumn("how", F.lit("delimited"))
    both = IO.materialize(spark, f"{folder}/stored", lambda: named.unionByName(typed))
    return IO.materialize(spark, f"{folder}/stored", lambda: both)


# W9 -------------------------------------------------------------------------------
@query
def sectionize_many_headers(spark, sf_dir):
    """Lines before the first header, several headers in one text, blank lines,
    and a header that repeats."""
    size, name, kind = F.col("p_size").cast("string"), F.col("p_name"), F.col("p_type")
    block = F.concat(F.lit("lead "), name, F.lit("\n\n Size:\n"), size, F.lit("\n  more "), kind, F.lit("\nKind: \n"), kind, F.lit("\nSize:\nagain "), name)
    out = sectionize(Tables(spark, sf_dir).part.select("p_partkey", block.alias("block")), ["p_partkey"], ["p_partkey"], "block")
    return out.withColumn("line_no", F.col("line_no").cast("bigint"))


# J7 ----------------------------------------------------------------------------
@query
def code_lookup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    p = F.col("o_orderpriority")
    ct = (F.when(p == "1-URGENT", "Cardiac Arrest").when(p == "2-HIGH", "Overdose")
          .when(p == "3-MEDIUM", "Other Cause").otherwise("Unknown"))
    x = t.orders.select("o_orderkey", ct.alias("call_type"))
    return x.withColumn("code", C.code_map("call_type", R.CALL_TYPE_CODES))


# G1 ----------------------------------------------------------------------------
def nation_polygons(t: Tables) -> DataFrame:
    """One square per nation at (key, region) with side 1 + key % 3; even keys
    get a clockwise square hole."""
    k = F.col("n_nationkey").cast("double")
    r = F.col("n_regionkey").cast("double")
    s = (F.col("n_nationkey") % 3 + 1).cast("double")

    def pt(x, y):
        return F.struct(x.alias("x"), y.alias("y"))
    outer = F.array(pt(k, r), pt(k + s, r), pt(k + s, r + s), pt(k, r + s))
    hole = F.array(pt(k + 0.25, r + 0.25), pt(k + 0.25, r + 0.5), pt(k + 0.5, r + 0.5), pt(k + 0.5, r + 0.25))
    geom = F.when(F.col("n_nationkey") % 2 == 0, F.array(outer, hole)).otherwise(F.array(outer))
    return t.nation.select("n_nationkey", "n_regionkey", geom.alias("geometry"))


@query
def centroid(spark, sf_dir):
    c = collection_centroid(nation_polygons(Tables(spark, sf_dir)), "geometry", ["n_regionkey"])
    return c.select("n_regionkey", *[F.round(x, 6).alias(x) for x in ("cx", "cy", "area")])


# S3 S4 S5 ----------------------------------------------------------------------
TYPE_SPEC = ["bigint", "string", "double", "date", "string"]


@query
def type_spec_ingest(spark, sf_dir):
    t = Tables(spark, sf_dir)
    k = F.col("o_orderkey")
    raw = t.orders.select(
        k.cast("string").alias("Order Key (ID)"),
        F.col("o_orderstatus").alias("OrderStatus"),
        F.when(k % 97 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("Total=Price"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Order Date"),
        F.when(k % 89 == 0, F.lit(" ")).otherwise(F.col("o_orderpriority")).alias("Order Priority"))
    typed = apply_type_spec(raw, TYPE_SPEC, clean_up=True, on_error="null")   # the bad prices are asked to be NULL
    typed = rename_with(typed, lambda c: c.replace("(", "").replace(")", ""))
    return rename_with(typed, lambda c: c.replace("=", "_"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


# X1 / X2 on driver-table analogues --------------------------------------------
def _initcap_words(c: Column) -> Column:
    return F.initcap(F.lower(c))


def analog_places(t: Tables) -> DataFrame:
    """Geonames-layout places from nation x region: '(historical)' suffixes,
    padding whitespace, one non-populated feature, one other-state row."""
    k = F.col("n_nationkey")
    nm = F.regexp_replace("n_name", "_", " ")
    x = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return x.select(
        k.cast("bigint").alias("geonameid"),
        F.when(k % 4 == 0, F.concat(nm, F.lit(" (historical)"))).otherwise(F.concat(F.lit("  "), nm, F.lit(" ")))
        .alias("name"),
        F.col("n_name").alias("asciiname"), F.lit(None).cast("string").alias("alternatenames"),
        (F.lit(40.0) + k / 10).alias("latitude"), (F.lit(-90.0) - F.col("n_regionkey")).alias("longitude"),
        F.when(k == 7, "H").otherwise("P").alias("feature_class"), F.lit("PPL").alias("feature_code"),
        F.lit("US").alias("country_code"), F.lit(None).cast("string").alias("cc2"),
        F.when(k == 11, "MN").otherwise("IA").alias("admin1_code"),
        (F.col("n_regionkey") * 2 + 1).cast("string").alias("admin2_code"),
        F.lit(None).cast("string").alias("admin3_code"), F.lit(None).cast("string").alias("admin4_code"),
        (k * 1000).cast("bigint").alias("population"), F.lit(None).cast("double").alias("elevation"),
        F.lit(None).cast("double").alias("dem"), F.lit(None).cast("string").alias("timezone"),
        F.lit(None).cast("date").alias("modification_date"))


def analog_county_codes(t: Tables) -> DataFrame:
    r = t.region
    code = F.lpad((F.col("r_regionkey") * 2 + 1).cast("string"), 3, "0")
    ia = r.select(F.concat(F.lit("US.IA."), code).alias("code"),
                  F.concat(_initcap_words("r_name"), F.lit(" County")).alias("name"),
                  F.col("r_name").alias("asciiname"), F.col("r_regionkey").cast("bigint").alias("geonameID"))
    other = r.select(F.concat(F.lit("CA.08."), code).alias("code"), F.lit("Elsewhere").alias("name"),
                     F.col("r_name").alias("asciiname"), F.col("r_regionkey").cast("bigint").alias("geonameID"))
    return ia.unionByName(other)


def analog_county_attrs(t: Tables) -> DataFrame:
    r = t.region.where(F.col("r_name") != "MIDDLE EAST")
    k = F.col("r_regionkey")
    return r.select(_initcap_words("r_name").alias("county"),
                    F.concat(F.lit("19"), F.lpad((k * 2 + 1).cast("string"), 3, "0")).alias("county_fips"),
                    (k + 1).cast("string").alias("region_preparedness"),
                    F.when(k % 2 == 0, "Metro").otherwise("Rural").alias("designation"),
                    F.when(k % 2 == 0, "Urban").otherwise("Rural").alias("urbanicity"))


ANALOG_EXCLUSIONS = list(R.GAZETTEER_EXCLUSIONS) + [("NATION 5", "Africa"), ("NATION 8", "Europe")]


def analog_gazetteer(spark, t: Tables) -> DataFrame:
    from vigil.plans.gazetteer import build_gazetteer
    return build_gazetteer(spark, analog_places(t), analog_county_codes(t), analog_county_attrs(t),
                           exclusions=ANALOG_EXCLUSIONS)


GAZETTEER_OUT = ["geonameid", "name", "name_county", "district", "county_fips", "designation", "urbanicity",
                 "admin2_code", "latitude", "longitude"]


@query
def gazetteer_build(spark, sf_dir):
    return analog_gazetteer(spark, Tables(spark, sf_dir)).select(*GAZETTEER_OUT)


def analog_incidents_raw(t: Tables) -> DataFrame:
    """Incident rows (FIXTURES B1 layout) derived from every order."""
    ok, ck = F.col("o_orderkey"), F.col("c_custkey")
    day = F.lit(TM.US_PER_DAY)
    toc = (ok * 7919 % 86400) * TM.US_PER_SECOND
    pat = F.pmod(toc + ((F.col("o_custkey") % 40) - 5) * TM.US_PER_MINUTE, day)
    on = F.when(ok % 23 == 0, F.lit(None)).otherwise(F.pmod(pat + (ok % 11) * TM.US_PER_MINUTE, day))
    dur = (F.when(ok % 19 == 0, F.lit(None)).when(ok % 17 == 0, F.lit(0))
           .otherwise((ok % 1800) * TM.US_PER_SECOND + 250_000))
    nm = F.regexp_replace("n_name", "_", " ")
    m8 = ok % 8
    place = (F.when(m8 == 0, F.lit(None)).when(m8 == 1, F.concat(F.lit("Rural "), nm))
             .when(m8 == 2, F.concat(nm, F.lit(" "), _initcap_words("r_name"), F.lit(" Co")))
             .when(m8 == 3, F.lit("Iowa State Fair Grounds")).when(m8 == 4, F.lit("Medic Ambulance"))
             .when(m8 == 5, F.concat(F.lower(nm), F.lit(", IA 50310")))
             .when(m8 == 6, F.concat(F.lit("Nowhere "), F.col("o_orderpriority")))
             .otherwise(F.concat(F.lit("West "), nm)))
    c6 = ck % 6
    agency = (F.when(c6 == 0, F.lit(None)).when(c6 == 1, F.concat(F.col("c_name"), F.lit(" PD")))
              .when(c6 == 2, F.lit("County S0")).when(c6 == 3, F.lit("Iowa DNR"))
              .when(c6 == 4, F.concat(F.lit("ISP Post "), F.col("n_nationkey").cast("string")))
              .otherwise(F.col("c_mktsegment")))
    raw_age = F.abs(F.col("c_acctbal")) / 100
    c5 = ck % 5
    age = (F.when(F.col("o_custkey") % 13 == 0, F.lit(None)).when(c5 == 0, raw_age * 365)
           .when(c5 == 1, raw_age * 12).when(c5 == 2, raw_age * 52).otherwise(raw_age))
    unit = (F.when(c5 == 0, "Days").when(c5 == 1, "Months").when(c5 == 2, "weeks").when(c5 == 3, "Years")
            .otherwise(F.lit(None)))
    c4 = ck % 4
    prio = F.col("o_orderpriority")
    x = (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
         .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
         .join(t.region, F.col("n_regionkey") == F.col("r_regionkey")))
    return x.select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("date_of_use"), toc.alias("amb_toc"),
        pat.alias("amb_pat"), on.alias("time_aed_on"), dur.alias("total_time_aed_actually_used_min_sec"),
        place.alias("location_city_event"), agency.alias("agency"), age.alias("age"), unit.alias("age_unit"),
        F.when(c4 == 0, F.lit(None)).when(c4 == 1, "F").when(c4 == 2, "M").otherwise("U").alias("sex"),
        F.when(ok % 9 == 0, F.lit(None)).otherwise(ok % 2 == 0).alias("witnessed"),
        F.lit(None).cast("boolean").alias("unknown_if_witnessed"),
        F.when(ok % 10 == 0, F.lit(None)).otherwise(F.col("o_custkey") % 3 == 0).alias("bystander_cpr"),
        (ok % 4).cast("int").alias("shock_no_shock"),
        F.when(prio == "1-URGENT", F.lit(True)).when(prio == "5-LOW", F.lit(None)).otherwise(F.lit(False))
        .alias("cardiac_episode"),
        (prio == "2-HIGH").alias("od_case"),
        F.when(prio.isin("3-MEDIUM", "1-URGENT"), F.lit("Fall")).alias("other_case"),
        (F.col("o_orderstatus") == "F").alias("expired_scene"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.lit(False)).alias("expired_in_er"),
        F.lit(None).cast("boolean").alias("expired_in_hospital"))


INCIDENT_OUT = ["o_orderkey", "unique_incident_id", "amb_pat_timestamp_fix", "time_aed_off",
                "time_aed_off_timestamp_fix", "time_from_call_to_patient", "time_from_call_to_aed_on",
                "time_from_patient_to_aed", "total_time_aed_used", "time_at_patient_to_end_aed",
                "time_from_call_to_end_aed", "bystander_cpr", "utstein_survival", "age_unit", "age_years",
                "age_range", "agency", "agency_type", "location_city_event_clean", "location", "call_type", "year",
                "survival", "name_county", "county_fips", "district"]


@query
def incident_build(spark, sf_dir):
    """X2 over every order: timestamps, rollover, AED-off clock, intervals,
    age, agency rules, place cleaning + dictionary extraction against the X1
    gazetteer, outcome, gazetteer attributes."""
    from vigil.plans.incidents import build_incidents
    t = Tables(spark, sf_dir)
    inc = build_incidents(analog_incidents_raw(t), analog_gazetteer(spark, t), id_cols=["o_orderkey"])
    return inc.select(*[fmt_ts(c).alias(c) if c.endswith("_fix") else
                        (F.round(c, 6).alias(c) if c.startswith("time_from") or c.startswith("time_at")
                         or c in ("total_time_aed_used", "age_years") else F.col(c))
                        for c in INCIDENT_OUT])


# X3 on a driver-table analogue -------------------------------------------------
def analog_runs_raw(t: Tables) -> DataFrame:
    """Registry-extract rows (FIXTURES B2 layout, text dates) from every
    lineitem joined to its order: run = order, procedure/medication = line."""
    from vigil.plans import runs as RU
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    disp = F.timestamp_add("SECOND", ok % 86400, F.col("o_orderdate"))
    scene = F.timestamp_add("MINUTE", ok % 13, disp)
    patient = F.when(ok % 10 == 0, F.lit(None)).otherwise(F.timestamp_add("MINUTE", ck % 7, scene))
    proc = F.timestamp_add("MINUTE", F.col("l_linenumber") * 2, disp)
    hms = "M/d/yyyy H:mm:ss"
    rf, prio, st = F.col("l_returnflag"), F.col("o_orderpriority"), F.col("o_orderstatus")
    x = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return x.select(
        ok.cast("string").alias(RU.KEY),
        F.date_format("o_orderdate", "M/d/yyyy").alias(RU.DATE),
        F.date_format(disp, hms).alias("incident_date_time"),
        F.date_format(disp, hms).alias(RU.DISPATCH),
        F.date_format(scene, hms).alias(RU.SCENE),
        F.date_format(patient, hms).alias(RU.PATIENT),
        F.date_format(proc, hms).alias(RU.PROC_TIME),
        F.when(rf == "R", "Defibrillation, AED").when(rf == "A", "CV - Cardioversion")
        .otherwise("Airway - Suction").alias(RU.PROC_DESC),
        F.when(F.col("l_linenumber") == 1, F.lit(None)).otherwise(F.col("l_linenumber")).alias(RU.PROC_ATTEMPTS),
        F.concat(F.lit("Med "), (F.col("l_partkey") % 5).cast("string")).alias(RU.MED),
        F.when(F.col("l_linestatus") == "O", "Improved").otherwise("Unchanged").alias(RU.MED_RESPONSE),
        F.when(prio == "1-URGENT", "Cardiac arrest").when(prio == "2-HIGH", "Overdose")
        .otherwise("Unconscious").alias(RU.COMPLAINT),
        F.when(ck % 11 == 0, F.lit(None)).when(ck % 7 == 0, F.lit("123456"))
        .otherwise(F.lpad((ck % 10000000).cast("string"), 7, "1")).alias(RU.AGENCY_NUMBER),
        F.lit("Agency").alias("agency_name_d_agency_03"),
        F.when(ok % 3 == 0, "Not Witnessed").when(ok % 3 == 1, "Bystander").otherwise(F.lit(None))
        .alias(RU.WITNESSED_BY),
        F.when(ok % 4 == 0, F.lit(None)).otherwise(F.lit("No")).alias(RU.CPR_PRIOR),
        F.when(ok % 5 == 0, F.lit('"Family Member"')).alias(RU.CPR_WHO),
        F.lit(None).cast("string").alias("cardiac_arrest_who_initiated_cpr_3_4_it_arrest_008_3_5_e_arrest_20"),
        F.when(ok % 6 == 0, F.lit(None)).otherwise(prio == "2-HIGH").alias(RU.OVERDOSE),
        F.when(st == "F", "Expired in the Field").when(st == "O", "ROSC in the ED")
        .when(ok % 2 == 0, F.lit(None)).otherwise(F.lit("Not Applicable")).alias(RU.OUTCOME),
        F.when(F.col("o_totalprice") > 200000, "Dead at scene").otherwise("Transported").alias(RU.DISPOSITION),
        F.lit("19").alias(RU.STATE),
        F.when(ck % 9 == 0, F.lit("")).when(ck % 9 == 1, (ck % 200).cast("string"))
        .otherwise(((ck % 4) * 2 + 1).cast("string")).alias(RU.COUNTY))


RUNS_OUT_EXTRA = ["incident_day", "season", "weekday_weekend", "shocks", "witnessed", "rosc_ed", "rosc_field",
                  "expire_field", "expire_ed", "survival", "county_id", "county_fips", "region_preparedness"]


@query
def runs_build(spark, sf_dir):
    """X3 over every lineitem x order: distinct, text dates parsed, dispatch
    intervals, 7-character agency filter, defibrillation shocks, one row per
    run with ordered procedure/medication texts, CPR/outcome repairs, exact
    median imputation, FIPS and county attributes."""
    from vigil.plans import runs as RU
    t = Tables(spark, sf_dir)
    runs = RU.build_runs(analog_runs_raw(t), analog_county_attrs(t), base_order=[RU.DISPATCH, RU.PROC_TIME])
    cols = [RU.KEY, F.date_format(RU.DATE, "yyyy-MM-dd").alias(RU.DATE), RU.COMPLAINT, RU.PROC_DESC, RU.PROC_TIME,
            RU.PROC_ATTEMPTS, RU.MED, RU.MED_RESPONSE, F.round(RU.TO_SCENE, 6).alias(RU.TO_SCENE),
            F.round(RU.TO_PATIENT, 6).alias(RU.TO_PATIENT), RU.CPR_PRIOR, RU.CPR_WHO, RU.OVERDOSE, RU.OUTCOME,
            *RUNS_OUT_EXTRA]
    return runs.select(*cols)


# X7 on a driver-table analogue -------------------------------------------------
def analog_measure(t: Tables) -> DataFrame:
    """Measure rows (FIXTURES B6 layout): mean account balance at nation /
    region ("State") / nation ("County") level, plus a non-overall stratum."""
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    v = F.round(F.avg("c_acctbal"), 6).alias("data_value")

    def rows(df, s1, level, lid, abbr, desc):
        return df.select(F.lit(s1).alias("stratification1"), F.lit("Overall").alias("stratification2"),
                         F.lit(level).alias("geographiclevel"), lid.alias("locationid"), abbr.alias("locationabbr"),
                         desc.alias("locationdesc"), "data_value")
    nat = rows(c.agg(v), "Overall", "Nation", F.lit("59"), F.lit("US"), F.lit("United States"))
    st = c.groupBy("n_regionkey").agg(v)
    state = rows(st, "Overall", "State", F.col("n_regionkey").cast("string"),
                 F.concat(F.lit("R"), F.col("n_regionkey").cast("string")),
                 F.concat(F.lit("Region "), F.col("n_regionkey").cast("string")))
    male = rows(st, "Male", "State", F.col("n_regionkey").cast("string"), F.lit("R"), F.lit("Region"))
    ct = c.groupBy("n_nationkey", "n_name").agg(v)
    county = rows(ct, "Overall", "County",
                  F.concat(F.lit("19"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0")),
                  F.when(F.col("n_nationkey") % 3 == 0, "XX").otherwise("IA"),
                  F.concat(_initcap_words("n_name"), F.lit(" County")))
    return nat.unionByName(state).unionByName(male).unionByName(county)


def _mortality(spark, sf_dir):
    from vigil.plans.reports import mortality_tables
    t = Tables(spark, sf_dir)
    states = t.region.select(F.lpad(F.col("r_regionkey").cast("string"), 2, "0").alias("STATEFP"),
                             F.col("r_name").alias("NAME"))
    # every nation is a county of the state, and once more one of another state (the boundary filter drops those)
    counties = t.nation.select(F.explode(F.array(F.lit("19"), F.lit("27"))).alias("STATEFP"),
                               F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("COUNTYFP"),
                               F.col("n_name").alias("NAME"))
    attrs = t.nation.where(F.col("n_regionkey") != 4).select(
        _initcap_words("n_name").alias("county"), (F.col("n_regionkey") + 1).cast("string").alias("region_preparedness"))
    return mortality_tables(analog_measure(t), states, counties, attrs)


@query
def mortality_state(spark, sf_dir):
    return _mortality(spark, sf_dir)["state"]


@query
def mortality_county(spark, sf_dir):
    return _mortality(spark, sf_dir)["county"]


@query
def mortality_national(spark, sf_dir):
    return _mortality(spark, sf_dir)["national"]


@query
def mortality_map_frame(spark, sf_dir):
    """Projection centre (area-weighted centroid of the state squares) and
    colour range (min / max measure) of the state map table."""
    from vigil.plans.reports import map_frame
    state = _mortality(spark, sf_dir)["state"]
    k = F.col("STATEFP").cast("double")

    def pt(x, y):
        return F.struct(x.alias("x"), y.alias("y"))
    sq = F.array(F.array(pt(k * 3, k), pt(k * 3 + 2, k), pt(k * 3 + 2, k + 2), pt(k * 3, k + 2)))
    frame = map_frame(state.withColumn("geometry", sq), "geometry", "data_value")
    return frame.select(*[F.round(c, 6).alias(c) for c in frame.columns])


# X5 reports on the X2 analogue ---------------------------------------------------
def _analog_incidents(spark, sf_dir):
    from vigil.plans.incidents import build_incidents
    t = Tables(spark, sf_dir)
    return build_incidents(analog_incidents_raw(t), analog_gazetteer(spark, t), id_cols=["o_orderkey"])


@query
def incident_location_counts(spark, sf_dir):
    """Deployments per (place, lat, lon) with quantile size bins, on the
    deduplicated incidents."""
    from vigil.plans.reports import location_counts, unique_incidents
    return location_counts(unique_incidents(_analog_incidents(spark, sf_dir), ["date_of_use", "amb_toc", "o_orderkey"]))


@query
def incident_city_share(spark, sf_dir):
    """Deployments by city (missing -> "Not Recorded") with shares of all
    deployments, then the city-size threshold (n > 46)."""
    from vigil.plans.reports import deployments_by_city, unique_incidents
    return deployments_by_city(unique_incidents(_analog_incidents(spark, sf_dir), ["date_of_use", "amb_toc", "o_orderkey"]))


@query
def incident_fanout_reports(spark, sf_dir):
    """X5 where places lie in two counties: the join multiplies incidents, keep-first
    leaves one copy of each, the same one however the rows are partitioned."""
    from vigil.plans.reports import deployments_by_group, unique_incidents
    t = Tables(spark, sf_dir)
    inc = _analog_incidents(spark, sf_dir).select("unique_incident_id", "date_of_use", "amb_toc", "agency", "location")
    gaz = analog_gazetteer(spark, t).select("name", "name_county", "district", "urbanicity").distinct()
    again = gaz.where(F.col("name").endswith("1") | F.col("name").endswith("A")).select(
        "name", F.concat(F.lit("Also "), "name_county").alias("name_county"), F.lit("99").alias("district"), F.lit("Mixed").alias("urbanicity"))
    u = unique_incidents(left_lookup(inc, gaz.unionByName(again), "location", "name", ["name_county", "district", "urbanicity"]))
    part = lambda c: deployments_by_group(u, c).select(F.lit(c).alias("report"), F.col(c).alias("value"), "n", "percent")
    return part("district").unionByName(part("urbanicity"))


# X5 table by table ------------------------------------------------------------------
def analog_report_base(t: Tables) -> DataFrame:
    """Built incident rows (the columns that reports read) from every order, its customer and nation.  Incidents of every
    fourth nation come twice, as after a fan-out (a place in two counties): only the gazetteer's columns differ."""
    ok, ck, nk = F.col("o_orderkey"), F.col("o_custkey"), F.col("n_nationkey")
    x = (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == nk))
    place = F.when(ok % 9 != 0, F.col("n_name"))
    x = x.select(
        ok.cast("string").alias("unique_incident_id"), F.col("o_orderdate").cast("date").alias("date_of_use"), (ok % 86400).alias("amb_toc"),
        F.when(ck % 17 != 0, F.concat(F.lit("Agency "), (ck % 40).cast("string"))).alias("agency"), year_of("o_orderdate").alias("year"),
        F.element_at(F.array(*map(F.lit, ("Cardiac", "OD", "Other", "Unknown", "Trauma"))), (ok % 5 + 1).cast("int")).alias("call_type"),
        F.when(nk % 6 != 5, F.col("n_regionkey").cast("string")).alias("district"), place.alias("location"),
        F.when(nk != 7, nk + F.lit(0.25)).alias("latitude"), (nk * -1.5).alias("longitude"),
        F.when(ok % 10 != 0, ok % 3 == 0).alias("witnessed"), F.when(ok % 14 != 0, ck % 2 == 0).alias("bystander_cpr"),
        F.when(ck % 50 == 0, F.concat(F.lit("Rare "), (ck % 1000).cast("string"))).otherwise(F.col("o_orderpriority")).alias("agency_type"),
        order_survival().alias("survival"), F.when(ok % 8 == 1, "F").when(ok % 8 == 2, "M").when(ok % 8 == 3, "X").alias("sex"),
        F.when(ok % 12 != 0, F.concat(F.lit("band "), (ck % 6).cast("string"))).alias("age_range"),
        F.when(nk % 5 != 0, F.concat(F.lit("Area "), (nk % 3).cast("string"))).alias("urbanicity"),
        F.when(ok % 5 == 2, F.concat(F.lit("case "), (ck % 7).cast("string"))).alias("other_case"), nk.alias("n_nationkey"))
    again = x.where((F.col("n_nationkey") % 4 == 0) & F.col("location").isNotNull()).withColumns({"district": F.lit("99"), "urbanicity": F.lit("Mixed")})
    return x.unionByName(again).drop("n_nationkey")


REPORTS = ("total_deployments", "total_responding_agencies", "agencies_by_year", "deployments_by_year", "deployments_change", "deployments_by_district",
           "deployments_by_city", "location_counts", "distinct_locations", "missing_locations", "deployments_by_calltype", "calltype_by_year",
           "calltype_share_within_year", "witnessed_bystander_cpr", "conditional_witnessed", "conditional_bcpr", "agency_type_pareto", "survival_by_year",
           "survival_by_year_long", "gender_distribution", "age_distribution", "survival_by_calltype", "survival_by_urbanicity", "other_causes")


def _report(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark, sf_dir):
        from vigil.plans.reports import report_set
        return report_set(analog_report_base(Tables(spark, sf_dir)))[name]
    run.__name__ = f"report_{name}"
    run.__doc__ = f"X5: the table ``{name}`` of the report set."
    return run


for _name in REPORTS:
    query(_report(_name))


# P4 O3 ------------------------------------------------------------------------------
@query
def relocated_columns(spark, sf_dir):
    """Every order's columns moved around anchors, written out in their new order."""
    x = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    x = relocate(x, ["o_orderpriority", "o_orderstatus"], before="o_custkey")
    x = relocate(x, "o_custkey", after="o_orderpriority")
    return x.select("o_orderkey", F.concat_ws("|", *x.columns).alias("line"))


@query
def sorted_by_all_columns(spark, sf_dir):
    """O3: counts sorted by every column, missing last, numbered as they come (a category table, so one partition)."""
    flag, line = F.when(F.col("l_orderkey") % 5 != 0, F.col("l_returnflag")), F.when(F.col("l_suppkey") % 3 != 0, F.col("l_linenumber"))
    counts = A.count_by(Tables(spark, sf_dir).lineitem.select(flag.alias("flag"), "l_linestatus", line.alias("line")), ["flag", "l_linestatus", "line"], "n")
    return sort_all(counts).coalesce(1).withColumn("place", F.monotonically_increasing_id() + 1)


# V3 + T15 labels ------------------------------------------------------------------
@query
def outcome_labels(spark, sf_dir):
    """Outcome table with text labels ``"1,234 (49.87%)"`` (thousands
    separators, fixed two-decimal percent), missing group -> "Not Known"."""
    t = Tables(spark, sf_dir)
    p = F.col("o_orderpriority")
    x = t.orders.select(F.when(p == "4-NOT SPECIFIED", F.lit(None)).otherwise(p).alias("urbanicity"),
                        order_survival().alias("survival"))
    tab = TB.outcome_table(x, ["urbanicity"], "survival", total="total",
                           pct={"percent_survived": "Survived", "percent_deceased": "Deceased"})
    return tab.select(
        F.coalesce("urbanicity", F.lit("Not Known")).alias("urbanicity"), "Survived", "Deceased", "total",
        F.concat(S.with_commas("Survived"), F.lit(" ("), S.pct_fixed("percent_survived"), F.lit(")")).alias("label_survived"),
        F.concat(S.with_commas("Deceased"), F.lit(" ("), S.pct_fixed("percent_deceased"), F.lit(")")).alias("label_deceased"))

"""X5 report set, X6 fiscal-year performance, X7 mortality map tables.

The report set is one job: ``report_counts`` numbers the rows of each incident and counts
by all groupings the reports need (grouping sets) in one pass, its small result is stored, and every table is derived
from that.  Single reports start from ``unique_incidents`` (keep-first per surrogate id).
Whole-table windows only run on category-bounded aggregates.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions import rules as R
from vigil.functions import times as TM
from vigil.functions.strings import pad_left, pct_fixed, remove_first, squish, to_text, with_commas
from vigil.operators import aggregate as A
from vigil.operators import tables as TB
from vigil.operators.columns import drop_missing
from vigil.operators.dedup import keep_first, order_columns
from vigil.operators.geo import composite_fips, polygon_terms
from vigil.operators.joins import left_lookup, right_lookup
from vigil.session import checkpointed

ID = "unique_incident_id"


def unique_incidents(incidents: DataFrame, order_by: Sequence = ("date_of_use", "amb_toc", "agency")) -> DataFrame:
    """One row per incident.  After a fan-out (a place in two counties) the copies differ in the
    gazetteer's columns only: ``keep_first`` breaks ties by all columns, so the
    same copy is kept however the input is partitioned."""
    return keep_first(incidents, [ID], list(order_by))


def deployments_by_group(u: DataFrame, col: str, missing_token: str | None = None) -> DataFrame:
    """Count + share by district/location; missing -> "Not Recorded"
    (``missing_token="missing"`` keeps the as-coded text instead).  Districts and places are names of the gazetteer, so the
    total is a window over their counts."""
    g = u.withColumn(col, squish(to_text(col, missing_token)))
    g = g.withColumn(col, F.coalesce(col, F.lit(R.NOT_RECORDED)))
    return TB.share(A.count_by(g, [col], "n"), "n", "percent", bounded=True).orderBy(F.desc("percent"), col)


def deployments_by_city(u: DataFrame, min_n: int = R.CITY_REPORT_MIN_N) -> DataFrame:
    return deployments_by_group(u, "location").where(F.col("n") > min_n)


def location_counts(u: DataFrame) -> DataFrame:
    """Points per (place, lat, lon) with quantile size bins.  The counts are checkpointed (a job runs), since the
    bins read them twice and what lies below may be a whole build."""
    c = checkpointed(A.count_by(drop_missing(u, ["location", "latitude", "longitude"]), ["location", "latitude", "longitude"], "n"))
    return TB.quantile_bin(c, "n").orderBy("location")


# the columns that the reports count by, and the groupings they need of them
REPORT_DIMS = ["year", "call_type", "district", "location", "latitude", "longitude", "witnessed", "bystander_cpr", "agency_type",
               "survival", "sex", "age_range", "urbanicity", "other_case", "agency"]
REPORT_SETS: dict[str, list[str]] = {
    "year": ["year"], "year_call_type": ["year", "call_type"], "call_type": ["call_type"], "district": ["district"], "location": ["location"],
    "place": ["location", "latitude", "longitude"], "agency": ["agency"], "year_agency": ["year", "agency"], "agency_type": ["agency_type"],
    "witnessed_cpr": ["witnessed", "bystander_cpr"], "survival_year": ["year", "survival"], "survival_sex": ["sex", "survival"],
    "survival_age": ["age_range", "survival"], "survival_call_type": ["call_type", "survival"], "survival_urbanicity": ["urbanicity", "survival"],
    "other_case": ["other_case"]}


def report_counts(incidents: DataFrame, order_by: Sequence = ("date_of_use", "amb_toc", "agency")) -> DataFrame:
    """Every count that the reports need, from ONE pass over the incidents: ``grouping, <columns>, n, rows``.

    ``rows`` counts all rows of a group, ``n`` those that ``unique_incidents`` would keep (the first row of its
    incident).  All groupings are expanded and partially aggregated in the map tasks, so a handful of small rows a
    task is shuffled for them; the one data-sized shuffle orders the rows of an incident."""
    dims = [c for c in REPORT_DIMS if c in incidents.columns]
    named = [c for c in order_by if isinstance(c, str)]
    need = list(dict.fromkeys([ID, *named, *dims]))
    x = incidents.select(*need, *[c.alias(f"__o{i}") for i, c in enumerate(order_by) if not isinstance(c, str)])
    rest = [c for c in x.columns if c != ID and c not in named]
    first = Window.partitionBy(ID).orderBy(*order_columns([c if isinstance(c, str) else F.col(f"__o{i}") for i, c in enumerate(order_by)]), *order_columns(rest))
    x = x.select(*dims, (F.row_number().over(first) == 1).alias("__first"))
    sets = {name: by for name, by in REPORT_SETS.items() if set(by) <= set(dims)}
    # a grouping's id has a bit for each column that it lacks, the first column's bit the highest
    lacks = {name: sum(1 << (len(dims) - 1 - i) for i, c in enumerate(dims) if c not in by) for name, by in sets.items()}
    name_of = F.create_map(*[F.lit(v) for name, k in lacks.items() for v in (k, name)])
    counts = x.groupingSets([[F.col(c) for c in by] for by in sets.values()], *dims).agg(
        F.grouping_id().cast("int").alias("__gid"), F.count_if("__first").alias("n"), F.count(F.lit(1)).alias("rows"))
    return counts.select(F.element_at(name_of, F.col("__gid")).alias("grouping"), *dims, "n", "rows")


def report_set(incidents: DataFrame, order_by: Sequence = ("date_of_use", "amb_toc", "agency"),
               lump_below: int = R.LUMP_BELOW) -> dict[str, DataFrame]:
    """All report tables keyed by name.

    The incidents are read once: ``report_counts`` is checkpointed (a job runs), and the tables are small
    lazy plans over it.  Its rows are bounded by the categories counted (years, call types, places, ...)."""
    stored = checkpointed(report_counts(incidents, order_by))

    def counts(name: str, kept: bool = True) -> DataFrame:
        c = stored.where(F.col("grouping") == name)
        return (c.where("n > 0") if kept else c).select(*REPORT_SETS[name], "n", "rows")

    def by_name(name: str, c: str) -> DataFrame:
        g = counts(name).withColumn(c, F.coalesce(squish(to_text(c)), F.lit(R.NOT_RECORDED))).groupBy(c).agg(F.sum("n").alias("n"))
        return TB.share(g, "n", "percent", bounded=True).orderBy(F.desc("percent"), c)

    def shares(name: str, c: str) -> DataFrame:
        return TB.share(drop_missing(counts(name), [c]) if c == "other_case" else counts(name), "n", "percent", bounded=True).select(c, F.col("n").alias("count"), "percent")

    def outcomes(name: str, c: str, **more) -> DataFrame:
        return TB.outcome_table(counts(name), [c], "survival", weight="n", **more)

    by_year = counts("year").select("year", F.col("n").alias("count"))
    ct_year = counts("year_call_type").select("year", "call_type", F.col("n").alias("count"))
    wb = drop_missing(counts("witnessed_cpr"), ["witnessed", "bystander_cpr"])
    agency = counts("agency_type").select("agency_type", F.col("n").alias("count"))
    place = drop_missing(counts("place"), ["location", "latitude", "longitude"]).select("location", "latitude", "longitude", "n")
    total = lambda df, c: df.agg(F.coalesce(c, F.lit(0).cast("bigint")).alias("n"))
    surv = {"Pct_Survived": "Survived", "Pct_Deceased": "Deceased"}
    out = {
        "total_deployments": total(by_year, F.sum("count")),
        "total_responding_agencies": total(counts("agency", kept=False), F.count(F.lit(1))),
        "agencies_by_year": counts("year_agency", kept=False).groupBy("year").agg(F.count("agency").alias("n")).orderBy("year"),
        "deployments_by_year": by_year.orderBy("year"),
        "deployments_change": TB.lag_change(by_year, "year", "count"),
        "deployments_by_district": by_name("district", "district"),
        "deployments_by_city": by_name("location", "location").where(F.col("n") > R.CITY_REPORT_MIN_N),
        "location_counts": TB.quantile_bin(place, "n").orderBy("location"),
        "distinct_locations": total(counts("location", kept=False), F.count("location")),
        "missing_locations": total(counts("location", kept=False).where("location is null"), F.sum("rows")),
        "deployments_by_calltype": shares("call_type", "call_type").orderBy("call_type"),
        "calltype_by_year": ct_year.orderBy("year", "call_type"),
        "calltype_share_within_year": TB.share(ct_year.where(F.col("call_type") != "Unknown"), "count", "percent", by=["year"]),
        "witnessed_bystander_cpr": TB.two_way_table(wb, "witnessed", "bystander_cpr", weight="n"),
        "conditional_witnessed": TB.conditional_table(wb, "witnessed", "bystander_cpr", "row", weight="n"),
        "conditional_bcpr": TB.conditional_table(wb, "witnessed", "bystander_cpr", "col", weight="n"),
        "agency_type_pareto": TB.pareto(agency, "agency_type", "count", lump_below=lump_below),
        "survival_by_year": outcomes("survival_year", "year", pct=surv).orderBy("year"),
        "gender_distribution": TB.outcome_by_recode(counts("survival_sex"), "sex", "survival", {"F": "Female", "M": "Male"}, weight="n"),
        "age_distribution": outcomes("survival_age", "age_range", pct=surv).where(F.col("age_range").isNotNull()).orderBy(F.desc_nulls_first("Pct_Survived")),
        "survival_by_calltype": outcomes("survival_call_type", "call_type", total="total", gap="line_length",
                                         pct={"percent_survived_by_group": "Survived", "percent_deceased_by_group": "Deceased"})
        .orderBy(F.desc_nulls_first("percent_survived_by_group")),
        "other_causes": shares("other_case", "other_case").orderBy(F.desc("percent")),
    }
    out["survival_by_year_long"] = TB.unpivot(out["survival_by_year"].select("year", "Pct_Survived", "Pct_Deceased"),
                                              ["year"], ["Pct_Survived", "Pct_Deceased"]).orderBy("year")
    urb = outcomes("survival_urbanicity", "urbanicity", total="total", pct={"percent_survived": "Survived", "percent_deceased": "Deceased"})
    out["survival_by_urbanicity"] = urb.withColumns({
        "label_survived": F.concat(with_commas("Survived"), F.lit(" ("), pct_fixed("percent_survived"), F.lit(")")),
        "label_deceased": F.concat(with_commas("Deceased"), F.lit(" ("), pct_fixed("percent_deceased"), F.lit(")")),
        "urbanicity": F.coalesce("urbanicity", F.lit("Not Known"))}).orderBy("urbanicity")
    return out


def write_reports(reports: dict[str, DataFrame], out_dir: str, fmt: str = "csv", mode: str = "errorifexists") -> None:
    """Each (small) report table as one file per table under ``out_dir``;
    create-only by default (an existing table fails), ``mode="overwrite"`` to
    replace."""
    from vigil.sources.io import write_table
    for name, df in reports.items():
        write_table(df, f"{out_dir.rstrip('/')}/{name}", mode=mode, fmt=fmt, single_file=True)


# X6 ----------------------------------------------------------------------------
def fiscal_year_performance(incidents: DataFrame, order_by: Sequence = ("date_of_use", "amb_toc", "agency"),
                            start_month: int = 5, first_fy: int = 2022, last_fy: int = 2027):
    """(per fiscal year: survival, n, percent) and (mean_n, mean_pct)."""
    u = unique_incidents(incidents, order_by).withColumn(
        "fiscal_year", TM.fiscal_year("date_of_use", start_month, first_fy, last_fy))
    per, summary = A.mean_of_group_rates(u, "fiscal_year", F.col("survival") == "Survived",
                                         n="n", hits="survival", rate="percent")
    return per.orderBy("fiscal_year"), summary


def map_frame(table: DataFrame, geometry: str = "geometry", value: str = "data_value") -> DataFrame:
    """One row for drawing a map table: the area-weighted centroid of all its
    polygons (projection centre) and the NULL-skipping min / max of the
    measure (colour range), in ONE aggregation pass."""
    t = table.select(polygon_terms(F.col(geometry)).alias("t"), F.col(value).alias("v"))
    s = t.agg(F.sum("t.a2").alias("a2"), F.sum("t.cx6").alias("cx6"), F.sum("t.cy6").alias("cy6"),
              F.min("v").alias("min_value"), F.max("v").alias("max_value"))
    return s.select(F.try_divide(F.col("cx6"), 3.0 * F.col("a2")).alias("cx"),
                    F.try_divide(F.col("cy6"), 3.0 * F.col("a2")).alias("cy"), "min_value", "max_value")


# G4 / X7 -----------------------------------------------------------------------
def map_boundaries(states: DataFrame, counties: DataFrame, state_fips: str = R.STATE_FIPS,
                   excluded_states: Sequence[str] = tuple(R.NON_CONTINENTAL_STATE_FIPS)) -> tuple[DataFrame, DataFrame]:
    """The boundaries that the maps show: states outside ``excluded_states``, and one state's counties with
    their composite code ``COUNTYFIPS``.  Codes may come unpadded or as numbers; a boundary without a code stays among the states."""
    code = pad_left(F.col("STATEFP").cast("string"), 2)
    inside = F.coalesce(~code.isin(list(excluded_states)), F.lit(True))
    own = counties.where(code == state_fips).withColumn("COUNTYFIPS", composite_fips(F.col("STATEFP").cast("string"), F.col("COUNTYFP").cast("string")))
    return states.where(inside), own


def mortality_tables(measure: DataFrame, state_boundaries: DataFrame, county_boundaries: DataFrame,
                     county_attrs: DataFrame, state_abbr: str = "IA", state_fips: str = R.STATE_FIPS,
                     excluded_states: Sequence[str] = tuple(R.NON_CONTINENTAL_STATE_FIPS)) -> dict[str, DataFrame]:
    """Overall-strata measure -> state map table, county map table (with district) and the national value.

    Boundaries are filtered first (``map_boundaries``): the state table keeps every state boundary but the
    ``excluded_states``, the county table every county of ``state_fips``; a boundary without a measure has NULLs."""
    state_boundaries, cb = map_boundaries(state_boundaries, county_boundaries, state_fips, excluded_states)
    m = measure.where((F.col("stratification1") == "Overall") & (F.col("stratification2") == "Overall"))
    state = (m.withColumn("locationid", pad_left(F.col("locationid").cast("string"), 2))
             .where(F.col("geographiclevel") == "State"))
    state_tbl = right_lookup(state, state_boundaries, "locationid", "STATEFP")
    county = (m.withColumn("locationid", pad_left(F.col("locationid").cast("string"), 3))
              .where((F.col("geographiclevel") == "County") & (F.col("locationabbr") == state_abbr)))
    county_tbl = right_lookup(county, cb, "locationid", "COUNTYFIPS")
    county_tbl = county_tbl.withColumn("COUNTY_NAME", squish(remove_first("locationdesc", r"\s+county$", True)))
    attrs = county_attrs.select("county", "region_preparedness")
    county_tbl = left_lookup(county_tbl, attrs, "COUNTY_NAME", "county", ["region_preparedness"])
    national = m.where(F.col("geographiclevel") == "Nation").select("data_value")
    return {"state": state_tbl, "county": county_tbl, "national": national}

import datetime as dt

import duckdb
from pyspark.sql import functions as F

from fixtures import (COUNTY_ATTR_SCHEMA, COUNTY_ATTRS, COUNTY_CODES, INCIDENT_SCHEMA, INCIDENTS, MEASURE,
                      MEASURE_SCHEMA, PLACES, RUN_COLS, RUN_TYPES, RUNS, clock)
from vigil.plans import catalog, oracle
from vigil.plans import gazetteer as G
from vigil.plans import incidents as I
from vigil.plans import reports as RP
from vigil.plans import runs as RU
from vigil.sources.io import apply_type_spec


def gaz(spark):
    places = spark.createDataFrame(PLACES, G.PLACE_SCHEMA)
    codes = spark.createDataFrame(COUNTY_CODES, G.COUNTY_CODE_SCHEMA)
    attrs = spark.createDataFrame(COUNTY_ATTRS, COUNTY_ATTR_SCHEMA)
    return G.build_gazetteer(spark, places, codes, attrs), attrs


def test_build_gazetteer(spark):
    g, _ = gaz(spark)
    got = {r.name: r for r in g.collect()}
    assert "TROY" not in got                       # excluded pair (TROY, Lucas); "(historical)" stripped first
    assert "MINNEAPOLIS" not in got and "DES MOINES RIVER" not in got
    assert got["WEST DES MOINES"].name_county == "Polk" and got["WEST DES MOINES"].district == "1A"
    assert got["ADAIR"].admin2_code == "001" and got["ADAIR"].county_fips == "19001"
    assert got["MELCHER-DALLAS"].name_county == "Marion"
    assert got["DESOTO"].district == "1A" and got["DESOTO"].county_fips == "19049"
    assert len([n for n in got if n in {m[0] for m in G.MANUAL_PLACES}]) == 7
    assert g.schema["geonameid"].dataType.simpleString() == "string"


def test_build_incidents(spark):
    g, _ = gaz(spark)
    raw = spark.createDataFrame(INCIDENTS, INCIDENT_SCHEMA)
    inc = I.build_incidents(raw, g)
    r = inc.orderBy("date_of_use", "amb_toc").collect()
    by_loc = {x.location_city_event: x for x in r}
    a = by_loc["West Des Moines"]
    assert a.amb_pat_timestamp_fix == dt.datetime(2022, 3, 2, 0, 10)
    assert a.time_aed_off == clock(0, 5) and a.time_aed_off_timestamp_fix == dt.datetime(2022, 3, 2, 0, 5)
    assert a.total_time_aed_used == 10.0 and a.time_from_call_to_patient == 20.0
    assert a.age_range == "05-09" and a.age_unit == "Years" and a.agency_type == "PD"
    assert a.location == "WEST DES MOINES" and a.county_fips == "19153" and a.survival == "Survived"
    assert a.utstein_survival is True and a.call_type == "Cardiac Arrest"
    b = by_loc["Des Moines"]                          # fair grounds rewrite
    assert b.amb_pat_timestamp_fix == dt.datetime(2022, 3, 1, 23, 10)   # hour rule: not repaired
    assert b.time_aed_off is None and b.total_time_aed_used is None     # zero-length use -> unknown
    assert b.location == "DES MOINES" and b.age_range == "00-04" and b.survival == "Deceased"
    assert b.call_type == "Overdose" and b.agency_type == "ISP"
    c = by_loc["Polk Co"]
    assert c.time_aed_off is None and c.location_city_event_clean == "" and c.location is None
    assert c.call_type == "Other Cause" and c.age_unit == "Not Recorded"
    d = by_loc["MEDIC AMBULANCE"]
    assert d.agency == "Not Recorded" and d.agency_type == "Unknown" and d.location is None
    assert by_loc["Melcher-Dallas"].location == "MELCHER-DALLAS" and by_loc["Melcher-Dallas"].agency_type == "SO"
    assert by_loc["Somewhere nowhere"].location is None
    assert inc.select("unique_incident_id").distinct().count() == len(INCIDENTS)
    coded = I.build_incidents(raw, g, aed_off_missing="zero", location_fallback="").collect()
    cc = {x.location_city_event: x for x in coded}
    assert cc["Polk Co"].time_aed_off == 0 and cc["Somewhere nowhere"].location == ""
    assert cc["MEDIC AMBULANCE"].location == ""   # already blanked by the rules, so the guard never fires


def test_reports_run_and_conserve_counts(spark):
    g, _ = gaz(spark)
    inc = I.build_incidents(spark.createDataFrame(INCIDENTS, INCIDENT_SCHEMA), g)
    reps = RP.report_set(inc)
    n = reps["total_deployments"].first().n
    assert n == len(INCIDENTS)
    assert sum(r.n for r in reps["deployments_by_district"].collect()) == n
    assert sum(r["count"] for r in reps["deployments_by_year"].collect()) == n
    assert abs(sum(r.percent for r in reps["deployments_by_calltype"].collect()) - 1) < 1e-12
    for name, df in reps.items():
        df.collect()
    per, summary = RP.fiscal_year_performance(inc)
    fy = {r.fiscal_year: r for r in per.collect()}
    assert set(fy) == {"FY2022", "FY2024"} and fy["FY2022"].n == 2
    s = summary.first()
    assert s.mean_n == 3.0


def test_build_runs(spark):
    raw = spark.createDataFrame(RUNS, ", ".join(f"{c} {t}" for c, t in zip(RUN_COLS, RUN_TYPES)))
    attrs = spark.createDataFrame(COUNTY_ATTRS, COUNTY_ATTR_SCHEMA)
    runs = RU.build_runs(raw, attrs, base_order=[RU.PROC_TIME, RU.PROC_DESC])
    got = {r.fact_incident_pk: r for r in runs.collect()}
    assert set(got) == {"r1", "r2", "r3"}
    r1 = got["r1"]
    assert r1.shocks == 3                                     # 1 (missing attempts) + 2
    assert r1[RU.PROC_TIME] == "2024-01-05 10:11:00, 2024-01-05 10:12:00, 2024-01-05 10:15:00"
    assert r1[RU.PROC_DESC] == "Airway - suction, Defibrillation, AED, CV - Cardioversion"
    assert r1[RU.COMPLAINT] == "Unconscious, Cardiac arrest"
    assert r1[RU.PROC_ATTEMPTS] == "1, 2"                     # missing attempts skipped (no token)
    assert r1[RU.MED] == "Amiodarone, Epinephrine" and r1.county_fips == "19153" and r1.region_preparedness == "1A"
    assert r1[RU.CPR_PRIOR] == "yes" and r1.witnessed is True and r1[RU.CPR_WHO] == "Bystander"
    assert r1[RU.TO_SCENE] == 6.5 and r1[RU.TO_PATIENT] == 9.0
    r2 = got["r2"]
    assert r2[RU.OUTCOME] == "Expired in the Field" and r2.survival is False and r2.expire_field is True
    assert r2.witnessed is False and r2[RU.CPR_PRIOR] == "Not Recorded" and r2.county_fips == "19007"
    assert r2[RU.TO_PATIENT] == 14.5                          # median of 9.0 and 20.0
    assert r2.shocks is None
    r3 = got["r3"]
    assert r3.county_id is None and r3.county_fips is None and r3.rosc_field is True
    assert got["r3"].incident_day == "Friday" and got["r3"].season == "Winter"


def test_typed_ingest_for_runs(spark):
    raw = spark.createDataFrame([("1", "x")], "`Fact Incident PK` string, `Agency Number (dAgency.02)` string")
    out = apply_type_spec(raw, ["bigint", "string"])
    assert out.columns == ["fact_incident_pk", "agency_number_d_agency_02"]


def test_mortality_tables(spark):
    m = spark.createDataFrame(MEASURE, RP_SCHEMA := MEASURE_SCHEMA)  # noqa: F841
    states = spark.createDataFrame([("19", "Iowa"), ("27", "Minnesota"), ("02", "Alaska")], "STATEFP string, NAME string")
    counties = spark.createDataFrame([("19", "153"), ("19", "1"), ("27", "153"), ("02", "001"), (None, "003")], "STATEFP string, COUNTYFP string")
    attrs = spark.createDataFrame(COUNTY_ATTRS, COUNTY_ATTR_SCHEMA)
    t = RP.mortality_tables(m, states, counties, attrs)
    st = {r.STATEFP: r.data_value for r in t["state"].collect()}
    assert st == {"19": 310.0, "27": None}
    ct = {r.COUNTYFIPS: r for r in t["county"].collect()}
    assert set(ct) == {"19153", "19001"}
    assert ct["19153"].data_value == 320.0 and ct["19153"].COUNTY_NAME == "Polk" and ct["19153"].region_preparedness == "1A"
    assert ct["19001"].data_value is None
    assert [r.data_value for r in t["national"].collect()] == [300.0]


def test_mortality_county_keeps_every_county(spark, tmp_path):
    nations = [(k, f"NATION {k}", k % 5) for k in range(12)]
    spark.createDataFrame(nations, "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(k, f"REGION {k}") for k in range(5)], "r_regionkey int, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    spark.createDataFrame([(k, k, 10.0 * k) for k in range(12)], "c_custkey int, c_nationkey int, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    got = {r.COUNTYFIPS: r for r in catalog.mortality_county(spark, str(tmp_path)).collect()}
    assert sorted(got) == [f"19{k:03d}" for k in range(12)]      # those of the other state are left out, none of its own
    assert [got[f"19{k:03d}"].data_value for k in (7, 8)] == [70.0, 80.0] and got["19003"].NAME == "NATION 3"
    con = duckdb.connect()
    for t in ("nation", "region", "customer"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    assert {r[0] for r in con.sql(f'SELECT "COUNTYFIPS" FROM ({oracle.oracle_sql()["mortality_county"]})').fetchall()} == set(got)


def test_layout_and_report_writer(spark):
    import os
    import tempfile
    g, _ = gaz(spark)
    inc = I.build_incidents(spark.createDataFrame(INCIDENTS, INCIDENT_SCHEMA), g)
    cols = inc.columns
    assert cols[0] == "unique_incident_id" and cols[cols.index("date_of_use") + 1] == "year"
    assert cols[cols.index("amb_pat_timestamp") + 1] == "amb_pat_timestamp_fix"
    assert cols[cols.index("location") + 1] == "name_county"
    d = tempfile.mkdtemp(prefix="vigil-rep-", dir="/tmp")
    reps = RP.report_set(inc)
    RP.write_reports({k: reps[k] for k in ("deployments_by_year", "gender_distribution")}, d)
    assert spark.read.option("header", "true").csv(os.path.join(d, "deployments_by_year")).count() == 2
    import pytest
    with pytest.raises(Exception):
        RP.write_reports({"deployments_by_year": reps["deployments_by_year"]}, d)


def test_incident_build_ngram_path_equals_regex_path(spark):
    g, _ = gaz(spark)
    raw = spark.createDataFrame(INCIDENTS, INCIDENT_SCHEMA)
    cols = ["unique_incident_id", "location", "county_fips", "district"]
    a = sorted(map(tuple, I.build_incidents(raw, g).select(cols).collect()), key=str)
    b = sorted(map(tuple, I.build_incidents(raw, g, place_method="ngram").select(cols).collect()), key=str)
    assert a == b


def test_build_runs_as_coded_missing_tokens(spark):
    raw = spark.createDataFrame(RUNS, ", ".join(f"{c} {t}" for c, t in zip(RUN_COLS, RUN_TYPES)))
    attrs = spark.createDataFrame(COUNTY_ATTRS, COUNTY_ATTR_SCHEMA)
    runs = RU.build_runs(raw, attrs, base_order=[RU.PROC_TIME, RU.PROC_DESC], missing_token="missing")
    got = {r.fact_incident_pk: r for r in runs.collect()}
    assert set(got) == {"r1", "r2", "r3", "r5"}                # a missing 7-character agency number passes
    assert got["r1"][RU.PROC_ATTEMPTS] == "1, missing, 2"        # missing printed, as coded
    assert got["r3"].county_fips == "19missing"
    assert got["r2"][RU.MED] == "missing"


def test_incident_fanout_guard(spark):
    import pytest
    g, _ = gaz(spark)
    dup = g.unionByName(g.where("name = 'DES MOINES'").withColumn("name_county", F.lit("Warren")))
    raw = spark.createDataFrame(INCIDENTS, INCIDENT_SCHEMA)
    assert I.build_incidents(raw, dup).count() == len(INCIDENTS) + 1        # as coded: the row multiplies
    with pytest.warns(UserWarning, match="DES MOINES"):
        I.build_incidents(raw, dup, on_fanout="warn")
    with pytest.raises(ValueError):
        I.build_incidents(raw, dup, on_fanout="raise")
    I.build_incidents(raw, g, on_fanout="raise")                              # unique names: fine

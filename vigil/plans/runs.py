"""Registry extract (one row per run x procedure x medication) -> one
row per run.

Plan shape: agency filter -> parse/derive (narrow) -> ONE aggregation per run
key that keeps the run's first row, builds the procedure and medication
texts and counts shocks (one shuffle, partially aggregated) -> flags,
exact-median imputation (distributed ranked quantile), FIPS and the
county-attribute join (broadcast by Catalyst/AQE when small).
"""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions import conditions as C
from vigil.functions import rules as R
from vigil.functions import times as TM
from vigil.functions.strings import code_length_is, strip_chars
from vigil.operators.collapse import Side, collapse_rows, shock_count, shock_rows
from vigil.operators.impute import impute_median
from vigil.operators.columns import apply_layout
from vigil.operators.joins import left_lookup
from vigil.session import checkpointed

KEY = "fact_incident_pk"
DATE = "incident_date"
DATE_TIMES = ["incident_date_time", "incident_unit_notified_by_dispatch_date_time_e_times_03",
              "incident_unit_arrived_on_scene_date_time_e_times_06",
              "incident_unit_arrived_at_patient_date_time_e_times_07", "procedure_performed_date_time_e_procedures_01"]
DISPATCH = "incident_unit_notified_by_dispatch_date_time_e_times_03"
SCENE = "incident_unit_arrived_on_scene_date_time_e_times_06"
PATIENT = "incident_unit_arrived_at_patient_date_time_e_times_07"
TO_SCENE = "incident_dispatch_notified_to_unit_arrived_on_scene_in_minutes"
TO_PATIENT = "incident_dispatch_notified_to_unit_arrived_at_patient_in_minutes"
COMPLAINT = "incident_complaint_reported_by_dispatch_dispatch_reason_e_dispatch_01"
PROC_DESC = "procedure_performed_description_e_procedures_03"
PROC_TIME = "procedure_performed_date_time_e_procedures_01"
PROC_ATTEMPTS = "procedure_number_of_attempts_e_procedures_05"
MED = "medication_given_or_administered_description_e_medications_03"
MED_RESPONSE = "medication_response_e_medications_07"
AGENCY_NUMBER = "agency_number_d_agency_02"
WITNESSED_BY = "cardiac_arrest_witnessed_by_list_e_arrest_04"
CPR_PRIOR = "cardiac_arrest_cpr_provided_prior_to_ems_arrival_3_4_e_arrest_05_3_5_it_arrest_105"
CPR_WHO = "cardiac_arrest_who_provided_cpr_prior_to_ems_arrival_list_3_4_e_arrest_06_3_5_it_arrest_106"
OUTCOME = "cardiac_arrest_patient_outcome_at_end_of_ems_event_e_arrest_18"
DISPOSITION = "disposition_incident_patient_disposition_3_4_e_disposition_12_3_5_it_disposition_112"
STATE = "scene_incident_state_gnis_e_scene_18"
COUNTY = "scene_incident_county_gnis_e_scene_21"
OVERDOSE = "situation_possible_overdose"


LAYOUT = [
    (["incident_day", "incident_month", "weekday_weekend", "season"], "after", DATE),
    (COMPLAINT, "after", "agency_name_d_agency_03"),
    ([PROC_DESC, PROC_TIME, PROC_ATTEMPTS], "after", CPR_WHO),
    ("shocks", "after", PROC_ATTEMPTS),
    ([MED, MED_RESPONSE], "after", OUTCOME),
]


def prepare_runs(raw: DataFrame, missing_token: str | None = None) -> DataFrame:
    """7-character agency numbers only -> parsed dates -> dispatch intervals.
    Rows that repeat need no ``distinct`` of their own: every aggregate of the
    collapse works on distinct sub-rows or keeps one row."""
    x = raw.where(code_length_is(AGENCY_NUMBER, 7, missing_token))
    x = x.withColumns({DATE: TM.parse_mdy(DATE), **{c: TM.parse_mdy_hms(c) for c in DATE_TIMES}})
    return x.withColumns({TO_SCENE: TM.minutes_between(SCENE, DISPATCH),
                          TO_PATIENT: TM.minutes_between(PATIENT, DISPATCH),
                          CPR_WHO: strip_chars(CPR_WHO, '"')})


def build_runs(raw: DataFrame, county_attrs: DataFrame, base_order: Sequence[str],
               side_order: Sequence[str] = (PROC_TIME, PROC_DESC, PROC_ATTEMPTS, COMPLAINT),
               defib_pattern: str = R.DEFIB_PATTERN, missing_token: str | None = None,
               median_method: str = "ranked", store: Callable[[DataFrame], DataFrame] = checkpointed) -> DataFrame:
    """One row per run, in two phases.  ``base_order`` orders a run's rows for keep-first
    (the reference keeps the first row in file order); all other columns break
    ties, so the result doesn't depend on partitioning.  ``side_order`` orders the
    joined procedure texts.  ``store``
    keeps the collapsed runs (a reliable checkpoint by default, or a written table): every input row is read and parsed once, and the medians
    read two columns of what is stored.  ``store=lambda df: df`` keeps the plan lazy, and reads the input twice."""
    x = prepare_runs(raw, missing_token)
    proc_cols = list(dict.fromkeys([*side_order, COMPLAINT, PROC_DESC, PROC_TIME, PROC_ATTEMPTS]))
    procedures = Side(columns=proc_cols, order=list(side_order), outputs={
        COMPLAINT: (COMPLAINT, "distinct"), PROC_DESC: (PROC_DESC, "distinct"),
        PROC_TIME: (PROC_TIME, "all"), PROC_ATTEMPTS: (PROC_ATTEMPTS, "all")})
    meds = Side(columns=[MED, MED_RESPONSE], outputs={MED: (MED, "all"), MED_RESPONSE: (MED_RESPONSE, "all")})
    shocks = shock_rows(PROC_DESC, PROC_TIME, PROC_ATTEMPTS, defib_pattern)
    runs = collapse_rows(x, KEY, list(base_order), [procedures, meds], {"__shocks": shocks}, missing_token)
    runs = runs.withColumn("shocks", shock_count(F.col("__shocks"))).drop("__shocks")
    runs = runs.withColumns({"incident_day": TM.day_name(DATE), "incident_month": TM.month_name(DATE),
                             "weekday_weekend": TM.is_weekend(DATE), "season": TM.season(DATE)})
    runs = runs.withColumns({"witnessed": C.witnessed_from_text(WITNESSED_BY),
                             CPR_PRIOR: C.cpr_prior_to_arrival(CPR_PRIOR, CPR_WHO),
                             OVERDOSE: F.coalesce(OVERDOSE, F.lit(False)),
                             OUTCOME: C.repair_outcome(OUTCOME, DISPOSITION)})
    runs = impute_median(store(runs), [TO_PATIENT, TO_SCENE], method=median_method)
    runs = runs.withColumns({**C.outcome_flags(OUTCOME),
                             f"length_{COUNTY}": F.length(F.coalesce(F.col(COUNTY).cast("string"), F.lit("")))})
    runs = runs.withColumns({"county_id": C.county_id(COUNTY),
                             "county_fips": C.county_fips(STATE, COUNTY, missing_token)})
    out = left_lookup(runs, county_attrs, "county_fips", "county_fips", [c for c in county_attrs.columns if c != "county_fips"])
    return apply_layout(out, LAYOUT)

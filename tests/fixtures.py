"""Hand-written domain fixtures (FIXTURES.md section B)."""
import datetime as dt

H = 3_600_000_000
M = 60_000_000
S = 1_000_000


def clock(h, m=0, s=0):
    return h * H + m * M + s * S


INCIDENT_SCHEMA = (
    "date_of_use date, amb_toc long, amb_pat long, time_aed_on long, total_time_aed_actually_used_min_sec long, "
    "location_city_event string, agency string, age double, age_unit string, sex string, witnessed boolean, "
    "unknown_if_witnessed boolean, bystander_cpr boolean, shock_no_shock int, cardiac_episode boolean, "
    "od_case boolean, other_case string, expired_scene boolean, expired_in_er boolean, expired_in_hospital boolean")

D1 = dt.date(2022, 3, 1)
D2 = dt.date(2023, 7, 4)
INCIDENTS = [
    # rollover toc 23:50 -> pat 00:10 ; AED on 23:55 used 10 min (crosses midnight)
    (D1, clock(23, 50), clock(0, 10), clock(23, 55), clock(0, 10), "West Des Moines", "West Des Moines PD",
     4.5, "years", "F", True, None, True, 1, True, None, None, False, None, None),
    # same-hour 23:50 -> 23:10 (not repaired by the hour rule); zero duration
    (D1, clock(23, 50), clock(23, 10), clock(23, 55), 0, "Iowa State Fair Grounds", "Iowa State Patrol ISP",
     400.0, "Days", "M", False, False, None, 0, None, True, None, None, True, None),
    # null duration; null AED-on
    (D2, clock(10, 0), clock(10, 7), None, None, "Polk Co", "Polk County SO", 30.0, None, None, None, True,
     False, 2, False, False, "Fall", None, None, True),
    (D2, clock(11, 0), clock(11, 9), clock(11, 12), clock(0, 3, 30), "MEDIC AMBULANCE", None, 67.0, "Years",
     "U", True, None, True, 3, None, None, "Fall", None, None, None),
    (D2, clock(12, 0), clock(12, 5), clock(12, 6), clock(0, 1), "Melcher-Dallas", "Story S0", 85.0, "Years", "M",
     True, None, True, 1, True, False, None, None, None, None),
    (D2, clock(13, 0), clock(13, 5), clock(13, 6), clock(0, 1), "Somewhere nowhere", "Iowa DNR", 50.0, "Years",
     "F", None, None, None, None, None, None, None, None, None, None),
]

PLACES = [
    (1, "Des Moines", "AMES", "", 41.6, -93.6, "P", "PPLA", "US", None, "IA", "153", None, None, 200000, 250.0, None,
     "America/Chicago", None),
    (2, "West Des  Moines", None, None, 41.57, -93.7, "P", "PPL", "US", None, "IA", "153", None, None, 60000, None,
     None, None, None),
    (3, "Melcher-Dallas", None, None, 41.2, -93.2, "P", "PPL", "US", None, "IA", "125", None, None, 1200, None, None,
     None, None),
    (4, "Troy (historical)", None, None, 40.7, -92.4, "P", "PPL", "US", None, "IA", "117", None, None, 0, None, None,
     None, None),
    (5, "Adair", None, None, 41.5, -94.6, "P", "PPL", "US", None, "IA", "1", None, None, 700, None, None, None, None),
    (6, "Minneapolis", None, None, 45.0, -93.2, "P", "PPL", "US", None, "MN", "053", None, None, 400000, None, None,
     None, None),
    (7, "Des Moines River", None, None, 41.0, -91.0, "H", "STM", "US", None, "IA", "153", None, None, 0, None, None,
     None, None),
]
COUNTY_CODES = [("US.IA.153", "Polk County", "Polk County", 1), ("US.IA.125", "Marion County", "Marion County", 2),
                ("US.IA.117", "Lucas County", "Lucas County", 3), ("US.IA.001", "Adair County", "Adair County", 4),
                ("US.MN.053", "Hennepin County", "Hennepin County", 5), ("CA.08.001", "Other", "Other", 6)]
COUNTY_ATTRS = [("Polk", "19153", "1A", "Metro", "Urban"), ("Marion", "19125", "5", "Rural", "Rural"),
                ("Lucas", "19117", "5", "Rural", "Rural"), ("Adair", "19001", "4", "Rural", "Rural"),
                ("Dallas", "19049", "1A", "Metro", "Urban")]
COUNTY_ATTR_SCHEMA = "county string, county_fips string, region_preparedness string, designation string, urbanicity string"

RUN_COLS = ["fact_incident_pk", "incident_date", "incident_date_time",
            "incident_unit_notified_by_dispatch_date_time_e_times_03",
            "incident_unit_arrived_on_scene_date_time_e_times_06",
            "incident_unit_arrived_at_patient_date_time_e_times_07",
            "procedure_performed_date_time_e_procedures_01", "procedure_performed_description_e_procedures_03",
            "procedure_number_of_attempts_e_procedures_05",
            "medication_given_or_administered_description_e_medications_03", "medication_response_e_medications_07",
            "incident_complaint_reported_by_dispatch_dispatch_reason_e_dispatch_01", "agency_number_d_agency_02",
            "agency_name_d_agency_03", "cardiac_arrest_witnessed_by_list_e_arrest_04",
            "cardiac_arrest_cpr_provided_prior_to_ems_arrival_3_4_e_arrest_05_3_5_it_arrest_105",
            "cardiac_arrest_who_provided_cpr_prior_to_ems_arrival_list_3_4_e_arrest_06_3_5_it_arrest_106",
            "cardiac_arrest_who_initiated_cpr_3_4_it_arrest_008_3_5_e_arrest_20", "situation_possible_overdose",
            "cardiac_arrest_patient_outcome_at_end_of_ems_event_e_arrest_18",
            "disposition_incident_patient_disposition_3_4_e_disposition_12_3_5_it_disposition_112",
            "scene_incident_state_gnis_e_scene_18", "scene_incident_county_gnis_e_scene_21"]
RUN_TYPES = ["string"] * 8 + ["int"] + ["string"] * 9 + ["boolean"] + ["string"] * 4


def run(pk, proc_time, desc, attempts, med, resp, complaint="Cardiac arrest", agency="1234567", outcome=None,
        disp="Transported", county="153", patient="1/5/2024 10:09:00", who='"Bystander"', witnessed="Bystander"):
    return (pk, "1/5/2024", "1/5/2024 10:00:00", "1/5/2024 10:00:00", "1/5/2024 10:06:30", patient, proc_time,
            desc, attempts, med, resp, complaint, agency, "Agency", witnessed, None, who, None, None, outcome,
            disp, "19", county)


RUNS = [
    run("r1", "1/5/2024 10:12:00", "Defibrillation, AED", None, "Epinephrine", "Unchanged"),
    run("r1", "1/5/2024 10:12:00", "Defibrillation, AED", None, "Epinephrine", "Unchanged"),   # exact duplicate
    run("r1", "1/5/2024 10:15:00", "CV - Cardioversion", 2, "Amiodarone", "Improved"),
    run("r1", "1/5/2024 10:11:00", "Airway - suction", 1, "Epinephrine", "Unchanged", complaint="Unconscious"),
    run("r2", "1/5/2024 11:00:00", "Airway - suction", 1, None, None, outcome="Not Applicable", disp="Dead at scene",
        county="7", patient=None, who=None, witnessed="Not witnessed"),
    run("r3", "1/5/2024 12:00:00", "Defibrillation, AED", 3, None, None, outcome="ROSC in the Field", county="",
        patient="1/5/2024 10:20:00"),
    run("r4", "1/5/2024 12:00:00", "Defibrillation, AED", 3, None, None, agency="123456"),       # filtered out
    run("r5", "1/5/2024 12:00:00", "Defibrillation, AED", 3, None, None, agency=None),            # filtered out
]

MEASURE_SCHEMA = ("stratification1 string, stratification2 string, geographiclevel string, locationid string, "
                  "locationabbr string, locationdesc string, data_value double")
MEASURE = [("Overall", "Overall", "Nation", "59", "US", "United States", 300.0),
           ("Overall", "Overall", "State", "19", "IA", "Iowa", 310.0),
           ("Overall", "Overall", "State", "2", "AK", "Alaska", 200.0),
           ("Overall", "Overall", "County", "19153", "IA", "Polk County", 320.0),
           ("Overall", "Overall", "County", "27053", "MN", "Hennepin County", 250.0),
           ("Male", "Overall", "State", "19", "IA", "Iowa", 400.0)]

"""Incident (device deployment) analytic table.

One lazy plan of narrow projections: surrogate id, timestamps with midnight
rollover repair, AED-off clock time, interval family, age normalisation,
agency rules, place-name cleaning, dictionary extraction of the place and a
left join of the gazetteer attributes.  Shuffles: the numbering of repeated rows
and the gazetteer join (broadcast by Catalyst/AQE when small; the n-gram
extraction path adds a join for large dictionaries).  Each ``withColumns`` call is one
of the reference's simultaneous mutate blocks.
"""
from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions import conditions as C
from vigil.functions import rules as R
from vigil.functions import times as TM
from vigil.functions.ids import surrogate_id, with_surrogate_id
from vigil.functions.rules import apply_rules
from vigil.functions.strings import squish, to_title
from vigil.operators.columns import apply_layout, pull
from vigil.operators.dedup import duplicate_keys
from vigil.operators.joins import left_lookup
from vigil.operators.places import clean_place, extract_dictionary, fair_grounds_city
from vigil.session import checkpointed

GAZETTEER_ATTRS = ["name_county", "county_fips", "district", "designation", "urbanicity", "asciiname",
                   "latitude", "longitude", "population", "elevation"]
# the reference's column layout, applied once at the end (metadata only)
LAYOUT = [
    ("unique_incident_id", "before", "date_of_use"), ("year", "after", "date_of_use"),
    ("amb_toc_timestamp", "after", "amb_toc"), ("amb_pat_timestamp", "after", "amb_pat"),
    ("amb_pat_timestamp_fix", "after", "amb_pat_timestamp"), ("time_aed_on_timestamp", "after", "time_aed_on"),
    ("time_aed_off", "after", "total_time_aed_actually_used_min_sec"),
    ("time_aed_off_timestamp", "after", "time_aed_off"),
    ("time_aed_off_timestamp_fix", "after", "time_aed_off_timestamp"),
    ("age_years", "after", "age_unit"), ("age_range", "after", "age_years"), ("agency_type", "after", "agency"),
    ("call_type", "after", "other_case"), ("location_city_event_clean", "after", "location_city_event"),
    ("location", "after", "location_city_event_clean"),
]
INTERVALS = {
    "time_from_call_to_patient": ("amb_toc_timestamp", "amb_pat_timestamp_fix"),
    "time_from_call_to_aed_on": ("amb_toc_timestamp", "time_aed_on_timestamp"),
    "time_from_patient_to_aed": ("amb_pat_timestamp_fix", "time_aed_on_timestamp"),
    "total_time_aed_used": ("time_aed_on_timestamp", "time_aed_off_timestamp_fix"),
    "time_at_patient_to_end_aed": ("amb_pat_timestamp_fix", "time_aed_off_timestamp_fix"),
    "time_from_call_to_end_aed": ("amb_toc_timestamp", "time_aed_off_timestamp_fix"),
}


def build_incidents(raw: DataFrame, gazetteer: DataFrame, id_cols: Sequence[str] | None = None,
                    seed: int = R.INCIDENT_ID_SEED, rollover: str = "hour", aed_off_missing: str = "null",
                    utstein_as_coded: bool = False, place_method: str = "auto",
                    location_fallback: str | None = None, county_suffix_as_coded: bool = False,
                    on_fanout: str = "keep") -> DataFrame:
    """Typed incident rows (see FIXTURES B1) -> analytic table.

    ``id_cols``: columns hashed into ``unique_incident_id`` (default: all input
    columns), with a number for rows that repeat them, so every row has its own id.  ``location_fallback``: None keeps NULL when no place is found,
    ``""`` reproduces the as-coded empty string, ``"text"`` falls back to the
    cleaned text.  ``on_fanout``: a place name listed under several counties
    multiplies incident rows in the attribute join; ``"keep"`` leaves that as
    is (as coded), ``"warn"`` / ``"raise"`` report such names first (one
    bounded aggregate over the gazetteer).  The gazetteer is checkpointed while the plan
    is built; the incidents themselves stay lazy."""
    gazetteer = checkpointed(gazetteer)   # a dimension that is read four times: its build runs once
    if on_fanout != "keep":
        dup = [r[0] for r in duplicate_keys(gazetteer.select("name"), ["name"]).limit(20).collect()]
        if dup:
            msg = f"gazetteer names listed more than once (incident rows would multiply): {dup}"
            if on_fanout == "raise":
                raise ValueError(msg)
            warnings.warn(msg, stacklevel=2)
    cols = list(id_cols or raw.columns)
    if raw.isStreaming:   # a stream has no row numbers: its ids come from the key columns alone
        x = raw.withColumn("unique_incident_id", surrogate_id(cols, seed))
    else:
        x = with_surrogate_id(raw, cols, seed, "unique_incident_id")
    x = x.withColumns({
        "amb_toc_timestamp": TM.combine_date_time("date_of_use", "amb_toc"),
        "amb_pat_timestamp": TM.combine_date_time("date_of_use", "amb_pat"),
        "time_aed_on_timestamp": TM.combine_date_time("date_of_use", "time_aed_on"),
        "location_city_event": fair_grounds_city("location_city_event")})
    x = x.withColumn("amb_pat_timestamp_fix",
                     TM.correct_midnight_rollover("amb_toc_timestamp", "amb_pat_timestamp", rollover))
    x = x.withColumn("time_aed_off", TM.add_time_of_day("time_aed_on", "total_time_aed_actually_used_min_sec",
                                                        aed_off_missing))
    x = x.withColumn("time_aed_off_timestamp", TM.combine_date_time("date_of_use", "time_aed_off"))
    x = x.withColumns({"time_aed_off": TM.null_if_equal("time_aed_on", "time_aed_off"),
                       "time_aed_off_timestamp": TM.null_if_equal("time_aed_on_timestamp", "time_aed_off_timestamp")})
    x = x.withColumn("time_aed_off_timestamp_fix",
                     TM.correct_midnight_rollover("time_aed_on_timestamp", "time_aed_off_timestamp", rollover))
    block = TM.interval_columns(INTERVALS)
    block.update({
        "unknown_if_witnessed": F.coalesce("unknown_if_witnessed", F.lit(False)),
        "bystander_cpr": F.coalesce("bystander_cpr", F.lit(False)),
        "utstein_survival": C.utstein("bystander_cpr", "witnessed", "shock_no_shock", utstein_as_coded),
        "age_unit": to_title(F.coalesce("age_unit", F.lit(R.NOT_RECORDED)))})
    x = x.withColumns(block)
    x = x.withColumn("age_years", C.age_in_years("age", "age_unit"))
    x = x.withColumns({"age_range": C.age_band("age_years"),
                       "agency": squish(F.coalesce("agency", F.lit(R.NOT_RECORDED)))})
    counties = sorted(c for c in pull(gazetteer.select("name_county").distinct(), "name_county") if c is not None)
    x = x.withColumns({"agency_type": apply_rules("agency", R.AGENCY_TYPE_RULES, R.AGENCY_TYPE_DEFAULT),
                       "location_city_event_clean": clean_place("location_city_event", counties,
                                                                county_suffix_as_coded)})
    ct = C.call_type("cardiac_episode", "od_case", "other_case")
    x = x.withColumns({**ct, "year": F.year("date_of_use")})
    x = extract_dictionary(x, "location_city_event_clean", gazetteer, "name", "location",
                           method="regex" if raw.isStreaming and place_method == "auto" else place_method)
    if location_fallback == "":
        x = x.withColumn("location", F.when(F.col("location").isNull() & (F.col("location_city_event_clean")
                                                                           != "MEDIC AMBULANCE"), F.lit(""))
                         .otherwise(F.col("location")))
    elif location_fallback == "text":
        x = x.withColumn("location", F.coalesce("location", "location_city_event_clean"))
    x = x.withColumns({f: F.coalesce(f, F.lit(False)) for f in ("expired_scene", "expired_in_er", "expired_in_hospital")})
    x = x.withColumn("survival", C.survival_from_flags("expired_scene", "expired_in_er", "expired_in_hospital"))
    attrs = [c for c in GAZETTEER_ATTRS if c in gazetteer.columns]
    out = left_lookup(x, gazetteer.select("name", *attrs), "location", "name", attrs)
    return apply_layout(out, LAYOUT + [(attrs, "after", "location")])

"""End-to-end build: inputs on storage -> gazetteer, incidents, runs (each
materialized: reused when present, lineage cut) -> report and map tables on storage.

This is the sequence the reference runs as separate scripts, with every
dependency passed explicitly instead of through globals.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from vigil.plans.gazetteer import COUNTY_CODE_SCHEMA, PLACE_SCHEMA, build_gazetteer
from vigil.plans.incidents import build_incidents
from vigil.plans.reports import fiscal_year_performance, map_frame, mortality_tables, report_set, write_reports
from vigil.plans.runs import OVERDOSE, PROC_ATTEMPTS, build_runs
from vigil.sources.io import (apply_type_spec, cast_columns, clean_names, header_from_first_row, materialize, read_csv,
                              read_delimited, rename_with)

COUNTY_ATTR_SCHEMA = ("county string, county_fips string, region_preparedness string, designation string, "
                      "urbanicity string")
MEASURE_SCHEMA = ("stratification1 string, stratification2 string, geographiclevel string, locationid string, "
                  "locationabbr string, locationdesc string, data_value double")
RUN_TYPES = {PROC_ATTEMPTS: "int", OVERDOSE: "boolean"}


@dataclass
class Inputs:
    places_tsv: str          # geonames layout, headerless, tab separated
    county_codes_tsv: str    # code, name, asciiname, geonameID
    county_attrs_csv: str    # county, county_fips, region_preparedness, designation, urbanicity (header)
    incidents: str           # parquet: typed FIXTURES B1 columns, or (with incident_types) a text grid
    runs_csv: str            # registry extract under its own headers
    incident_types: Sequence[str] | None = None   # types by position: the grid's first row holds the names
    incident_row: str = "row"                     # the grid's row number
    measure_csv: str | None = None                # mortality measure (header); with the two boundary tables
    state_boundaries: str | None = None           # parquet: STATEFP, NAME[, geometry]
    county_boundaries: str | None = None          # parquet: STATEFP, COUNTYFP, NAME[, geometry]


def read_incidents(spark: SparkSession, paths: Inputs) -> DataFrame:
    """Typed incident rows: as stored, or a sheet's text cells with the header row
    made names and every column cast (bad cells fail)."""
    grid = spark.read.parquet(paths.incidents)
    if paths.incident_types is None:
        return grid
    return apply_type_spec(header_from_first_row(grid, paths.incident_row), list(paths.incident_types), clean_up=True)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The raw registry extract: names cleaned, brackets dropped, ``=`` to ``_``; codes stay text."""
    raw = clean_names(read_csv(spark, path))
    raw = rename_with(raw, lambda c: c.replace("(", "").replace(")", ""))
    return cast_columns(rename_with(raw, lambda c: c.replace("=", "_")), RUN_TYPES)


def read_inputs(spark: SparkSession, paths: Inputs) -> dict[str, DataFrame]:
    return {
        "places": read_delimited(spark, paths.places_tsv, PLACE_SCHEMA),
        "county_codes": read_delimited(spark, paths.county_codes_tsv, COUNTY_CODE_SCHEMA),
        "county_attrs": read_csv(spark, paths.county_attrs_csv, COUNTY_ATTR_SCHEMA),
        "incidents": read_incidents(spark, paths),
        "runs": read_runs(spark, paths.runs_csv),
    }


def build_mortality(spark: SparkSession, paths: Inputs, county_attrs: DataFrame) -> dict[str, DataFrame]:
    """The map tables and, where the boundaries have geometry, the map's centre and colour range."""
    if not (paths.measure_csv and paths.state_boundaries and paths.county_boundaries):
        return {}
    states = spark.read.parquet(paths.state_boundaries)
    tables = mortality_tables(read_csv(spark, paths.measure_csv, MEASURE_SCHEMA), states,
                              spark.read.parquet(paths.county_boundaries), county_attrs)
    if "geometry" in states.columns:
        tables["state_frame"] = map_frame(tables["state"])
    return {f"mortality_{k}": v for k, v in tables.items()}


def build_all(spark: SparkSession, paths: Inputs, out_dir: str, mode: str = "reuse",
              run_order: tuple[str, ...] = ("incident_unit_notified_by_dispatch_date_time_e_times_03",
                                            "procedure_performed_date_time_e_procedures_01"),
              report_format: str = "csv") -> dict[str, DataFrame]:
    """Build and store gazetteer, incidents, runs and mortality map tables under
    ``out_dir`` (parquet; ``mode="reuse"`` keeps stored results, ``"rebuild"``
    replaces them), then write every report table (one file each, replaced)."""
    x = read_inputs(spark, paths)
    out = out_dir.rstrip("/")
    gaz = materialize(spark, f"{out}/gazetteer",
                      lambda: build_gazetteer(spark, x["places"], x["county_codes"], x["county_attrs"]), mode)
    inc = materialize(spark, f"{out}/incidents", lambda: build_incidents(x["incidents"], gaz), mode)
    runs = materialize(spark, f"{out}/runs", lambda: build_runs(x["runs"], x["county_attrs"], list(run_order)), mode)
    maps = {k: materialize(spark, f"{out}/{k}", lambda v=v: v, mode) for k, v in build_mortality(spark, paths, x["county_attrs"]).items()}
    reports = report_set(inc)   # ~25 reports from one pass over the incidents
    per_fy, fy_summary = fiscal_year_performance(inc)
    reports.update({"fiscal_year": per_fy, "fiscal_year_summary": fy_summary})
    write_reports(reports, f"{out}/reports", fmt=report_format, mode="overwrite")
    return {"gazetteer": gaz, "incidents": inc, "runs": runs, **maps, **reports}

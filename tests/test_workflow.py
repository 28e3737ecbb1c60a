import csv
import os
import tempfile

from fixtures import COUNTY_ATTRS, COUNTY_CODES, INCIDENT_SCHEMA, INCIDENTS, MEASURE, MEASURE_SCHEMA, PLACES, RUN_COLS, RUNS
from vigil.plans.incidents import build_incidents
from vigil.plans.workflow import Inputs, build_all


def _tsv(path, rows):
    with open(path, "w") as f:
        for r in rows:
            f.write("\t".join("" if v is None else str(v) for v in r) + "\n")


def _raw_header(name):
    """A header as an extract has it: capitals, blanks, brackets."""
    return name.replace("_", " ").title() + " ()"


def _grid():
    """The incidents as a sheet's text cells: (row number, cells...), names in the first row, and the types by position."""
    fields = [f.split() for f in INCIDENT_SCHEMA.split(", ")]
    types = ["time" if n in ("amb_toc", "amb_pat", "time_aed_on", "total_time_aed_actually_used_min_sec") else t for n, t in fields]

    def text(v, t):
        if v is None:
            return None if t == "string" else " "
        if t == "time":
            s = v // 1_000_000
            return f"{s // 3600}:{s // 60 % 60:02d}:{s % 60:02d}"
        return str(v)
    rows = [(1, *[n.replace("_", " ").title() for n, _ in fields])]
    return rows + [(k + 2, *[text(v, t) for v, t in zip(r, types, strict=True)]) for k, r in enumerate(INCIDENTS)], types


def test_build_all_end_to_end(spark):
    d = tempfile.mkdtemp(prefix="vigil-wf-", dir="/tmp")
    p = {k: os.path.join(d, k) for k in ("places.tsv", "codes.tsv", "attrs.csv", "incidents", "runs.csv", "out", "measure.csv", "states", "counties")}
    _tsv(p["places.tsv"], PLACES)
    _tsv(p["codes.tsv"], COUNTY_CODES)
    with open(p["attrs.csv"], "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["county", "county_fips", "region_preparedness", "designation", "urbanicity"])
        w.writerows(COUNTY_ATTRS)
    grid, types = _grid()
    spark.createDataFrame(grid, "row int, " + ", ".join(f"c{i} string" for i in range(len(types)))).repartition(3).write.parquet(p["incidents"])
    with open(p["runs.csv"], "w", newline="") as f:
        w = csv.writer(f)
        w.writerow([_raw_header(c) for c in RUN_COLS])
        w.writerows([["" if v is None else v for v in r] for r in RUNS])
    with open(p["measure.csv"], "w", newline="") as f:
        w = csv.writer(f)
        w.writerow([c.split()[0] for c in MEASURE_SCHEMA.split(", ")])
        w.writerows(MEASURE)
    spark.createDataFrame([("19", "Iowa"), ("27", "Minnesota"), ("02", "Alaska"), ("72", "Puerto Rico")], "STATEFP string, NAME string").write.parquet(p["states"])
    spark.createDataFrame([("19", "153", "Polk"), ("19", "001", "Adair"), ("27", "053", "Hennepin"), ("02", "020", "Anchorage")], "STATEFP string, COUNTYFP string, NAME string").write.parquet(p["counties"])
    paths = Inputs(p["places.tsv"], p["codes.tsv"], p["attrs.csv"], p["incidents"], p["runs.csv"], types,
                   measure_csv=p["measure.csv"], state_boundaries=p["states"], county_boundaries=p["counties"])
    out = build_all(spark, paths, p["out"])
    assert out["incidents"].count() == len(INCIDENTS)
    assert out["runs"].count() == 3
    assert out["gazetteer"].where("name = 'WEST DES MOINES'").count() == 1
    assert os.path.isdir(os.path.join(p["out"], "reports", "gender_distribution"))
    typed = build_incidents(spark.createDataFrame(INCIDENTS, INCIDENT_SCHEMA), out["gazetteer"])
    assert out["incidents"].schema.names == typed.schema.names
    assert sorted(map(str, out["incidents"].drop("unique_incident_id").collect())) == sorted(map(str, typed.drop("unique_incident_id").collect()))
    assert out["mortality_state"].where("STATEFP = '19'").first().data_value == 310.0 and out["mortality_county"].count() == 2
    assert out["mortality_state"].count() == 2
    again = build_all(spark, paths, p["out"])          # reuses the stored tables
    assert again["incidents"].count() == len(INCIDENTS)

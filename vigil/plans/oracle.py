"""DuckDB oracle SQL for every registered query (same column names/values).

Written independently of the Spark code paths (CASE chains instead of the
arithmetic used in Spark, literal date ranges for fiscal years, vertex-level
shoelace sums, first-appearance ranks for ordered distinct joins) so the
comparison checks semantics, not a transliteration.
"""
from __future__ import annotations

from vigil.functions import rules as R
from vigil.functions.ids import LETTERS
from vigil.plans.catalog import ANALOG_EXCLUSIONS, PART_RULES
from vigil.plans.gazetteer import MANUAL_PLACES

SURVIVAL = ("CASE o_orderstatus WHEN 'F' THEN 'Deceased' WHEN 'O' THEN 'Survived' "
            "ELSE 'Unknown' END")
TS = "'%Y-%m-%d %H:%M:%S.%f'"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def surrogate_id_sql(key_sql: str | list[str], seed: int) -> str:
    keys = [key_sql] if isinstance(key_sql, str) else list(key_sql)
    part = lambda k: f"coalesce(length(CAST({k} AS VARCHAR)) || ':' || CAST({k} AS VARCHAR) || ';', 'N;')"
    h = f"sha256('{seed};'" + "".join(f" || {part(k)}" for k in keys) + ")"
    letters = " || ".join(
        f"substr('{LETTERS}', (('0x' || substr({h}, {2 * i + 1}, 2))::INTEGER % 52) + 1, 1)" for i in range(10))
    digits = f"CAST(((('0x' || substr({h}, 21, 15))::BIGINT % 9000000000) + 1000000000) AS VARCHAR)"
    return f"({letters} || '-' || {digits})"


def _labels_base() -> str:
    return ("SELECT * FROM (SELECT CASE WHEN doc_id % 10 = 0 THEN NULL ELSE quality = 1 END AS witnessed, "
            "toxic = 1 AS bcpr FROM labels) WHERE witnessed IS NOT NULL AND bcpr IS NOT NULL")


def _pivot_labels() -> str:
    return (f"SELECT witnessed, nullif(count(*) FILTER (WHERE bcpr), 0) AS t, "
            f"nullif(count(*) FILTER (WHERE NOT bcpr), 0) AS f FROM ({_labels_base()}) GROUP BY witnessed")


def _row_totals() -> str:
    return f"SELECT witnessed, count(*) AS n FROM ({_labels_base()}) GROUP BY witnessed"


def _label(n: str, share: str) -> str:
    return f"CAST({n} AS VARCHAR) || ' (' || CAST(round({share} * 100, 2) AS VARCHAR) || '%)'"


def _outcome_pivot(by: str, by_alias: str) -> str:
    return (f"SELECT {by} AS {by_alias}, "
            f"nullif(count(*) FILTER (WHERE s = 'Deceased'), 0) AS \"Deceased\", "
            f"nullif(count(*) FILTER (WHERE s = 'Survived'), 0) AS \"Survived\", "
            f"nullif(count(*) FILTER (WHERE s = 'Unknown'), 0) AS \"Unknown\" "
            f"FROM (SELECT *, {SURVIVAL} AS s FROM orders) GROUP BY 1")


def _squish(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def _fy_case() -> str:
    arms = []
    for fy in range(1996, 2001):
        arms.append(f"WHEN o_orderdate > DATE '{fy - 1}-04-30' AND o_orderdate < DATE '{fy}-05-01' THEN 'FY{fy}'")
    arms.append("WHEN o_orderdate >= DATE '2000-05-01' THEN 'FY2001'")
    return "CASE " + " ".join(arms) + " ELSE 'Unknown' END"


def _age_band(y: str) -> str:
    arms = [f"WHEN {y} IS NULL THEN NULL"]
    for lo in range(0, 85, 5):
        arms.append(f"WHEN {y} <= {lo + 4} THEN '{lo:02d}-{lo + 4:02d}'")
    return "CASE " + " ".join(arms) + " ELSE '85+' END"


def _rules_case(x: str, rules, default: str) -> str:
    arms = []
    for rule in rules:
        pat = ("(?i)" if len(rule) > 2 and rule[2] else "") + rule[0]
        arms.append(f"WHEN regexp_matches(coalesce({x}, ''), {_q(pat)}) THEN {_q(rule[1])}")
    return "CASE " + " ".join(arms) + f" ELSE {default} END"


def _place_raw() -> str:
    return """
      SELECT c.c_custkey, CASE c.c_custkey % 12
        WHEN 0 THEN NULL
        WHEN 1 THEN '  Rural ' || n.n_name || '  (north) '
        WHEN 2 THEN 'Ft. ' || lower(n.n_name) || ' hwy 30'
        WHEN 3 THEN n.n_name || ' ' || array_to_string(list_transform(string_split(r.r_name, ' '),
                      lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ') || ' County'
        WHEN 4 THEN 'Sgt. ' || n.n_name || ' Co'
        WHEN 5 THEN n.n_name || ', IA 50309'
        WHEN 6 THEN 'delaware twp ' || n.n_name
        WHEN 7 THEN n.n_name || ' Twnshp'
        WHEN 8 THEN 'Melcher-Dallas'
        WHEN 9 THEN 'Iowa State Fair Grounds'
        WHEN 10 THEN c.c_name
        ELSE 'Medic Ambulance ' || n.n_name END AS place_raw
      FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey"""


def _clean_place_sql() -> str:
    # region names are single words or "MIDDLE EAST": initcap == upper first letter of each word
    county_pat = ("(SELECT '(?i)\\b(?:' || string_agg(name, '|' ORDER BY name) || ')\\b(?:\\sCO|\\sCOUNTY)$' "
                  "FROM (SELECT DISTINCT array_to_string(list_transform(string_split(r_name, ' '), "
                  "lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ') AS name FROM region))")
    rules = _rules_case("p8", R.PLACE_REPAIR_RULES, "p8")
    return f"""
    WITH raw AS ({_place_raw()}),
    s0 AS (SELECT c_custkey, place_raw, CASE WHEN regexp_matches(coalesce(place_raw, ''), '(?i){R.FAIR_GROUNDS_PATTERN}')
                  THEN '{R.FAIR_GROUNDS_CITY}' ELSE place_raw END AS p0 FROM raw),
    s1 AS (SELECT *, {_squish("coalesce(p0, 'Not Recorded')")} AS p1 FROM s0),
    s2 AS (SELECT *, regexp_replace(p1, {_q('(?i)' + R.PLACE_QUALIFIER_PATTERN)}, '', 'g') AS p2 FROM s1),
    s3 AS (SELECT *, upper(regexp_replace(p2, {_q(R.FORT_PATTERN)}, {_q(R.FORT_VALUE)}, 'g')) AS p3 FROM s2),
    s4 AS (SELECT *, regexp_replace(p3, {county_pat}, '') AS p4 FROM s3),
    s5 AS (SELECT *, regexp_replace(p4, {_q(R.SERGEANT_PATTERN)}, {_q(R.SERGEANT_VALUE)}) AS p5 FROM s4),
    s6 AS (SELECT *, regexp_replace(p5, {_q('(?i)' + R.JUNK_TAIL_PATTERN)}, '') AS p6 FROM s5),
    s7 AS (SELECT *, CASE WHEN regexp_matches(p6, '(?i)delaware') THEN 'DELAWARE' ELSE p6 END AS p7 FROM s6),
    s8 AS (SELECT *, regexp_replace(p7, {_q('(?i)' + R.TOWNSHIP_PATTERN)}, 'TOWNSHIP') AS p8 FROM s7),
    s9 AS (SELECT *, {rules} AS p9 FROM s8),
    s10 AS (SELECT *, regexp_replace({_squish("p9")}, '[^A-Za-z0-9\\s]+', ' ', 'g') AS p10 FROM s9)
    SELECT c_custkey, place_raw, CASE WHEN regexp_matches(p10, '(?i)melcher') THEN 'MELCHER-DALLAS' ELSE p10 END
           AS place_clean FROM s10"""


def _dictionary_sql() -> str:
    return """
    WITH d AS (
      SELECT DISTINCT trim(name) AS name FROM (
        SELECT upper(split_part(p_name, ' ', 2)) AS name FROM part
        UNION ALL SELECT upper(p_name) FROM part WHERE p_type = 'SMALL'
        UNION ALL SELECT upper(split_part(p_name, ' ', 1)) FROM part WHERE p_type = 'LARGE')
      WHERE name IS NOT NULL AND trim(name) <> ''),
    pat AS (SELECT '(?i)\\b(?:' || string_agg(name, '|' ORDER BY name) || ')\\b' AS p FROM d)
    SELECT p_partkey, text, nullif(regexp_extract(text, (SELECT p FROM pat), 0), '') AS location
    FROM (SELECT p_partkey, upper(p_name || ' ' || p_type) AS text FROM part)"""


def _punctuated_sql() -> str:
    return """
    WITH x AS (
      SELECT upper(CASE p_partkey % 4 WHEN 0 THEN split_part(p_name, ' ', 1) || '-' || split_part(p_name, ' ', 2)
                                      WHEN 1 THEN 'o' || chr(39) || split_part(p_name, ' ', 2)
                                      WHEN 2 THEN 'st. ' || split_part(p_name, ' ', 1)
                                      ELSE split_part(p_name, ' ', 2) END) AS name, upper(p_type) AS kind FROM part),
    texts AS (SELECT 'NEAR ' || name || ', ' || kind AS text FROM x),
    pat AS (SELECT '(?i)\\b(?:' || string_agg(replace(n, '.', '\\.'), '|' ORDER BY n) || ')\\b' AS p FROM (SELECT DISTINCT name AS n FROM x))
    SELECT text, nullif(regexp_extract(text, (SELECT p FROM pat), 0), '') AS location
    FROM (SELECT * FROM texts UNION ALL SELECT * FROM texts)"""


def _centroid_sql() -> str:
    k, r, s = "n_nationkey::DOUBLE", "n_regionkey::DOUBLE", "(n_nationkey % 3 + 1)::DOUBLE"
    outer = [(k, r), (f"{k} + {s}", r), (f"{k} + {s}", f"{r} + {s}"), (k, f"{r} + {s}")]
    hole = [(f"{k} + 0.25", f"{r} + 0.25"), (f"{k} + 0.25", f"{r} + 0.5"), (f"{k} + 0.5", f"{r} + 0.5"),
            (f"{k} + 0.5", f"{r} + 0.25")]
    parts = [f"SELECT n_regionkey AS g, n_nationkey AS id, 0 AS ring, {i} AS i, {x} AS x, {y} AS y FROM nation"
             for i, (x, y) in enumerate(outer)]
    parts += [f"SELECT n_regionkey, n_nationkey, 1, {i}, {x}, {y} FROM nation WHERE n_nationkey % 2 = 0"
              for i, (x, y) in enumerate(hole)]
    v = " UNION ALL ".join(parts)
    return f"""
    WITH v AS ({v}),
    e AS (SELECT g, x, y,
            coalesce(lead(x) OVER w, first_value(x) OVER w) AS x2,
            coalesce(lead(y) OVER w, first_value(y) OVER w) AS y2
          FROM v WINDOW w AS (PARTITION BY id, ring ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
    t AS (SELECT g, sum(x * y2 - x2 * y) AS a2, sum((x + x2) * (x * y2 - x2 * y)) AS cx6,
                 sum((y + y2) * (x * y2 - x2 * y)) AS cy6 FROM e GROUP BY g)
    SELECT g AS n_regionkey, round(cx6 / (3 * a2), 6) AS cx, round(cy6 / (3 * a2), 6) AS cy,
           round(a2 / 2, 6) AS area FROM t"""


def _title(x: str) -> str:
    return (f"array_to_string(list_transform(string_split({x}, ' '), "
            f"lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ')")


def _gazetteer_sql() -> str:
    """CTE chain ending in ``gz`` (the X1 analogue on nation x region)."""
    excl = ", ".join(f"({_q(a)}, {_q(b)})" for a, b in ANALOG_EXCLUSIONS)
    manual = ", ".join(f"({_q(n)}, {_q(c)}, {lat!r}::DOUBLE, {lon!r}::DOUBLE, {_q(d)}, {_q(a2)})"
                       for n, c, lat, lon, d, a2 in MANUAL_PLACES)
    code = "lpad(CAST(r_regionkey * 2 + 1 AS VARCHAR), 3, '0')"
    return rf"""
    p AS (SELECT n_nationkey AS geonameid,
                 CASE WHEN n_nationkey % 4 = 0 THEN replace(n_name, '_', ' ') || ' (historical)'
                      ELSE '  ' || replace(n_name, '_', ' ') || ' ' END AS raw_name,
                 40.0::DOUBLE + n_nationkey / 10 AS latitude, -90.0::DOUBLE - n_regionkey AS longitude,
                 CASE WHEN n_nationkey = 7 THEN 'H' ELSE 'P' END AS feature_class,
                 CASE WHEN n_nationkey = 11 THEN 'MN' ELSE 'IA' END AS admin1_code,
                 CAST(n_regionkey * 2 + 1 AS VARCHAR) AS admin2_code FROM nation),
    pi AS (SELECT geonameid, trim(regexp_replace(regexp_replace(raw_name, '(?i)\s\(historical\)', ''), '\s+', ' ', 'g'))
                    AS name, latitude, longitude,
                  CASE WHEN length(admin2_code) < 3 THEN lpad(admin2_code, 3, '0') ELSE admin2_code END AS admin2_code
           FROM p WHERE admin1_code = 'IA' AND feature_class = 'P'),
    cc AS (SELECT 'US.IA.' || {code} AS code, {_title("r_name")} || ' County' AS name FROM region
           UNION ALL SELECT 'CA.08.' || {code}, 'Elsewhere' FROM region),
    cty AS (SELECT regexp_extract(code, '\.(\d+)$', 1) AS county_code,
                   trim(regexp_replace(regexp_replace(name, '(?i)\scounty', ''), '\s+', ' ', 'g')) AS name_county
            FROM cc WHERE regexp_extract(code, '^[^\.]+', 0) = 'US'
                      AND regexp_extract(code, '^[A-Z]{{2}}\.(\d{{2}}|[A-Z]{{2}})', 1) = 'IA'),
    attrs AS (SELECT {_title("r_name")} AS county, '19' || {code} AS county_fips,
                     CAST(r_regionkey + 1 AS VARCHAR) AS district,
                     CASE WHEN r_regionkey % 2 = 0 THEN 'Metro' ELSE 'Rural' END AS designation,
                     CASE WHEN r_regionkey % 2 = 0 THEN 'Urban' ELSE 'Rural' END AS urbanicity
              FROM region WHERE r_name <> 'MIDDLE EAST'),
    g0 AS (SELECT CAST(pi.geonameid AS VARCHAR) AS geonameid, coalesce(upper(pi.name), '') AS name,
                  coalesce(cty.name_county, '') AS name_county, a.district, a.county_fips, a.designation,
                  a.urbanicity, pi.admin2_code, pi.latitude, pi.longitude
           FROM pi LEFT JOIN cty ON pi.admin2_code = cty.county_code LEFT JOIN attrs a ON cty.name_county = a.county),
    m AS (SELECT * FROM (VALUES {manual}) v(name, name_county, latitude, longitude, district, admin2_code)),
    gz AS (SELECT * FROM g0 WHERE (name, name_county) NOT IN (SELECT * FROM (VALUES {excl}))
           UNION ALL
           SELECT {surrogate_id_sql(["m.name", "m.name_county"], R.INCIDENT_ID_SEED)}, m.name, m.name_county,
                  m.district, a.county_fips, a.designation, a.urbanicity, m.admin2_code, m.latitude, m.longitude
           FROM m LEFT JOIN attrs a ON m.name_county = a.county)"""


def _incident_sql(extra: str = "") -> str:
    day = "86400000000"
    agency_rules = _rules_case("agency", R.AGENCY_TYPE_RULES, _q(R.AGENCY_TYPE_DEFAULT))
    place_rules = _rules_case("p8", R.PLACE_REPAIR_RULES, "p8")
    county_pat = ("(SELECT '(?i)\\b(?:' || string_agg(name_county, '|' ORDER BY name_county) || ')\\b(?:\\sCO|\\sCOUNTY)$' "
                  "FROM (SELECT DISTINCT trim(name_county) AS name_county FROM gz WHERE trim(name_county) <> ''))")
    name_pat = ("(SELECT '(?i)\\b(?:' || string_agg(name, '|' ORDER BY name) || ')\\b' "
                "FROM (SELECT DISTINCT trim(name) AS name FROM gz WHERE name IS NOT NULL AND trim(name) <> ''))")
    rollover = ("CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL AND hour({a}) > hour({b}) "
                "THEN {b} + INTERVAL 1 DAY ELSE {b} END")
    mins = "round((epoch_us({e}) - epoch_us({s})) / 60000000, 6)"
    ts = "strftime({x}, " + TS + ")"
    return f"""
    WITH {_gazetteer_sql()},
    r AS (
      SELECT o.o_orderkey, CAST(o.o_orderdate AS DATE) AS date_of_use, o.o_custkey, c.c_custkey,
             (o.o_orderkey * 7919 % 86400) * 1000000 AS amb_toc,
             o.o_orderpriority AS prio, o.o_orderstatus AS status,
             CASE o.o_orderkey % 8 WHEN 0 THEN NULL WHEN 1 THEN 'Rural ' || replace(n.n_name, '_', ' ')
                  WHEN 2 THEN replace(n.n_name, '_', ' ') || ' ' || {_title("r.r_name")} || ' Co'
                  WHEN 3 THEN 'Iowa State Fair Grounds' WHEN 4 THEN 'Medic Ambulance'
                  WHEN 5 THEN lower(replace(n.n_name, '_', ' ')) || ', IA 50310'
                  WHEN 6 THEN 'Nowhere ' || o.o_orderpriority ELSE 'West ' || replace(n.n_name, '_', ' ') END
               AS location_city_event,
             CASE c.c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN c.c_name || ' PD' WHEN 2 THEN 'County S0'
                  WHEN 3 THEN 'Iowa DNR' WHEN 4 THEN 'ISP Post ' || CAST(n.n_nationkey AS VARCHAR)
                  ELSE c.c_mktsegment END AS agency,
             CASE WHEN o.o_custkey % 13 = 0 THEN NULL WHEN c.c_custkey % 5 = 0 THEN abs(c.c_acctbal) / 100 * 365
                  WHEN c.c_custkey % 5 = 1 THEN abs(c.c_acctbal) / 100 * 12
                  WHEN c.c_custkey % 5 = 2 THEN abs(c.c_acctbal) / 100 * 52 ELSE abs(c.c_acctbal) / 100 END AS age,
             CASE c.c_custkey % 5 WHEN 0 THEN 'Days' WHEN 1 THEN 'Months' WHEN 2 THEN 'weeks' WHEN 3 THEN 'Years'
                  END AS age_unit,
             CASE WHEN o.o_orderkey % 9 = 0 THEN NULL ELSE o.o_orderkey % 2 = 0 END AS witnessed,
             CASE WHEN o.o_orderkey % 10 = 0 THEN NULL ELSE o.o_custkey % 3 = 0 END AS bystander_raw,
             o.o_orderkey % 4 AS shocks,
             CASE o.o_orderpriority WHEN '1-URGENT' THEN true WHEN '5-LOW' THEN NULL ELSE false END AS cardiac_raw,
             o.o_orderpriority = '2-HIGH' AS od_raw,
             CASE WHEN o.o_orderpriority IN ('3-MEDIUM', '1-URGENT') THEN 'Fall' END AS other_case,
             o.o_orderstatus = 'F' AS expired_scene,
             CASE WHEN o.o_orderstatus = 'P' THEN NULL ELSE false END AS expired_in_er
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
      JOIN region r ON n.n_regionkey = r.r_regionkey),
    r2 AS (SELECT *, ((amb_toc + ((o_custkey % 40) - 5) * 60000000) % {day} + {day}) % {day} AS amb_pat,
                  CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN 0
                       ELSE (o_orderkey % 1800) * 1000000 + 250000 END AS dur FROM r),
    r3 AS (SELECT *, CASE WHEN o_orderkey % 23 = 0 THEN NULL
                          ELSE ((amb_pat + (o_orderkey % 11) * 60000000) % {day} + {day}) % {day} END AS aed_on FROM r2),
    b1 AS (SELECT *, CAST(date_of_use AS TIMESTAMP) + to_microseconds(amb_toc) AS toc_ts,
                  CAST(date_of_use AS TIMESTAMP) + to_microseconds(amb_pat) AS pat_ts,
                  CAST(date_of_use AS TIMESTAMP) + to_microseconds(aed_on) AS on_ts,
                  CASE WHEN regexp_matches(coalesce(location_city_event, ''), '(?i)iowa state fair grounds')
                       THEN 'Des Moines' ELSE location_city_event END AS loc,
                  ((aed_on + dur - dur % 1000000) % {day} + {day}) % {day} AS off0 FROM r3),
    b2 AS (SELECT *, {rollover.format(a="toc_ts", b="pat_ts")} AS pat_fix,
                  CAST(date_of_use AS TIMESTAMP) + to_microseconds(off0) AS off_ts0 FROM b1),
    b3 AS (SELECT *, CASE WHEN coalesce(aed_on = off0, false) THEN NULL ELSE off0 END AS time_aed_off,
                  CASE WHEN coalesce(on_ts = off_ts0, false) THEN NULL ELSE off_ts0 END AS off_ts FROM b2),
    b4 AS (SELECT *, {rollover.format(a="on_ts", b="off_ts")} AS off_fix FROM b3),
    b5 AS (SELECT *, coalesce(agency, 'Not Recorded') AS agency0,
                  {_title("coalesce(age_unit, 'Not Recorded')")} AS unit_t FROM b4),
    b6 AS (SELECT *, CASE unit_t WHEN 'Days' THEN age / 365.25 WHEN 'Months' THEN age / 12
                                 WHEN 'Weeks' THEN age / 52.1786 ELSE age END AS age_years,
                  {_squish("agency0")} AS agency1 FROM b5),
    s1 AS (SELECT *, {_squish("coalesce(loc, 'Not Recorded')")} AS p1 FROM b6),
    s2 AS (SELECT *, regexp_replace(p1, {_q('(?i)' + R.PLACE_QUALIFIER_PATTERN)}, '', 'g') AS p2 FROM s1),
    s3 AS (SELECT *, upper(regexp_replace(p2, {_q(R.FORT_PATTERN)}, {_q(R.FORT_VALUE)}, 'g')) AS p3 FROM s2),
    s4 AS (SELECT *, regexp_replace(p3, {county_pat}, '') AS p4 FROM s3),
    s5 AS (SELECT *, regexp_replace(p4, {_q(R.SERGEANT_PATTERN)}, {_q(R.SERGEANT_VALUE)}) AS p5 FROM s4),
    s6 AS (SELECT *, regexp_replace(p5, {_q('(?i)' + R.JUNK_TAIL_PATTERN)}, '') AS p6 FROM s5),
    s7 AS (SELECT *, CASE WHEN regexp_matches(p6, '(?i)delaware') THEN 'DELAWARE' ELSE p6 END AS p7 FROM s6),
    s8 AS (SELECT *, regexp_replace(p7, {_q('(?i)' + R.TOWNSHIP_PATTERN)}, 'TOWNSHIP') AS p8 FROM s7),
    s9 AS (SELECT *, {place_rules} AS p9 FROM s8),
    s10 AS (SELECT *, regexp_replace({_squish("p9")}, '[^A-Za-z0-9\\s]+', ' ', 'g') AS p10 FROM s9),
    s11 AS (SELECT *, CASE WHEN regexp_matches(p10, '(?i)melcher') THEN 'MELCHER-DALLAS' ELSE p10 END AS clean
            FROM s10),
    f AS (SELECT *, nullif(regexp_extract(clean, {name_pat}, 0), '') AS location,
                 coalesce(cardiac_raw, false) AS cardiac, coalesce(od_raw, false) AS od FROM s11)
    SELECT f.o_orderkey, {surrogate_id_sql("f.o_orderkey", R.INCIDENT_ID_SEED)} AS unique_incident_id,
           {ts.format(x="pat_fix")} AS amb_pat_timestamp_fix, time_aed_off,
           {ts.format(x="off_fix")} AS time_aed_off_timestamp_fix,
           {mins.format(e="pat_fix", s="toc_ts")} AS time_from_call_to_patient,
           {mins.format(e="on_ts", s="toc_ts")} AS time_from_call_to_aed_on,
           {mins.format(e="on_ts", s="pat_fix")} AS time_from_patient_to_aed,
           {mins.format(e="off_fix", s="on_ts")} AS total_time_aed_used,
           {mins.format(e="off_fix", s="pat_fix")} AS time_at_patient_to_end_aed,
           {mins.format(e="off_fix", s="toc_ts")} AS time_from_call_to_end_aed,
           coalesce(bystander_raw, false) AS bystander_cpr,
           (bystander_raw = true) AND (witnessed = true) AND (shocks > 0) AS utstein_survival,
           unit_t AS age_unit, round(age_years, 6) AS age_years, {_age_band("age_years")} AS age_range,
           agency1 AS agency, {agency_rules.replace("coalesce(agency, '')", "coalesce(agency1, '')")} AS agency_type,
           clean AS location_city_event_clean, location,
           CASE WHEN cardiac THEN 'Cardiac Arrest' WHEN od THEN 'Overdose'
                WHEN other_case IS NOT NULL AND NOT cardiac THEN 'Other Cause' ELSE 'Unknown' END AS call_type,
           CAST(year(date_of_use) AS INTEGER) AS year,
           CASE WHEN coalesce(expired_scene, false) OR coalesce(expired_in_er, false) THEN 'Deceased'
                ELSE 'Survived' END AS survival,
           gz.name_county, gz.county_fips, gz.district{extra}
    FROM f LEFT JOIN (SELECT name, name_county, county_fips, district, latitude, longitude FROM gz) gz
      ON f.location = gz.name"""


def _runs_sql() -> str:
    from vigil.plans import runs as RU
    hms = "'%-m/%-d/%Y %-H:%M:%S'"
    parse = "try_strptime({x}, '%m/%d/%Y %H:%M:%S')"
    code = "lpad(CAST(r_regionkey * 2 + 1 AS VARCHAR), 3, '0')"
    order = "proc_time, proc_desc, attempts, complaint"
    return f"""
    WITH raw AS (
      SELECT DISTINCT CAST(o.o_orderkey AS VARCHAR) AS pk, strftime(o.o_orderdate, '%-m/%-d/%Y') AS d_text,
             strftime(o.o_orderdate + to_seconds(o.o_orderkey % 86400), {hms}) AS disp_t,
             strftime(o.o_orderdate + to_seconds(o.o_orderkey % 86400) + to_minutes(o.o_orderkey % 13), {hms}) AS scene_t,
             CASE WHEN o.o_orderkey % 10 = 0 THEN NULL ELSE strftime(o.o_orderdate + to_seconds(o.o_orderkey % 86400)
                  + to_minutes(o.o_orderkey % 13) + to_minutes(o.o_custkey % 7), {hms}) END AS patient_t,
             strftime(o.o_orderdate + to_seconds(o.o_orderkey % 86400) + to_minutes(l.l_linenumber * 2), {hms}) AS proc_t,
             CASE l.l_returnflag WHEN 'R' THEN 'Defibrillation, AED' WHEN 'A' THEN 'CV - Cardioversion'
                  ELSE 'Airway - Suction' END AS proc_desc,
             CASE WHEN l.l_linenumber = 1 THEN NULL ELSE l.l_linenumber END AS attempts,
             'Med ' || CAST(l.l_partkey % 5 AS VARCHAR) AS med,
             CASE WHEN l.l_linestatus = 'O' THEN 'Improved' ELSE 'Unchanged' END AS resp,
             CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Cardiac arrest' WHEN '2-HIGH' THEN 'Overdose'
                  ELSE 'Unconscious' END AS complaint,
             CASE WHEN o.o_custkey % 11 = 0 THEN NULL WHEN o.o_custkey % 7 = 0 THEN '123456'
                  ELSE lpad(CAST(o.o_custkey % 10000000 AS VARCHAR), 7, '1') END AS agency_no,
             CASE o.o_orderkey % 3 WHEN 0 THEN 'Not Witnessed' WHEN 1 THEN 'Bystander' END AS witnessed_by,
             CASE WHEN o.o_orderkey % 4 = 0 THEN NULL ELSE 'No' END AS cpr_raw,
             CASE WHEN o.o_orderkey % 5 = 0 THEN '"Family Member"' END AS who_raw,
             CASE WHEN o.o_orderkey % 6 = 0 THEN NULL ELSE o.o_orderpriority = '2-HIGH' END AS overdose_raw,
             CASE WHEN o.o_orderstatus = 'F' THEN 'Expired in the Field' WHEN o.o_orderstatus = 'O' THEN 'ROSC in the ED'
                  WHEN o.o_orderkey % 2 = 0 THEN NULL ELSE 'Not Applicable' END AS outcome_raw,
             CASE WHEN o.o_totalprice > 200000 THEN 'Dead at scene' ELSE 'Transported' END AS disposition,
             '19' AS state,
             CASE WHEN o.o_custkey % 9 = 0 THEN '' WHEN o.o_custkey % 9 = 1 THEN CAST(o.o_custkey % 200 AS VARCHAR)
                  ELSE CAST((o.o_custkey % 4) * 2 + 1 AS VARCHAR) END AS county
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
    x AS (SELECT *, try_strptime(d_text, '%m/%d/%Y')::DATE AS d, {parse.format(x="disp_t")} AS disp,
                 {parse.format(x="scene_t")} AS scene, {parse.format(x="patient_t")} AS patient,
                 {parse.format(x="proc_t")} AS proc_ts, replace(who_raw, '"', '') AS who
          FROM raw WHERE length(agency_no) = 7),
    y AS (SELECT *, CAST(proc_ts AS VARCHAR) AS proc_time,
                 (epoch_us(scene) - epoch_us(disp)) / 60000000 AS to_scene,
                 (epoch_us(patient) - epoch_us(disp)) / 60000000 AS to_patient FROM x),
    defib AS (SELECT pk, CAST(sum(coalesce(attempts, 1)) AS BIGINT) AS shocks
              FROM (SELECT DISTINCT pk, proc_desc, proc_time, attempts FROM y
                    WHERE regexp_matches(coalesce(proc_desc, ''), {_q('(?i)' + R.DEFIB_PATTERN)})) GROUP BY pk),
    base AS (SELECT pk, any_value(d) AS d, any_value(to_scene) AS to_scene, any_value(to_patient) AS to_patient,
                    any_value(witnessed_by) AS witnessed_by, any_value(cpr_raw) AS cpr_raw, any_value(who) AS who,
                    any_value(overdose_raw) AS overdose_raw, any_value(outcome_raw) AS outcome_raw,
                    any_value(disposition) AS disposition, any_value(state) AS state, any_value(county) AS county
             FROM y GROUP BY pk),
    ps AS (SELECT DISTINCT pk, proc_time, proc_desc, attempts, complaint FROM y),
    pr AS (SELECT *, row_number() OVER (PARTITION BY pk ORDER BY {order}) AS pos FROM ps),
    s1 AS (SELECT pk, string_agg(proc_time, ', ' ORDER BY pos) AS proc_time_j,
                  string_agg(CAST(attempts AS VARCHAR), ', ' ORDER BY pos) AS attempts_j FROM pr GROUP BY pk),
    c1 AS (SELECT pk, string_agg(complaint, ', ' ORDER BY fp) AS complaint_j
           FROM (SELECT pk, complaint, min(pos) AS fp FROM pr GROUP BY 1, 2) GROUP BY pk),
    d1 AS (SELECT pk, string_agg(proc_desc, ', ' ORDER BY fp) AS desc_j
           FROM (SELECT pk, proc_desc, min(pos) AS fp FROM pr GROUP BY 1, 2) GROUP BY pk),
    m AS (SELECT pk, string_agg(med, ', ' ORDER BY med, resp) AS med_j, string_agg(resp, ', ' ORDER BY med, resp) AS resp_j
          FROM (SELECT DISTINCT pk, med, resp FROM y) GROUP BY pk),
    runs AS (SELECT b.*, s1.proc_time_j, s1.attempts_j, c1.complaint_j, d1.desc_j, m.med_j, m.resp_j, defib.shocks,
                    CASE WHEN outcome_raw IS NULL OR (regexp_matches(coalesce(outcome_raw, ''), '(?i)not applicable|not recorded')
                          AND regexp_matches(coalesce(disposition, ''), '(?i)dead')) THEN 'Expired in the Field'
                         ELSE outcome_raw END AS outcome
             FROM base b LEFT JOIN s1 USING (pk) LEFT JOIN c1 USING (pk) LEFT JOIN d1 USING (pk) LEFT JOIN m USING (pk)
             LEFT JOIN defib USING (pk)),
    imp AS (SELECT *, coalesce(to_scene, (SELECT median(to_scene) FROM runs)) AS to_scene_i,
                   coalesce(to_patient, (SELECT median(to_patient) FROM runs)) AS to_patient_i,
                   CASE WHEN length(coalesce(county, '')) = 0 THEN NULL
                        WHEN length(county) < 3 THEN lpad(county, 3, '0') ELSE county END AS county_id FROM runs),
    attrs AS (SELECT '19' || {code} AS county_fips, CAST(r_regionkey + 1 AS VARCHAR) AS region_preparedness
              FROM region WHERE r_name <> 'MIDDLE EAST')
    SELECT pk AS {RU.KEY}, strftime(d, '%Y-%m-%d') AS {RU.DATE}, complaint_j AS {RU.COMPLAINT},
           desc_j AS {RU.PROC_DESC}, proc_time_j AS {RU.PROC_TIME}, attempts_j AS {RU.PROC_ATTEMPTS},
           med_j AS {RU.MED}, resp_j AS {RU.MED_RESPONSE}, round(to_scene_i, 6) AS {RU.TO_SCENE},
           round(to_patient_i, 6) AS {RU.TO_PATIENT},
           CASE WHEN who IS NOT NULL THEN 'yes' ELSE coalesce(cpr_raw, 'Not Recorded') END AS {RU.CPR_PRIOR},
           who AS {RU.CPR_WHO}, coalesce(overdose_raw, false) AS {RU.OVERDOSE}, outcome AS {RU.OUTCOME},
           dayname(d) AS incident_day,
           CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) IN (3, 4, 5) THEN 'Spring'
                WHEN month(d) IN (6, 7, 8) THEN 'Summer' WHEN d IS NULL THEN NULL ELSE 'Fall' END AS season,
           dayofweek(d) IN (0, 6) AS weekday_weekend, shocks,
           NOT regexp_matches(coalesce(witnessed_by, ''), '(?i)not') AS witnessed,
           regexp_matches(outcome, '(?i)rosc in the ed') AS rosc_ed,
           regexp_matches(outcome, '(?i)rosc in the field') AS rosc_field,
           regexp_matches(outcome, '(?i)expired in the field') AS expire_field,
           regexp_matches(outcome, '(?i)expired in the ed') AS expire_ed,
           NOT regexp_matches(outcome, '(?i)expire') AS survival,
           county_id, state || county_id AS county_fips, attrs.region_preparedness
    FROM imp LEFT JOIN attrs ON imp.state || imp.county_id = attrs.county_fips"""


def _measure_sql() -> str:
    excl = ", ".join(_q(c) for c in R.NON_CONTINENTAL_STATE_FIPS)
    return f"""
    c AS (SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey),
    measure AS (
      SELECT 'Overall' AS stratification1, 'Overall' AS stratification2, 'Nation' AS geographiclevel,
             '59' AS locationid, 'US' AS locationabbr, 'United States' AS locationdesc,
             round(avg(c_acctbal), 6) AS data_value FROM c
      UNION ALL
      SELECT 'Overall', 'Overall', 'State', CAST(n_regionkey AS VARCHAR), 'R' || CAST(n_regionkey AS VARCHAR),
             'Region ' || CAST(n_regionkey AS VARCHAR), round(avg(c_acctbal), 6) FROM c GROUP BY n_regionkey
      UNION ALL
      SELECT 'Male', 'Overall', 'State', CAST(n_regionkey AS VARCHAR), 'R', 'Region', round(avg(c_acctbal), 6)
      FROM c GROUP BY n_regionkey
      UNION ALL
      SELECT 'Overall', 'Overall', 'County', '19' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0'),
             CASE WHEN n_nationkey % 3 = 0 THEN 'XX' ELSE 'IA' END, {_title("lower(n_name)")} || ' County',
             round(avg(c_acctbal), 6) FROM c GROUP BY n_nationkey, n_name),
    m AS (SELECT * FROM measure WHERE stratification1 = 'Overall' AND stratification2 = 'Overall'),
    st AS (SELECT * EXCLUDE (locationid),
                  CASE WHEN length(locationid) < 2 THEN lpad(locationid, 2, '0') ELSE locationid END AS lid
           FROM m WHERE geographiclevel = 'State'),
    st2 AS (SELECT * FROM st WHERE lid NOT IN ({excl})),
    ct AS (SELECT * EXCLUDE (locationid),
                  CASE WHEN length(locationid) < 3 THEN lpad(locationid, 3, '0') ELSE locationid END AS lid
           FROM m WHERE geographiclevel = 'County' AND locationabbr = 'IA')"""


def _mortality_sql(which: str) -> str:
    cols = "stratification1, stratification2, geographiclevel, locationabbr, locationdesc, data_value"
    if which == "state":
        return f"""WITH {_measure_sql()}
        SELECT b."STATEFP", b."NAME", {", ".join("s." + c for c in cols.split(", "))}
        FROM st2 s RIGHT JOIN (SELECT lpad(CAST(r_regionkey AS VARCHAR), 2, '0') AS "STATEFP", r_name AS "NAME"
                               FROM region WHERE r_regionkey <> 2) b ON s.lid = b."STATEFP" """
    if which == "county":
        return f"""WITH {_measure_sql()},
        b AS (SELECT '19' AS "STATEFP", lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS "COUNTYFP", n_name AS "NAME",
                     '19' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS "COUNTYFIPS" FROM nation),
        j AS (SELECT b.*, {", ".join("s." + c for c in cols.split(", "))},
                     trim(regexp_replace(regexp_replace(s.locationdesc, '(?i)\\s+county$', ''), '\\s+', ' ', 'g'))
                       AS "COUNTY_NAME"
              FROM ct s RIGHT JOIN b ON s.lid = b."COUNTYFIPS"),
        attrs AS (SELECT {_title("lower(n_name)")} AS county, CAST(n_regionkey + 1 AS VARCHAR) AS region_preparedness
                  FROM nation WHERE n_regionkey <> 4)
        SELECT j.*, attrs.region_preparedness FROM j LEFT JOIN attrs ON j."COUNTY_NAME" = attrs.county"""
    return f"WITH {_measure_sql()} SELECT data_value FROM m WHERE geographiclevel = 'Nation'"


def _incident_reports_sql(which: str) -> str:
    inc = _incident_sql(", gz.latitude, gz.longitude")
    if which == "location_counts":
        return f"""
        WITH inc AS ({inc}),
        c AS (SELECT location, latitude, longitude, count(*) AS n FROM inc
              WHERE location IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2, 3),
        q AS (SELECT quantile_cont(n, 0.8) AS q80, quantile_cont(n, 0.9) AS q90, quantile_cont(n, 0.99) AS q99 FROM c)
        SELECT location, latitude, longitude, n,
               CASE WHEN n <= q80 THEN 10 WHEN n < q90 THEN 15 WHEN n < q99 THEN 20 ELSE 25 END AS quantiles,
               CASE WHEN n <= q80 THEN '01-06' WHEN n < q90 THEN '06-11' WHEN n < q99 THEN '11-47' ELSE '47+' END
                 AS quantile_labels
        FROM c, q"""
    return f"""
        WITH inc AS ({inc}),
        c AS (SELECT coalesce({_squish("location")}, 'Not Recorded') AS location, count(*) AS n FROM inc GROUP BY 1)
        SELECT location, n, n / sum(n) OVER () AS percent FROM c QUALIFY n > 46"""


# The analogue of built incidents, its copies, and the rows that keep-first leaves
_REPORT_BASE = """
    x AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_custkey % 17 <> 0 THEN 'Agency ' || CAST(o_custkey % 40 AS VARCHAR) END AS agency,
                 CAST(year(o_orderdate) AS BIGINT) AS year,
                 CASE o_orderkey % 5 WHEN 0 THEN 'Cardiac' WHEN 1 THEN 'OD' WHEN 2 THEN 'Other' WHEN 3 THEN 'Unknown' ELSE 'Trauma' END AS call_type,
                 CASE WHEN n_nationkey % 6 <> 5 THEN CAST(n_regionkey AS VARCHAR) END AS district, CASE WHEN o_orderkey % 9 <> 0 THEN n_name END AS location,
                 CASE WHEN n_nationkey <> 7 THEN CAST(n_nationkey AS DOUBLE) + 0.25 END AS latitude, CAST(n_nationkey AS DOUBLE) * -1.5 AS longitude,
                 CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey % 3 = 0 END AS witnessed, CASE WHEN o_orderkey % 14 <> 0 THEN o_custkey % 2 = 0 END AS bcpr,
                 CASE WHEN o_custkey % 50 = 0 THEN 'Rare ' || CAST(o_custkey % 1000 AS VARCHAR) ELSE o_orderpriority END AS agency_type,
                 CASE o_orderstatus WHEN 'F' THEN 'Deceased' WHEN 'O' THEN 'Survived' ELSE 'Unknown' END AS s,
                 CASE o_orderkey % 8 WHEN 1 THEN 'F' WHEN 2 THEN 'M' WHEN 3 THEN 'X' END AS sex,
                 CASE WHEN o_orderkey % 12 <> 0 THEN 'band ' || CAST(o_custkey % 6 AS VARCHAR) END AS age_range,
                 CASE WHEN n_nationkey % 5 <> 0 THEN 'Area ' || CAST(n_nationkey % 3 AS VARCHAR) END AS urbanicity,
                 CASE WHEN o_orderkey % 5 = 2 THEN 'case ' || CAST(o_custkey % 7 AS VARCHAR) END AS other_case, n_nationkey
          FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
    inc AS (SELECT * FROM x UNION ALL
            SELECT * REPLACE ('99' AS district, 'Mixed' AS urbanicity) FROM x WHERE n_nationkey % 4 = 0 AND location IS NOT NULL),
    u AS (SELECT * FROM inc QUALIFY row_number() OVER (PARTITION BY id ORDER BY district NULLS LAST, urbanicity NULLS LAST) = 1)"""


def _report_outcomes(by: str, total: str = '"Total"', where: str = "true") -> str:
    return (f"p AS (SELECT {by}, nullif(count(*) FILTER (WHERE s = 'Deceased'), 0) AS \"Deceased\", nullif(count(*) FILTER (WHERE s = 'Survived'), 0) AS \"Survived\", "
            f"nullif(count(*) FILTER (WHERE s = 'Unknown'), 0) AS \"Unknown\" FROM u WHERE {where} GROUP BY 1), "
            f"o AS (SELECT *, \"Deceased\" + \"Survived\" AS {total}, \"Survived\" / (\"Deceased\" + \"Survived\") AS ps, \"Deceased\" / (\"Deceased\" + \"Survived\") AS pd FROM p)")


def _report_sql() -> dict[str, str]:
    surv = 'ps AS "Pct_Survived", pd AS "Pct_Deceased"'
    wb = "wb AS (SELECT * FROM u WHERE witnessed IS NOT NULL AND bcpr IS NOT NULL), w AS (SELECT witnessed, count(*) FILTER (WHERE bcpr) AS t, count(*) FILTER (WHERE NOT bcpr) AS f FROM wb GROUP BY 1)"
    name = lambda c: f"SELECT coalesce({c}, 'Not Recorded') AS {c}, count(*) AS n, count(*) / sum(count(*)) OVER () AS percent FROM u GROUP BY 1"
    tables = {
        "total_deployments": "SELECT count(*) AS n FROM u",
        "total_responding_agencies": "SELECT count(DISTINCT agency) + max(CASE WHEN agency IS NULL THEN 1 ELSE 0 END) AS n FROM inc",
        "agencies_by_year": "SELECT year, count(DISTINCT agency) AS n FROM inc GROUP BY 1",
        "deployments_by_year": 'SELECT year, count(*) AS "count" FROM u GROUP BY 1',
        "deployments_change": 'SELECT year, "count", "count" - lag("count") OVER (ORDER BY year) AS change, ("count" - lag("count") OVER (ORDER BY year)) / "count" * 100 AS pct_change '
                              'FROM (SELECT year, count(*) AS "count" FROM u GROUP BY 1)',
        "deployments_by_district": name("district"),
        "deployments_by_city": f"SELECT * FROM ({name('location')}) WHERE n > 46",
        "location_counts": """SELECT location, latitude, longitude, n, CASE WHEN n <= q80 THEN 10 WHEN n < q90 THEN 15 WHEN n < q99 THEN 20 ELSE 25 END AS quantiles,
               CASE WHEN n <= q80 THEN '01-06' WHEN n < q90 THEN '06-11' WHEN n < q99 THEN '11-47' ELSE '47+' END AS quantile_labels
               FROM c, (SELECT quantile_cont(n, 0.8) AS q80, quantile_cont(n, 0.9) AS q90, quantile_cont(n, 0.99) AS q99 FROM c)""",
        "distinct_locations": "SELECT count(DISTINCT location) AS n FROM inc",
        "missing_locations": "SELECT count(*) AS n FROM inc WHERE location IS NULL",
        "deployments_by_calltype": 'SELECT call_type, count(*) AS "count", count(*) / sum(count(*)) OVER () AS percent FROM u GROUP BY 1',
        "calltype_by_year": 'SELECT year, call_type, count(*) AS "count" FROM u GROUP BY 1, 2',
        "calltype_share_within_year": """SELECT year, call_type, "count", "count" / sum("count") OVER (PARTITION BY year) AS percent
               FROM (SELECT year, call_type, count(*) AS "count" FROM u WHERE call_type <> 'Unknown' GROUP BY 1, 2)""",
        "witnessed_bystander_cpr": f"""SELECT CAST(witnessed AS VARCHAR) AS witnessed, CAST(t AS VARCHAR) AS "true", CAST(f AS VARCHAR) AS "false",
               {_label("t + f", "(t + f) / sum(t + f) OVER ()")} AS total FROM w
               UNION ALL SELECT 'total', {_label("sum(t)::BIGINT", "sum(t) / sum(t + f)")}, {_label("sum(f)::BIGINT", "sum(f) / sum(t + f)")}, CAST(sum(t + f)::BIGINT AS VARCHAR) FROM w""",
        "conditional_witnessed": f"SELECT witnessed, {_label('t', 't / (t + f)')} AS true_bcpr, {_label('f', 'f / (t + f)')} AS false_bcpr FROM w",
        "conditional_bcpr": f"SELECT witnessed, {_label('t', 't / sum(t) OVER ()')} AS true_bcpr, {_label('f', 'f / sum(f) OVER ()')} AS false_bcpr FROM w",
        "agency_type_pareto": """SELECT agency_type, CAST(cnt AS BIGINT) AS "count", cnt / sum(cnt) OVER () AS percent,
               sum(cnt) OVER (ORDER BY first, agency_type ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(cnt) OVER () AS cumpercent
               FROM (SELECT CASE WHEN k < 6 THEN 'Other' ELSE agency_type END AS agency_type, sum(k) AS cnt, min(k) AS first
                     FROM (SELECT agency_type, count(*) AS k FROM u GROUP BY 1) GROUP BY 1)""",
        "survival_by_year": f'SELECT year, "Deceased", "Survived", "Total", {surv} FROM o',
        "survival_by_year_long": "SELECT year, 'Pct_Survived' AS variable, ps AS value FROM o UNION ALL SELECT year, 'Pct_Deceased', pd FROM o",
        "gender_distribution": """SELECT "Sex", s1 AS "Survived", d AS "Deceased", d + s1 AS "Total", printf('%.2f%%', s1 / (s1 + d) * 100) AS "Percent_Survived_By_Sex",
               printf('%.2f%%', s1 / (sum(s1) OVER () + sum(d) OVER ()) * 100) AS "Percent_Survived_Overall"
               FROM (SELECT CASE sex WHEN 'F' THEN 'Female' WHEN 'M' THEN 'Male' ELSE 'Unknown' END AS "Sex",
                            nullif(count(*) FILTER (WHERE s = 'Survived'), 0) AS s1, count(*) FILTER (WHERE s = 'Deceased') AS d FROM u GROUP BY 1)""",
        "age_distribution": f'SELECT age_range, "Deceased", "Survived", "Total", {surv} FROM o',
        "survival_by_calltype": 'SELECT call_type, "Deceased", "Survived", total, ps AS percent_survived_by_group, pd AS percent_deceased_by_group, abs(ps - pd) AS line_length FROM o',
        "survival_by_urbanicity": """SELECT coalesce(urbanicity, 'Not Known') AS urbanicity, "Deceased", "Survived", total, ps AS percent_survived, pd AS percent_deceased,
               format('{:,}', "Survived") || ' (' || printf('%.2f%%', ps * 100) || ')' AS label_survived,
               format('{:,}', "Deceased") || ' (' || printf('%.2f%%', pd * 100) || ')' AS label_deceased FROM o""",
        "other_causes": 'SELECT other_case, count(*) AS "count", count(*) / sum(count(*)) OVER () AS percent FROM u WHERE other_case IS NOT NULL GROUP BY 1',
    }
    before = {"location_counts": "c AS (SELECT location, latitude, longitude, count(*) AS n FROM u WHERE location IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2, 3)",
              "witnessed_bystander_cpr": wb, "conditional_witnessed": wb, "conditional_bcpr": wb,
              "survival_by_year": _report_outcomes("year"), "survival_by_year_long": _report_outcomes("year"),
              "age_distribution": _report_outcomes("age_range", where="age_range IS NOT NULL"),
              "survival_by_calltype": _report_outcomes("call_type", "total"), "survival_by_urbanicity": _report_outcomes("urbanicity", "total")}
    return {f"report_{k}": f"WITH {_REPORT_BASE}{', ' + before[k] if k in before else ''} {v}" for k, v in tables.items()}


def _map_frame_sql() -> str:
    st = _mortality_sql("state")
    verts = " UNION ALL ".join(
        f"SELECT id, {i} AS i, {x} AS x, {y} AS y FROM b" for i, (x, y) in enumerate(
            [("k * 3", "k"), ("k * 3 + 2", "k"), ("k * 3 + 2", "k + 2"), ("k * 3", "k + 2")]))
    return f"""
    WITH st AS ({st}),
    b AS (SELECT "STATEFP" AS id, CAST("STATEFP" AS DOUBLE) AS k FROM st),
    v AS ({verts}),
    e AS (SELECT x, y, coalesce(lead(x) OVER w, first_value(x) OVER w) AS x2,
                 coalesce(lead(y) OVER w, first_value(y) OVER w) AS y2
          FROM v WINDOW w AS (PARTITION BY id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
    t AS (SELECT sum(x * y2 - x2 * y) AS a2, sum((x + x2) * (x * y2 - x2 * y)) AS cx6,
                 sum((y + y2) * (x * y2 - x2 * y)) AS cy6 FROM e)
    SELECT round(cx6 / (3 * a2), 6) AS cx, round(cy6 / (3 * a2), 6) AS cy,
           (SELECT round(min(data_value), 6) FROM st) AS min_value,
           (SELECT round(max(data_value), 6) FROM st) AS max_value FROM t"""


SQL: dict[str, str] = {
    **_report_sql(),
    "sectionize_long_documents": """
        WITH r AS (SELECT conv_id % 4 AS doc, conv_id, turn, CASE WHEN (conv_id + turn) % 5 = 0 THEN 'Turn ' || CAST(conv_id AS VARCHAR) || ':' || chr(10) ELSE '' END
                          || text || CASE WHEN turn = 3 THEN chr(10) || 'last:' ELSE '' END AS text FROM conversations),
        p AS (SELECT doc, conv_id, turn, string_split(text, chr(10)) AS parts FROM r),
        l AS (SELECT doc, conv_id, turn, unnest(parts) AS line, unnest(range(len(parts))) AS line_no FROM p),
        s AS (SELECT *, regexp_replace(line, '^\\s+|\\s+$', '', 'g') AS t FROM l),
        h AS (SELECT *, CASE WHEN t LIKE '%:' THEN replace(t, ':', '') END AS head FROM s),
        f AS (SELECT *, coalesce(last_value(head IGNORE NULLS) OVER (PARTITION BY doc ORDER BY conv_id, turn, line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'General') AS cat FROM h)
        SELECT doc, conv_id, turn, CAST(line_no AS BIGINT) AS line_no, cat AS "Category", t AS "Detail" FROM f WHERE head IS NULL AND t <> ''""",
    "relocated_columns": """
        SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) || '|' || o_orderpriority || '|' || CAST(o_custkey AS VARCHAR) || '|' || o_orderstatus AS line FROM orders""",
    "sorted_by_all_columns": """
        WITH c AS (SELECT CASE WHEN l_orderkey % 5 <> 0 THEN l_returnflag END AS flag, l_linestatus,
                          CASE WHEN l_suppkey % 3 <> 0 THEN l_linenumber END AS line, count(*) AS n FROM lineitem GROUP BY ALL)
        SELECT *, row_number() OVER (ORDER BY flag NULLS LAST, l_linestatus NULLS LAST, line NULLS LAST, n) AS place FROM c""",
    "mortality_map_frame": _map_frame_sql(),
    "outcome_labels": f"""
        WITH p AS ({_outcome_pivot("CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_orderpriority END",
                                   "urbanicity")})
        SELECT coalesce(urbanicity, 'Not Known') AS urbanicity, "Survived", "Deceased",
               "Survived" + "Deceased" AS total,
               format('{{:,}}', "Survived") || ' (' || printf('%.2f%%', "Survived" / ("Survived" + "Deceased") * 100) || ')'
                 AS label_survived,
               format('{{:,}}', "Deceased") || ' (' || printf('%.2f%%', "Deceased" / ("Survived" + "Deceased") * 100) || ')'
                 AS label_deceased
        FROM p""",
    "incident_location_counts": _incident_reports_sql("location_counts"),
    "incident_city_share": _incident_reports_sql("city"),
    "mortality_state": _mortality_sql("state"),
    "mortality_county": _mortality_sql("county"),
    "mortality_national": _mortality_sql("national"),
    "runs_build": _runs_sql(),
    "gazetteer_build": "WITH " + _gazetteer_sql() + " SELECT * FROM gz",
    "incident_build": _incident_sql(),
    "count_by_year_keep_first": """
        SELECT CAST(year(l_shipdate) AS BIGINT) AS year, count(*) AS n
        FROM (SELECT l_shipdate, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber,
                     l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem)
        WHERE rn = 1 GROUP BY 1 ORDER BY 1""",

    "share_by_district": f"""
        WITH x AS (
          SELECT coalesce({_squish("r.r_name")}, 'Not Recorded') AS district
          FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
          LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
          LEFT JOIN (SELECT * FROM region WHERE r_name <> 'MIDDLE EAST') r ON n.n_regionkey = r.r_regionkey)
        SELECT district, count(*) AS n, count(*) / sum(count(*)) OVER () AS percent
        FROM x GROUP BY district ORDER BY percent DESC, district""",

    "threshold_after_share": """
        SELECT o_custkey, n, percent FROM (
          SELECT o_custkey, count(*) AS n, count(*) / sum(count(*)) OVER () AS percent FROM orders GROUP BY 1)
        WHERE n > 15""",

    "agencies_per_year": """
        SELECT CAST(year(o_orderdate) AS BIGINT) AS year, count(DISTINCT o_custkey) AS n FROM orders GROUP BY 1 ORDER BY 1""",

    "yoy_change": """
        SELECT year, "count", "count" - lag("count") OVER (ORDER BY year) AS change,
               ("count" - lag("count") OVER (ORDER BY year)) / "count" * 100 AS pct_change
        FROM (SELECT CAST(year(o_orderdate) AS BIGINT) AS year, count(*) AS "count" FROM orders GROUP BY 1)""",

    "calltype_share_within_year": """
        SELECT year, call_type, "count", "count" / sum("count") OVER (PARTITION BY year) AS percent
        FROM (SELECT CAST(year(o_orderdate) AS BIGINT) AS year, o_orderpriority AS call_type, count(*) AS "count"
              FROM orders GROUP BY 1, 2)
        WHERE call_type <> '4-NOT SPECIFIED'""",

    "count_share_proprow": """
        SELECT event_type, count(*) AS "count", count(*) / sum(count(*)) OVER () AS percent FROM events GROUP BY 1""",

    "two_way_table": f"""
        WITH p AS ({_pivot_labels()})
        SELECT CAST(witnessed AS VARCHAR) AS witnessed, CAST(t AS VARCHAR) AS "true", CAST(f AS VARCHAR) AS "false",
               {_label("n", "n / sum(n) OVER ()")} AS total FROM p JOIN ({_row_totals()}) USING (witnessed)
        UNION ALL
        SELECT 'total', {_label("count(*) FILTER (WHERE bcpr)", "count(*) FILTER (WHERE bcpr) / count(*)")},
               {_label("count(*) FILTER (WHERE NOT bcpr)", "count(*) FILTER (WHERE NOT bcpr) / count(*)")},
               CAST(count(*) AS VARCHAR) FROM ({_labels_base()})""",

    "two_way_table_absent_cell": f"""
        WITH b AS (SELECT p_size > 25 AS big, p_size > 40 AS huge FROM part),
        p AS (SELECT big, count(*) FILTER (WHERE huge) AS t, count(*) FILTER (WHERE NOT huge) AS f, count(*) AS n FROM b GROUP BY big)
        SELECT CAST(big AS VARCHAR) AS big, CAST(nullif(t, 0) AS VARCHAR) AS "true", CAST(nullif(f, 0) AS VARCHAR) AS "false",
               {_label("n", "n / sum(n) OVER ()")} AS total FROM p
        UNION ALL
        SELECT 'total', {_label("count(*) FILTER (WHERE huge)", "count(*) FILTER (WHERE huge) / count(*)")},
               {_label("count(*) FILTER (WHERE NOT huge)", "count(*) FILTER (WHERE NOT huge) / count(*)")},
               CAST(count(*) AS VARCHAR) FROM b""",

    "conditional_given_row": f"""
        WITH p AS ({_pivot_labels()})
        SELECT witnessed, {_label("t", "t / (t + f)")} AS true_bcpr, {_label("f", "f / (t + f)")} AS false_bcpr FROM p""",

    "conditional_given_col": f"""
        WITH p AS ({_pivot_labels()})
        SELECT witnessed, {_label("t", "t / sum(t) OVER ()")} AS true_bcpr,
               {_label("f", "f / sum(f) OVER ()")} AS false_bcpr FROM p""",

    "lump_and_pareto": """
        WITH c AS (SELECT p_brand || ' ' || p_type AS category, count(*) AS cnt FROM part GROUP BY 1),
        l AS (SELECT CASE WHEN cnt < 10 THEN 'Other' ELSE category END AS category, sum(cnt) AS cnt,
                     min(cnt) AS first FROM c GROUP BY 1)
        SELECT category, CAST(cnt AS BIGINT) AS "count", cnt / sum(cnt) OVER () AS percent,
               sum(cnt) OVER (ORDER BY first, category ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                 / sum(cnt) OVER () AS cumpercent
        FROM l""",

    "outcome_by_year": f"""
        WITH p AS ({_outcome_pivot("CAST(year(o_orderdate) AS BIGINT)", "year")})
        SELECT year, "Deceased", "Survived", "Unknown", "Deceased" + "Survived" AS "Total",
               "Survived" / ("Deceased" + "Survived") AS "Pct_Survived",
               "Deceased" / ("Deceased" + "Survived") AS "Pct_Deceased" FROM p ORDER BY year""",

    "outcome_by_year_long": f"""
        WITH p AS ({_outcome_pivot("CAST(year(o_orderdate) AS BIGINT)", "year")}),
        w AS (SELECT year, "Survived" / ("Deceased" + "Survived") AS ps, "Deceased" / ("Deceased" + "Survived") AS pd FROM p)
        SELECT year, 'Pct_Survived' AS variable, ps AS value FROM w
        UNION ALL SELECT year, 'Pct_Deceased', pd FROM w""",

    "outcome_by_recode": f"""
        WITH x AS (
          SELECT CASE WHEN c.c_custkey % 7 = 0 THEN NULL ELSE c.c_mktsegment END AS seg, {SURVIVAL} AS survival
          FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
        r AS (SELECT CASE WHEN seg IS NULL THEN 'Unknown' WHEN seg = 'BUILDING' THEN 'Female'
                          WHEN seg = 'AUTOMOBILE' THEN 'Male' ELSE 'Unknown' END AS "Sex", survival FROM x),
        p AS (SELECT "Sex", nullif(count(*) FILTER (WHERE survival = 'Survived'), 0) AS s,
                     count(*) FILTER (WHERE survival = 'Deceased') AS d FROM r GROUP BY 1)
        SELECT "Sex", s AS "Survived", d AS "Deceased", d + s AS "Total",
               printf('%.2f%%', s / (s + d) * 100) AS "Percent_Survived_By_Sex",
               printf('%.2f%%', s / (sum(s) OVER () + sum(d) OVER ()) * 100) AS "Percent_Survived_Overall"
        FROM p""",

    "outcome_gap": f"""
        WITH p AS ({_outcome_pivot("o_orderpriority", "call_type")})
        SELECT call_type, "Deceased", "Survived", "Unknown", "Survived" + "Deceased" AS total,
               "Survived" / ("Survived" + "Deceased") AS percent_survived_by_group,
               "Deceased" / ("Survived" + "Deceased") AS percent_deceased_by_group,
               abs("Survived" / ("Survived" + "Deceased") - "Deceased" / ("Survived" + "Deceased")) AS line_length
        FROM p ORDER BY percent_survived_by_group DESC""",

    "quantile_bins": """
        WITH c AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1),
        q AS (SELECT quantile_cont(n, 0.8) AS q80, quantile_cont(n, 0.9) AS q90, quantile_cont(n, 0.99) AS q99 FROM c)
        SELECT l_partkey, n,
               CASE WHEN n <= q80 THEN 10 WHEN n < q90 THEN 15 WHEN n < q99 THEN 20 ELSE 25 END AS quantiles,
               CASE WHEN n <= q80 THEN '01-06' WHEN n < q90 THEN '06-11' WHEN n < q99 THEN '11-47' ELSE '47+' END
                 AS quantile_labels
        FROM c, q ORDER BY l_partkey""",

    "median_impute": """
        WITH x AS (SELECT event_id, event_type, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value
                   FROM events)
        SELECT event_id, event_type, round(coalesce(value, (SELECT median(value) FROM x)), 6) AS value FROM x""",

    "collapse_one_to_many": """
        WITH p AS (SELECT DISTINCT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS ship_day,
                          l_returnflag, l_linestatus FROM lineitem),
        pr AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey
                         ORDER BY l_linenumber, ship_day, l_returnflag, l_linestatus) AS pos FROM p),
        s1 AS (SELECT l_orderkey, string_agg(ship_day, ', ' ORDER BY pos) AS performed_at,
                      string_agg(CAST(l_linenumber AS VARCHAR), ', ' ORDER BY pos) AS attempts FROM pr GROUP BY 1),
        c1 AS (SELECT l_orderkey, string_agg(l_returnflag, ', ' ORDER BY fp) AS complaint
               FROM (SELECT l_orderkey, l_returnflag, min(pos) AS fp FROM pr GROUP BY 1, 2) GROUP BY 1),
        d1 AS (SELECT l_orderkey, string_agg(l_linestatus, ', ' ORDER BY fp) AS description
               FROM (SELECT l_orderkey, l_linestatus, min(pos) AS fp FROM pr GROUP BY 1, 2) GROUP BY 1),
        m AS (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey FROM lineitem),
        s2 AS (SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ', ' ORDER BY l_partkey, l_suppkey) AS medication,
                      string_agg(CAST(l_suppkey AS VARCHAR), ', ' ORDER BY l_partkey, l_suppkey) AS response
               FROM m GROUP BY 1)
        SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderpriority, c1.complaint, d1.description,
               s1.performed_at, s1.attempts, s2.medication, s2.response
        FROM orders o LEFT JOIN s1 ON o.o_orderkey = s1.l_orderkey LEFT JOIN c1 ON o.o_orderkey = c1.l_orderkey
        LEFT JOIN d1 ON o.o_orderkey = d1.l_orderkey LEFT JOIN s2 ON o.o_orderkey = s2.l_orderkey""",

    "procedure_summary": f"""
        WITH r AS (SELECT DISTINCT l_orderkey,
                     CASE l_returnflag WHEN 'R' THEN 'Defibrillation, AED' WHEN 'A' THEN 'CV - Cardioversion'
                          ELSE 'Airway - Suction' END AS description,
                     strftime(l_shipdate, '%Y-%m-%d') AS performed_at,
                     CASE WHEN l_linenumber = 1 THEN NULL ELSE l_linenumber END AS attempts
                   FROM lineitem
                   WHERE regexp_matches(CASE l_returnflag WHEN 'R' THEN 'Defibrillation, AED'
                          WHEN 'A' THEN 'CV - Cardioversion' ELSE 'Airway - Suction' END, {_q('(?i)' + R.DEFIB_PATTERN)})),
        f AS (SELECT l_orderkey, coalesce(description, '') AS description, coalesce(performed_at, '') AS performed_at,
                     coalesce(attempts, 1) AS attempts FROM r)
        SELECT l_orderkey, CAST(sum(attempts) AS BIGINT) AS shocks,
               string_agg(description, ', ' ORDER BY performed_at, description, attempts) AS description,
               string_agg(performed_at, ', ' ORDER BY performed_at, description, attempts) AS performed_at,
               string_agg(CAST(attempts AS VARCHAR), ', ' ORDER BY performed_at, description, attempts) AS attempts
        FROM f GROUP BY 1""",

    "midnight_rollover": f"""
        WITH e AS (SELECT event_id, ts, epoch_us(ts) - epoch_us(date_trunc('day', ts)) AS tod FROM events),
        x AS (SELECT event_id, ts AS t1,
                     CASE WHEN event_id % 11 = 0 THEN NULL
                          ELSE date_trunc('day', ts) + to_microseconds(
                            ((tod + ((event_id % 180) - 30) * 60000000) % 86400000000 + 86400000000) % 86400000000)
                     END AS t2 FROM e),
        f AS (SELECT *, CASE WHEN t1 IS NOT NULL AND t2 IS NOT NULL AND hour(t1) > hour(t2) THEN t2 + INTERVAL 1 DAY
                             ELSE t2 END AS t2_fix FROM x)
        SELECT event_id, strftime(t1, {TS}) AS t1, strftime(t2, {TS}) AS t2, strftime(t2_fix, {TS}) AS t2_fix,
               (epoch_us(t2_fix) - epoch_us(t1)) / 60000000 AS minutes FROM f""",

    "time_of_day_add": """
        WITH x AS (SELECT event_id,
                     CASE WHEN event_id % 13 = 0 THEN NULL ELSE epoch_us(ts) - epoch_us(date_trunc('day', ts)) END AS tod_on,
                     CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN 0
                          ELSE (event_id % 7200) * 1000000 + event_id % 1000 END AS duration FROM events),
        y AS (SELECT *, (((tod_on + duration - (duration % 1000000)) % 86400000000) + 86400000000) % 86400000000 AS off
              FROM x)
        SELECT event_id, tod_on, duration, CASE WHEN coalesce(tod_on = off, false) THEN NULL ELSE off END AS tod_off
        FROM y""",

    "interval_family": """
        WITH s AS (SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1)
        SELECT o_orderkey,
               (epoch_us(first_ship) - epoch_us(o_orderdate)) / 60000000 AS order_to_first_ship,
               (epoch_us(last_ship) - epoch_us(o_orderdate)) / 60000000 AS order_to_last_ship,
               (epoch_us(last_ship) - epoch_us(first_ship)) / 60000000 AS first_to_last_ship
        FROM orders LEFT JOIN s ON o_orderkey = l_orderkey""",

    "parse_mdy": """
        WITH x AS (SELECT o_orderkey,
                     CASE WHEN o_orderkey % 13 = 0 THEN 'not a date' ELSE strftime(o_orderdate, '%-m/%-d/%Y') END AS date_text,
                     CASE WHEN o_orderkey % 11 = 0 THEN '13/45/2020 25:00:00'
                          ELSE strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%-m/%-d/%Y %-H:%M:%S') END AS ts_text
                   FROM orders)
        SELECT o_orderkey, date_text, ts_text,
               strftime(try_strptime(date_text, '%m/%d/%Y'), '%Y-%m-%d') AS parsed_date,
               strftime(try_strptime(ts_text, '%m/%d/%Y %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS parsed_ts FROM x""",

    "calendar_features": """
        WITH x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS d
                   FROM orders)
        SELECT o_orderkey, dayname(d) AS incident_day, monthname(d) AS incident_month,
               dayofweek(d) IN (0, 6) AS weekday_weekend,
               CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) IN (3, 4, 5) THEN 'Spring'
                    WHEN month(d) IN (6, 7, 8) THEN 'Summer' WHEN d IS NULL THEN NULL ELSE 'Fall' END AS season
        FROM x""",

    "fiscal_year_table": f"""
        SELECT fy, count(*) FILTER (WHERE s = 'Survived') AS survival, count(*) AS n,
               count(*) FILTER (WHERE s = 'Survived') / count(*) AS percent
        FROM (SELECT {_fy_case()} AS fy, {SURVIVAL} AS s FROM orders) GROUP BY fy ORDER BY fy""",

    "fiscal_year_rates": f"""
        SELECT round(avg(n), 9) AS mean_n, round(avg(percent), 12) AS mean_pct FROM (
          SELECT fy, count(*) AS n, count(*) FILTER (WHERE s = 'Survived') / count(*) AS percent
          FROM (SELECT {_fy_case()} AS fy, {SURVIVAL} AS s FROM orders) GROUP BY fy)""",

    "age_bands": f"""
        WITH x AS (
          SELECT c_custkey,
                 CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN abs(c_acctbal) / 100 * 365
                      WHEN c_custkey % 5 = 1 THEN abs(c_acctbal) / 100 * 12 WHEN c_custkey % 5 = 2 THEN abs(c_acctbal) / 100 * 52
                      ELSE abs(c_acctbal) / 100 END AS age,
                 CASE c_custkey % 5 WHEN 0 THEN 'Days' WHEN 1 THEN 'Months' WHEN 2 THEN 'Weeks' WHEN 3 THEN 'Years'
                      ELSE 'Not Recorded' END AS age_unit
          FROM customer),
        y AS (SELECT *, CASE age_unit WHEN 'Days' THEN age / 365.25 WHEN 'Months' THEN age / 12
                                      WHEN 'Weeks' THEN age / 52.1786 ELSE age END AS age_years FROM x)
        SELECT c_custkey, age_unit, round(age_years, 6) AS age_years, {_age_band("age_years")} AS age_range FROM y""",

    "clean_place_chain": _clean_place_sql(),

    "dictionary_extract": _dictionary_sql(),
    "dictionary_extract_ngram": _dictionary_sql(),

    "dictionary_extract_punctuated": _punctuated_sql(),

    "dictionary_extract_punctuated_regex": _punctuated_sql(),

    "code_parts": """
        WITH x AS (
          SELECT n_nationkey,
                 CASE WHEN n_nationkey % 5 = 0 THEN 'CA.' || substr(r_name, 1, 2) || '.' || CAST(n_nationkey AS VARCHAR)
                      WHEN n_nationkey % 5 = 1 THEN 'US.' || CAST(n_regionkey + 10 AS VARCHAR) || '.' || CAST(n_nationkey AS VARCHAR)
                      ELSE 'US.' || substr(r_name, 1, 2) || '.' || CAST(n_nationkey * 7 AS VARCHAR) END AS code,
                 n_name || ' County ' AS county_name
          FROM nation JOIN region ON n_regionkey = r_regionkey),
        y AS (SELECT n_nationkey, code,
                     trim(regexp_replace(nullif(regexp_extract(code, '^[^\\.]+', 0), ''), '\\s+', ' ', 'g')) AS country_code,
                     nullif(regexp_extract(code, '^[A-Z]{2}\\.(\\d{2}|[A-Z]{2})', 1), '') AS state_code,
                     nullif(regexp_extract(code, '\\.(\\d+)$', 1), '') AS county_code,
                     trim(regexp_replace(regexp_replace(county_name, '(?i)\\scounty', ''), '\\s+', ' ', 'g')) AS name_county
              FROM x)
        SELECT *, CASE WHEN length(county_code) < 3 THEN lpad(county_code, 3, '0') ELSE county_code END AS county_padded
        FROM y""",

    "fips_build": """
        WITH x AS (SELECT n_nationkey, CASE WHEN n_nationkey % 6 = 0 THEN '' WHEN n_nationkey % 7 = 0 THEN NULL
                                            ELSE CAST(n_nationkey * 7 AS VARCHAR) END AS county_raw FROM nation),
        y AS (SELECT *, CASE WHEN length(coalesce(county_raw, '')) = 0 THEN NULL
                             WHEN length(county_raw) IN (1, 2) THEN lpad(county_raw, 3, '0') ELSE county_raw END AS county_id
              FROM x)
        SELECT n_nationkey, county_raw, county_id, '19' || county_id AS county_fips,
               '19' || coalesce(county_id, 'missing') AS county_fips_as_coded FROM y""",

    "exclude_pairs_query": """
        SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
        WHERE (n_name, r_name) NOT IN (SELECT * FROM (VALUES ('NATION_1', 'AMERICA'), ('NATION_7', 'ASIA'),
                                         ('NATION_24', 'MIDDLE EAST'), ('NATION_3', 'AFRICA')))""",

    "right_join_boundaries": f"""
        WITH m AS (SELECT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS locationid, round(avg(c_acctbal), 6) AS data_value
                   FROM customer
                   WHERE lpad(CAST(c_nationkey AS VARCHAR), 2, '0') NOT IN
                         ({", ".join(_q(c) for c in R.NON_CONTINENTAL_STATE_FIPS)})
                   GROUP BY 1)
        SELECT b."STATEFP", b.n_name, m.data_value FROM m RIGHT JOIN
          (SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS "STATEFP", n_name FROM nation) b ON m.locationid = b."STATEFP" """,

    "union_manual_rows": f"""
        SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name, n_regionkey AS regionkey,
               CAST(NULL AS VARCHAR) AS admin3_code FROM nation
        UNION ALL
        SELECT {surrogate_id_sql("name", R.INCIDENT_ID_SEED)}, name, regionkey, CAST(NULL AS VARCHAR)
        FROM (VALUES ('MANUAL TOWN A', 3), ('MANUAL TOWN B', 4), ('MANUAL TOWN C', 0)) v(name, regionkey)""",

    "surrogate_ids": f"""
        WITH x AS (SELECT CAST(l_orderkey AS VARCHAR) || CASE WHEN l_linenumber % 2 = 0 THEN '|' ELSE '' END AS a,
                          CASE WHEN l_linenumber % 2 = 0 THEN '' ELSE '|' END || CAST(l_partkey % 3 AS VARCHAR) AS b,
                          CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE l_returnflag END AS c FROM lineitem),
        y AS (SELECT *, row_number() OVER (PARTITION BY a, b, c) AS k FROM x)
        SELECT a, b, c, CASE WHEN k = 1 THEN {surrogate_id_sql(["a", "b", "c"], 10232015)}
                             ELSE {surrogate_id_sql(["a", "b", "c", "k"], 10232015)} END AS unique_incident_id
        FROM y""",

    "surrogate_ids_unique": """
        SELECT count(*) AS n_rows, count(*) AS n_ids, count(*) AS n_kept FROM lineitem""",

    "sectionize_text": """
        WITH b AS (SELECT conv_id, turn, string_split(role || ':' || chr(10) || text, chr(10)) AS parts
                   FROM conversations),
        l AS (SELECT conv_id, turn, unnest(parts) AS line, generate_subscripts(parts, 1) - 1 AS line_no FROM b),
        s AS (SELECT *, regexp_replace(line, '^\\s+|\\s+$', '', 'g') AS st FROM l),
        h AS (SELECT *, CASE WHEN ends_with(st, ':') THEN replace(st, ':', '') END AS hd FROM s),
        c AS (SELECT *, coalesce(last_value(hd IGNORE NULLS) OVER (PARTITION BY conv_id, turn ORDER BY line_no
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'General') AS "Category" FROM h)
        SELECT conv_id, turn, CAST(line_no AS BIGINT) AS line_no, "Category", st AS "Detail" FROM c
        WHERE NOT ends_with(st, ':') AND st <> ''""",

    "outcome_flags": """
        WITH x AS (
          SELECT l.doc_id, l.quality, l.toxic, d.text,
                 CASE l.doc_id % 6 WHEN 0 THEN NULL WHEN 1 THEN 'ROSC in the ED' WHEN 2 THEN 'ROSC in the Field'
                      WHEN 3 THEN 'Not Applicable' WHEN 4 THEN 'Expired in the ED' ELSE 'Ongoing Resuscitation in ED' END
                   AS outcome_raw,
                 CASE WHEN l.toxic = 1 THEN 'Dead at Scene' ELSE 'Transported' END AS disposition
          FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id),
        y AS (SELECT *, CASE WHEN outcome_raw IS NULL OR (regexp_matches(coalesce(outcome_raw, ''), '(?i)not applicable|not recorded')
                                AND regexp_matches(disposition, '(?i)dead')) THEN 'Expired in the Field'
                             ELSE outcome_raw END AS outcome FROM x)
        SELECT doc_id, outcome,
               regexp_matches(outcome, '(?i)rosc in the ed') AS rosc_ed,
               regexp_matches(outcome, '(?i)rosc in the field') AS rosc_field,
               regexp_matches(outcome, '(?i)ongoing resuscitation by other ems') AS ongoing_resus_ems,
               regexp_matches(outcome, '(?i)ongoing resuscitation in ed') AS ongoing_resus_ed,
               regexp_matches(outcome, '(?i)expired in the field') AS expire_field,
               regexp_matches(outcome, '(?i)expired in the ed') AS expire_ed,
               NOT regexp_matches(outcome, '(?i)expire') AS survival,
               NOT regexp_matches(coalesce(text, ''), '(?i)not') AS witnessed,
               CASE WHEN quality = 1 THEN 'yes' WHEN doc_id % 4 = 0 THEN 'Not Recorded' ELSE 'No' END AS cpr,
               CASE WHEN coalesce(CASE WHEN doc_id % 9 = 0 THEN NULL ELSE toxic = 1 END, false) OR quality = 0
                    THEN 'Deceased' ELSE 'Survived' END AS survival_incident
        FROM y""",

    "call_type_precedence": """
        WITH x AS (
          SELECT l.doc_id,
                 coalesce(CASE WHEN l.doc_id % 5 = 0 THEN NULL ELSE l.quality = 1 END, false) AS cardiac_episode,
                 coalesce(CASE WHEN l.doc_id % 7 = 0 THEN NULL ELSE l.toxic = 1 END, false) AS od_case,
                 CASE WHEN d.lang = 'fr' THEN d.source END AS other_case
          FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id)
        SELECT doc_id, cardiac_episode, od_case, other_case IS NOT NULL AND NOT cardiac_episode AS other_case_binary,
               CASE WHEN cardiac_episode THEN 'Cardiac Arrest' WHEN od_case THEN 'Overdose'
                    WHEN other_case IS NOT NULL AND NOT cardiac_episode THEN 'Other Cause' ELSE 'Unknown' END AS call_type
        FROM x""",

    "fanout_report_join": """
        SELECT o_orderkey, n_matches FROM (SELECT DISTINCT o_orderkey FROM orders)
        JOIN (SELECT l_orderkey, count(*) AS n_matches FROM lineitem GROUP BY 1 HAVING count(*) > 1) ON o_orderkey = l_orderkey""",

    "distinct_and_missing": """
        SELECT count(DISTINCT segment) + max(CASE WHEN segment IS NULL THEN 1 ELSE 0 END) AS n_with_missing,
               count(DISTINCT segment) AS n_plain, count(*) FILTER (segment IS NULL) AS n_missing
        FROM (SELECT CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS segment FROM customer)""",

    "category_levels": """
        SELECT DISTINCT CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS priority FROM orders""",

    "composite_fips_codes": """
        SELECT s_suppkey, lpad(CAST(s_suppkey % 60 AS VARCHAR), 2, '0') || lpad(CAST(s_nationkey AS VARCHAR), 3, '0') AS fips FROM supplier""",

    "write_and_read_back": """
        SELECT o_orderkey, o_orderstatus, o_orderpriority, round(o_totalprice, 2) AS o_totalprice, how
        FROM orders, (VALUES ('csv'), ('delimited')) v(how)""",

    "sectionize_many_headers": """
        SELECT p_partkey, CAST(line_no AS BIGINT) AS line_no, Category AS "Category", Detail AS "Detail" FROM (
          SELECT p_partkey, 0 AS line_no, 'General' AS Category, 'lead ' || p_name AS Detail FROM part
          UNION ALL SELECT p_partkey, 3, 'Size', CAST(p_size AS VARCHAR) FROM part
          UNION ALL SELECT p_partkey, 4, 'Size', 'more ' || p_type FROM part
          UNION ALL SELECT p_partkey, 6, 'Kind', p_type FROM part
          UNION ALL SELECT p_partkey, 8, 'Size', 'again ' || p_name FROM part)""",

    "incident_fanout_reports": f"""
        WITH inc AS (SELECT o_orderkey, location FROM ({_incident_sql()})),
        g AS (SELECT DISTINCT name, name_county, district, urbanicity FROM (WITH {_gazetteer_sql()} SELECT * FROM gz)),
        dim AS (SELECT * FROM g UNION ALL
                SELECT name, 'Also ' || name_county, '99', 'Mixed' FROM g WHERE name LIKE '%1' OR name LIKE '%A'),
        u AS (SELECT o_orderkey, district, urbanicity FROM (
                SELECT inc.o_orderkey, dim.district, dim.urbanicity,
                       row_number() OVER (PARTITION BY inc.o_orderkey ORDER BY dim.name_county NULLS LAST,
                                          dim.district NULLS LAST, dim.urbanicity NULLS LAST) AS rn
                FROM inc LEFT JOIN dim ON inc.location = dim.name) WHERE rn = 1),
        v AS (SELECT 'district' AS report, coalesce(district, 'Not Recorded') AS value FROM u
              UNION ALL SELECT 'urbanicity', coalesce(urbanicity, 'Not Recorded') FROM u)
        SELECT report, value, count(*) AS n, count(*) / (SELECT count(*) FROM u) AS percent FROM v GROUP BY 1, 2""",

    "fanout_report": """
        SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",

    "code_lookup": """
        SELECT o_orderkey, call_type,
               CASE call_type WHEN 'Cardiac Arrest' THEN 1 WHEN 'Overdose' THEN 2 WHEN 'Other Cause' THEN 3 END AS code
        FROM (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'Cardiac Arrest' WHEN '2-HIGH' THEN 'Overdose'
                     WHEN '3-MEDIUM' THEN 'Other Cause' ELSE 'Unknown' END AS call_type FROM orders)""",

    "centroid": _centroid_sql(),

    "type_spec_ingest": """
        SELECT o_orderkey AS order_key_id, o_orderstatus AS order_status,
               CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_totalprice END AS total_price,
               CAST(o_orderdate AS DATE) AS order_date,
               CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE o_orderpriority END AS order_priority
        FROM orders""",

    "rule_classify": f"""
        SELECT p_partkey, descr, {_rules_case("descr", PART_RULES, "'Unknown'")}
               AS part_class
        FROM (SELECT p_partkey, p_type || ' ' || p_name AS descr FROM part)""",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)

"""Gazetteer of populated places with county codes and county attributes.

Inputs are tables (no download/unzip: see README): ``places`` (geonames
layout, 19 columns), ``county_codes`` (code, name, asciiname, geonameID) and
``county_attrs`` (county, county_fips, region_preparedness, designation,
urbanicity).  All joins are fact -> small dimension; dimensions are
broadcast only after a bounded row count.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions import rules as R
from vigil.functions.ids import surrogate_id
from vigil.functions.strings import extract_first, pad_left, remove_first, squish
from vigil.operators.joins import exclude_pairs, left_lookup
from vigil.sources.io import literal_table

PLACE_COLUMNS = ["geonameid", "name", "asciiname", "alternatenames", "latitude", "longitude", "feature_class",
                 "feature_code", "country_code", "cc2", "admin1_code", "admin2_code", "admin3_code", "admin4_code",
                 "population", "elevation", "dem", "timezone", "modification_date"]
PLACE_SCHEMA = T.StructType([
    T.StructField("geonameid", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("asciiname", T.StringType()), T.StructField("alternatenames", T.StringType()),
    T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType()),
    T.StructField("feature_class", T.StringType()), T.StructField("feature_code", T.StringType()),
    T.StructField("country_code", T.StringType()), T.StructField("cc2", T.StringType()),
    T.StructField("admin1_code", T.StringType()), T.StructField("admin2_code", T.StringType()),
    T.StructField("admin3_code", T.StringType()), T.StructField("admin4_code", T.StringType()),
    T.StructField("population", T.LongType()), T.StructField("elevation", T.DoubleType()),
    T.StructField("dem", T.DoubleType()), T.StructField("timezone", T.StringType()),
    T.StructField("modification_date", T.DateType())])
COUNTY_CODE_SCHEMA = T.StructType([
    T.StructField("code", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("asciiname", T.StringType()), T.StructField("geonameID", T.LongType())])

# Places missing from geonames, added by hand
# (name, name_county, latitude, longitude, district, admin2_code).
MANUAL_PLACES = [
    ("TERRILL", "Dickinson", 43.305473, -94.971433, "7", "059"),
    ("LEMARS", "Plymouth", 42.7942, -96.1656, "3", "149"),
    ("FREDRICKSBURG", "Chickasaw", 42.964586, -92.198465, "2", "037"),
    ("MOLVILLE", "Woodbury", 42.488210, -96.069997, "3", "193"),
    ("CALLENDAR", "Webster", 42.362592, -94.293268, "7", "187"),
    ("SYDNEY", "Fremont", 40.7592, -95.6668, "4", "071"),
    ("DESOTO", "Dallas", 41.5316, -94.0078, "1A", "049"),
]
MANUAL_SCHEMA = ("name string, name_county string, latitude double, longitude double, district string, "
                 "admin2_code string")


def county_table(county_codes: DataFrame, state: str = "IA", country: str = "US") -> DataFrame:
    """Split ``US.IA.153`` codes, strip " County" from names, keep one state."""
    c = county_codes.withColumns({
        "country_code": squish(extract_first("code", r"^[^\.]+")),
        "state_code": extract_first("code", r"(?<=^[A-Z]{2}\.)(?:\d{2}|[A-Z]{2})"),
        "county_code": extract_first("code", r"(?<=\.)\d+$")})
    c = c.withColumn("name_county", squish(remove_first("name", r"\scounty", ignore_case=True)))
    return c.where((F.col("country_code") == country) & (F.col("state_code") == state))


def build_gazetteer(spark: SparkSession, places: DataFrame, county_codes: DataFrame, county_attrs: DataFrame,
                    state: str = "IA", exclusions: Sequence[tuple[str, str]] = tuple(R.GAZETTEER_EXCLUSIONS),
                    manual: Sequence[tuple] = tuple(MANUAL_PLACES), seed: int = R.INCIDENT_ID_SEED) -> DataFrame:
    """Populated places of one state with county name, district and county
    attributes; wrong (city, county) pairs removed; manual places appended.
    ``geonameid`` is text (numeric ids and generated ids share the column)."""
    p = (places.where((F.col("admin1_code") == state) & (F.col("feature_class") == "P"))
         .withColumns({"name": squish(remove_first("name", r"\s\(historical\)", ignore_case=True)),
                       "admin2_code": F.col("admin2_code").cast("string")})
         .withColumn("admin2_code", pad_left("admin2_code", 3)))
    # county tables are dimensions: Catalyst/AQE broadcast them from measured size
    counties = county_table(county_codes, state).select("county_code", "name_county")
    attrs = county_attrs
    g = left_lookup(p, counties, "admin2_code", "county_code", ["name_county"]).withColumn("name", F.upper("name"))
    g = left_lookup(g, attrs, "name_county", "county", [c for c in attrs.columns if c != "county"])
    g = g.withColumns({"name": F.coalesce("name", F.lit("")), "name_county": F.coalesce("name_county", F.lit(""))})
    ex = literal_table(spark, list(exclusions), "name string, name_county string")
    g = exclude_pairs(g, ex, ["name", "name_county"]).withColumnRenamed("region_preparedness", "district")
    g = g.withColumn("geonameid", F.col("geonameid").cast("string"))
    if manual:
        m = literal_table(spark, list(manual), MANUAL_SCHEMA)
        m = left_lookup(m, attrs, "name_county", "county",
                        [c for c in attrs.columns if c not in ("county", "region_preparedness")])
        m = m.withColumn("geonameid", surrogate_id(["name", "name_county"], seed))
        g = g.unionByName(m, allowMissingColumns=True)
    return g

import os
import tempfile

from fixtures import COUNTY_ATTR_SCHEMA, COUNTY_ATTRS, COUNTY_CODES, INCIDENT_SCHEMA, INCIDENTS, PLACES
from vigil.plans import gazetteer as G
from vigil.plans.incidents import build_incidents
from vigil.streaming import incident_stream, start_incident_sink


def test_streaming_build_equals_batch(spark):
    d = tempfile.mkdtemp(prefix="vigil-stream-", dir="/tmp")
    src, out, ck = (os.path.join(d, x) for x in ("src", "out", "ck"))
    raw = spark.createDataFrame(INCIDENTS, INCIDENT_SCHEMA)
    raw.limit(3).write.parquet(os.path.join(src, "a"))
    raw.subtract(raw.limit(3)).write.parquet(os.path.join(src, "b"))
    gz = G.build_gazetteer(spark, spark.createDataFrame(PLACES, G.PLACE_SCHEMA),
                           spark.createDataFrame(COUNTY_CODES, G.COUNTY_CODE_SCHEMA),
                           spark.createDataFrame(COUNTY_ATTRS, COUNTY_ATTR_SCHEMA))
    ids = [c.split()[0] for c in INCIDENT_SCHEMA.split(", ")]
    stream = incident_stream(spark, os.path.join(src, "*"), INCIDENT_SCHEMA, gz, id_cols=ids)
    q = start_incident_sink(stream, out, checkpoint_location=ck, partition_by=None)
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    batch = build_incidents(raw, gz, id_cols=ids)
    cols = ["unique_incident_id", "location", "time_aed_off", "agency_type", "survival"]
    assert sorted(map(tuple, got.select(cols).collect()), key=str) == sorted(map(tuple, batch.select(cols).collect()), key=str)

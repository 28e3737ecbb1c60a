"""Rows without a key, long documents: spread over tasks, and the same results."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.operators.joins import left_lookup
from vigil.operators.text import sectionize, sectionize_rows

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}


@pytest.fixture
def shuffled(spark):
    old = {k: spark.conf.get(k) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def test_rows_without_a_key_are_dealt_to_many_tasks(shuffled):
    spark = shuffled
    fact = spark.range(4000).select("id", F.when(F.col("id") % 10 == 0, F.col("id") % 7).alias("k"))
    dim = spark.createDataFrame([(k, f"name {k}") for k in range(5)] + [(None, "nobody")], "key long, name string")
    out = left_lookup(fact, dim, "k", "key", ["name"])
    sizes = [n for n in out.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()]
    assert max(sizes) < 0.5 * sum(sizes) and sum(n > 200 for n in sizes) >= 3
    got = {r.id: r.name for r in out.collect()}
    assert out.columns == ["id", "k", "name"]
    assert got == {i: f"name {i % 7}" if i % 10 == 0 and i % 7 < 5 else None for i in range(4000)}


def test_two_keys_and_null_safe_lookups(spark):
    fact = spark.createDataFrame([(1, "a", None), (2, None, 1), (3, "a", 1), (4, None, None)], "id long, x string, y long")
    dim = spark.createDataFrame([("a", 1, "hit"), (None, None, "none"), ("a", None, "half")], "p string, q long, v string")
    plain = {r.id: r.v for r in left_lookup(fact, dim, ["x", "y"], ["p", "q"], ["v"]).collect()}
    safe = {r.id: r.v for r in left_lookup(fact, dim, ["x", "y"], ["p", "q"], ["v"], null_safe=True).collect()}
    assert plain == {1: None, 2: None, 3: "hit", 4: None} and safe == {1: "half", 2: None, 3: "hit", 4: "none"}


def test_sections_of_long_documents_equal_the_window(spark):
    rng = np.random.default_rng(4)
    words = ["Head one:", " Other : ", "line a", "", "  b ", ":", "x: y", "Third:"]
    rows = [(None if d == 3 else d, int(i), "\n".join(words[int(k)] for k in rng.integers(len(words), size=rng.integers(0, 6))) if rng.random() < 0.95 else None)
            for d in range(4) for i in range(150)]
    df = spark.createDataFrame(rows, "doc long, i long, text string").repartition(7)
    want = sorted(map(str, sectionize(df.withColumn("text", F.coalesce("text", F.lit(""))), ["doc"], ["i"], "text").collect()))
    assert sorted(map(str, sectionize_rows(df, ["doc"], ["i"], "text").collect())) == want
    assert sectionize_rows(df.limit(0), ["doc"], ["i"], "text").collect() == []


def test_a_long_document_lies_in_many_partitions(shuffled):
    df = shuffled.range(5000).select(F.lit(1).alias("doc"), "id", F.when(F.col("id") == 0, "Only:\nx").otherwise("y").alias("text")).repartition(3)
    out = sectionize_rows(df, ["doc"], ["id"], "text")
    assert {r.Category for r in out.select("Category").distinct().collect()} == {"Only"} and out.count() == 5000
    sizes = out.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert max(sizes) < 0.5 * sum(sizes)

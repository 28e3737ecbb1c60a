import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from vigil.functions.ids import SPREAD, surrogate_id, with_surrogate_id
from vigil.functions.strings import alternation_regex
from vigil.operators.geo import collection_centroid
from vigil.operators.places import extract_dictionary
from vigil.operators.text import sectionize
from vigil.plans import catalog
from vigil.plans.oracle import surrogate_id_sql

from conftest import rows

GAZ = ["DES MOINES", "WEST", "WEST DES MOINES", "AMES", "ST CHARLES", "MOUNT AYR"]


def _dict(spark, names):
    return spark.createDataFrame([(n,) for n in names], "name string")


@pytest.mark.parametrize("method", ["regex", "ngram"])
def test_first_match_semantics(spark, method):
    texts = [(1, "WEST DES MOINES"), (2, "NEAR AMES"), (3, "JAMESTOWN"), (4, "NO PLACE HERE"), (5, None),
             (6, "des moines, west"), (7, "MOUNT  AYR"), (8, "ST CHARLES MOUNT AYR")]
    df = spark.createDataFrame(texts, "id long, text string")
    out = dict(rows(extract_dictionary(df, "text", _dict(spark, GAZ), "name", method=method),
                    "id", "location"))
    assert out == {1: "WEST", 2: "AMES", 3: None, 4: None, 5: None, 6: "des moines", 7: None, 8: "ST CHARLES"}


def test_prefer_longest(spark):
    df = spark.createDataFrame([(1, "WEST DES MOINES")], "id long, text string")
    out = extract_dictionary(df, "text", _dict(spark, GAZ), "name", method="ngram", prefer="longest")
    assert out.first().location == "WEST DES MOINES"


def test_regex_and_ngram_agree_on_random_texts(spark):
    vocab = ["RED", "BLUE", "OAK", "PINE", "HILL", "LAKE", "CITY", "NORTH", "SOUTH"]
    rnd = random.Random(11)
    names = sorted({" ".join(rnd.sample(vocab, rnd.choice([1, 2]))) for _ in range(12)})
    seps = [" ", " ", "  ", ", ", "-"]
    texts = []
    for i in range(300):
        words = [rnd.choice(vocab + ["X", "Y"]) for _ in range(rnd.randint(0, 7))]
        t = ""
        for w in words:
            t += w + rnd.choice(seps)
        texts.append((i, t.strip().lower() if i % 5 == 0 else t.strip()))
    df = spark.createDataFrame(texts, "id long, text string")
    d = _dict(spark, names)
    a = dict(rows(extract_dictionary(df, "text", d, "name", method="regex"), "id", "location"))
    b = dict(rows(extract_dictionary(df, "text", d, "name", method="ngram"), "id", "location"))
    pat = re.compile(alternation_regex(names).replace("(?i)", ""), re.I)
    py = {i: (m.group(0) if (m := pat.search(t)) else None) for i, t in texts}
    assert a == b == py


def test_unit_square_and_hole_centroid(spark):
    sq = [[{"x": 0.0, "y": 0.0}, {"x": 2.0, "y": 0.0}, {"x": 2.0, "y": 2.0}, {"x": 0.0, "y": 2.0}]]
    hole = [{"x": 0.0, "y": 0.0}, {"x": 0.0, "y": 1.0}, {"x": 1.0, "y": 1.0}, {"x": 1.0, "y": 0.0}]  # clockwise
    far = [[{"x": 10.0, "y": 0.0}, {"x": 12.0, "y": 0.0}, {"x": 12.0, "y": 2.0}, {"x": 10.0, "y": 2.0},
            {"x": 10.0, "y": 0.0}]]  # closed ring
    df = spark.createDataFrame([("a", sq), ("b", [sq[0], hole]), ("c", sq), ("c", far)],
                               "g string, geometry array<array<struct<x double, y double>>>")
    out = {r.g: r for r in collection_centroid(df, "geometry", ["g"]).collect()}
    assert (out["a"].cx, out["a"].cy, out["a"].area) == (1.0, 1.0, 4.0)
    # L-shape: 2x2 minus unit square at origin -> area 3, centroid (7/6, 7/6)
    assert abs(out["b"].area - 3) < 1e-12 and abs(out["b"].cx - 7 / 6) < 1e-12
    assert (out["c"].cx, out["c"].cy, out["c"].area) == (6.0, 1.0, 8.0)


def test_sectionize(spark):
    text = "intro line\n\nSystem:\n  OS: Linux\nCPU:\n  8 cores \n:\nafter colon-only"
    df = spark.createDataFrame([(1, 0, text), (2, 0, "")], "doc long, part long, text string")
    out = sectionize(df, ["doc"], ["doc", "part"], "text").orderBy("line_no").collect()
    assert [(r.Category, r.Detail) for r in out] == [
        ("General", "intro line"), ("System", "OS: Linux"), ("CPU", "8 cores"), ("", "after colon-only")]


def test_surrogate_id_shape_determinism_and_duckdb_parity(spark):
    df = spark.range(0, 2000).withColumnRenamed("id", "k")
    a = df.select("k", surrogate_id(["k"], 10232015).alias("sid"))
    b = df.repartition(9).select("k", surrogate_id(["k"], 10232015).alias("sid"))
    ra, rb = rows(a), rows(b)
    assert ra == rb
    assert all(re.fullmatch(r"[A-Za-z]{10}-[1-9]\d{9}", s) for _, s in ra)
    assert len({s for _, s in ra}) == len(ra)
    con = duckdb.connect()
    got = con.sql(f"SELECT k, {surrogate_id_sql('k', 10232015)} FROM range(2000) t(k) ORDER BY k").fetchall()
    assert [tuple(r) for r in got] == ra
    assert rows(df.select("k", surrogate_id(["k"], 1).alias("s")))[0][1] != ra[0][1]


def test_numbered_rows_are_dealt_to_many_tasks(spark, tmp_path):
    n = SPREAD * int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = spark.range(20000).select((F.col("id") % 15000).alias("k"), F.when(F.col("id") % 3 > 0, "v").alias("v"))
    x = with_surrogate_id(df, ["k", "v"], 1, "sid")
    sizes = [r["count"] for r in x.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 20000 and len(sizes) == n and max(sizes) < 2 * 20000 / n   # before: the session's partitions, coalesced
    assert x.select("sid").distinct().count() == 20000
    # ids, and the rows that keep-first sorts, are dealt likewise: no shuffle to the session's own number of partitions
    lines = [(i % 700 if i % 50 else None, i % 5, i % 7, i % 4, "A") for i in range(3000)]
    (spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string")
     .write.parquet(f"{tmp_path}/lineitem.parquet"))
    out = catalog.surrogate_ids_unique(spark, str(tmp_path))
    assert tuple(out.first()) == (3000, 3000, 3000)
    dealt = re.findall(r"hashpartitioning\([^)]*, (\d+)\)", out._jdf.queryExecution().executedPlan().toString())
    assert dealt and set(map(int, dealt)) == {n}


def test_auto_method_picks_by_size(spark, monkeypatch):
    import vigil.operators.places as P
    df = spark.createDataFrame([(1, "WEST DES MOINES")], "id long, text string")
    assert extract_dictionary(df, "text", _dict(spark, GAZ), "name", method="auto").first().location == "WEST"
    monkeypatch.setattr(P, "AUTO_REGEX_NAMES", 2)     # force the n-gram path
    out = extract_dictionary(df, "text", _dict(spark, GAZ), "name", method="auto", prefer="longest")
    assert out.first().location == "WEST DES MOINES"


def test_degenerate_polygon_and_zero_base_give_null_not_error(spark):
    from vigil.operators import tables as TB
    line = [[{"x": 0.0, "y": 0.0}, {"x": 1.0, "y": 1.0}, {"x": 2.0, "y": 2.0}]]
    df = spark.createDataFrame([("z", line)], "g string, geometry array<array<struct<x double, y double>>>")
    r = collection_centroid(df, "geometry", ["g"]).first()
    assert r.cx is None and r.area == 0.0
    y = spark.createDataFrame([(2021, 0), (2022, 5)], "year int, n long")
    assert [x.pct_change for x in TB.lag_change(y, "year", "n", base="previous").orderBy("year").collect()] == [None, None]


def test_map_frame_one_pass(spark):
    from vigil.plans.reports import map_frame
    sq = lambda x0: [[{"x": x0, "y": 0.0}, {"x": x0 + 2, "y": 0.0}, {"x": x0 + 2, "y": 2.0}, {"x": x0, "y": 2.0}]]
    df = spark.createDataFrame([(sq(0.0), 5.0), (sq(10.0), None), (sq(4.0), 1.0)],
                               "geometry array<array<struct<x double, y double>>>, data_value double")
    r = map_frame(df).first()
    assert (r.cx, r.cy, r.min_value, r.max_value) == (5.666666666666667, 1.0, 1.0, 5.0)
    plan = map_frame(df)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_regex_and_ngram_agree_on_accented_texts(spark):
    vocab = ["CAFÉ", "ÉCOLE", "RUE", "NORD", "STRAßE", "ÜBER", "COLE", "café", "école", "STRASSE", "über"]
    rnd = random.Random(17)
    names = sorted({" ".join(rnd.sample(vocab[:7], rnd.choice([1, 2]))) for _ in range(10)} | {"COLE"})
    texts = [(i, " ".join(rnd.choice(vocab + ["ÉT", "X1", "é"]) for _ in range(rnd.randint(0, 6)))) for i in range(300)]
    df = spark.createDataFrame(texts, "id long, text string")
    d = _dict(spark, names)
    a = dict(rows(extract_dictionary(df, "text", d, "name", method="regex"), "id", "location"))
    b = dict(rows(extract_dictionary(df, "text", d, "name", method="ngram"), "id", "location"))
    pat = re.compile(alternation_regex(names).replace("(?iu)", ""), re.I)
    py = {i: (m.group(0) if (m := pat.search(t)) else None) for i, t in texts}
    assert a == b == py

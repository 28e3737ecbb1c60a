"""One key / value / word holding a third of all rows: results stay whole and
exact (checked against plain Python)."""
import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from vigil.operators import aggregate as A
from vigil.operators.collapse import Side, join_strings
from vigil.operators.dedup import keep_first
from vigil.operators.impute import ranked_quantile
from vigil.operators.places import extract_dictionary

from conftest import rows

N = 30_000


def skewed_rows():
    rnd = random.Random(5)
    out = []
    for i in range(N):
        k = 0 if i % 3 == 0 else rnd.randint(1, 2000)     # key 0 holds a third of the rows
        out.append((k, rnd.randint(0, 10 ** 6), i, rnd.choice("abcde")))
    return out


def test_keep_first_hot_key(spark):
    data = skewed_rows()
    df = spark.createDataFrame(data, "k int, v int, i int, c string").repartition(8)
    got = dict(rows(keep_first(df, ["k"], ["v", "i"]), "k", "i"))
    best = {}
    for k, v, i, _ in data:
        if k not in best or (v, i) < best[k][0]:
            best[k] = ((v, i), i)
    assert got == {k: b[1] for k, b in best.items()}


def test_string_aggregation_hot_key(spark):
    data = skewed_rows()
    df = spark.createDataFrame(data, "k int, v int, i int, c string").repartition(8)
    side = Side(columns=["c"], outputs={"cs": ("c", "distinct")})
    got = dict(rows(join_strings(df, ["k"], side), "k", "cs"))
    exp = defaultdict(set)
    for k, _, _, c in data:
        exp[k].add(c)
    assert got == {k: ", ".join(sorted(v)) for k, v in exp.items()}


def test_distinct_per_group_hot_group(spark):
    data = skewed_rows()
    df = spark.createDataFrame(data, "k int, v int, i int, c string").repartition(8)
    got = dict(rows(A.distinct_per_group(df, ["c"], "k"), "c", "n"))
    exp = defaultdict(set)
    for k, _, _, c in data:
        exp[c].add(k)
    assert got == {c: len(v) for c, v in exp.items()}


def test_ranked_quantile_hot_value(spark):
    rnd = random.Random(9)
    vals = [7.0 if i % 3 == 0 else round(rnd.uniform(0, 100), 3) for i in range(N)]
    df = spark.createDataFrame([(v,) for v in vals], "v double").repartition(8)
    for p in (0.1, 0.5, 0.9):
        assert abs(ranked_quantile(df, "v", p).first().q - float(np.percentile(vals, p * 100))) < 1e-9


def test_ngram_extraction_hot_word(spark):
    rnd = random.Random(3)
    words = ["ALPHA", "BETA", "GAMMA", "DELTA"]
    texts = [(i, "THE " * 3 + ("HOT SPOT" if i % 3 == 0 else " ".join(rnd.choices(words, k=3)))) for i in range(3000)]
    df = spark.createDataFrame(texts, "id long, text string").repartition(8)
    d = spark.createDataFrame([("HOT SPOT",), ("GAMMA",), ("THE END",)], "name string")
    got = dict(rows(extract_dictionary(df, "text", d, "name", method="ngram"), "id", "location"))
    reg = dict(rows(extract_dictionary(df, "text", d, "name", method="regex"), "id", "location"))
    assert got == reg
    assert sum(1 for v in got.values() if v == "HOT SPOT") == 1000

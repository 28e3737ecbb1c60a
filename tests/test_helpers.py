"""Small helpers not exercised elsewhere."""
import numpy as np
from pyspark.sql import functions as F

from vigil.functions import conditions as C
from vigil.functions import strings as S
from vigil.operators import aggregate as A
from vigil.operators.columns import count_missing, relocate
from vigil.operators.geo import composite_fips
from vigil.sources import io as IO

from conftest import rows


def test_composite_fips_pads_without_truncating(spark):
    df = spark.createDataFrame([("19", "7"), ("9", "153"), ("19", "1530")], "s string, c string")
    assert [r[0] for r in df.select(composite_fips("s", "c")).collect()] == ["19007", "09153", "191530"]


def test_levels_missing_and_lumping(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("b",)], "c string")
    assert [r.c for r in A.levels(df, "c").collect()] == ["a", "b", None]
    assert count_missing(df, "c").first().n_missing == 1
    assert A.n_distinct(df, "c", count_missing=False).first().n == 2
    assert A.n_distinct(df, "c").first().n == 3
    counts = spark.createDataFrame([("x", 1), ("y", 2), ("z", 9)], "cat string, n long")
    assert rows(A.lump_small(counts, "cat", "n", k=5), "cat", "n") == [("Other", 3), ("z", 9)]


def test_quantile_list_and_total_row(spark):
    vals = [1, 2, 3, 10, 11, 40]
    df = spark.createDataFrame([(v,) for v in vals], "v long")
    from vigil.operators.impute import count_quantiles
    assert np.allclose(count_quantiles(df, "v", [0.5, 0.9, 0.0, 1.0]).first().qs, np.percentile(vals, [50, 90, 0, 100]))
    t = A.with_total_row(A.count_by(df.withColumn("g", F.col("v") % 2), ["g"]), "g", None, {"n": F.sum("n")})
    assert sorted(r.n for r in t.collect()) == [3, 3, 6]
    s = spark.createDataFrame([(1,), (None,)], "a int").agg(A.sum_default("a").alias("s")).first().s
    assert s == 2


def test_text_helpers(spark):
    df = spark.createDataFrame([('"Mother-in-law" smith', 1234567)], "t string, n long")
    r = df.select(S.strip_chars("t").alias("a"), S.to_title("t").alias("b"), S.with_commas("n").alias("c"),
                  S.non_alnum_to_space("t").alias("d")).first()
    assert r.a == "Mother-in-law smith" and r.b == '"mother-in-law" Smith' and r.c == "1,234,567"
    assert r.d == " Mother in law  smith"
    assert df.select(C.code_map("t", {"x": 1}, default=0)).first()[0] == 0


def test_rename_and_relocate(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Total=Price` int, `(b)` int, c int")
    out = IO.rename_with(IO.rename_with(df, lambda c: c.replace("(", "").replace(")", "")), lambda c: c.replace("=", "_"))
    assert out.columns == ["Total_Price", "b", "c"]
    assert relocate(out, ["c", "b"], after="Total_Price").columns == ["Total_Price", "c", "b"]
    assert IO.materialize is not None

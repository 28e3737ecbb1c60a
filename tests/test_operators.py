import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.operators import aggregate as A
from vigil.operators import tables as TB
from vigil.operators.collapse import Side, collapse_one_to_many, defibrillation_summary, join_strings
from vigil.operators.columns import pull, relocate
from vigil.operators.dedup import assert_unique_key, fanout_report, keep_first
from vigil.operators.impute import impute_median, ranked_quantile, ranked_quantiles
from vigil.operators.joins import exclude_pairs, left_lookup, right_lookup
from vigil.functions import rules as R

from conftest import rows


def test_keep_first_total_order_and_repartition_invariance(spark):
    data = [(k, v, f"p{k}-{v}") for k in range(50) for v in random.Random(k).sample(range(100), 5)]
    df = spark.createDataFrame(data, "k int, v int, payload string")
    a = keep_first(df, ["k"], ["v"])
    b = keep_first(df.repartition(7).orderBy(F.rand(3)), ["k"], ["v"])
    expected = sorted((k, min(v for kk, v, _ in data if kk == k)) for k in range(50))
    assert rows(a, "k", "v") == expected == rows(b, "k", "v")
    assert a.columns == ["k", "v", "payload"]


def test_keep_first_nulls_last(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 5, "b")], "k int, v int, p string")
    assert keep_first(df, ["k"], ["v"]).first().p == "b"


def test_keep_first_plan_limits_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = keep_first(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_fanout_and_unique(spark):
    fact = spark.createDataFrame([("AMES",), ("ADEL",)], "city string")
    dim = spark.createDataFrame([("AMES", "Story"), ("AMES", "Polk"), ("ADEL", "Dallas")], "name string, county string")
    assert rows(fanout_report(fact, dim, ["city"], ["name"])) == [("AMES", 2)]
    with pytest.raises(ValueError):
        assert_unique_key(dim, ["name"])
    assert_unique_key(dim, ["name", "county"])


def test_lookups_and_exclusions(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    dim = spark.createDataFrame([("a", 10), ("b", 20)], "key string, v int")
    assert rows(left_lookup(df, dim, "k", "key", ["v"])) == [(1, "a", 10), (2, "b", 20), (3, None, None)]
    m = spark.createDataFrame([("01", 1.5)], "loc string, val double")
    b = spark.createDataFrame([("01", "x"), ("02", "y")], "STATEFP string, name string")
    assert rows(right_lookup(m, b, "loc", "STATEFP", ["val"])) == [("01", "x", 1.5), ("02", "y", None)]
    ex = spark.createDataFrame(R.GAZETTEER_EXCLUSIONS, "name string, county string")
    g = spark.createDataFrame([("TROY", "Lucas"), ("TROY", "Davis"), ("VAN", "Marshall")], "name string, county string")
    assert rows(exclude_pairs(g, ex, ["name", "county"])) == [("TROY", "Davis")]


def test_join_strings_orders_and_distinct(spark):
    df = spark.createDataFrame([(1, 3, "x"), (1, 1, "y"), (1, 2, "x"), (1, 2, "x"), (2, 1, None)], "k int, o int, v string")
    side = Side(columns=["o", "v"], outputs={"all": ("v", "all"), "uniq": ("v", "distinct"), "ord": ("o", "all")})
    out = {r.k: r for r in join_strings(df, ["k"], side).collect()}
    assert (out[1].all, out[1].uniq, out[1].ord) == ("y, x, x", "y, x", "1, 2, 3")
    assert out[2].all is None          # nothing recorded -> NULL
    tok = {r.k: r for r in join_strings(df, ["k"], side, missing_token="missing").collect()}
    assert tok[2].all == "missing"


def test_collapse_one_to_many(spark):
    base = spark.createDataFrame([(1, "b1", 2), (1, "b0", 1), (2, "c", 1), (3, "d", 1)], "k int, name string, ord int")
    rows_ = spark.createDataFrame([(1, "p1", "m1"), (1, "p2", "m1"), (2, "p3", "m2")], "k int, proc string, med string")
    out = collapse_one_to_many(base, "k", ["ord"], rows_, [
        Side(columns=["proc"], outputs={"procs": ("proc", "all")}),
        Side(columns=["med"], outputs={"meds": ("med", "all")})])
    assert rows(out, "k", "name", "procs", "meds") == [(1, "b0", "p1, p2", "m1"), (2, "c", "p3", "m2"), (3, "d", None, None)]


def test_defibrillation_summary(spark):
    data = [("r1", "Defibrillation, AED", "t1", None), ("r1", "Defibrillation, AED", "t1", None),
            ("r1", "CV - Cardioversion", "t2", 3), ("r1", "Airway", "t0", 5), ("r2", "Airway", "t1", 1)]
    df = spark.createDataFrame(data, "k string, d string, t string, a int")
    out = defibrillation_summary(df, "k", "d", "t", "a", R.DEFIB_PATTERN).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.k, r.shocks, r.d, r.t, r.a) == ("r1", 4, "Defibrillation, AED, CV - Cardioversion", "t1, t2", "1, 3")


def test_counts_and_shares(spark):
    df = spark.createDataFrame([(c,) for c in "aaabbc"], "c string")
    cs = {r.c: r for r in A.count_share(df, ["c"]).collect()}
    assert cs["a"].n == 3 and abs(sum(r.percent for r in cs.values()) - 1) < 1e-12
    assert A.n_distinct(spark.createDataFrame([("a",), (None,), ("a",)], "c string"), "c").first()[0] == 2
    t = A.with_total_row(A.count_by(df, ["c"]), "c", "total", {"n": F.sum("n")})
    assert rows(t)[-1] == ("total", 6) or ("total", 6) in rows(t)


def test_pareto_matches_python(spark):
    counts = {"a": 1, "b": 2, "c": 10, "d": 7, "e": 30, "f": 7}
    df = spark.createDataFrame(list(counts.items()), "cat string, count long")
    out = TB.pareto(df, "cat", "count", lump_below=6).collect()
    d = {r.cat: r for r in out}
    assert d["Other"]["count"] == 3 and "a" not in d
    order = sorted(d.values(), key=lambda r: r.cumpercent)
    assert [r.cat for r in order] == ["Other", "d", "f", "c", "e"]
    assert abs(order[-1].cumpercent - 1) < 1e-12


def test_lag_change(spark):
    df = spark.createDataFrame([(2021, 10), (2022, 20), (2023, 15)], "year int, count long")
    out = TB.lag_change(df, "year", "count").orderBy("year").collect()
    assert [r.change for r in out] == [None, 10, -5]
    assert out[1].pct_change == 50.0 and abs(out[2].pct_change - (-5 / 15 * 100)) < 1e-12


def test_quantile_bin_vs_numpy(spark):
    ns = [1, 1, 2, 3, 3, 4, 5, 8, 13, 21, 34, 55, 89, 200]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(ns)], "id int, n long")
    q80, q90, q99 = np.percentile(ns, [80, 90, 99])
    exp = [10 if n <= q80 else 15 if n < q90 else 20 if n < q99 else 25 for n in ns]
    out = TB.quantile_bin(df, "n").orderBy("id").collect()
    assert [r.quantiles for r in out] == exp
    assert {r.quantile_labels for r in out} <= {"01-06", "06-11", "11-47", "47+"}


def test_outcome_tables(spark):
    data = [("F", "Survived")] * 3 + [("F", "Deceased")] + [("M", "Survived")] * 2 + [(None, "Survived"), ("U", "Deceased")]
    df = spark.createDataFrame(data, "sex string, survival string")
    t = {r.Sex: r for r in TB.outcome_by_recode(df, "sex", "survival", {"F": "Female", "M": "Male"}).collect()}
    assert set(t) == {"Female", "Male", "Unknown"}            # NULL and "U" merged before counting
    assert (t["Male"].Deceased, t["Male"].Total) == (0, 2)
    assert t["Female"].Percent_Survived_By_Sex == "75.00%" and t["Female"].Percent_Survived_Overall == "37.50%"
    o = {r.sex: r for r in TB.outcome_table(df, ["sex"], "survival").collect()}
    assert o["M"].Deceased is None and o["M"].Total is None and o["F"].Pct_Survived == 0.75
    total = df.count()
    cells = TB.pivot_counts(df, ["sex"], "survival", ["Deceased", "Survived"]).agg(
        F.sum("Deceased") + F.sum("Survived")).first()[0]
    assert cells == total


def test_two_way_and_conditional(spark):
    data = [(True, True)] * 3 + [(True, False)] + [(False, True)] + [(False, False)] * 3
    df = spark.createDataFrame(data, "w boolean, b boolean")
    t = {r.w: r for r in TB.two_way_table(df, "w", "b").collect()}
    assert (t["true"].true, t["true"].false, t["true"].total) == ("3", "1", "4 (50.0%)")
    assert (t["total"].true, t["total"].false, t["total"].total) == ("4 (50.0%)", "4 (50.0%)", "8")
    row = {r.w: r for r in TB.conditional_table(df, "w", "b", "row").collect()}
    assert row[True].true_bcpr == "3 (75.0%)"
    col = {r.w: r for r in TB.conditional_table(df, "w", "b", "col").collect()}
    assert col[True].true_bcpr == "3 (75.0%)" and col[False].false_bcpr == "3 (75.0%)"
    coded = {r.w: r for r in TB.conditional_table(df, "w", "b", "col", as_coded=True).collect()}
    assert coded[False].false_bcpr == "3 (75.0%)" and coded[True].false_bcpr == "1 (25.0%)"


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.8, 0.99, 1.0])
def test_ranked_quantile_equals_numpy(spark, p):
    rnd = random.Random(7)
    vals = [round(rnd.gauss(10, 5), 2) for _ in range(3000)] + [42.0] * 1000 + [None] * 50
    df = spark.createDataFrame([(v,) for v in vals], "v double").repartition(5)
    got = ranked_quantile(df, "v", p, partitions=6).first()[0]
    exp = float(np.percentile([v for v in vals if v is not None], p * 100))
    assert abs(got - exp) < 1e-9


def test_impute_median(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0), (4, 10.0), (5, 2.0)], "id int, v double")
    out = {r.id: r.v for r in impute_median(df, ["v"]).collect()}
    assert out[2] == 2.5
    out2 = {r.id: r.v for r in impute_median(df, ["v"], method="percentile").collect()}
    assert out2[2] == 2.5


def test_layout_helpers(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert relocate(df, "c", before="a").columns == ["c", "a", "b"]
    assert relocate(df, ["a"], after="c").columns == ["b", "c", "a"]
    assert pull(df, "b") == [2]


def test_sorts_and_aliases(spark):
    from vigil.operators.columns import arrange, sort_all
    from vigil.functions.times import intervals
    import datetime as dt
    df = spark.createDataFrame([(2, "b"), (None, "a"), (1, "c")], "k int, v string")
    assert [r.k for r in arrange(df, "k").collect()] == [1, 2, None]
    assert [r.k for r in arrange(df, "k", desc=True).collect()] == [None, 2, 1]
    assert [r.v for r in sort_all(df).collect()] == ["c", "b", "a"]
    y = spark.createDataFrame([(2021, 10), (2022, 20)], "year int, n long")
    assert [r.p for r in TB.pct_change(y, "year", "n", base="previous", name="p").orderBy("year").collect()] == [None, 100.0]
    assert [r.percent for r in TB.share(y.withColumn("g", F.lit(1)), "n", by=["g"]).orderBy("year").collect()] == [1 / 3, 2 / 3]
    t = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 10, 30))], "a timestamp_ntz, b timestamp_ntz")
    assert intervals(t, {"m": ("a", "b")}).first().m == 30.0


def test_ranked_quantiles_several_columns_one_pass(spark):
    rnd = random.Random(21)
    a = [round(rnd.uniform(-5, 5), 3) if i % 7 else None for i in range(2000)]
    b = [float(rnd.randint(0, 9)) if i % 5 else None for i in range(2000)]
    df = spark.createDataFrame(list(zip(a, b)), "a double, b double").repartition(4)
    for p in (0.0, 0.37, 0.5, 1.0):
        got = ranked_quantiles(df, ["a", "b"], p).first()
        assert abs(got.a - float(np.percentile([x for x in a if x is not None], p * 100))) < 1e-9
        assert abs(got.b - float(np.percentile([x for x in b if x is not None], p * 100))) < 1e-9

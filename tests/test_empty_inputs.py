"""Operators on empty inputs return empty (or NULL-valued) results, never fail."""
from pyspark.sql import functions as F

from vigil.operators import aggregate as A
from vigil.operators import tables as TB
from vigil.operators.collapse import Side, join_strings
from vigil.operators.dedup import keep_first
from vigil.operators.impute import impute_median, ranked_quantile
from vigil.operators.places import extract_dictionary
from vigil.operators.text import sectionize


def test_empty_tables(spark):
    e = spark.createDataFrame([], "k int, v double, c string, w boolean, b boolean")
    assert keep_first(e, ["k"], ["v"]).count() == 0
    assert A.count_share(e, ["c"]).count() == 0
    assert TB.share(A.count_by(e, ["c"]), "n").count() == 0
    assert TB.pareto(A.count_by(e, ["c"], "count"), "c", "count", lump_below=6).count() == 0
    assert TB.quantile_bin(A.count_by(e, ["c"]), "n").count() == 0
    assert TB.outcome_table(e, ["k"], "c").count() == 0
    assert TB.two_way_table(e, "w", "b").collect()[0]["w"] == "total"
    assert join_strings(e, ["k"], Side(columns=["c"], outputs={"x": ("c", "all")})).count() == 0
    assert ranked_quantile(e, "v", 0.5).first().q is None
    assert impute_median(e, ["v"]).count() == 0
    d = spark.createDataFrame([("AMES",)], "name string")
    t = spark.createDataFrame([], "id long, text string")
    assert extract_dictionary(t, "text", d, "name").count() == 0
    assert extract_dictionary(t, "text", d, "name", method="ngram").count() == 0
    assert sectionize(t, ["id"], ["id"], "text").count() == 0


def test_empty_dictionary_matches_nothing(spark):
    t = spark.createDataFrame([(1, "AMES")], "id long, text string")
    d = spark.createDataFrame([(None,), ("  ",)], "name string")
    assert extract_dictionary(t, "text", d, "name", method="ngram").first().location is None

"""Dictionary extraction gives the regex's answers whatever the method, also for letters that case mappings treat unlike each other."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.functions import strings as S
from vigil.operators import places as P

ODD = "İIiıſSsςσΣKkKµμÅåßǅǆĿŉΩω"


def test_fold_agrees_with_the_pattern(spark):
    a, b = S.fold_table()
    df = spark.createDataFrame([(x, y) for x, y in zip(a, b)], "x string, y string")
    got = df.select("x", "y", S.fold("x").alias("f"), F.expr(r"x rlike concat('(?iu)^\\Q', y, '\\E$')").alias("m")).collect()
    assert [r.x for r in got if r.f != r.y] == []
    assert len([r.x for r in got if not r.m]) <= 0.03 * len(got)   # letters newer than the Java runtime


def test_fold_pairs_of_odd_letters(spark):
    df = spark.createDataFrame([(x, y) for x in ODD for y in ODD], "x string, y string")
    got = df.select("x", "y", (S.fold("x") == S.fold("y")).alias("f"), F.expr(r"x rlike concat('(?iu)^\\Q', y, '\\E$')").alias("m")).collect()
    assert [(r.x, r.y) for r in got if r.f != r.m] == []


def both(spark, names, texts):
    d = spark.createDataFrame([(n,) for n in names], "name string")
    t = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, text string")
    out = []
    for method in ("regex", "ngram", "auto"):
        out.append([r.location for r in P.extract_dictionary(t, "text", d, "name", method=method).orderBy("i").collect()])
    return out


def test_named_letters(spark):
    regex, ngram, auto = both(spark, ["IOWA", "MASON", "ΣΑΣ", "KELVIN", "STRASSE"], ["in İowa.", "maſon city", "σας", "σασ!", "the Kelvin", "straße", "iowa", "MAſON", None])
    assert regex == ngram == auto == ["İowa", "maſon", "σας", "σασ", "Kelvin", None, "iowa", "MAſON", None]


@pytest.mark.parametrize("seed", [1, 2])
def test_methods_agree_on_random_text(spark, seed):
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.choice(list(ODD + "abAB"), size=rng.integers(1, 4)))
    names = [" ".join(word() for _ in range(rng.integers(1, 3))) for _ in range(60)]
    texts = [" ".join(rng.choice([word(), str(names[rng.integers(60)]).swapcase()]) for _ in range(rng.integers(1, 9))) + rng.choice(["", ".", "-x"]) for _ in range(120)]
    regex, ngram, auto = both(spark, names, texts)
    assert regex == ngram == auto and sum(x is not None for x in regex) > 20


def test_a_pattern_refuses_an_unbounded_dictionary(spark, monkeypatch):
    monkeypatch.setattr(P, "PATTERN_NAMES", 3)
    with pytest.raises(ValueError):
        P.dictionary_regex(spark.range(4).selectExpr("cast(id as string) as name"), "name")


def test_candidates_are_dropped_before_the_shuffle(spark):
    """Only candidates that pass the bitmap of names are exchanged, and a common name is dealt to many places."""
    d = spark.createDataFrame([("alpha town",), ("beta",)], "name string")
    names = P.dictionary_names(d, "name").select(S.fold("__name").alias("key"))
    words = spark.range(20_000).select(F.concat(F.lit("w"), F.col("id").cast("string")).alias("key"))
    assert words.where(P.passes(P.key_filter(names, "key"), F.col("key"))).count() < 20
    assert names.where(P.passes(P.key_filter(names, "key"), F.col("key"))).count() == 2

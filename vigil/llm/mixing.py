"""Mixing sources to target weights by entropy balancing.

Targets share the mix among the sources by weight, none above ``most`` times its
source (water level over the sources).  Document rates solve, for every source,

    minimise sum_i b_i (w_i log w_i - w_i + 1)   with  sum_i size_i w_i = target,  w_i <= most,

with base measure ``b_i = size_i ** GAMMA``.  The dual has one multiplier a source and the
rates are exponentially tilted, ``w_i = min(most, exp(lambda x_i))`` with
``x_i = (size_i / mean) ** (1 - GAMMA)``.  Newton's iteration on the dual runs for
all sources at once: each step is one Spark job that sums value and slope over the
(source, size) histogram; a bracket keeps it safe.  The state is a
table with one row a source, checkpointed after each step.

Rates become whole copies by carrying the rounding error from document to document,
largest first, in blocks of about ``BLOCK`` documents of one source, so a
source of any size is rounded in parallel and each block misses its share by about half of one
of its smallest documents.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.session import checkpoint_dir

GAMMA = 0.5
BLOCK = 8192
WEIGHTS = (3.0, 1.0, 2.0)
MAX_STEPS = 60
TOLERANCE = 1e-10


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; 0 for null."""
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(totals: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Adds ``target`` to a table of one row a source (``source, source_size``).

    Sources by code point, null last, get the weights in turn; targets share
    ``share`` times all sizes by weight, and what exceeds ``most`` times a source's size is
    shared again by weight.  In closed form: with sources by the ratio of
    limit to weight, the level is that of the first source whose ratio reaches it.
    The windows run over the sources alone (one row each)."""
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), turn.cast("int") + 1)
    by_ratio = Window.orderBy("__ratio", F.col("source").isNull(), "source")
    before, after = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    return (totals.withColumn("__w", weight).withColumn("__cap", F.col("source_size") * F.lit(most))
            .withColumn("__ratio", F.col("__cap") / F.col("__w"))
            .withColumn("__all", F.sum(F.col("source_size")).over(Window.partitionBy()) * F.lit(share))
            .withColumn("__level", (F.col("__all") - F.coalesce(F.sum("__cap").over(before), F.lit(0.0))) / F.sum("__w").over(after))
            .withColumn("__theta", F.min(F.when(F.col("__level") <= F.col("__ratio"), F.struct("__ratio", "source", "__level"))).over(Window.partitionBy())["__level"])
            .withColumn("target", F.least(F.col("__cap"), F.coalesce(F.col("__theta") * F.col("__w"), F.col("__cap"))))
            .drop("__w", "__cap", "__ratio", "__all", "__level", "__theta"))


def _rate(size: Column, mean: Column, lam: Column, most: float) -> Column:
    return F.least(F.lit(float(most)), F.exp(lam * F.pow(size / mean, F.lit(1 - GAMMA))))


def solve(hist: DataFrame, sources: DataFrame, most: float = 2.0) -> DataFrame:
    """``sources`` (``source, source_size, n, target``) with its multiplier ``lam``:
    null where nothing is to be taken, infinite where every document is at its limit."""
    low, high = F.lit(0.0), F.col("source_size") * F.lit(most)
    state = sources.withColumn("mean", F.col("source_size") / F.greatest(F.col("n"), F.lit(1))) \
        .withColumn("lam", F.when(F.col("target") <= low, F.lit(None).cast("double"))
                    .when(F.col("target") >= high * (1 - 1e-12), F.lit(float("inf")))
                    .otherwise(F.log(F.col("target") / F.col("source_size")))) \
        .withColumn("lo", F.lit(None).cast("double")).withColumn("hi", F.lit(None).cast("double")) \
        .withColumn("open", F.coalesce(F.abs("lam") < F.lit(float("inf")), F.lit(False))).checkpoint()
    for _ in range(MAX_STEPS):
        todo = state.where("open").select(F.col("source").alias("__s"), "mean", "lam")
        rate = _rate(F.col("size"), F.col("mean"), F.col("lam"), most)
        words = F.col("docs") * F.col("size")
        sums = (hist.join(todo, F.col("source").eqNullSafe(F.col("__s")))
                .groupBy("__s").agg(F.sum(words * rate).alias("g"),
                                    F.sum(F.when(rate < most, words * rate * F.pow(F.col("size") / F.col("mean"), F.lit(1 - GAMMA)))
                                          .otherwise(0.0)).alias("slope")))
        lam, g = F.col("lam"), F.col("g")
        step = lam + F.log(F.col("target") / g) * g / F.nullif(F.col("slope"), F.lit(0.0))  # Newton on the logarithm
        lo = F.when(g < F.col("target"), lam).otherwise(F.col("lo"))
        hi = F.when(g >= F.col("target"), lam).otherwise(F.col("hi"))
        done = F.abs(g - F.col("target")) <= F.col("target") * TOLERANCE
        inside = step.isNotNull() & (step > F.coalesce(F.col("__lo"), F.lit(float("-inf")))) & (step < F.coalesce(F.col("__hi"), F.lit(float("inf"))))
        other = (F.when(F.col("__lo").isNull(), F.col("__hi") - 1 - F.abs("__hi"))
                 .when(F.col("__hi").isNull(), F.col("__lo") + 1 + F.abs("__lo"))
                 .otherwise((F.col("__lo") + F.col("__hi")) / 2))
        state = (state.join(sums, F.col("source").eqNullSafe(F.col("__s")), "left")
                 .withColumn("__lo", lo).withColumn("__hi", hi)
                 .select("source", "source_size", "n", "target", "mean",
                         F.when(~F.col("open") | F.coalesce(done, F.lit(True)), lam).when(inside, step).otherwise(other).alias("lam"),
                         F.col("__lo").alias("lo"), F.col("__hi").alias("hi"),
                         (F.col("open") & F.coalesce(~done, F.lit(False))).alias("open")).checkpoint())
        if state.where("open").isEmpty():
            break
    return state.select("source", "source_size", "n", "target", "mean", F.round("lam", 9).alias("lam"))


def round_block(part: pd.DataFrame, most: float) -> pd.DataFrame:
    """Copies of a block's items (``repeats`` rows of ``size`` words, ``rate``), error carried from
    row to row, largest first: each of an item's rows is taken ``copies`` times, the first ``more`` of them once more."""
    part = part.sort_values(["size", "doc_id"], ascending=[False, True], kind="stable", na_position="last")
    carry, taken, top = 0.0, np.zeros(len(part), dtype=np.int64), int(most)
    rows = part["repeats"].to_numpy(np.int64)
    for i, (size, rate, n) in enumerate(zip(part["size"].to_numpy(float), part["rate"].to_numpy(float), rows.tolist(), strict=True)):
        if size <= 0:
            taken[i] = n if rate > 0 else 0
            continue
        want = rate * size * n + carry
        taken[i] = min(top * n, max(0, int(np.floor(want / size + 0.5))))
        carry = want - taken[i] * size
    return part.assign(copies=taken // rows, more=taken % rows)


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, source, size, repeats, source_size, target, rate, copies, more``: one row for
    each distinct (document, source, size), found in ``repeats`` rows; each of those rows
    is taken ``copies`` times, ``more`` of them once more.

    ``size`` counts words; null and empty texts have size 0 and are taken once
    in sources that are taken at all. Null ids and null sources are values like others.
    Rows that agree in id, source and size share their copies out, none getting two more than another.  An empty table gives no rows.
    """
    checkpoint_dir(docs.sparkSession)
    items = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                         word_count(F.col(text_col)).alias("size"))
             .groupBy("doc_id", "source", "size").agg(F.count("*").alias("repeats")).checkpoint())
    totals = items.groupBy("source").agg(F.sum(F.col("size") * F.col("repeats")).alias("source_size"),
                                         F.sum("repeats").alias("n"))
    hist = (items.where("size > 0").groupBy("source", "size").agg(F.sum("repeats").alias("docs")).checkpoint())
    solved = solve(hist, targets(totals, weights, share, most), most).select(
        F.col("source").alias("__s"), "source_size", "n", "target", "mean", "lam").checkpoint()
    rated = (items.join(solved, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
             .withColumn("rate", F.when(F.col("lam").isNull(), 0.0).when(F.col("lam") == float("inf"), float(most))
                         .when(F.col("size") > 0, _rate(F.col("size"), F.col("mean"), F.col("lam"), most)).otherwise(1.0))
             .withColumn("block", F.pmod(F.xxhash64("doc_id", "size"), F.ceil(F.col("n") / BLOCK)))
             .select(F.col("doc_id").cast("string").alias("doc_id"),  # pandas would make floats of ids with nulls
                     "source", "size", "repeats", "source_size", "target", "rate", "block"))
    schema = "doc_id string, source string, size long, repeats long, source_size long, target double, rate double, copies long, more long"
    names = [c.split()[0] for c in schema.split(", ")]
    return (rated.groupBy("source", "block").applyInPandas(lambda part: round_block(part, most)[names], schema)
            .withColumn("doc_id", F.col("doc_id").cast("long")))


def per_document(mixed: DataFrame) -> DataFrame:
    """One row for each input row, with the words that the mix takes of it (``taken``)."""
    return (mixed.withColumn("__k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("repeats"))))
            .withColumn("copies", F.col("copies") + F.when(F.col("__k") <= F.col("more"), 1).otherwise(0))
            .select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "rate", "copies"))


def apply_mix(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: every row as often as ``mixed`` says, with all its columns.  Of rows that agree in id,
    source and size those with the first texts are taken once more."""
    picked = (mixed.where("copies + more > 0")
              .select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__n"), F.col("copies").alias("__copies"), F.col("more").alias("__more")))
    place = F.row_number().over(Window.partitionBy("__id", "__source", "__n").orderBy(F.col(text_col)))
    return (docs.withColumn("__size", word_count(F.col(text_col)))
            .join(picked, F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & F.col(source_col).cast("string").eqNullSafe(F.col("__source")) & (F.col("__size") == F.col("__n")))
            .withColumn("__place", place)
            .withColumn("__take", F.col("__copies") + F.when(F.col("__place") <= F.col("__more"), 1).otherwise(0)).where("__take > 0")
            .withColumn("__k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__take"))))
            .select(*docs.columns))

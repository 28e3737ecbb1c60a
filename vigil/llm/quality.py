"""Quality classifier: hashed word n-grams, logistic regression by FTRL.

Features are hashed n-grams of tokens (runs of letters and digits, runs of other visible
characters), scaled by one over the square root of their number; a pair of equal
neighbours counts as one more feature, whatever the token. Training
uses a bounded sample of labelled rows (``MAX_TRAIN``, chosen by a hash of the id), dealt to a fixed
number of shards; each shard runs follow-the-regularised-leader (proximal, per
coordinate rates, L1 and L2) over its rows, and the shards' weights are averaged.
The model is one weight vector of ``2**bits`` floats, so what is collected
and broadcast is bounded by parameters, not by the data.  Scoring is a
sparse dot product per text, map-side, over the whole text.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm import textbytes

MAX_TRAIN = 20_000  # labelled documents used for training at most
SHARDS = 8
BITS = 18
ORDERS = (1, 2)
REPEAT = 0x5DEECE66D  # hash shared by all pairs of equal neighbours

#: 0 white space, 1 letters, digits and all bytes of non-ASCII characters, 2 other visible characters.
KINDS = np.array([0 if b in (32, *range(9, 14)) else 1 if b >= 128 or chr(b).isalnum() else 2 for b in range(256)], dtype=np.uint8)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    bits: int
    orders: tuple[int, ...]


def features(texts: pa.Array, bits: int, orders: tuple[int, ...]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, end, feature indices, text index) by group of texts."""
    data, offsets = textbytes.buffers(texts)
    for i, j, tok, counts in textbytes.tokens(data, offsets, KINDS):
        parts = [textbytes.ngrams(tok, counts, n) for n in orders]
        text = np.repeat(np.arange(j - i), counts)
        again = np.flatnonzero((tok[1:] == tok[:-1]) & (text[1:] == text[:-1]))  # every n-gram of one repeated token
        parts.append((np.full(len(again), REPEAT, dtype=np.uint64), text[again]))
        yield (i, j, np.concatenate([(h & np.uint64((1 << bits) - 1)).astype(np.int32) for h, _ in parts]),
               np.concatenate([t for _, t in parts]))


def ftrl(rows: list[tuple[int, np.ndarray]], bits: int, epochs: int, alpha: float, beta: float, l1: float,
         l2: float) -> tuple[np.ndarray, float]:
    """FTRL-proximal over (label, indices) rows; the bias is not regularised."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    zb = nb = 0.0
    for _ in range(epochs):
        for label, index in rows:
            idx, count = np.unique(index, return_counts=True)
            x = count / np.sqrt(max(1, len(index)))
            zi, ni = z[idx], n[idx]
            w = np.where(np.abs(zi) > l1, (np.sign(zi) * l1 - zi) / ((beta + np.sqrt(ni)) / alpha + l2), 0.0)
            b = -zb / ((beta + np.sqrt(nb)) / alpha)
            err = 1 / (1 + np.exp(-np.clip(w @ x + b, -30, 30))) - label
            g = err * x
            z[idx] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha * w
            n[idx] = ni + g * g
            zb += err - (np.sqrt(nb + err * err) - np.sqrt(nb)) / alpha * b
            nb += err * err
    w = np.where(np.abs(z) > l1, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2), 0.0)
    return w, -zb / ((beta + np.sqrt(nb)) / alpha)


def is_held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, shards: int = SHARDS, bits: int = BITS,
          orders: tuple[int, ...] = ORDERS, epochs: int = 6, alpha: float = 2.0, beta: float = 1.0, l1: float = 0.02,
          l2: float = 0.01, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Fit on the rows of ``labels`` (0/1) that are not held out.

    Null ids or labels are not learnt from; an id labelled several times counts
    with its mean, rounded. Without any label every score is 0.5."""
    label = F.col(label_col).cast("double")
    known = (labels.select(F.col(id_col).cast("long").alias("__id"), label.alias("__y"))
             .where(F.col("__y").isin(0.0, 1.0) & F.col("__id").isNotNull() & ~is_held_out(F.col("__id")))
             .groupBy("__id").agg(F.round(F.avg("__y")).cast("int").alias("__y"))
             .orderBy(F.xxhash64("__id"), "__id").limit(max_train))
    sample = (docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).cast("string").alias("__text"))
              .join(F.broadcast(known), "__id"))  # at most max_train rows

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, labels_, shard = b.column(0), b.column(2).to_pylist(), b.column(3)
            for i, j, index, text in features(b.column(1), bits, orders):
                order = np.argsort(text, kind="stable")
                at = np.searchsorted(text[order], np.arange(j - i + 1))
                index = index[order]
                yield pa.RecordBatch.from_arrays(
                    [shard[i:j], ids[i:j], pa.array(labels_[i:j], pa.int32()),
                     pa.array([index[at[k]:at[k + 1]].tobytes() for k in range(j - i)], pa.binary())],
                    names=["shard", "id", "y", "x"])

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.assign(o=[hash((i * 0x9E3779B1) & 0xFFFFFFFF) for i in part["id"]]).sort_values(["o", "id"], kind="stable")
        rows = [(y, np.frombuffer(x, dtype=np.int32)) for y, x in zip(part["y"], part["x"], strict=True)]
        w, b = ftrl(rows, bits, epochs, alpha, beta, l1, l2)
        return pd.DataFrame({"shard": [part["shard"].iloc[0]], "n": [len(rows)], "b": [b], "w": [w.astype("<f4").tobytes()]})

    shard = F.pmod(F.xxhash64("__id", F.lit(7)), F.lit(shards)).cast("int").alias("shard")
    fitted = (sample.select("__id", "__text", "__y", shard).mapInArrow(featurise, "shard int, id long, y int, x binary")
              .groupBy("shard").applyInPandas(fit, "shard int, n long, b double, w binary")
              .collect())  # at most `shards` rows of 2**bits floats
    if not fitted:
        return Model(np.zeros(1 << bits, np.float32), 0.0, bits, orders)
    fitted.sort(key=lambda r: r.shard)
    share = np.array([r.n for r in fitted], dtype=float) / sum(r.n for r in fitted)
    weights = sum(s * np.frombuffer(r.w, "<f4") for s, r in zip(share, fitted, strict=True))
    return Model(weights.astype(np.float32), float(sum(s * r.b for s, r in zip(share, fitted, strict=True))), bits, orders)


def score_column(docs: DataFrame, model: Model, text_col: str = "text") -> Column:
    """The score (0 to 1) of each row's whole text; null and empty texts get the model's bias."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        w = m.weights.astype(np.float64)
        for texts in batches:
            out = np.empty(len(texts))
            for i, j, index, text in features(texts, m.bits, m.orders):
                n = np.maximum(1, np.bincount(text, minlength=j - i))
                out[i:j] = np.bincount(text, weights=w[index], minlength=j - i) / np.sqrt(n) + m.bias
            yield pa.array(1 / (1 + np.exp(-np.clip(out, -30, 30))))

    return score(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row (also repeated rows, null ids and empty texts)."""
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), score_column(docs, model, text_col).alias("score"))
            .select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that the model accepts, with all their columns."""
    name = "__quality_score"
    return docs.withColumn(name, score_column(docs, model)).where(F.col(name) >= 0.5).drop(name)

"""Document fingerprints by locally consistent parsing.

A text is parsed level by level.  Runs of one symbol become one symbol; then deterministic
coin tossing labels every symbol by the lowest bit in which it differs from its left
neighbour, again and again until few labels are left, and local maxima of the labels start phrases of
two to four symbols.  A phrase's name is a hash of its symbols, and the names are the next
level's text.  Where phrases start depends on a few neighbours only, so
equal substrings get equal names inside, whatever their offset.

The fingerprint is the root's name plus, for the first ``LEVELS`` levels, a sketch of the
level's names with their occurrence numbers (smallest in each of ``BINS`` parts of the hash range, 12 bits each).
Equal texts have equal fingerprints; two fingerprints give an estimate of the
share of phrases in common.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.textbytes import mix

LEVELS = 3
BINS = 64
LEAST_NAMES = 16      # phrases that a level needs on both sides to be compared
GROUP_CHARS = 1 << 17  # texts are parsed together up to so many characters
WINDOW = 1 << 20      # symbols whose labels are computed at once
MARGIN = 32           # neighbours that a label can depend on, rounded up
_NONE = 7

_FREE = np.array([next((v for v in range(3) if not used >> v & 1), 0) for used in range(8)], dtype=np.uint8)


def _toss_table(labels: int) -> np.ndarray:
    """[left, own] -> 2 * (lowest differing bit) + own bit there, for small labels."""
    out = np.zeros((labels, labels), dtype=np.uint8)
    for a in range(labels):
        for b in range(labels):
            if a != b:
                low = ((a ^ b) & -(a ^ b)).bit_length() - 1
                out[a, b] = 2 * low + (b >> low & 1)
    return out


_SMALL = {n: _toss_table(n) for n in (128, 14, 8)}


def _labels(s: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Labels 0 to 2, different for neighbours; ``first``/``last`` are positions without left/right neighbour."""
    lab = np.empty(len(s), dtype=np.uint8)
    diff = s[1:] ^ s[:-1]
    low = np.bitwise_count((diff & (np.uint64(0) - diff)) - np.uint64(1))
    lab[1:] = 2 * low + ((s[1:] >> np.minimum(low, 63).astype(np.uint64)) & np.uint64(1)).astype(np.uint8)
    lab[first] = (s[first] & np.uint64(1)).astype(np.uint8)
    np.minimum(lab, 127, out=lab)
    for n in (128, 14, 8):  # 128 labels become 14, then 8, then 6
        new = np.empty_like(lab)
        new[1:] = _SMALL[n].ravel()[lab[:-1].astype(np.uint16) * n + lab[1:]]
        new[first] = lab[first] & 1
        lab = new
    for v in (5, 4, 3):  # neighbours of a v are no v, so all of them can change at once
        at = np.flatnonzero(lab == v)
        left, right = lab[at - 1], lab[np.minimum(at + 1, len(lab) - 1)]
        left = np.where(np.isin(at, first, assume_unique=True), _NONE, left)
        right = np.where(np.isin(at, last, assume_unique=True), _NONE, right)
        lab[at] = _FREE[(np.left_shift(1, left) | np.left_shift(1, right)) & 7]
    return lab


def _starts(s: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether a phrase starts at each symbol. Long input goes through in windows
    with a margin, which changes nothing as labels are local."""
    out = np.zeros(len(s), dtype=bool)
    for lo in range(0, len(s), WINDOW):
        a, b = max(0, lo - MARGIN), min(len(s), lo + WINDOW + MARGIN)
        own = first[np.searchsorted(first, a):np.searchsorted(first, b)] - a
        begins = own if len(own) and own[0] == 0 else np.concatenate([[0], own])
        last = np.append(begins[1:] - 1, b - a - 1)
        lab = _labels(s[a:b], begins, last).astype(np.int8)
        peak = np.zeros(b - a, dtype=bool)
        peak[1:-1] = (lab[1:-1] > lab[:-2]) & (lab[1:-1] > lab[2:])
        peak[last] = False
        peak[own] = True
        hi = min(len(s), lo + WINDOW)
        out[lo:hi] = peak[lo - a:hi - a]
    out[first] = True
    return out


def _names(s: np.ndarray, at: np.ndarray, salt: int) -> np.ndarray:
    """Names of the phrases that start at ``at``."""
    place = np.arange(len(s), dtype=np.uint64) - np.repeat(at, np.diff(np.append(at, len(s)))).astype(np.uint64)
    value = mix(s + (place + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03))
    return mix(np.add.reduceat(value, at) + np.uint64(salt))


def _collapse(s: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of an equal symbol become one symbol, named by symbol and length."""
    new = np.ones(len(s), dtype=bool)
    np.not_equal(s[1:], s[:-1], out=new[1:])
    new[first] = True
    at = np.flatnonzero(new)
    if len(at) == len(s):
        return s, first
    length = np.diff(np.append(at, len(s)))
    out = s[at]
    many = np.flatnonzero(length > 1)
    out[many] = mix(out[many] * np.uint64(3) + length[many].astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    return out, np.searchsorted(at, first)


def _occurrences(s: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Names that tell a text's first, second, ... occurrence of a phrase apart, so that
    repetition counts when sketches are compared."""
    key = mix(s + mix(row.astype(np.uint64) + np.uint64(1)))  # equal for one phrase of one text
    order = np.argsort(key)
    key = key[order]
    place = np.arange(len(s))
    begins = np.ones(len(s), dtype=bool)
    np.not_equal(key[1:], key[:-1], out=begins[1:])
    nth = np.empty(len(s), dtype=np.uint64)
    nth[order] = place - np.maximum.accumulate(np.where(begins, place, 0))
    return mix(s + nth * np.uint64(0xE7037ED1A0B428DB))


def parse(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(root names, phrases of each level, sketches [text, level, bin]) of a list of texts."""
    n = len(texts)
    roots, sizes = np.zeros(n, dtype=np.uint64), np.zeros((n, LEVELS), dtype=np.int64)
    sketch = np.zeros((n, LEVELS, BINS), dtype=np.uint16)
    points = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype="<u4") for t in texts]
    live = np.array([i for i in range(n) if len(points[i])], dtype=np.int64)
    if not len(live):
        return roots, sizes, sketch
    s = mix(np.concatenate([points[i] for i in live]).astype(np.uint64) + np.uint64(1))
    first = np.cumsum([0] + [len(points[i]) for i in live[:-1]])
    level = 0
    while len(live):
        s, first = _collapse(s, first)
        count = np.diff(np.append(first, len(s)))
        if level and level <= LEVELS:
            sizes[live, level - 1] = count
            row = np.repeat(np.arange(len(live)), count)
            least = np.full(len(live) * BINS, np.iinfo(np.uint64).max, dtype=np.uint64)
            seen = _occurrences(s, row)
            np.minimum.at(least, row * BINS + (seen >> np.uint64(58)).astype(np.int64), seen)
            sketch[live, level - 1] = np.where(least == np.iinfo(np.uint64).max, 0, least % np.uint64(4095) + np.uint64(1)).reshape(-1, BINS)
        done = count == 1
        if done.any() and level:
            roots[live[done]] = s[first[done]]
            keep = ~done
            s = s[np.repeat(keep, count)]
            live, count = live[keep], count[keep]
            first = np.cumsum(count) - count
            if not len(live):
                break
        level += 1
        starts = _starts(s, first)
        at = np.flatnonzero(starts)
        s, first = _names(s, at, level), np.searchsorted(at, first)
    return roots, sizes, sketch


def fingerprints(texts: list[str]) -> list[str]:
    """``root.characters:phrases.bins of level 1:...`` in hexadecimal; the empty text's is all zero."""
    out: list[str] = []
    i = 0
    while i < len(texts):
        j, chars = i, 0
        while j < len(texts) and (j == i or chars + len(texts[j]) <= GROUP_CHARS):
            chars += len(texts[j])
            j += 1
        roots, sizes, sketch = parse(texts[i:j])
        hexed = "".join(f"{v:03x}" for v in range(4096))
        bins = np.frombuffer(hexed.encode(), dtype="S3")[sketch]
        for k in range(j - i):
            out.append(f"{int(roots[k]):016x}.{len(texts[i + k]):x}" + "".join(f":{sizes[k, v]:x}.{bins[k, v].tobytes().decode()}" for v in range(LEVELS)))
        i = j
    return out


def likeness(a: str, b: str) -> float:
    """Estimated share of phrases in common (Dice), 0 to 1; 1 for equal fingerprints.

    Compared at the highest level at which both sides have ``LEAST_NAMES`` phrases and runs have not
    swallowed much of a side (a phrase spans about 2.7 symbols, unless runs collapsed), else at the first."""
    if a == b:
        return 1.0
    (ha, *left), (hb, *right) = a.split(":"), b.split(":")
    ca, cb = int(ha.split(".")[1], 16), int(hb.split(".")[1], 16)
    for level in range(len(left), 0, -1):
        (n, p), (m, q) = left[level - 1].split("."), right[level - 1].split(".")
        n, m = int(n, 16), int(m, 16)
        if min(n, m) >= LEAST_NAMES and n * 3.2 ** level >= ca and m * 3.2 ** level >= cb:
            break
    u = np.frombuffer(p.encode(), dtype="S3")
    v = np.frombuffer(q.encode(), dtype="S3")
    held = (u != b"000") | (v != b"000")
    same = float(np.count_nonzero((u == v) & held))
    j = same / max(1, np.count_nonzero(held))
    return 2 * j / (1 + j)


def fingerprint_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` of every row; null texts are empty."""
    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            yield pa.array(fingerprints(b.to_pylist()), pa.string())

    return df.select(F.col(id_col).cast("long").alias("doc_id"), run(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("fingerprint"))


def with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, next_text``: every row with the text that follows it by ascending id
    (nulls first, ties by text; after the last row comes the first).

    Ids are cut into buckets at their quantiles; each bucket also gets
    the first rows of the bucket after it, so one shuffle of the texts is enough and no
    task sees more than a bucket."""
    spark = df.sparkSession
    number = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / number for i in range(1, number)], 20 * number)).first()[0]
    splits = sorted({float(c) for c in cuts or [0.0]})
    bucketed = Bucketizer(splits=[float("-inf"), *splits, float("inf")], inputCol="__at", outputCol="__bucket").transform(
        rows.withColumn("__at", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))))).drop("__at")
    order = F.struct(F.col("doc_id").isNotNull().alias("known"), F.col("doc_id").alias("doc_id"))
    found = sorted((int(r[0]), r[1]["doc_id"]) for r in bucketed.groupBy("__bucket").agg(F.min(order)).collect()) if splits else []  # one row a bucket
    firsts = spark.createDataFrame([(float(b), first, float(found[k - 1][0])) for k, (b, first) in enumerate(found)],
                                   "__b double, __first long, __before double")
    lone = F.struct(F.col("__bucket").alias("bucket"), F.lit(0).alias("copy"))
    copied = F.struct(F.col("__before").alias("bucket"), F.lit(1).alias("copy"))
    dealt = (bucketed.join(F.broadcast(firsts), F.col("__bucket") == F.col("__b"))
             .withColumn("__to", F.explode(F.when(F.col("doc_id").eqNullSafe(F.col("__first")), F.array(lone, copied)).otherwise(F.array(lone))))
             .select("doc_id", "text", "__to.bucket", "__to.copy"))
    follow = Window.partitionBy("bucket").orderBy("copy", F.asc_nulls_first("doc_id"), "text")
    return dealt.withColumn("next_text", F.lead("text").over(follow)).where("copy = 0").select("doc_id", "text", "next_text")


def edit(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the following one."""
    k = len(text) // 4
    return text[:len(text) - k] + following[:k]


def compare_edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of every row.

    Null texts are empty; repeated rows follow one another; the only row of a table follows
    itself; null ids come first; an empty table gives no rows; other columns are not returned."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                own, following = part.column(1).to_pylist(), part.column(2).to_pylist()
                edited = [edit(t, f) for t, f in zip(own, following, strict=True)]
                apart = [k for k in range(len(own)) if k + 1 == len(own) or following[k] != own[k + 1]]
                prints = fingerprints(own + edited + [following[k] for k in apart])
                n = len(own)
                after = dict(zip(apart, prints[2 * n:], strict=True))
                after = [after[k] if k in after else prints[k + 1] for k in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(t) for t in own], pa.int64()),
                     pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]), pa.array(prints[:n]), pa.array(prints[n:2 * n]),
                     pa.array([likeness(x, y) for x, y in zip(prints[:n], prints[n:2 * n], strict=True)], pa.float64()),
                     pa.array([likeness(x, y) for x, y in zip(prints[:n], after, strict=True)], pa.float64())],
                    names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return with_next(df, id_col, text_col).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")

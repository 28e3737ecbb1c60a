"""Near-duplicates of documents by HyperMinHash.

A document's set holds its distinct word shingles.  Its sketch has ``BINS`` registers: the
smallest hash in each part of the hash range, compressed to its number of leading zeros and
``MANTISSA`` further bits (16 bits, 0 for an empty part).  Equal sets are
one representative from the start.  Bands of ``ROWS`` registers put similar sets into
buckets; inside buckets the collision-corrected estimate of the Jaccard
similarity picks pairs, and every link is confirmed on the full sets.

Two passes avoid all pairs of a large group.  The first compares each member of a
bucket with the one most like it and with the bucket's most central member; confirmed
links give components.  The second takes only buckets that still hold several components
and compares every pair of different components whose estimate doesn't rule out
the threshold (by ``SIGMAS`` standard errors), each pair in the first band it shares, on
small sets of 32-bit hashes within the bucket's task.  So links inside a known component are
never needed, no link between components is left out, and only likely pairs leave a task.
Large buckets are cut into cells (pairs of blocks of at most about ``BLOCK`` members),
so a hot bucket is spread over tasks.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm import links, textbytes
from vigil.session import checkpoint_dir

WORDS = 5
BINS, MANTISSA = 128, 10
ROWS = 4
BLOCK = 1024
SIGMAS = 5.0
SMALL = 4096          # hashes of a small set at most, on average

_KINDS = np.array([0 if b in (32, *range(9, 14)) else 1 for b in range(256)], dtype=np.uint8)
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


def shingle_sets(texts: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text (A-Z lower-cased): runs of ``words``
    words, or all words as one if there are fewer; nothing for a text without words."""
    data, offsets = textbytes.buffers(texts)
    for i, j in textbytes.groups(offsets):  # lower-cased group by group
        lo, hi = int(offsets[i]), int(offsets[j])
        part, off = _LOWER[data[lo:hi]], offsets[i:j + 1] - lo
        for a, b, tok, counts in textbytes.tokens(part, off, _KINDS):
            ends = np.cumsum(counts)
            for k in range(b - a):
                own = tok[ends[k] - counts[k]:ends[k]]
                if len(own):
                    yield np.unique(textbytes.ngrams(own, counts[k:k + 1], min(words, len(own)))[0])
                else:
                    yield own


def registers(shingles: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of a sorted set of hashes."""
    shift = np.uint64(64 - (BINS - 1).bit_length())
    at = np.searchsorted(shingles, np.arange(BINS, dtype=np.uint64) << shift)
    out = np.zeros(BINS, dtype=np.uint16)
    have = at < len(shingles)
    least = shingles[at[have]]
    inside = (least >> shift) == np.flatnonzero(have).astype(np.uint64)
    rest = (least[inside] << np.uint64(64) - shift) | np.uint64(1)
    spread = rest.copy()
    for s in (1, 2, 4, 8, 16, 32):
        spread |= spread >> np.uint64(s)
    zeros = np.uint64(64) - np.bitwise_count(spread).astype(np.uint64)
    mantissa = (rest << zeros << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    out[np.flatnonzero(have)[inside]] = (zeros << np.uint64(MANTISSA)) + mantissa + np.uint64(1)
    return out


def band_keys(regs: np.ndarray) -> np.ndarray:
    """Bucket of each band of each row of registers; 0 where the band is empty."""
    packed = np.ascontiguousarray(regs).view(np.uint64).reshape(len(regs), -1)  # four 16-bit registers
    band = np.arange(1, packed.shape[1] + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)
    return np.where(packed == 0, np.uint64(0), textbytes.mix(packed ^ band) | np.uint64(1)).view(np.int64)


def estimate(equal: np.ndarray, either: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the registers that agree, corrected for chance agreement.

    Two unrelated minima among ``a`` and ``b`` values a bin share leading zeros and
    mantissa with probability about 0.72 * 2**-MANTISSA * a * b / (a + b)**2."""
    chance = 0.72 * 2.0 ** -MANTISSA * n * m / np.square(n + m)
    return np.clip((equal / np.maximum(1, either) - chance) / (1 - chance), 0, 1)


def small_set(shingles: np.ndarray) -> np.ndarray:
    """The upper halves of a set's hashes; of a set over ``SMALL``, those whose low bits are zero
    (one bit for each doubling), preceded by that number of bits."""
    level = max(0, int(np.ceil(np.log2(max(1, len(shingles)) / SMALL))))
    top = (shingles >> np.uint64(32)).astype(np.uint32)
    top = np.unique(top[(top & np.uint32((1 << level) - 1)) == 0]) if level else np.unique(top)
    return np.concatenate([np.array([level], dtype=np.uint32), top])


def _likely(left: np.ndarray, right: np.ndarray, small: list[np.ndarray], threshold: float) -> np.ndarray:
    """Whether pairs of members may reach the threshold, by their small sets. These are exact but for
    chance agreement of 32-bit hashes and for the sampling of large sets; a margin covers both."""
    level = np.array([int(x[0]) for x in small])
    values = [x[1:] for x in small]
    ok = np.zeros(len(left), dtype=bool)
    every, index = np.unique(np.concatenate(values), return_inverse=True)
    edge = np.cumsum([0] + [len(v) for v in values])
    mark = np.zeros(len(every), dtype=bool)
    order = np.argsort(left, kind="stable")
    heads = np.flatnonzero(np.append(True, np.diff(left[order]) > 0)) if len(left) else []
    for group in np.split(order, heads[1:]):
        a = left[group[0]]
        mark[index[edge[a]:edge[a + 1]]] = True
        for k in group:
            b = right[k]
            top = max(level[a], level[b])
            size, other = len(values[a]), index[edge[b]:edge[b + 1]]
            if level[a] != level[b]:
                keep = np.uint32((1 << top) - 1)
                size = np.count_nonzero((values[a] & keep) == 0)
                other = other[(values[b] & keep) == 0]
            both = np.count_nonzero(mark[other])
            union = size + len(other) - both
            margin = 0.01 + (SIGMAS * np.sqrt(threshold * (1 - threshold) / max(1, union)) if top else 0)
            ok[k] = both >= (threshold - margin) * union
        mark[index[edge[a]:edge[a + 1]]] = False
    return ok


def _signatures(df: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, ka, kb, regs = [], [], [], []
            for s in shingle_sets(b.column(1), words):
                n.append(len(s))
                ka.append(int(s.sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
                kb.append(int(textbytes.mix(s.copy()).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
                regs.append(registers(s).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ka, pa.int64()), pa.array(kb, pa.int64()), pa.array(regs, pa.binary())],
                                             names=["doc_id", "n", "ka", "kb", "regs"])

    return df.mapInArrow(run, "doc_id long, n long, ka long, kb long, regs binary")


def _bands(reps: DataFrame) -> DataFrame:
    """``bucket, rep`` for each non-empty band of each representative."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            keys = band_keys(np.frombuffer(b"".join(b.column(1).to_pylist()), dtype="<u2").reshape(-1, BINS))
            rep = np.repeat(b.column(0).to_numpy(), keys.shape[1]).reshape(keys.shape)
            yield pa.RecordBatch.from_arrays([pa.array(keys[keys != 0]), pa.array(rep[keys != 0])], names=["bucket", "rep"])

    return reps.select("rep", "regs").mapInArrow(run, "bucket long, rep long")


class _Cell:
    """Members of one cell (two blocks of a bucket, or one with itself), as columns."""

    def __init__(self, columns: list):
        bucket, ci, cj, block, self.rep, n, self.comp, self.regs, *small = columns
        self.bucket, self.n, self.same = bucket[0], n.astype(float), ci[0] == cj[0]
        self.rows = np.arange(len(n)) if self.same else np.flatnonzero(block == block.min())
        self.cols = np.arange(len(n)) if self.same else np.flatnonzero(block != block.min())
        self.full = (self.regs != 0).astype(np.float32)
        self.small = small[0] if small else None

    def slices(self, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, estimates [rows, cols], whether a pair may reach the threshold)."""
        for lo in range(0, len(self.rows), 32):
            rows, cols = self.rows[lo:lo + 32], self.cols
            a, b = self.regs[rows][:, None, :], self.regs[cols][None, :, :]
            equal = np.count_nonzero((a == b) & (a != 0), axis=2)
            either = self.full[rows].sum(1)[:, None] + self.full[cols].sum(1)[None, :] - self.full[rows] @ self.full[cols].T
            est = estimate(equal, either, self.n[rows][:, None], self.n[cols][None, :])
            may = est >= threshold - SIGMAS * np.sqrt(threshold * (1 - threshold) / np.maximum(1, either))
            small = np.minimum(self.n[rows][:, None], self.n[cols][None, :]) < threshold * np.maximum(self.n[rows][:, None], self.n[cols][None, :])
            may &= ~small & (self.rep[rows][:, None] != self.rep[cols][None, :])
            yield rows, est, may

    def nearest(self, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of each member with the one most like it and with the most central one."""
        parts, central = list(self.slices(threshold)), None
        total = np.zeros(len(self.cols))
        left, right = [], []
        for _, est, may in parts:
            may &= est >= threshold - 0.03  # this pass looks for links that are likely; the second leaves none out
            total += np.where(may, est, 0).sum(0)
        central = self.cols[int(total.argmax())]
        for rows, est, may in parts:
            some = may.any(1)
            left.append(rows[some])
            right.append(self.cols[np.where(may, est, -1).argmax(1)[some]])
            to_center = may[:, int(total.argmax())]
            left.append(rows[to_center])
            right.append(np.full(int(to_center.sum()), central))
        return np.concatenate(left), np.concatenate(right)

    def crossing(self, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of different components that may reach the threshold, in their first common band."""
        left, right = [], []
        for rows, _, may in self.slices(threshold):
            may &= self.comp[rows][:, None] != self.comp[self.cols][None, :]
            if self.same:
                may &= self.rep[rows][:, None] < self.rep[self.cols][None, :]
            i, j = np.nonzero(may)
            if len(i):
                a, b = rows[i], self.cols[j]
                keys = band_keys(self.regs[a])
                shared = (keys == band_keys(self.regs[b])) & (keys != 0)
                first = keys[np.arange(len(a)), shared.argmax(1)] == self.bucket
                left.append(a[first])
                right.append(b[first])
        none = np.zeros(0, dtype=np.int64)
        return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _cells(members: DataFrame, blocks, payload: str) -> DataFrame:
    """Members dealt to the cells of their buckets, each cell's rows together."""
    block = F.pmod(F.xxhash64("rep", "bucket"), blocks)
    return (members.withColumn("block", block.cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
            .select("bucket", F.least("block", "other").cast("int").alias("ci"), F.greatest("block", "other").cast("int").alias("cj"), "block", "rep", "n", "comp", "regs", *([payload] if payload else []))
            .repartition("bucket", "ci", "cj").sortWithinPartitions("bucket", "ci", "cj", "rep"))


def _by_cell(cells: DataFrame, work, schema: str) -> DataFrame:
    """``work(cell)`` over every cell of rows dealt by ``_cells``; returns columns of equal length or None."""
    names = [c.split()[0] for c in schema.split(", ")]

    def columns(b: pa.RecordBatch) -> list:
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in range(7)]
        cols.append(np.frombuffer(b"".join(b.column(7).to_pylist()), dtype="<u2").reshape(-1, BINS))
        if b.num_columns > 8:
            small = np.empty(b.num_rows, dtype=object)
            small[:] = [np.frombuffer(x, dtype="<u4") for x in b.column(8).to_pylist()]
            cols.append(small)
        return cols

    def one(cols, lo, hi):
        part = [c[lo:hi] for c in cols]
        if hi - lo < 2 or part[1][0] != part[2][0] and (part[3][0] == part[3]).all():
            return None
        return work(_Cell(part))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for b in batches:
            if not b.num_rows:
                continue
            cols = columns(b)
            if rest is not None:
                cols = [np.concatenate([r, c]) for r, c in zip(rest, cols, strict=True)]
            new = np.flatnonzero((cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]) | (cols[2][1:] != cols[2][:-1])) + 1
            edges = [0, *new.tolist()]
            found = [x for lo, hi in zip(edges[:-1], edges[1:], strict=True) if (x := one(cols, lo, hi)) is not None]
            rest = [c[edges[-1]:] for c in cols]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], names=names)
        if rest is not None and (x := one(rest, 0, len(rest[0]))) is not None:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in x], names=names)

    return cells.mapInArrow(run, schema)


def _first_pairs(members: DataFrame, threshold: float) -> DataFrame:
    """Distinct pairs of each member (``b``) with the one most like it and with its bucket's most central one (``a``)."""
    def work(cell: _Cell):
        member, other = cell.nearest(threshold)
        pair = np.unique(np.stack([cell.rep[other], cell.rep[member]]), axis=1)
        return list(pair) if pair.shape[1] else None

    return _by_cell(_cells(members, F.ceil(F.col("m") / BLOCK), ""), work, "a long, b long").distinct()


def _second_pairs(members: DataFrame, docs: DataFrame, threshold: float, words: int) -> DataFrame:
    """All pairs ``a < b`` of different components that may reach the threshold.

    The registers pick the members of such pairs; their small sets, fetched for them
    alone, then settle nearly every pair within its cell, so that few pairs leave it."""
    def involved(cell: _Cell):
        a, b = cell.crossing(threshold)
        at = np.unique(np.concatenate([a, b]))
        return [np.full(len(at), cell.bucket), cell.rep[at], cell.n[at].astype(np.int64), cell.comp[at]] if len(at) else None

    some = (_by_cell(_cells(members, F.ceil(F.col("m") / BLOCK), ""), involved, "bucket long, rep long, n long, comp long").distinct().checkpoint())
    if some.isEmpty():
        return some.select(F.col("rep").alias("a"), F.col("rep").alias("b"))
    ids = some.select(F.col("rep").alias("id")).distinct()
    small = _small_sets(docs, ids, words)
    # an id of several rows: its rows' sets come one after another, as members of their own
    crowd = some.groupBy("bucket").agg(F.count("*").alias("m"))
    full = (some.join(crowd, "bucket").join(members.select("bucket", "rep", "regs"), ["bucket", "rep"])
            .join(small, F.col("rep") == F.col("id")).drop("id"))

    def pairs(cell: _Cell):
        a, b = cell.crossing(threshold)
        keep = _likely(a, b, cell.small, threshold) if len(a) else np.zeros(0, dtype=bool)
        a, b = cell.rep[a[keep]], cell.rep[b[keep]]
        return [np.minimum(a, b), np.maximum(a, b)] if len(a) else None

    return _by_cell(_cells(full, F.ceil(F.col("m") / BLOCK), "shingles"), pairs, "a long, b long").distinct()


def _small_sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """``id, shingles``: the small sets of the documents with one of the ids."""
    return links.sets_of(docs, ids, lambda texts: (small_set(x).astype("<u4") if len(x) else x for x in shingle_sets(texts, words)))


def near_duplicates(df: DataFrame, threshold: float = 0.85, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row.

    Documents are linked if the Jaccard similarity of their shingle sets is at least
    ``threshold`` (whole percent); ``component_id`` is the smallest id that links reach, ``kept`` whether that is
    the row's own.  Null, empty and wordless texts have an empty set and no links; rows
    without an id are kept, with a null component; rows that share an id are one node,
    which has the links of all of them.  Other columns are neither read nor returned.  Building the result runs jobs,
    whose results are checkpointed."""
    checkpoint_dir(df.sparkSession)
    percent, sets = round(100 * threshold), partial(shingle_sets, words=words)
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    sig = _signatures(docs, words).checkpoint()
    reps = (sig.where("n > 0 and doc_id is not null").groupBy("ka", "kb")
            .agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("regs").alias("regs")).checkpoint())
    bands = _bands(reps)
    # aggregates are stored before they are joined, so that hot buckets can be split
    crowded = bands.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1").checkpoint()
    members = bands.join(crowded, "bucket").checkpoint()
    known = reps.select("rep", "n", "regs")
    first = _first_pairs(members.join(known, "rep").withColumn("comp", F.col("rep")), threshold).checkpoint()
    tried = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    found = links.confirm(first, docs, percent, sets).unionByName(links.shared_ids(sig, reps))
    comps = links.components(found)
    placed = (members.join(comps, F.col("rep") == F.col("node"), "left")
              .select("bucket", "m", "rep", F.coalesce("comp", "rep").alias("comp")))
    mixed = placed.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("bucket").checkpoint()
    second = (_second_pairs(placed.join(mixed, "bucket", "left_semi").join(known, "rep"), docs, threshold, words)
              .join(tried, ["a", "b"], "left_anti").checkpoint())
    if not second.isEmpty():
        more = links.confirm(second, docs, percent, sets)
        comps = links.components(comps.select(F.col("node").alias("a"), F.col("comp").alias("b")).union(more))
    return links.placed(sig, reps, comps).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, threshold: float = 0.8, words: int = WORDS) -> DataFrame:
    """One row of each group of near-duplicates, with all its columns; rows that agree in id and text are one.

    Rows are grouped by their texts alone: an id with several texts is several documents, and rows without an
    id take part.  The smallest id of a group stays, an id with several texts or none only where the group has no other."""
    several = (docs.groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("lo"), F.max(F.xxhash64("text")).alias("hi"))
               .where("doc_id is null or lo <> hi").select(F.col("doc_id").alias("__several")).checkpoint())
    node = F.col("doc_id")
    named = docs
    if not several.isEmpty():   # those rows go by a number of their id and text, above ordinary ids
        named = docs.join(several, F.col("doc_id").eqNullSafe(F.col("__several")), "left")
        own = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)
        node = F.when(F.col("doc_id").isNull() | F.col("__several").isNotNull(), own).otherwise(F.col("doc_id"))
    named = named.withColumn("__node", node)
    kept = (near_duplicates(named, threshold, words, id_col="__node").where("kept").select(F.col("doc_id").alias("__kept")).distinct())
    again = Window.partitionBy("__node").orderBy("text", "source", "lang", "n_chars")
    return (named.join(kept, F.col("__node") == F.col("__kept"), "left_semi").withColumn("__nth", F.row_number().over(again)).where("__nth = 1")
            .select(docs.columns))

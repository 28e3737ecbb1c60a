"""N-gram Jaccard join: size-banded tiles, hashed bitmap signatures, exact intersections.

Documents with equal sets of word shingles are one class from the start.  Two sets can reach the
threshold only if they share a shingle among the first ``n - ceil(t n) + 1`` of each, in any order common to all;
here common shingles go last (by a table of ``SLOTS`` counts over all documents) and
the rest by hash.  The classes that hold such a shingle are a tile; of tiles with the same members one stays.

1. Each member is paired with its tile's hub, the one that lies in most tiles (an original shares all its shingles, its
   edited copies do not); the bound below drops most pairs that can't link, the others are confirmed on full
   sets, links give components.
2. Tiles that still hold several components are cut into size bands, one band wide enough that only
   neighbouring bands can link, and hot ones into blocks.  Only members outside the component of the tile's
   hub (rows) are compared, with all members (columns), so a large group of copies is not compared with itself.
   The signature of a set has one parity bit for each of b hash slots.  Two signatures differ in at most as
   many bits as the sets differ in shingles, so ``(|A| + |B| - bits) / 2`` bounds the overlap from above.
   A cell gives all pairs of different components that the bound allows if they are few.  A crowded one gives each row's
   most alike column and the column that is most often possible, and is looked at again when
   their links have grown the components; the last time it gives every pair.  So no link
   between components is left out, and links within one are never needed.

Every link rests on the intersection of two full sorted arrays.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm import links
from vigil.llm.near_dup import shingle_sets
from vigil.session import checkpoint_dir

WORDS = 5
SLOTS = 1 << 21            # counts that tell common shingles from rare ones, and bytes of the table that is broadcast
BLOCK = 1024               # rows or columns of a cell
MIN_BITS, MAX_BITS = 64, 1 << 16
CELL_WORDS = 1 << 21       # 64-bit words compared at once
FEW = 4                    # possible pairs for each row or column that make a cell crowded
ROUNDS = 3                 # the last round gives every pair


def band_starts(percent: int, limit: int = 1 << 40) -> np.ndarray:
    """Least set size of each band: a set can only reach the threshold with sets of its own band and the two beside it."""
    out = [1]
    while out[-1] < limit:
        out.append(out[-1] * 100 // percent + 1)
    return np.array(out, dtype=np.int64)


def signature_bits(least: int) -> int:
    """Bits of the signatures of a band whose least set size is given: at least 1.5 times that."""
    return int(np.clip(1 << int(np.ceil(np.log2(1.5 * least))), MIN_BITS, MAX_BITS))


def signature(shingles: np.ndarray, bits: int) -> np.ndarray:
    """Parity of the shingles in each of ``bits`` slots, as 64-bit words."""
    parity = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").view(np.uint64)


def fold(words: np.ndarray, length: int) -> np.ndarray:
    """A signature as it would be with fewer bits (``length`` words)."""
    while len(words) > length:
        words = words[:len(words) // 2] ^ words[len(words) // 2:]
    return words


def may_link(left: bytes, right: bytes, percent: int) -> bool:
    """Whether the sizes (8 bytes, most significant first) and signatures of two sets allow a link."""
    a, b = np.frombuffer(left, dtype=np.uint64, offset=8), np.frombuffer(right, dtype=np.uint64, offset=8)
    length = min(len(a), len(b))
    n, m = int.from_bytes(left[:8], "big"), int.from_bytes(right[:8], "big")
    overlap = min((n + m - int(np.bitwise_count(fold(a, length) ^ fold(b, length)).sum())) // 2, n, m)
    return overlap * (100 + percent) >= percent * (n + m)


def _slot(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(65 - SLOTS.bit_length())).astype(np.int64)


def prefix(shingles: np.ndarray, common: np.ndarray, percent: int) -> np.ndarray:
    """The first ``n - ceil(percent n / 100) + 1`` shingles, common ones last, then by hash."""
    n = len(shingles)
    keep = n - -(-percent * n // 100) + 1
    order = np.argsort(common[_slot(shingles)], kind="stable")   # the shingles are sorted
    return shingles[order[:keep]]


def common_slots(docs: DataFrame, words: int) -> np.ndarray:
    """For each slot of the hash range the logarithm of its count, 0 where it is nothing special.

    Every task counts all shingles of its documents and reports the slots that stand out (by more than four
    standard deviations of a slot with its share).  Any table gives a right result, it only settles an order.  At most one row a slot
    reaches the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part, size = np.zeros(SLOTS, dtype=np.int64), [], 0
        for b in batches:
            for s in shingle_sets(b.column(0), words):
                part.append(s)
                size += len(s)
                if size > 1 << 20:
                    total += np.bincount(_slot(np.concatenate(part)), minlength=SLOTS)
                    part, size = [], 0
        if part:
            total += np.bincount(_slot(np.concatenate(part)), minlength=SLOTS)
        mean = total.sum() / SLOTS
        at = np.flatnonzero(total > mean + 4 * np.sqrt(mean) + 1)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["slot", "n"])

    found = docs.select("text").mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(SLOTS, dtype=np.uint8)
    out[found["slot"].to_numpy(np.int64)] = np.floor(np.log2(found["n"].to_numpy(np.float64))).astype(np.uint8) + 1
    return out


def _signatures(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``doc_id, n, ka, kb, keys, bits`` of every row; ``ka, kb`` identify the set, ``keys`` is its prefix."""
    common = docs.sparkSession.sparkContext.broadcast(common_slots(docs, words))
    starts = band_starts(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from vigil.llm.textbytes import mix
        for b in batches:
            n, ka, kb, keys, bits = [], [], [], [], []
            for s in shingle_sets(b.column(1), words):
                n.append(len(s))
                ka.append(int(s.sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
                kb.append(int(mix(s.copy()).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
                keys.append(prefix(s, common.value, percent).tobytes() if len(s) else None)
                least = int(starts[np.searchsorted(starts, len(s), side="right") - 1]) if len(s) else 1
                bits.append(signature(s, signature_bits(least)).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ka, pa.int64()), pa.array(kb, pa.int64()), pa.array(keys, pa.binary()), pa.array(bits, pa.binary())],
                                             names=["doc_id", "n", "ka", "kb", "keys", "bits"])

    return docs.mapInArrow(run, "doc_id long, n long, ka long, kb long, keys binary, bits binary")


def _keys(reps: DataFrame, chosen: np.ndarray | None = None) -> DataFrame:
    """``key, node, ka, n``: a row for each shingle of each class's prefix; with a bitmap only the chosen ones (and a few more)."""
    have = reps.sparkSession.sparkContext.broadcast(chosen) if chosen is not None else None
    shift = np.uint64(64 - links.BITMAP.bit_length() + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                packed = part.column(3).to_pylist()
                key = np.frombuffer(b"".join(packed), dtype=np.uint64)
                row = np.repeat(np.arange(len(packed)), [len(x) // 8 for x in packed])
                if have is not None:
                    place = key >> shift
                    at = np.flatnonzero(have.value[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1))
                    key, row = key[at], row[at]
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *(pa.array(part.column(k).to_numpy()[row]) for k in range(3))], names=["key", "node", "ka", "n"])

    return reps.select(F.col("rep").alias("node"), "ka", "n", "keys").mapInArrow(run, "key long, node long, ka long, n long")


def _chosen(keys: DataFrame) -> np.ndarray:
    """A bitmap of the upper bits of a column ``key``."""
    place = F.shiftrightunsigned("key", 64 - links.BITMAP.bit_length() + 1)
    words = (keys.select(F.shiftright(place, 6).alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int")).alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")).collect())   # BITMAP / 64 rows at most
    out = np.zeros(links.BITMAP // 64, dtype=np.int64)
    out[[r.w for r in words]] = [r.b for r in words]
    return out.view(np.uint64)


def _similar_size(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _tiles(reps: DataFrame) -> DataFrame:
    """``key, node, ka, n, tiles`` of the members of every tile of two classes or more, ``tiles`` being the number
    that the member lies in; of tiles with equal members (told by their number,
    the smallest one and 64 bits of hashes) the one with the smallest key."""
    shared = (_keys(reps).groupBy("key").agg(F.count("*").alias("m"), F.min("node").alias("least"), F.bit_xor(F.xxhash64("node", "ka")).alias("who"))
              .where("m > 1"))
    tiles = shared.groupBy("m", "least", "who").agg(F.min("key").alias("key")).select("key").checkpoint()
    members = _keys(reps, _chosen(tiles)).join(tiles, "key").checkpoint()
    often = members.groupBy("node", "ka").agg(F.count("*").alias("tiles")).checkpoint()
    return members.join(often, ["node", "ka"])


class Cell:
    """Rows and columns of one cell, with their signatures folded to the shortest one's length."""

    def __init__(self, role: np.ndarray, node: np.ndarray, n: np.ndarray, comp: np.ndarray, bits: list[bytes], percent: int):
        length = min(map(len, bits)) // 8
        self.words = np.stack([fold(np.frombuffer(x, dtype=np.uint64), length) for x in bits])
        self.node, self.n, self.comp, self.percent = node, n, comp, percent
        self.rows, self.cols = np.flatnonzero(role == 0), np.flatnonzero(role == 1)

    def bounds(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, upper bounds of their similarity to the columns, whether a pair of different components may link)."""
        step = max(1, CELL_WORDS // max(1, len(self.cols) * self.words.shape[1]))
        for lo in range(0, len(self.rows), step):
            r, c = self.rows[lo:lo + step], self.cols
            differ = np.bitwise_count(self.words[r][:, None, :] ^ self.words[c][None, :, :]).sum(2, dtype=np.int64)
            both = self.n[r][:, None] + self.n[c][None, :]
            overlap = np.minimum((both - differ) // 2, np.minimum(self.n[r][:, None], self.n[c][None, :]))
            may = (overlap * (100 + self.percent) >= self.percent * both) & (self.comp[r][:, None] != self.comp[c][None, :])
            yield r, overlap / np.maximum(1, both - overlap), may

    def pairs(self, every: bool) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """Pairs of different components that the bound allows, a slice of rows at a time: all of them, or, if that is not wanted and
        they are many, each row with its most alike column and with the column that may link to most rows; and whether some are missing."""
        parts, often = [], np.zeros(len(self.cols), dtype=np.int64)
        for r, bound, may in self.bounds():
            often += may.sum(0)
            parts.append((r, np.where(may, bound, -1).argmax(1), may))
        crowded = not every and often.sum() > FEW * (len(self.rows) + len(self.cols))
        middle = int(often.argmax())
        for r, best, may in parts:
            if crowded:
                some, to_middle = may.any(1), may[:, middle]
                yield np.concatenate([r[some], r[to_middle]]), np.concatenate([self.cols[best[some]], np.full(int(to_middle.sum()), self.cols[middle])]), True
            else:
                i, j = np.nonzero(may)
                yield r[i], self.cols[j], False


def _cells(members: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """``key, band, rb, cb, role, node, n, comp, bits``: the cells of tiles that hold several components."""
    starts = band_starts(percent)
    band = F.expr("0L" + "".join(f" + int(n >= {int(s)})" for s in starts[1:] if s < 1 << 31))
    tiles = members.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max(F.when(F.col("node") == F.col("hub"), F.col("comp"))).alias("main")).where("lo < hi")
    tiles = tiles.select("key", "main").checkpoint()
    mixed = members.join(tiles, "key").withColumn("band", band).select("key", "band", "node", "ka", "n", "comp", (F.col("comp") != F.col("main")).alias("row")).checkpoint()
    cols = mixed.drop("row").withColumn("role", F.lit(1))
    rows = (mixed.where("row").drop("row").withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1))).withColumn("role", F.lit(0)))
    both = rows.unionByName(cols)
    crowd = both.groupBy("key", "band").agg(F.sum(1 - F.col("role")).alias("q"), F.sum("role").alias("m")).where("q > 0 and m > 0").checkpoint()
    blocks = lambda n: F.ceil(F.col(n) / BLOCK)
    dealt = both.join(crowd, ["key", "band"]).withColumn("h", F.xxhash64("node", "key"))
    own = F.when(F.col("role") == 0, F.pmod("h", blocks("q"))).otherwise(F.pmod("h", blocks("m")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("role") == 0, blocks("m")).otherwise(blocks("q")) - 1))
    dealt = (dealt.withColumn("own", own).withColumn("other", other)
             .select("key", "band", F.when(F.col("role") == 0, F.col("own")).otherwise(F.col("other")).alias("rb"),
                     F.when(F.col("role") == 0, F.col("other")).otherwise(F.col("own")).alias("cb"), "role", "node", "ka", "n", "comp"))
    return dealt.join(signatures, ["node", "ka"]).drop("ka")


def _pairs(cells: DataFrame, percent: int, every: bool) -> DataFrame:
    """Distinct pairs ``a < b`` from the cells, and whether they come from a cell that has more."""
    place = ["key", "band", "rb", "cb"]

    def work(held: list) -> Iterator[pa.RecordBatch]:
        role, node, n, comp, bits = (np.concatenate(c) for c in zip(*held))
        cell = Cell(role, node, n, comp, bits.tolist(), percent)
        if not len(cell.rows) or not len(cell.cols):
            return
        for a, b, more in cell.pairs(every):
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(node[a], node[b])), pa.array(np.maximum(node[a], node[b])), pa.array(np.full(len(a), more))],
                                                 names=["a", "b", "more"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            where = np.stack([batch.column(k).to_numpy() for k in range(4)])
            cuts = [0, *(np.flatnonzero((where[:, 1:] != where[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
            values = [batch.column(k).to_numpy() for k in range(4, 8)] + [np.array(batch.column(8).to_pylist() + [None], dtype=object)[:-1]]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                now = tuple(where[:, lo])
                if at is not None and now != at:
                    yield from work(held)
                    held = []
                at = now
                held.append([v[lo:hi] for v in values])
        if held:
            yield from work(held)

    return (cells.select(*place, "role", "node", "n", "comp", "bits").repartition(*place).sortWithinPartitions(*place)
            .mapInArrow(run, "a long, b long, more boolean").groupBy("a", "b").agg(F.max("more").alias("more")))


def join(df: DataFrame, threshold: float = 0.8, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row.

    Documents are linked if the Jaccard similarity of their shingle sets is at least ``threshold`` (whole
    percent); ``component_id`` is the smallest id that links reach.  Null, empty and wordless texts have an empty set and no
    links; rows without an id have a null component; rows that share an id are one node, which has the
    links of all of them; an empty table gives no rows.  Other columns are neither read nor returned.  Building the result runs
    jobs, whose results are checkpointed."""
    percent = round(100 * threshold)
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    sets = partial(shingle_sets, words=words)
    spark, folder = df.sparkSession, f"{checkpoint_dir(df.sparkSession)}/signatures-{uuid.uuid4().hex}"
    rows = links.stored(_signatures(docs, words, percent), folder)
    reps = (rows.where("n > 0 and doc_id is not null").groupBy("ka", "kb")
            .agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("bits").alias("bits")).checkpoint())
    sig = rows.select("doc_id", "n", "ka", "kb").checkpoint()
    links.remove(spark, folder)   # from here on, keys and signatures are those of the classes
    members = _tiles(reps)
    rank = F.struct("tiles", -F.col("node"))
    hubs = members.groupBy("key").agg(F.max_by("node", rank).alias("hub"), F.max_by("n", rank).alias("hub_n")).checkpoint()
    members = members.join(hubs, "key").select("key", "node", "ka", "n", "hub", "hub_n").checkpoint()
    first = (members.where((F.col("node") != F.col("hub")) & _similar_size(F.col("n"), F.col("hub_n"), percent))
             .select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct().checkpoint())
    tried = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    signatures = reps.select(F.col("rep").alias("node"), "ka", "bits")
    bounds = reps.select(F.col("rep").alias("id"), F.concat(F.unhex(F.lpad(F.hex("n"), 16, "0")), "bits").alias("packed"))
    possible = links.meet(first, bounds, partial(may_link, percent=percent)).checkpoint()
    found = links.confirm(possible, docs, percent, sets).unionByName(links.shared_ids(sig, reps)).checkpoint()
    comps = links.components(found)
    members = members.select("key", "node", "ka", "n", "hub")
    for k in range(ROUNDS):
        current = members.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        pairs = _pairs(_cells(current, signatures, percent), percent, k + 1 == ROUNDS).checkpoint()
        new = pairs.join(tried, ["a", "b"], "left_anti").select("a", "b").checkpoint()
        if not new.isEmpty():
            tried = tried.unionByName(new)
            more = links.confirm(new, docs, percent, sets)
            comps = links.components(comps.select(F.col("node").alias("a"), F.col("comp").alias("b")).union(more))
        if pairs.where("more").isEmpty():
            break
    return links.placed(sig, reps, comps)

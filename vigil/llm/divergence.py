"""Source divergence audit: how each source's word use departs from its language's.

``audit`` gives, for each (lang, source) group, its divergence from each other source of the
language (part ``pair``) and the terms that set it apart most (part ``term``).  Shares are
exact integers: ``p = 1 + floor(1e9 * (count + 1) / (N + V))`` over the V terms that a language keeps (those in at
least ``MIN_DOCS`` of its documents), N the group's occurrences of them; a term
contributes ``floor((p - q)**2 / q)``.

Part ``term`` is a dominance skyband.  The contribution grows with the group's
count and falls with the language's, and ties go to the earlier term, so a term that at least ``top`` others
beat or equal in higher group count, lower language count and earlier UTF-8 can't be among
the first ``top``.  That needs neither N nor V: partitions of the term table keep their skybands,
these are merged in salted parts, and only what is left is ranked exactly.

Part ``pair`` sums over all kept terms without visiting them for each pair of sources.  Where
one or both sources lack a term, its share there is one constant of the group, so those sums come
from histograms of shares; only terms present in both are met pair by pair, inside the
task that holds the term, and leave it as sums.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.session import checkpoint_dir

MIN_DOCS = 3            # documents of a language that a kept term lies in, at least
TOP = 200               # ranks of part ``term``
SCALE = 1_000_000_000
FLUSH = 500_000         # distinct (group, term) entries a worker holds
PIECE = 1 << 22         # bytes of a long text that are split at once
PAIRS = 1 << 21         # pairs of sources that are weighed at once
SALTS = 16              # parts in which the skybands of one group are merged
SMALL_GROUPS = 50_000   # groups up to which their totals are broadcast

# a term is a run of ASCII letters and of any code points beyond ASCII; only A-Z are lower-cased
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, in lists (a long text is cut between terms)."""
    at = 0
    while at < len(text):
        end = at + PIECE
        part = text[at:end].translate(_TERM_BYTES)
        if end < len(text):
            cut = part.rfind(b" ") + 1
            while not cut and end < len(text):   # one term longer than a piece
                more = text[end:end + PIECE].translate(_TERM_BYTES)
                end += len(more)
                cut = (len(part) + more.find(b" ") + 1) if b" " in more else 0
                part += more
            part = part[:cut] if cut else part
        yield part.split()
        at += len(part)


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, term, source, occ, docs``: occurrences and documents of every term, summed per worker
    (at most ``FLUSH`` entries at a time), several rows for one key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        occ: dict[tuple, Counter] = {}
        num: dict[tuple, Counter] = {}

        def flush() -> pa.RecordBatch:
            lang, term, source, o, d = [], [], [], [], []
            for key, count in occ.items():
                lang += [key[0]] * len(count)
                source += [key[1]] * len(count)
                term += count.keys()
                o += count.values()
                d += map(num[key].__getitem__, count)
            occ.clear()
            num.clear()
            return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(term, pa.binary()).cast(pa.string()), pa.array(source, pa.string()), pa.array(o, pa.int64()), pa.array(d, pa.int64())],
                                              names=["lang", "term", "source", "occ", "docs"])

        held = 0
        for b in batches:
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary())):
                key = (lang, source)
                if key not in occ:
                    occ[key], num[key] = Counter(), Counter()
                before, seen = len(occ[key]), set()
                for words in terms(text.as_py()):
                    occ[key].update(words)
                    seen.update(words)
                num[key].update(seen)
                held += len(occ[key]) - before
                if held > FLUSH:
                    yield flush()
                    held = 0
        yield flush()

    return docs.select("lang", "source", "text").mapInArrow(run, "lang string, term string, source string, occ long, docs long")


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, term, total, sources``: each language's kept terms, their occurrences in it and, for the
    sources that hold them, ``(source, count)``; one shuffle of the workers' sums."""
    counts = (term_counts(docs).repartition("lang", "term").groupBy("lang", "term", "source")
              .agg(F.sum("occ").alias("occ"), F.sum("docs").alias("docs")))
    return (counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("occ").alias("total"),
                                               F.collect_list(F.struct("source", F.col("occ").alias("count"))).alias("sources"))
            .where(F.col("docs") >= min_docs).select("lang", "term", "total", "sources"))


def _share(count: Column, n: Column, v: Column) -> Column:
    """``1 + floor(SCALE * (count + 1) / (n + v))``; wide decimals, since counts may exceed 9e9."""
    return F.lit(1) + F.call_function("div", F.lit(SCALE).cast("decimal(12,0)") * (count + 1).cast("decimal(20,0)"), (n + v).cast("decimal(20,0)"))


def _excess(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def group_totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang, source, n, v, total, p0``: kept occurrences in the group, kept terms and their occurrences
    in the language, and the group's share of a term that it lacks (null if nothing is kept)."""
    n = kept.select("lang", F.explode("sources").alias("s")).groupBy("lang", "s.source").agg(F.sum("s.count").alias("n"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    return (docs.select("lang", "source").distinct().join(n, ["lang", "source"], "left").join(langs, "lang", "left")
            .select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("lang_n", F.lit(0)).alias("lang_n"))
            .withColumn("p0", F.when(F.col("v") > 0, _share(F.lit(0), F.col("n"), F.col("v")))))


# ---- part term --------------------------------------------------------------
def skyband(count: np.ndarray, total: np.ndarray, term: pa.Array, k: int, block: int = 512) -> np.ndarray:
    """Indices of the items that fewer than ``k`` others dominate: at least the count, at most the
    total, an earlier term.  Items of one (count, total) past the k-th go at once; the others are
    compared in order with those retained so far (which suffices: of ``k`` dominators, the
    first ``k`` in any order that respects dominance are themselves retained)."""
    rank = np.empty(len(term), dtype=np.int64)
    rank[pc.sort_indices(term.cast(pa.binary())).to_numpy()] = np.arange(len(term))
    order = np.lexsort((rank, total, -count))
    new = np.append(True, (count[order][1:] != count[order][:-1]) | (total[order][1:] != total[order][:-1])) if len(order) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    order = order[np.arange(len(order)) - start < k]
    held = np.zeros(0, dtype=np.int64)
    for lo in range(0, len(order), block):
        part = order[lo:lo + block]
        above = ((total[held][None, :] <= total[part][:, None]) & (rank[held][None, :] < rank[part][:, None])).sum(1)
        inside = (total[part][None, :] <= total[part][:, None]) & (rank[part][None, :] < rank[part][:, None])
        above += np.tril(inside, -1).sum(1)
        held = np.append(held, part[above < k])
    return held


def _skybands(rows: DataFrame, k: int) -> DataFrame:
    """The skyband of each group within each partition (``lang, source, term, count, total``)."""
    names = ["lang", "source", "term", "count", "total"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            at = skyband(t["count"].to_numpy(), t["total"].to_numpy(), t["term"].combine_chunks(), k)
            return t.take(pa.array(at)).combine_chunks().to_batches()[0]

        for b in batches:
            if not b.num_rows:
                continue
            lang, source = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero((lang[1:] != lang[:-1]) | (source[1:] != source[:-1])) + 1).tolist(), b.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if held and (held[0].column(0)[0].as_py(), held[0].column(1)[0].as_py()) != (lang[lo], source[lo]):
                    yield done()
                    held = []
                held.append(b.slice(lo, hi - lo))
        if held:
            yield done()

    return rows.select(names).sortWithinPartitions("lang", "source").mapInArrow(run, "lang string, source string, term string, count long, total long")


def divergent_terms(kept: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """``lang, source, item, value, rank``: each group's ``top`` terms whose share there exceeds the language's."""
    rows = kept.select("lang", "term", "total", F.explode("sources").alias("s")).select("lang", "s.source", "term", "s.count", "total")
    local = _skybands(rows, top)
    merged = _skybands(local.repartition("lang", "source", F.pmod(F.xxhash64("term"), F.lit(SALTS))), top)
    p, q = _share(F.col("count"), F.col("n"), F.col("v")), _share(F.col("total"), F.col("lang_n"), F.col("v"))
    valued = (merged.join(groups, ["lang", "source"]).withColumns({"p": p, "q": q}).where("p > q")
              .select("lang", "source", F.col("term").alias("item"), _excess(F.col("p"), F.col("q")).alias("value")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return valued.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


# ---- part pair --------------------------------------------------------------
def _excess_np(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _both_present(shares: DataFrame) -> DataFrame:
    """``lang, source, item, value``: for pairs of sources, over the terms that both hold, what the
    histogram sums lack: ``f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)``; a sum a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            flat = b.column(1).flatten() if b.column(1).offset == 0 else pa.concat_arrays([b.column(1)]).flatten()
            size = pc.list_value_length(b.column(1)).to_numpy().astype(np.int64)
            group, p, p0 = (flat.field(k).to_numpy() for k in range(3))
            first = np.repeat(np.cumsum(size) - size, size)   # of each entry's term
            many = np.repeat(size, size)
            reach = np.cumsum(many)
            sums: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            lo = 0
            while lo < len(many):   # entries with about PAIRS partners at a time
                hi = max(lo + 1, int(np.searchsorted(reach, (reach[lo - 1] if lo else 0) + PAIRS, side="right")))
                a = np.repeat(np.arange(lo, hi), many[lo:hi])
                c = first[a] + np.arange(len(a)) - np.repeat(np.cumsum(many[lo:hi]) - many[lo:hi], many[lo:hi])
                a, c = a[a != c], c[a != c]
                f = _excess_np(p[a], p[c]) - _excess_np(p[a], p0[c]) - _excess_np(p0[a], p[c]) + _excess_np(p0[a], p0[c])
                order = np.lexsort((group[c], group[a]))
                ga, gc, f = group[a][order], group[c][order], f[order]
                if len(f):
                    new = np.flatnonzero(np.append(True, (ga[1:] != ga[:-1]) | (gc[1:] != gc[:-1])))
                    sums.append((ga[new], gc[new], np.add.reduceat(f, new)))
                lo = hi
            if sums:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*sums)], names=["ga", "gb", "value"])

    return shares.mapInArrow(run, "ga long, gb long, value long")


def diverging_pairs(kept: DataFrame, groups: DataFrame, small: bool) -> DataFrame:
    """``lang, source, item, value``: each group against each other source of its language."""
    hint = F.broadcast if small else lambda d: d   # groups were counted
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"), F.col("g").alias("gb"))
    pairs = groups.join(hint(other), "lang").where("source <> item")
    entries = kept.select("lang", "term", F.explode("sources").alias("s")).select("lang", "term", "s.source", "s.count")
    placed = (entries.join(hint(groups), ["lang", "source"])
              .select("lang", "term", "source", "g", "p0", _share(F.col("count"), F.col("n"), F.col("v")).alias("p")))
    both = _both_present(placed.groupBy("lang", "term").agg(F.collect_list(F.struct("g", "p", "p0")).alias("e")).where(F.size("e") > 1).select("lang", "e"))
    # where only one of the two holds a term: histograms of shares
    histogram = placed.groupBy("lang", "source", "g", "p").agg(F.count("*").alias("k"))
    one = histogram.join(hint(other), "lang").where("source <> item")
    single = (one.select(F.explode(F.array(
        F.struct(F.col("g").alias("ga"), "gb", (F.col("k") * _excess(F.col("p"), F.col("q0"))).alias("value"), F.col("k").alias("held")),
        F.struct(F.col("gb").alias("ga"), F.col("g").alias("gb"), (F.col("k") * _excess(F.col("q0"), F.col("p"))).alias("value"), F.col("k").alias("held")))).alias("x")).select("x.*"))
    sums = (single.unionByName(both.withColumn("held", F.lit(0).cast("long"))).groupBy("ga", "gb")
            .agg(F.sum("value").alias("value"), F.sum("held").alias("held")))
    rest = (F.col("v") - F.coalesce("held", F.lit(0))) * _excess(F.col("p0"), F.col("q0"))   # terms that neither holds, those of both counted twice
    return (pairs.join(sums.withColumnRenamed("ga", "g"), ["g", "gb"], "left")
            .select("lang", "source", "item", F.coalesce(F.coalesce("value", F.lit(0)) + rest, F.lit(0)).alias("value")))


def audit(df: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every (lang, source) that occurs.

    Null langs, sources and texts are read as ''; a group without terms has its pairs and no terms; a language without kept terms has pairs of
    value 0; a repeated row counts again; an empty table gives no rows.  Other columns are neither read nor
    returned.  Building the result runs jobs: the kept terms and the groups are checkpointed."""
    checkpoint_dir(df.sparkSession)
    blank = lambda c, name: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name)
    docs = df.select(blank(lang, "lang"), blank(source, "source"), blank(text, "text"))
    kept = kept_terms(docs, min_docs).checkpoint()
    groups = group_totals(docs, kept).withColumn("g", F.xxhash64("lang", F.lit("\x00"), "source")).checkpoint()
    small = groups.count() <= SMALL_GROUPS
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = diverging_pairs(kept, groups, small).withColumn("rank", F.row_number().over(by_value))
    found = divergent_terms(kept, F.broadcast(groups) if small else groups, top)
    out = ["lang", "source", "part", "item", "value", "rank"]
    return (pairs.withColumn("part", F.lit("pair")).select(out)
            .unionByName(found.withColumn("part", F.lit("term")).select(out)))

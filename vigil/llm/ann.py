"""Approximate nearest neighbours with balanced posting lists.

Vectors are clustered into lists of about ``LIST`` members (k-means on a bounded
sample that splits its largest clusters); the centroids stay in memory with a neighbour graph
that both indexing and searching walk best first.  A vector near a boundary is
replicated into up to ``COPIES`` lists whose centroids are within ``1 + BOUNDARY`` of its
nearest; a query searches every list within ``1 + ratio`` of its nearest (distance-ratio
pruning), so clear queries read few lists and unclear ones many.  The ratio is fitted to each index: the exact
neighbours of ``FIT_QUERIES`` queries among all rows are found by one pass over the table, and the ratio is
the least one, from ``PRUNE`` up, that reads the lists of ``RECALL`` of them.

Inner products become distances by one more component, ``sqrt(M**2 - |x|**2)`` with the
largest norm ``M``; queries are scaled to that norm.  Of equal vectors only the
smallest ids can be among the nearest, so each vector is indexed ``top + 1`` times at most, which loses no result
and takes the heat out of very common vectors; equal queries are searched once.

Lists are dealt to shards of bounded size, large lists in parts, and queries to blocks: a
(shard, block) cell is one group of a cogrouped map.  What the driver holds is bounded by
``MAX_LISTS`` (centroids, graph, list sizes), ``SAMPLE`` and ``FIT_QUERIES``.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.session import checkpoint_dir

LIST = 256            # vectors a list before replication
MAX_LISTS = 4096
SAMPLE = 65_536       # vectors that centroids are fitted on at most
COPIES, BOUNDARY = 4, 0.10
PRUNE = 0.12          # least pruning ratio
FIT_QUERIES = 256     # queries that the ratio is fitted on at most
RECALL = 0.95         # share of their neighbours that it must find
DEGREE = 24           # neighbours of a centroid in the graph
PART = 4096           # members of a list that stay together
SHARD = 32_768        # vectors of a shard
QUERY_BLOCK = 8192    # queries of a cell


@dataclass
class Centroids:
    """Cluster centres with their neighbour graph."""

    points: np.ndarray
    graph: np.ndarray
    starts: np.ndarray
    floor: float = 0.0  # a smaller distance to the nearest centroid counts as this, as it gives no scale

    def reach(self, nearest: np.ndarray, ratio: float) -> np.ndarray:
        return np.maximum(nearest, self.floor) * (1 + ratio)

    def distances(self, x: np.ndarray, eps: float, least: int) -> np.ndarray:
        """[row, centroid] distances of a best-first walk over the graph; infinite where it didn't come.

        The walk expands every centroid within ``1 + eps`` of the nearest one found and at least the ``least`` nearest."""
        k = len(self.points)
        out = np.full((len(x), k), np.inf)
        done = np.zeros((len(x), k), dtype=bool)
        out[:, self.starts] = np.sqrt(np.square(x[:, None, :] - self.points[self.starts][None]).sum(2))
        least = min(least, k)
        rows = np.arange(len(x))
        while len(rows):
            d = out[rows]
            limit = np.maximum(self.reach(d.min(1), eps), np.partition(d, least - 1, axis=1)[:, least - 1])
            open_ = np.where(done[rows] | (d > limit[:, None]), np.inf, d)
            width = min(8, k)
            best = np.argpartition(open_, width - 1, axis=1)[:, :width]
            good = np.isfinite(np.take_along_axis(open_, best, 1))
            r, c = np.nonzero(good)
            if not len(r):
                break
            node = best[r, c]
            done[rows[r], node] = True
            pair = np.unique((rows[r][:, None] * k + self.graph[node]).ravel())
            i, j = pair // k, pair % k
            new = np.isinf(out[i, j])
            i, j = i[new], j[new]
            out[i, j] = np.sqrt(np.square(x[i] - self.points[j]).sum(1))
            rows = rows[good.any(1)]
        return out


def fit(x: np.ndarray, lists: int, rounds: int = 8, seed: int = 1) -> Centroids:
    """k-means with balancing: after each round clusters far below the mean size restart inside the largest ones."""
    rng = np.random.default_rng(seed)
    lists = max(1, min(lists, len(x)))
    points = x[rng.choice(len(x), lists, replace=False)].copy()
    for step in range(rounds):
        own = np.concatenate([np.argmax(x[i:i + 2048] @ points.T - 0.5 * np.square(points).sum(1), axis=1) for i in range(0, len(x), 2048)])
        size = np.bincount(own, minlength=lists)
        total = np.zeros_like(points)
        np.add.at(total, own, x)
        points = np.where(size[:, None] > 0, total / np.maximum(1, size)[:, None], points)
        if step < rounds - 2:
            mean = len(x) / lists
            small, large = np.flatnonzero(size < mean / 4), np.argsort(-size)
            for s, b in zip(small, large[size[large] > 2 * mean], strict=False):
                points[s] = x[rng.choice(np.flatnonzero(own == b))]
    degree = min(DEGREE, lists)
    graph = np.empty((lists, degree), dtype=np.int64)
    for i in range(0, lists, 512):
        d = np.square(points[i:i + 512]).sum(1)[:, None] - 2 * points[i:i + 512] @ points.T + np.square(points).sum(1)
        graph[i:i + 512] = np.argpartition(d, degree - 1, axis=1)[:, :degree]
    if lists > degree:  # a few far links keep the graph in one piece
        graph[:, -2:] = np.stack([(np.arange(lists) + 1) % lists, rng.permutation(lists)], axis=1)
    return Centroids(points, graph, rng.choice(lists, min(8, lists), replace=False), 1e-9 * float(np.sqrt(np.square(points).sum(1).max())))


def fit_ratio(index: Centroids, q: np.ndarray, wanted: list[list[list[int]]], least: float) -> float:
    """The least pruning ratio, from ``least`` up, with which the queries read a list of ``RECALL`` of their
    neighbours; ``wanted`` has, of each query, the lists of each neighbour."""
    row = np.repeat(np.arange(len(wanted)), [len(w) for w in wanted])
    if not len(row):
        return least
    share = 1 / np.repeat([max(1, len(w)) for w in wanted], [len(w) for w in wanted])  # each query counts once
    held = [lists for w in wanted for lists in w]
    full = np.sqrt(np.maximum(0.0, np.square(q).sum(1)[:, None] - 2 * q @ index.points.T + np.square(index.points).sum(1)))
    scale = np.maximum(full.min(1), index.floor)
    need = np.array([full[r, lists].min() for r, lists in zip(row, held, strict=True)]) / scale[row] - 1
    order = np.argsort(need)
    ratio = max(least, float(need[order][min(len(need) - 1, np.searchsorted(np.cumsum(share[order]), RECALL * share.sum()))]))
    most = float((full.max(1) / scale).max())  # reads all lists
    while ratio < most:  # the walk may miss a few lists
        d = index.distances(q, ratio, 4)
        read = d <= index.reach(d.min(1), ratio)[:, None]
        if share[np.array([read[r, lists].any() for r, lists in zip(row, held, strict=True)])].sum() >= RECALL * share.sum():
            break
        ratio = ratio * 1.05 + 0.005
    return ratio


def _augment(x: np.ndarray, norm: float) -> np.ndarray:
    return np.concatenate([x, np.sqrt(np.maximum(0.0, norm ** 2 - np.square(x).sum(1)))[:, None]], axis=1)


def _as_query(x: np.ndarray, norm: float) -> np.ndarray:
    return np.concatenate([x * (norm / np.sqrt(np.square(x).sum(1)))[:, None], np.zeros((len(x), 1))], axis=1)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f8").reshape(-1, dim)


def _pack(column: pa.Array, dim: int) -> pa.Array:
    flat = np.ascontiguousarray(column.flatten().to_numpy(zero_copy_only=False), dtype="<f8").reshape(-1, dim)
    return pa.array([row.tobytes() for row in flat], pa.binary())


def _plan(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(parts of each list, first unit's shard positions, number of shards): units fill shards in order.

    Returns for each list its number of parts and the offset of its parts in ``shard_of``."""
    parts = np.maximum(1, -(-sizes // PART))
    offset = np.concatenate([[0], np.cumsum(parts)])
    weight = np.repeat(sizes / parts, parts)
    shard_of = (np.cumsum(weight) - weight) // SHARD
    return offset, shard_of.astype(np.int64), int(shard_of.max(initial=0)) + 1


def _part(ids: np.ndarray, parts: np.ndarray) -> np.ndarray:
    h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((h >> np.uint64(33)) % parts.astype(np.uint64)).astype(np.int64)


def nearest(df: DataFrame, is_query: str, top: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", prune: float = PRUNE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``top`` rows of largest inner product found for
    each row that fulfils the SQL condition ``is_query``, itself left out; ties go to smaller ids.

    Scores are inner products of the original vectors in double precision. Rows without an id, vectors that
    are null, zero or hold null or non-finite components take no part, nor do vectors of another
    dimension than the most frequent one. ``prune`` is the least pruning ratio; it is widened until the index
    finds ``RECALL`` of the neighbours of a sample of the queries. Repeated rows count once. If there are no more than ``top``
    candidates, all are returned; an empty table gives no rows; other columns are not returned."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    x = F.col("x")
    rows = (df.where(f"{id_col} is not null").withColumn("query", F.expr(f"coalesce({is_query}, false)"))
            .select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("x"), "query")
            .where(x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)))
    square = F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v)
    shape = rows.groupBy(F.size(x).alias("dim")).agg(F.count("*").alias("n"), F.max(F.sqrt(square)).alias("norm")).orderBy(F.desc("n"), F.desc("dim")).first()
    out = "query_id long, rank int, vec_id long, score double"
    if shape is None:
        return spark.createDataFrame([], out)
    dim, norm = int(shape["dim"]), float(shape["norm"])
    rows = rows.where(F.size(x) == dim).withColumn("ka", F.xxhash64(x)).withColumn("kb", F.xxhash64(F.lit(1), x))
    smallest = Window.partitionBy("ka", "kb").orderBy("vec_id")
    base = (rows.select("vec_id", "x", "ka", "kb").withColumn("nth", F.dense_rank().over(smallest)).where(F.col("nth") <= top + 1)
            .dropDuplicates(["vec_id", "ka", "kb"]).select("vec_id", "x").checkpoint())
    count = base.count()
    lists = min(MAX_LISTS, -(-count // LIST))
    sample = base.orderBy(F.xxhash64("vec_id"), "vec_id").limit(min(SAMPLE, 32 * lists + 1024)).select("x").collect()  # at most SAMPLE rows
    shared = spark.sparkContext.broadcast(fit(_augment(np.array([r.x for r in sample], dtype=float), norm), lists))
    del sample

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                packed = _pack(part.column(1), dim)
                d = index.distances(_augment(_matrix(packed, dim), norm), BOUNDARY, 2 * COPIES)
                near = np.argsort(d, axis=1)[:, :COPIES]
                dist = np.take_along_axis(d, near, 1)
                keep = dist <= dist[:, :1] * (1 + BOUNDARY)
                yield pa.RecordBatch.from_arrays([part.column(0), packed, pa.array([n[k].tolist() for n, k in zip(near, keep, strict=True)], pa.list_(pa.int32()))],
                                                 names=["vec_id", "x", "lists"])

    placed = base.mapInArrow(assign, "vec_id long, x binary, lists array<int>").checkpoint()
    sizes = np.zeros(len(shared.value.points), dtype=np.int64)
    for r in placed.select(F.explode("lists").alias("l")).groupBy("l").count().collect():  # one row a list
        sizes[r.l] = r["count"]
    offset, shard_of, _ = _plan(sizes)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = np.diff(offset)
        for b in batches:
            if not b.num_rows:
                continue
            counts = b.column(2).value_lengths().to_numpy()
            row, lst = np.repeat(np.arange(b.num_rows), counts), b.column(2).flatten().to_numpy().astype(np.int64)
            unit = offset[lst] + _part(b.column(0).to_numpy()[row], parts[lst])
            key = row * (int(shard_of.max()) + 1) + shard_of[unit]
            order = np.argsort(key, kind="stable")
            heads = np.flatnonzero(np.append(True, np.diff(key[order]) > 0))
            at = pa.array(row[order][heads])
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard_of[unit][order][heads]), b.column(0).take(at), b.column(1).take(at),
                 pa.array([p.astype("<i4").tobytes() for p in np.split(lst[order], heads[1:])], pa.binary())], names=["shard", "vec_id", "x", "lists"])

    asked = rows.where("query").select("vec_id", "x", "ka", "kb").checkpoint()
    distinct = asked.groupBy("ka", "kb").agg(F.first("x").alias("x"), F.min("vec_id").alias("vec_id")).checkpoint()
    blocks = max(1, -(-distinct.count() // QUERY_BLOCK))
    need = 8 * (top + 1)
    tried = distinct.orderBy(F.xxhash64("ka", "kb"), "ka", "kb").limit(FIT_QUERIES).select("vec_id", "x").collect()  # at most FIT_QUERIES rows
    if tried:
        sought = spark.sparkContext.broadcast((np.array([r.vec_id for r in tried]), np.array([r.x for r in tried], dtype=float)))

        def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            asker, q = sought.value
            best: list[list[tuple[float, int, list[int]]]] = [[] for _ in asker]
            edge = np.full(len(asker), -np.inf)
            for b in batches:
                for lo in range(0, b.num_rows, 2048):
                    part = b.slice(lo, 2048)
                    ids = part.column(0).to_numpy()
                    score = q @ _matrix(part.column(1), dim).T
                    score[asker[:, None] == ids] = -np.inf
                    k = min(top, len(ids))
                    lower = np.maximum(edge, np.partition(score, len(ids) - k, axis=1)[:, len(ids) - k])
                    i, j = np.nonzero((score >= lower[:, None]) & np.isfinite(score))
                    lists = part.column(2).take(pa.array(j)).to_pylist()
                    for a, c, own in zip(i.tolist(), j.tolist(), lists, strict=True):
                        best[a].append((float(score[a, c]), -int(ids[c]), own))
                    for a in np.unique(i):
                        best[a] = sorted(best[a], reverse=True)[:top]
                        if len(best[a]) == top:
                            edge[a] = best[a][-1][0]
            found = [(a, [{"score": s, "minus": n, "lists": own} for s, n, own in w]) for a, w in enumerate(best) if w]
            struct = pa.list_(pa.struct([("score", pa.float64()), ("minus", pa.int64()), ("lists", pa.list_(pa.int32()))]))
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int32()), pa.array([w for _, w in found], struct)], names=["at", "found"])

        true = (placed.mapInArrow(exact, "at int, found array<struct<score: double, minus: long, lists: array<int>>>")
                .groupBy("at").agg(F.slice(F.sort_array(F.flatten(F.collect_list("found")), asc=False), 1, top)["lists"].alias("lists")).collect())
        prune = fit_ratio(shared.value, _as_query(sought.value[1][[r["at"] for r in true]], norm), [r["lists"] for r in true], prune)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                packed = _pack(part.column(2), dim)
                q = _as_query(_matrix(packed, dim), norm)
                d = index.distances(q, prune, 4)
                shard, at, held = [], [], []
                for k in range(len(d)):
                    order = np.argsort(d[k])
                    dist = d[k][order]
                    n = int(np.searchsorted(dist, index.reach(dist[0], prune), side="right"))
                    if sizes[order[:n]].sum() < need:  # few vectors: go on with the next lists, walked or not
                        full = np.sqrt(np.square(index.points - q[k]).sum(1))
                        order = np.argsort(full)
                        n = max(n, int(np.searchsorted(np.cumsum(sizes[order]), need)) + 1)
                    chosen = order[:n]
                    where = np.concatenate([shard_of[offset[c]:offset[c + 1]] for c in chosen])
                    which = np.repeat(chosen, np.diff(offset)[chosen])
                    for s in np.unique(where):
                        shard.append(int(s))
                        at.append(k)
                        held.append(which[where == s].astype("<i4").tobytes())
                take = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), part.column(0).take(take), part.column(1).take(take), packed.take(take), pa.array(held, pa.binary())],
                                                 names=["shard", "ka", "kb", "q", "lists"])

    def search(key: tuple, qs: pd.DataFrame, vs: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"ka": [], "kb": [], "vec_id": [], "score": []}).astype({"ka": "int64", "kb": "int64", "vec_id": "int64"})
        if not len(qs) or not len(vs):
            return none
        q, v = (np.frombuffer(b"".join(c), dtype="<f8").reshape(-1, dim) for c in (qs["q"], vs["x"]))
        ids = vs["vec_id"].to_numpy()

        def by_list(column):
            parts = [np.frombuffer(p, dtype="<i4") for p in column]
            row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            lst = np.concatenate(parts)
            order = np.argsort(lst, kind="stable")
            heads = np.flatnonzero(np.append(True, np.diff(lst[order]) > 0))
            return {int(lst[order][h]): g for h, g in zip(heads, np.split(row[order], heads[1:]), strict=True)}

        askers, members = by_list(qs["lists"]), by_list(vs["lists"])
        rows_, cols_, scores_ = [], [], []
        for lst, who in askers.items():
            what = members.get(lst)
            if what is None:
                continue
            for lo in range(0, len(what), PART):
                some = what[lo:lo + PART]
                for ql in range(0, len(who), 512):
                    w = np.unique(who[ql:ql + 512])
                    s = q[w] @ v[some].T
                    k = min(top + 1, len(some))
                    edge = np.partition(s, len(some) - k, axis=1)[:, len(some) - k]
                    i, j = np.nonzero(s >= (edge - 1e-9 * (1 + np.abs(edge)))[:, None])
                    rows_.append(w[i])
                    cols_.append(some[j])
                    scores_.append(s[i, j])
        if not rows_:
            return none
        pair = np.unique(np.concatenate(rows_) * len(v) + np.concatenate(cols_))
        i, j = pair // len(v), pair % len(v)
        exact = np.concatenate([(q[i[k:k + 8192]] * v[j[k:k + 8192]]).sum(axis=1) for k in range(0, len(i), 8192)])
        order = np.lexsort((ids[j], -exact, i))
        i, j, exact = i[order], j[order], exact[order]
        place = np.arange(len(i)) - np.maximum.accumulate(np.where(np.append(True, np.diff(i) > 0), np.arange(len(i)), 0))
        keep = place <= top
        return pd.DataFrame({"ka": qs["ka"].to_numpy()[i[keep]], "kb": qs["kb"].to_numpy()[i[keep]], "vec_id": ids[j[keep]], "score": exact[keep]})

    vectors = (placed.mapInArrow(deal, "shard long, vec_id long, x binary, lists binary")
               .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))))
    queries = (distinct.select("ka", "kb", "x").mapInArrow(probe, "shard long, ka long, kb long, q binary, lists binary")
               .withColumn("block", F.pmod(F.xxhash64("ka", "kb"), F.lit(blocks).cast("long"))))
    found = (queries.groupBy("shard", "block").cogroup(vectors.groupBy("shard", "block"))
             .applyInPandas(search, "ka long, kb long, vec_id long, score double"))
    best = Window.partitionBy("ka", "kb").orderBy(F.desc("score"), "vec_id")
    answers = (found.groupBy("ka", "kb", "vec_id").agg(F.max("score").alias("score"))
               .withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= top + 1)
               .groupBy("ka", "kb").agg(F.sort_array(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("found")))
    own = F.filter("found", lambda f: f["vec_id"] != F.col("query_id"))
    return (asked.select(F.col("vec_id").alias("query_id"), "ka", "kb").distinct().join(answers, ["ka", "kb"])
            .select("query_id", F.posexplode(F.slice(own, 1, top)).alias("at", "f"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("f.vec_id").alias("vec_id"), F.col("f.score").alias("score")))

"""Links between documents: exact confirmation of candidate pairs, and connected components.

Shared by the operators that find near-duplicates.  Both steps expect hubs (a document
that a third of all others link to): a hub's set is copied once for ``CROWD`` partners, not once a pair,
and joins by node are between stored or freshly shuffled sides, which
adaptive execution can split where a node is hot.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.session import checkpoint_dir

BITMAP = 1 << 23      # bits of the filter that finds chosen ids; its false positives cost time only
CROWD = 256           # partners that share one copy of a hub's set
FOUND = 4096          # pairs a batch


def held(ids: DataFrame) -> np.ndarray:
    """A bitmap of ``BITMAP`` bits of the hashes of a column ``id`` (bounded, whatever the number of ids)."""
    place = F.pmod(F.xxhash64("id"), F.lit(BITMAP))
    words = (ids.select(F.shiftright(place, 6).alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int")).alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")).collect())  # BITMAP / 64 rows at most
    out = np.zeros(BITMAP // 64, dtype=np.int64)
    out[[r.w for r in words]] = [r.b for r in words]
    return out.view(np.uint64)


def sets_of(docs: DataFrame, ids: DataFrame, sets: Callable[[pa.Array], Iterator[np.ndarray]]) -> DataFrame:
    """``id, shingles`` (sorted 64-bit hashes, packed) of the documents with one of the ids and of a few others: the
    bitmap drops the rest where they are read, so texts are never shuffled.  An id of several rows has several sets."""
    bits = docs.sparkSession.sparkContext.broadcast(held(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = bits.value
        for b in batches:
            place = b.column(2).to_numpy().astype(np.uint64)
            b = b.filter(pa.array((have[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)))
            found = [(i, x.tobytes()) for i, x in zip(b.column(0).to_pylist(), sets(b.column(1))) if len(x)]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.int64()), pa.array([x for _, x in found], pa.binary())], names=["id", "shingles"])

    return (docs.where("doc_id is not null").select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(BITMAP)))
            .mapInArrow(run, "id long, shingles binary"))


def common(left: np.ndarray, right: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct values."""
    if len(left) < len(right):
        left, right = right, left
    at = np.searchsorted(left, right)
    at[at == len(left)] = 0
    return int(np.count_nonzero(left[at] == right))


def alike(left: bytes, right: bytes, percent: int) -> bool:
    """Whether two packed sets have a Jaccard similarity of at least ``percent``."""
    a, b = np.frombuffer(left, dtype=np.uint64), np.frombuffer(right, dtype=np.uint64)
    both = common(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def meet(pairs: DataFrame, found: DataFrame, test: Callable[[bytes, bytes], bool]) -> DataFrame:
    """The pairs ``a, b`` (each once) of ids that pass the test with some ``packed`` value of each end; ``found`` holds ``id, packed``.

    ``a`` should be the end with more partners.  They are dealt to parts of about ``CROWD``; each part gets one copy of its hub's
    values, and the partners' values stream past them."""
    load = pairs.groupBy("a").agg(F.ceil(F.count("*") / CROWD).alias("parts")).checkpoint()
    partners = (pairs.join(load, "a").select("a", F.pmod(F.xxhash64("b"), "parts").alias("part"), "b")
                .join(found.withColumnRenamed("id", "b"), "b").select("a", "part", "b", "packed"))
    hubs = (load.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
            .join(found.withColumnRenamed("id", "a"), "a").select("a", "part", F.lit(None).cast("long").alias("b"), "packed"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, hub, a, b = None, [], [], []
        for batch in batches:
            for x, p, y, packed in zip(*(c.to_pylist() for c in batch.columns)):
                if part != (x, p):
                    part, hub = (x, p), []
                if y is None:
                    hub.append(packed)
                elif any(test(h, packed) for h in hub):
                    a.append(x)
                    b.append(y)
            if len(a) >= FOUND:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return (hubs.unionByName(partners).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
            .mapInArrow(run, "a long, b long").distinct())


def confirm(pairs: DataFrame, docs: DataFrame, percent: int, sets: Callable[[pa.Array], Iterator[np.ndarray]]) -> DataFrame:
    """The pairs ``a, b`` (each once) of ids whose full sets have a Jaccard similarity of at least ``percent``; an id of
    several rows stands for all their sets."""
    found = sets_of(docs, pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), sets)
    return meet(pairs, found.withColumnRenamed("shingles", "packed"), partial(alike, percent=percent))


def stored(df: DataFrame, folder: str) -> DataFrame:
    """``df`` written to a new table in ``folder`` and read again.  Steps that repeat need this: a checkpoint
    keeps the optimiser's size estimate, and a join's is the product of its sides', so its digits would double with every step."""
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, folder: str) -> None:
    """Deletes a folder of tables that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def _stars(edges: DataFrame) -> bool:
    """Whether every node has either one edge to a smaller node or none, and none if larger ones lead to it."""
    ends = edges.select("a", F.lit(1).alias("out")).union(edges.select("b", F.lit(0)))
    return ends.groupBy("a").agg(F.sum("out").alias("out"), F.min("out").alias("root")).where("out > 1 or out = 1 and root = 0").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node, comp`` (smallest node reachable) of every node of some link ``a, b``.

    Alternating large-star and small-star steps until every component is a star, each written to the shared folder; the
    smallest neighbours of all nodes are before they are joined to the edges (an aggregate that feeds a join directly
    would keep a hot node in one task).  The result is checkpointed, the steps' tables are deleted."""
    spark = links.sparkSession
    folder = f"{checkpoint_dir(spark)}/components-{uuid.uuid4().hex}"
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), folder)
    while not _stars(edges):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), folder)
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        # small star: edges run from the larger to the smaller end, of which a node has few by now
        down = stored(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), folder)
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (down.join(low, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
                 .select("e.*").where("a <> b").distinct())
        edges = stored(small, folder)
    own = edges.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    out = own.union(edges.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()).checkpoint()
    remove(spark, folder)
    return out


def shared_ids(sig: DataFrame, reps: DataFrame) -> DataFrame:
    """Links ``a, b`` from the representative of each set of an id that has several different ones (rows that
    share an id are one node).  ``sig`` holds ``doc_id, n, ka, kb`` of every row, ``reps`` the ``rep`` of each set ``ka, kb``."""
    several = (sig.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("ka", "kb")).alias("lo"), F.max(F.struct("ka", "kb")).alias("hi"))
               .where("lo <> hi").select("doc_id"))
    return (sig.where("n > 0").join(several, "doc_id", "left_semi").join(reps.select("ka", "kb", "rep"), ["ka", "kb"])
            .select(F.col("rep").alias("a"), F.col("doc_id").alias("b")))


def placed(sig: DataFrame, reps: DataFrame, comps: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``sig``."""
    classes = (reps.select("ka", "kb", "rep").join(comps, F.col("rep") == F.col("node"), "left")
               .select("ka", "kb", F.coalesce("comp", "rep").alias("__class")))
    # a row without words shares the component of its id's other rows, if it has any
    empty = sig.where("n = 0").select("doc_id", "n").join(comps, F.col("doc_id") == F.col("node"), "left").select("doc_id", "n", F.coalesce("comp", "doc_id").alias("component_id"))
    full = (sig.where("n > 0").select("doc_id", "n", "ka", "kb").join(classes, ["ka", "kb"], "left")
            .select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("__class")).alias("component_id")))
    return full.unionByName(empty).select("doc_id", F.col("n").alias("n_shingles"), "component_id")

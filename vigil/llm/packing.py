"""Harmonic packing of documents into fixed-length training sequences.

Every document becomes its token ids plus an end id.  Lengths fall into the
reciprocal-capacity classes of the harmonic algorithm: class ``k`` holds
lengths in ``(C/(k+1), C/k]`` and each of its bins takes exactly ``k`` pieces.
A length that would leave more than ``slack`` tokens of its ``C/k`` share unused
is cut: its head gets the next class's exact share ``C // (k+1)``, its rest
is classed again, so bins are nearly full whatever the length distribution.

Workers pack independently: the classes' open bins are the only state (at
most one bin per class, so bounded), there is no shuffle, and a lost task is
recomputed to the same rows because it only depends on its scan split.  When
a split ends, the pieces of its open bins are laid out end to end and cut at the
capacity, so a worker leaves one padded sequence, not one per class.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.tokens import encoder

SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
EMIT_PIECES = 1024      # rows of an output batch (8 KB each at most)
SEQUENCES_BITS = 36     # sequence_id = worker's partition << 36 | its counter


def cut(length: int, capacity: int, slack: float) -> list[tuple[int, int]]:
    """(piece length, class) of each piece of a document, in order."""
    out = [(capacity, 1)] * (length // capacity)
    rest = length % capacity
    while rest:
        k = capacity // rest
        if capacity / k - rest <= slack:
            out.append((rest, k))
            break
        head = capacity // (k + 1)
        out.append((head, capacity // head))
        rest -= head
    return out


class HarmonicPacker:
    """One worker's bins; ``add`` and ``finish`` return the rows of closed bins."""

    def __init__(self, worker: int, capacity: int, slack: float):
        self.base, self.count = worker << SEQUENCES_BITS, 0
        self.capacity, self.slack = capacity, slack
        self.open: dict[int, list[tuple]] = {}

    def _close(self, parts: list[tuple]) -> list[tuple]:
        rows, offset, seq = [], 0, self.base + self.count
        for doc_id, start, ids, total in parts:
            rows.append((doc_id, start, len(ids), total, seq, offset, ids.tobytes()))
            offset += len(ids)
        self.count += 1
        return rows

    def add(self, doc_id: int | None, ids: np.ndarray) -> list[tuple]:
        rows, start = [], 0
        for length, k in cut(len(ids), self.capacity, self.slack):
            part = (doc_id, start, ids[start:start + length], len(ids))
            start += length
            if k == 1:
                rows += self._close([part])
                continue
            filled = self.open.setdefault(k, [])
            filled.append((part[0], part[1], part[2].copy(), part[3]))  # a copy: open bins don't keep whole documents
            if len(filled) == k:
                rows += self._close(self.open.pop(k))
        return rows

    def finish(self) -> list[tuple]:
        rows, parts, room = [], [], self.capacity
        for k in sorted(self.open):
            for doc_id, start, ids, total in self.open[k]:
                while len(ids):
                    head, ids = ids[:room], ids[room:]
                    parts.append((doc_id, start, head, total))
                    start, room = start + len(head), room - len(head)
                    if not room:
                        rows += self._close(parts)
                        parts, room = [], self.capacity
        if parts:
            rows += self._close(parts)
        self.open = {}
        return rows


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset"]
    cols = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols[:6]] + [pa.array(cols[6], pa.binary())],
                                      names=[*names, "ids"])


def pack(df: DataFrame, tokenizer: str = "byte_bpe_50k.json", capacity: int = 2048, end_id: int = 1,
         slack: float = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Packed pieces: ``doc_id, start, length, doc_tokens, sequence_id, offset, ids``.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit
    integers; pieces of a sequence lie gapless from offset 0 and never exceed
    ``capacity``.  Null or empty texts are the end id alone; repeated rows
    and null ids are packed like any other row; an empty table gives no rows.
    Other columns of ``df`` are neither read nor returned.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        packer = HarmonicPacker(TaskContext.get().partitionId(), capacity, slack)
        end, rows = np.array([end_id], dtype=np.uint32), []
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                text = text.as_py()
                ids = np.concatenate([encode(text), end]) if text else end
                rows += packer.add(doc_id, ids.astype("<u4", copy=False))
                while len(rows) >= EMIT_PIECES:
                    yield _batch(rows[:EMIT_PIECES])
                    rows = rows[EMIT_PIECES:]
        rows += packer.finish()
        for i in range(0, len(rows), EMIT_PIECES):
            yield _batch(rows[i:i + EMIT_PIECES])

    picked = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, SCHEMA)

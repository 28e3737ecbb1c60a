"""Conversation structure repair: weighted CYK interval parsing.

A conversation's role initials should read ``(s?(ua)+)?``.  The repair keeps (0), re-roles to
user or assistant (3) or deletes (4) each row and inserts empty turns (3); a truncated row that
stays costs 3 more; blank and duplicate rows must go.  Of the cheapest repairs the one whose
edit initials (D, I, K, R) come first is taken.

The grammar is in Chomsky normal form over the strings a span can be repaired to; its
nonterminals and binary rules:

    E  nothing         P (ua)+    Q (au)+    U u(au)*    A a(ua)*
    S  s               T s(ua)+   V s u(au)*
    P -> UA | PP   U -> PU | UQ   A -> QA | AP   Q -> AU | QQ
    T -> SP | VA | TP             V -> SU | TU | VQ          X -> EX | XE

Leaves are single rows; insertion closure lets empty spans derive U, A (one insertion), P and Q (two), and is
applied on both sides of every leaf.  A cell holds the least (cost, edits) of a span and nonterminal.
Any repair of a span can be cut at any row border into repairs of the two
parts, so one cut per span is enough: cells are combined bottom-up over spans of 1, 2, 4, 8
... rows.  Least edits are safe to combine: edits of one span and equal cost hold the same number of insertions, so
none is a prefix of another.

So a conversation needs no task of its own either.  Rows are range-partitioned by (conversation, turn), every
partition parses its part of a conversation, and only these parts' summaries meet.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.session import checkpoint_dir

NAMES = "EPQUASTV"
RULES = {"UA": "P", "PP": "P", "PU": "U", "UQ": "U", "QA": "A", "AP": "A", "AU": "Q", "QQ": "Q",
         "SP": "T", "VA": "T", "TP": "T", "SU": "V", "TU": "V", "VQ": "V"} | {f"E{x}": x for x in NAMES} | {f"{x}E": x for x in NAMES}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
CACHED_SPAN = 32        # spans of so many rows at most are remembered (there are few different ones)
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"

Cells = tuple  # (nonterminal, cost, edits) of each derivable nonterminal
INSERTED: Cells = (("E", 0, ""), ("U", INSERT, "I"), ("A", INSERT, "I"), ("P", 2 * INSERT, "II"), ("Q", 2 * INSERT, "II"))


def combine(left: Cells, right: Cells) -> Cells:
    """Cells of a span from those of its two parts."""
    best: dict[str, tuple[int, str]] = {}
    for x, cost_x, edits_x in left:
        for y, cost_y, edits_y in right:
            z = RULES.get(x + y)
            if z is not None:
                cost, have = cost_x + cost_y, best.get(z)
                if have is None or cost < have[0] or cost == have[0] and edits_x + edits_y < have[1]:
                    best[z] = (cost, edits_x + edits_y)
    return tuple((z, *best[z]) for z in sorted(best))


@lru_cache(maxsize=None)   # one entry a row letter
def leaf(row: str) -> Cells:
    """Cells of one row: ``x`` must go; ``s u a o`` by role initial (``o`` any other), capitals are truncated."""
    best = {"E": (DELETE, "D")}
    if row != "x":
        more = TRUNCATED if row.isupper() else 0
        best |= {"U": (REROLE + more, "R"), "A": (REROLE + more, "R")}
        if row.lower() in "sua":
            best[row.upper()] = (KEEP + more, "K")
    return combine(combine(INSERTED, tuple((z, *c) for z, c in best.items())), INSERTED)


def _split(rows: str) -> Cells:
    if len(rows) == 1:
        return leaf(rows)
    half = 1 << (len(rows) - 1).bit_length() - 1   # the left part is a whole power of two
    return combine(parse(rows[:half]), parse(rows[half:]))


_remembered = lru_cache(maxsize=1 << 16)(_split)


def parse(rows: str) -> Cells:
    """Cells of a span of rows, given as letters (see ``leaf``)."""
    if not rows:
        return INSERTED
    return _remembered(rows) if len(rows) <= CACHED_SPAN else _split(rows)


def cheapest(cells: Cells) -> tuple[int, str]:
    """(cost, edits) of the best repair of a whole conversation."""
    return min((cost, edits) for z, cost, edits in cells if z in "EPT")


# ---- damage -----------------------------------------------------------------
def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, alive`` after the damage that a checksum of ``conv_id:turn`` picks
    (null cells read as one space there and in role and text). A dropped row stays with ``alive`` false."""
    pick = F.crc32(F.concat(_text("conv_id"), F.lit(":"), _text("turn"))) % 20
    role, text = F.when(F.col("__pick") == 4, "user").otherwise(_text("role")), _text("text")
    text = (F.when(F.col("__pick") == 1, "").when(F.col("__pick") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text))
    copies = F.explode(F.when(F.col("__pick") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return (rows.withColumn("__pick", pick)
            .select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("__pick") != 0).alias("alive"), copies.alias("__copy")).drop("__copy"))


def _first_turn() -> Column:
    return F.col("turn").asc_nulls_first()


def letters(rows: DataFrame) -> DataFrame:
    """``conv_id, alive, turn, role, fp, initial, blank, truncated, copies, again``: rows without their texts.
    Rows alike in turn, role and text (``fp`` is the text's SHA-256) are one with a number of ``copies``;
    ``again`` tells that an earlier turn holds the same role and text."""
    tail = F.rtrim("text", F.lit(WHITE))
    narrow = rows.select(
        "conv_id", "alive", "turn", "role", F.sha2("text", 256).alias("fp"), F.substring("role", 1, 1).alias("initial"),
        (tail == "").alias("blank"), (~F.substring(tail, -1, 1).isin(".", "!", "?")).alias("truncated"))
    keys = narrow.columns
    counted = narrow.groupBy(*keys).agg(F.count("*").alias("copies"))
    earlier = F.row_number().over(Window.partitionBy("conv_id", "alive", "role", "fp").orderBy(_first_turn()))
    return counted.withColumn("again", earlier > 1)


# ---- parts of conversations ---------------------------------------------------
@dataclass
class Part:
    """A run of a conversation's rows in order (or nothing, for a conversation whose rows are all dropped)."""
    low: int | None = None
    high: int | None = None
    turns: int = 0
    rows: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first: str = ""
    last: str = ""
    cells: Cells = INSERTED

    def join(self, later: Part) -> Part:
        if not later.rows or not self.rows:
            return self if self.rows else later
        low, high = [x for x in (self.low, later.low) if x is not None], [x for x in (self.high, later.high) if x is not None]
        return Part(min(low, default=None), max(high, default=None), self.turns + later.turns - (self.high is not None and self.high == later.low),
                    self.rows + later.rows, self.blank + later.blank, self.duplicate + later.duplicate, self.truncated + later.truncated,
                    self.illegal + later.illegal + (self.last + later.first not in LEGAL), self.first, later.last, combine(self.cells, later.cells))

    def figures(self) -> list:
        cost, audit = cheapest(self.cells)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return [gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit]


LEGAL = ("su", "ua", "au")
_PART = "low long, high long, turns long, rows long, blank long, duplicate long, truncated long, illegal long, first string, last string"
_CELLS = "names string, costs array<long>, edits array<string>"
_FIGURES = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class _Reader:
    """Builds one Part from rows that arrive in order."""

    def __init__(self):
        self.part, self.text = Part(), []

    def add(self, turn, initial, blank, truncated, copies, again) -> None:
        p = self.part
        if turn is not None:
            p.low = turn if p.low is None else p.low
            p.turns += p.high != turn
            p.high = turn
        if p.rows:
            p.illegal += p.last + initial not in LEGAL
        else:
            p.first = initial
        p.illegal += (copies - 1) * (initial + initial not in LEGAL)
        p.last = initial
        p.rows += copies
        letter = initial if initial and initial in "sua" else "o"
        if blank:
            p.blank += copies
        else:
            p.duplicate += copies - (not again)
            p.truncated += truncated and not again
        self.text.append("x" * copies if blank or again else (letter.upper() if truncated else letter) + "x" * (copies - 1))

    def done(self) -> Part:
        if self.part.rows:
            self.part.cells = parse("".join(self.text))
        return self.part


def _parts(rows: DataFrame) -> DataFrame:
    """Parts of conversations, one a partition and conversation; those that can't go on in a neighbouring
    partition are whole and carry their figures, the others their cells."""
    schema = f"conv_id long, whole boolean, place int, {_PART}, {_CELLS}, gaps long, cost long, audit string"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, out = TaskContext.get().partitionId(), []
        reader, conv, open_left = None, None, True

        def close(whole: bool) -> None:
            p = reader.done()
            figures = p.figures() if whole else [None] * 7
            out.append([conv, whole, place, p.low, p.high, p.turns, p.rows, p.blank, p.duplicate, p.truncated, p.illegal, p.first, p.last,
                        None if whole else "".join(c[0] for c in p.cells), None if whole else [c[1] for c in p.cells], None if whole else [c[2] for c in p.cells],
                        figures[0], figures[5], figures[6]])

        def batch() -> pa.RecordBatch:
            types = {"long": pa.int64(), "boolean": pa.bool_(), "int": pa.int32(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
            columns = zip(*out) if out else [[] for _ in names]
            made = pa.RecordBatch.from_arrays([pa.array(list(v), types[c.split()[1]]) for v, c in zip(columns, schema.split(", "))], names=names)
            out.clear()
            return made

        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                if reader is None or r[0] != conv:
                    if reader is not None:
                        close(not open_left)
                        open_left = False
                    reader, conv = _Reader(), r[0]
                if r[1]:
                    reader.add(*r[2:])
            if len(out) >= 4096:
                yield batch()
        if reader is not None:
            close(False)
        yield batch()

    order = ["conv_id", "turn", "role", "fp"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return placed.select("conv_id", "alive", "turn", "initial", "blank", "truncated", "copies", "again").mapInArrow(run, schema)


def figures(rows: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` of every conversation of damaged rows."""
    parts = _parts(letters(rows)).checkpoint()

    def join(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for b in batches:
            found += b.to_pylist()
        whole = Part()
        for r in sorted(found, key=lambda r: r["place"]):
            whole = whole.join(Part(*(r[c.split()[0]] for c in _PART.split(", ")), tuple(zip(r["names"], r["costs"], r["edits"]))))
        yield pa.RecordBatch.from_pydict({"conv_id": pa.array([key[0].as_py()], pa.int64())} | {
            c.split()[0]: pa.array([v], pa.string() if c.endswith("string") else pa.int64()) for c, v in zip(_FIGURES.split(", "), whole.figures())})

    columns = ["conv_id", *(c.split()[0] for c in _FIGURES.split(", "))]
    cut = parts.where("not whole").groupBy("conv_id").applyInArrow(join, f"conv_id long, {_FIGURES}")   # two parts a partition at most
    return parts.where("whole").select(columns).unionByName(cut.select(columns))


# ---- repaired text --------------------------------------------------------------
def repaired_lines(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired conversation from its edits and its rows in order. The roles of
    re-roled and inserted turns follow from their place: user and assistant alternate."""
    role = "user"
    for edit in audit:
        if edit == "I":
            yield role, ""
        else:
            own, text = next(rows)
            if edit == "D":
                continue
            if edit == "K":
                yield own, text
                if own[:1] == "s":
                    continue
            else:
                yield role, text
        role = "assistant" if role == "user" else "user"


def _digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` with ``repaired_sha256``; rows stream past their conversation's edits, none is held."""
    names = ["conv_id", *(c.split()[0] for c in _FIGURES.split(", "))]
    schema = f"conv_id long, {_FIGURES}, repaired_sha256 string"
    nothing = [F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in _FIGURES.split(", ")]
    lines = rows.where("alive").select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", F.sha2("text", 256).alias("fp"), *nothing)
    heads = found.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
                         F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("fp"), *names[1:])
    order = ["conv_id", "kind", "turn", "role", "fp"]
    together = heads.unionByName(lines).repartition("conv_id").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records():
            for b in batches:
                yield from zip(*(c.to_pylist() for c in b.columns))

        def conversations():
            rest = records()
            head = next(rest, None)
            while head is not None:
                digest, after, begun = hashlib.sha256(), None, False

                def own(rest=rest):
                    nonlocal after
                    for r in rest:
                        if r[0] == 0:
                            after = r
                            return
                        yield r[1], r[2]
                lines = own()
                for role, text in repaired_lines(head[-1] or "", lines):
                    digest.update((b"\n" if begun else b"") + role.encode() + b":" + text.encode())
                    begun = True
                for _ in lines:   # none is left: every row has its edit
                    pass
                yield [*head[3:], digest.hexdigest()]
                head = after

        types = [pa.string() if c.endswith("string") else pa.int64() for c in schema.split(", ")]
        columns, held = [c.split()[0] for c in schema.split(", ")], []
        for row in conversations():
            held.append(row)
            if len(held) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(list(v), t) for v, t in zip(zip(*held), types)], names=columns)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(v), t) for v, t in zip(zip(*held), types)], names=columns)

    return together.select("kind", "role", "text", *names).mapInArrow(run, schema)


def repair(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", damaged: bool = True) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of every conversation.

    ``damaged`` first applies ``damage``.  Rows go by turn, nulls first; rows of one turn by role, then by
    their text's SHA-256; equal rows are adjacent.  Null roles and texts read as one space; rows
    with a null conversation id are one conversation, with a null id; a conversation that has lost all rows has zeros, no
    edits and the digest of an empty string; an empty table gives no rows.  Other columns are neither read nor returned.
    A digest reads its conversation's repaired text in order, so that one step (only) streams a conversation through one task.
    Building the result runs jobs: the parts of conversations are checkpointed."""
    checkpoint_dir(df.sparkSession)
    rows = df.select(F.col(f"`{conv_id}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"),
                     F.col(f"`{role}`").alias("role"), F.col(f"`{text}`").alias("text"))
    rows = damage(rows) if damaged else rows.select("conv_id", "turn", _text("role").alias("role"), _text("text").alias("text"), F.lit(True).alias("alive"))
    return _digests(rows, figures(rows))

"""Conversation repair against a shortest-path search over single edits, and its parts against the whole."""
import hashlib
import heapq
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vigil.llm import conversation_repair as CR

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"


def plain_cheapest(rows):
    """(cost, edits) by Dijkstra over (row, last role), one edit at a time."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, edits, i, last = heapq.heappop(heap)
        if (i, last) in seen:
            continue
        seen.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, edits
        def step(more, edit, j, role):
            if (role == "s" and last == "") or (role == "u" and last != "u") or (role == "a" and last == "u"):
                heapq.heappush(heap, (cost + more, edits + edit, j, role))
        step(3, "I", i, "u")
        step(3, "I", i, "a")
        if i < len(rows):
            heapq.heappush(heap, (cost + 4, edits + "D", i + 1, last))
            if rows[i] != "x":
                stay = 3 if rows[i].isupper() else 0
                step(stay, "K", i + 1, rows[i].lower())
                step(3 + stay, "R", i + 1, "u")
                step(3 + stay, "R", i + 1, "a")


@given(st.text("suaoSUAOx", max_size=14))
@settings(max_examples=400, deadline=None)
def test_parse_equals_shortest_path(rows):
    assert CR.cheapest(CR.parse(rows)) == plain_cheapest(rows)


@given(st.text("suaoSUAOx", min_size=1, max_size=10), st.data())
@settings(max_examples=100, deadline=None)
def test_any_cut_gives_the_same_cells(rows, data):
    at = data.draw(st.integers(0, len(rows)))
    assert CR.combine(CR.parse(rows[:at]), CR.parse(rows[at:])) == CR.parse(rows)


def test_long_conversation_parses():
    rows = "sua" + "uaxUA" * 2000
    cost, audit = CR.cheapest(CR.parse(rows))
    assert cost == 2000 * (4 + 6) and audit == "K" + "KK" + "KKDKK" * 2000


def plain_repair(rows):
    """{conv_id: figures} from (conv_id, turn, role, text) rows."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        lines = convs[conv]
        pick = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if pick == 1 else re.sub("[.!?]", "", text) if pick == 2 else text
        role = "user" if pick == 4 else role
        lines += [(turn, role, text)] * (0 if pick == 0 else 2 if pick == 3 else 1)
    out = {}
    for conv, lines in convs.items():
        lines.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
        faults, letters, seen = {"blank": 0, "duplicate": 0, "truncated": 0}, "", set()
        for _, role, text in lines:
            body = text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
            letters += "x" if fault in ("blank", "duplicate") else initial.upper() if fault else initial
            if fault:
                faults[fault] += 1
        turns = [t for t, _, _ in lines if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(lines, lines[1:]))
        cost, audit = plain_cheapest(letters)
        final, rest, last = [], iter(lines), ""
        for e in audit:
            row = next(rest) if e != "I" else None
            if e == "D":
                continue
            role = row[1] if e == "K" else "assistant" if last == "u" else "user"
            final.append(f"{role}:{row[2] if row else ''}")
            last = role[:1]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *faults.values(), illegal, cost, audit, hashlib.sha256("\n".join(final).encode()).hexdigest())
    return out


def awkward_rows(seed, n=300, ids=12):
    rng = np.random.default_rng(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "Assistant"]
    texts = ["Yes.", "no", "", " \t\n", None, "wörd!\x0b", "why? ", "Yes.", "東京。", " ", "a\nb."]
    rows = []
    for i in range(n):
        conv = [None, 0, *range(1, ids)][int(rng.integers(ids + 1))] if rng.random() < 0.6 else 0   # a hot conversation
        turn = None if rng.random() < 0.1 else int(rng.integers(-2, 60))
        rows.append((conv, turn, roles[rng.choice(7, p=[.35, .35, .1, .05, .05, .05, .05])], texts[int(rng.integers(len(texts)))] if rng.random() < 0.5 else f"line {i}."))
    return rows + rows[:30] + [(77, t, "user", "x") for t in range(40) if zlib.crc32(f"77:{t}".encode()) % 20 == 0]   # all of conversation 77 is dropped


def collect(df):
    found = df.collect()
    assert len(found) == len({r.conv_id for r in found})
    return {r.conv_id: tuple(r)[1:] for r in found}


@pytest.mark.parametrize("partitions", [1, 4, 23])
def test_equals_plain(spark, partitions):
    rows = awkward_rows(partitions)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")   # conversations are cut by partition borders
    try:
        assert collect(CR.repair(df)) == plain_repair(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_query_equals_plain(spark):
    from vigil.llm import queries
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert collect(queries.op13_conversation_repair(spark, SF)) == plain_repair(rows)


def test_undamaged_rows_clashing_columns_and_empty_table(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Hello!"), (2, 0, "assistant", "cut off"), (None, None, None, None)]
    df = spark.createDataFrame([(*r, 5, "x", True) for r in rows], SCHEMA + ", cost long, audit string, alive boolean")
    got = collect(CR.repair(df, damaged=False))
    assert got[1][:7] == (0, 0, 0, 0, 0, 0, "KK") and got[1][7] == hashlib.sha256(b"user:Hi.\nassistant:Hello!").hexdigest()
    assert got[2][:7] == (0, 0, 0, 1, 0, 4, "D") and got[None][:7] == (0, 1, 0, 0, 0, 4, "D")
    assert CR.repair(df.limit(0)).collect() == []

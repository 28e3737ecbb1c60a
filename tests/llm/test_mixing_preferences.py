"""Mixing against a brute-force water level; preference formatting against plain Python."""
import re

import pytest
from pyspark.sql import functions as F

from vigil.llm import mixing, preferences, queries

SF = "/root/testdata/sf0.01"


def water(sizes, weights=(3, 1, 2)):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w, left, free, out = {s: weights[i % 3] for i, s in enumerate(names)}, 1.5 * sum(sizes.values()), set(names), {}
    while free:
        per = left / sum(w[s] for s in free)
        over = [s for s in free if per * w[s] > 2 * sizes[s]]
        for s in over or list(free):
            out[s] = 2.0 * sizes[s] if over else per * w[s]
            free.discard(s)
            left -= out[s]
    return out


def test_targets_and_taken(spark):
    docs = {r.doc_id: (r.source, len(re.findall(r"[^\x20\x09-\x0D]+", r.text))) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    sizes, taken = {}, {}
    for s, n in docs.values():
        sizes[s] = sizes.get(s, 0) + n
    want, rows = water(sizes), queries.op4_mixing(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        s, n = docs[r.doc_id]
        assert (r.size, r.source_size) == (n, sizes[s]) and r.target == pytest.approx(want[s], rel=1e-9) and 0 <= r.taken <= 2 * n
        taken[s] = taken.get(s, 0) + r.taken
    assert all(taken[s] == pytest.approx(want[s], rel=0.005) for s in want)
    again = queries.op4_mixing(spark, SF).repartition(3)
    assert sorted((r.doc_id, r.taken) for r in again.collect()) == sorted((r.doc_id, r.taken) for r in rows)


def test_mix_edge_rows(spark):
    rows = [(1, "a b c", "x"), (1, "a b c", "x"), (2, None, "x"), (3, "", None), (None, "w " * 50000, None), (None, "d e", "y"), (2**60 + 1, "f", "y"),
            (2**60 + 1, "g h", None)] + [(100 + i, "one two three", "hot") for i in range(400)]
    docs = spark.createDataFrame([(i, t, s, 5) for i, t, s in rows], "doc_id long, text string, source string, size int")
    out = mixing.per_document(mixing.mix(docs)).collect()
    assert len(out) == len(rows) and {r.doc_id for r in out} == {i for i, _, _ in rows}
    sizes = {s: sum(len((t or "").split()) for _, t, x in rows if x == s) for _, _, s in rows}
    want = water(sizes)
    assert all(r.target == pytest.approx(want[r.source]) for r in out)
    hot = sum(r.taken for r in out if r.source == "hot")
    assert abs(hot - want["hot"]) <= 3
    mixed = mixing.mix(docs)
    kept = mixing.apply_mix(docs, mixed)
    assert kept.columns == docs.columns
    assert kept.count() == mixed.agg(F.sum(F.col("copies") * F.col("repeats") + F.col("more"))).first()[0]
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mix(docs.where("size(split(text, ' ')) < 0 or text is null")).count() == 1


def test_repeated_rows_share_their_copies(spark):
    rows = [(1, "w " * 10, "a")] * 30 + [(7, "one two three four five", "b")] * 100 + [(k, "x y", "c") for k in range(50)] + [(7, "five four three two one", "b")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, n_chars long")
    mixed = mixing.mix(docs)
    sizes = {s: sum(len(t.split()) for _, t, x in rows if x == s) for s in "abc"}
    out, want = mixing.per_document(mixed).collect(), water(sizes)
    assert len(out) == len(rows)
    for s in sizes:
        assert abs(sum(r.taken for r in out if r.source == s) - want[s]) <= 10
        assert len({r.taken for r in out if r.source == s}) <= 2
    made = [(r.source, len(r.text.split())) for r in mixing.apply_mix(docs, mixed).collect()]
    assert {s: sum(n for x, n in made if x == s) for s in sizes} == {s: sum(r.taken for r in out if r.source == s) for s in sizes}


def test_blocks_of_one_source(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 16)
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.expr("repeat('w ', cast(id % 40 + 1 as int))").alias("text"))
    docs = docs.union(docs.limit(50).select(F.col("doc_id") + 10_000, F.lit("t"), "text"))
    out = mixing.per_document(mixing.mix(docs)).groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("w")).collect()
    assert all(abs(r.t - r.w) < 0.01 * r.w for r in out)


def plain_pairs(convs):
    def cut(turns):
        k = max((i for i, t in enumerate(turns) if t[0] == "assistant"), default=None)
        return turns if k is None else turns[:k + 1], k
    out = {}
    show = lambda ts: "".join(f"<|im_start|>{r or ''}\n{t or ''}<|im_end|>\n" for r, t in ts)

    def spans(ts):
        at, got = 0, []
        for r, t in ts:
            a = at + len(f"<|im_start|>{r or ''}\n")
            b = a + len(f"{t or ''}<|im_end|>")
            got += [f"{a}:{b}"] * (r == "assistant")
            at = b + 1
        return ",".join(got)
    for c, turns in convs.items():
        chosen, k = cut(turns)
        rejected = turns
        if k is not None:
            other = cut([] if c is None else convs.get(c ^ 1, []))
            rejected = turns[:k] + ([other[0][other[1]]] if other[1] is not None else [])
        n = 0
        while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
            n += 1
        out[c] = (show(chosen[:n]), n, show(chosen[n:]), spans(chosen[n:]), show(rejected[n:]), spans(rejected[n:]))
    return out


def test_preferences_equal_plain(spark):
    convs = {0: [("user", "hi"), ("assistant", "yes")], 1: [("user", "hi"), ("assistant", "yes"), ("user", "so?")], 2: [("user", "only")],
             3: [("system", None), ("user", "é"), ("assistant", "ß" * 5000), ("user", "b"), ("assistant", "c")], 5: [("assistant", "alone")],
             8: [(None, "x"), ("assistant", "")], 9: [("assistant", "z"), (None, None)], -3: [("user", "n"), ("assistant", "m")], None: [("user", "q"), ("assistant", "r")]}
    rows = [(c, k, r, t, "extra") for c, ts in convs.items() for k, (r, t) in enumerate(ts)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, prompt string")
    got = {r.conv_id: (r.prompt, r.prompt_turns, r.chosen, r.chosen_loss, r.rejected, r.rejected_loss)
           for r in preferences.format_pairs(preferences.contrast_pairs(df.repartition(5))).collect()}
    assert got == plain_pairs(convs)
    assert preferences.format_pairs(preferences.contrast_pairs(df.limit(0))).count() == 0


def test_format_pairs_of_any_table(spark):
    turn = "array<struct<role: string, text: string>>"
    df = spark.createDataFrame([(1, [("user", "a"), ("assistant", "b")], None, "p"), (2, None, None, "p"), (3, [("user", "a")], [("user", "a"), ("assistant", "c")], "p")],
                               f"id int, chosen {turn}, rejected {turn}, prompt string")
    got = {r.id: r for r in preferences.format_pairs(df).collect()}
    assert got[1].prompt == "" and got[1].rejected == "" and got[2].chosen == "" and got[3].prompt_turns == 1
    r = got[3]
    a, b = map(int, r.rejected_loss.split(":"))
    assert r.rejected[a:b] == "c<|im_end|>"


def test_repeated_turns_are_kept(spark):
    df = spark.createDataFrame([(4, 0, "user", "a"), (4, 0, "user", "a"), (4, 1, "assistant", "b")], "conv_id long, turn long, role string, text string")
    r = preferences.format_pairs(preferences.contrast_pairs(df)).first()
    assert r.prompt_turns == 2 and r.rejected == ""

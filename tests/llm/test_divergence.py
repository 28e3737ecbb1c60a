"""Source divergence against a plain version; the skyband against all pairs."""
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vigil.llm import divergence

LOWER = {i: i + 32 for i in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plain_terms(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(rows, min_docs=3, top=200):
    docs, total, count, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        sources[lang].add(source)
        docs[lang].update(set(plain_terms(text)))
        total[lang].update(plain_terms(text))
        count[lang, source].update(plain_terms(text))
    out = set()
    for lang, names in sources.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        v, n = len(kept), {s: sum(count[lang, s][t] for t in kept) for s in names}
        share = {s: {t: 1 + 10**9 * (count[lang, s][t] + 1) // (n[s] + v) for t in kept} for s in names}
        whole = {t: 1 + 10**9 * (total[lang][t] + 1) // (sum(total[lang][x] for x in kept) + v) for t in kept}
        for s in names:
            pairs = [(sum((share[s][t] - share[o][t]) ** 2 // share[o][t] for t in kept), o) for o in names - {s}]
            words = [((share[s][t] - whole[t]) ** 2 // whole[t], t) for t in kept if count[lang, s][t] and share[s][t] > whole[t]]
            for part, found, limit in (("pair", pairs, None), ("term", words, top)):
                for k, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit]):
                    out.add((lang, s, part, item, value, k + 1))
    return out


WORDS = ["alpha", "Beta", "GAMMA", "été", "ÉTÉ", "東京", "a-b", "x1y", "don't", "naïve", " ", "\x7f", "a", "b", "zz"]


def random_rows(seed, n=160):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        lang = ["en", "de", "", None, "fr"][rng.choice(5, p=[.5, .2, .1, .1, .1])]
        source = ["hot", "s1", "s2", "", None, "s3"][rng.choice(6, p=[.4, .2, .1, .1, .1, .1])]
        words = [WORDS[int(k)] + ("x" * int(rng.integers(3)) if rng.random() < 0.2 else "") for k in rng.zipf(1.5, size=rng.integers(0, 30)) % len(WORDS)]
        rows.append((i, None if rng.random() < 0.1 else " ".join(words), lang, source, 0))
    return rows + rows[:20] + [(900, "", "xx", "only", 0), (901, "!!! 123", "yy", "a", 0), (902, None, "yy", "b", 0)]


@pytest.mark.parametrize("flush", [500_000, 7])
def test_equals_plain(spark, monkeypatch, flush):
    monkeypatch.setattr(divergence, "FLUSH", flush)
    rows = random_rows(1)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for top in (200, 3):
        got = [tuple(r) for r in divergence.audit(df, top=top).collect()]
        assert len(got) == len(set(got)) and set(got) == plain([(r[2], r[3], r[1]) for r in rows], top=top)


def test_many_groups_are_joined_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SMALL_GROUPS", 0)
    monkeypatch.setattr(divergence, "PAIRS", 5)
    rows = random_rows(2)
    got = {tuple(r) for r in divergence.audit(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == plain([(r[2], r[3], r[1]) for r in rows])


def test_clashing_columns_and_empty_table(spark):
    rows = random_rows(3, 40)
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA + ", term string, g long, value long")
    assert {tuple(r) for r in divergence.audit(df).collect()} == plain([(r[2], r[3], r[1]) for r in rows])
    assert divergence.audit(df.limit(0)).collect() == []


def test_counts_past_the_range_of_doubles(spark):
    share = spark.range(1).select(divergence._share(divergence.F.lit(8 * 10**12), divergence.F.lit(9 * 10**12), divergence.F.lit(10**6))).first()[0]
    assert share == 1 + 10**9 * (8 * 10**12 + 1) // (9 * 10**12 + 10**6)


@given(st.lists(st.tuples(st.integers(1, 6), st.integers(0, 5), st.text("abé", min_size=1, max_size=4)), max_size=60, unique_by=lambda x: x[2]), st.integers(1, 5), st.integers(1, 9))
@settings(max_examples=60, deadline=None)
def test_skyband(items, k, block):
    items = [(c, c + more, t) for c, more, t in items]
    at = divergence.skyband(np.array([x[0] for x in items], dtype=np.int64), np.array([x[1] for x in items], dtype=np.int64), pa.array([x[2] for x in items], pa.string()), k, block)
    beaten = [sum(d[0] >= c[0] and d[1] <= c[1] and d[2].encode() < c[2].encode() for d in items) for c in items]
    assert sorted(at.tolist()) == [i for i, n in enumerate(beaten) if n < k]


@given(st.text("aZ é-.\x00", max_size=60), st.integers(1, 9))
@settings(max_examples=80, deadline=None)
def test_terms_of_a_text_in_pieces(text, piece):
    old, divergence.PIECE = divergence.PIECE, piece
    try:
        got = [t.decode() for part in divergence.terms(text.encode()) for t in part]
    finally:
        divergence.PIECE = old
    assert got == plain_terms(text)

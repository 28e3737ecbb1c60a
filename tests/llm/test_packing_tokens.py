"""Packing and token counts against the tokenizer library itself."""
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st

from vigil.llm import packing, token_counts
from vigil.llm.tokens import encoder, library

ODD = st.text(alphabet=st.one_of(st.characters(max_codepoint=0x24F, exclude_categories=["Cs"]), st.sampled_from("İıſKΣσς ́ⅷ²½'s’“–—… \n\t\r\x1c 　日本😀|<>"),
                                 st.characters(exclude_categories=["Cs"])), max_size=60)
WORD = "word_bpe_49k.json"
SPECIAL = ("<|startoftext|>", "<|endoftext|>")


@settings(max_examples=400, deadline=None)
@given(ODD)
@example("it's a  TEST's 'S don''t <|endoftext|> x<|startoftext|>")
@example("<|endof text|> é é İstanbul ﬁn Σας ́x")
def test_count_text_equals_library(text):
    lengths = token_counts.Lengths({"the": 1}, WORD, 100)
    assert token_counts.count_text(text, lengths, SPECIAL) == len(library(WORD).encode(text, add_special_tokens=False).ids)


@settings(max_examples=400, deadline=None)
@given(ODD)
@example("a   b \n\n c  <|endoftext|>   ")
def test_encoder_equals_library(text):
    assert encoder("byte_bpe_50k.json")(text).tolist() == library("byte_bpe_50k.json").encode(text, add_special_tokens=False).ids


@given(st.integers(1, 3 * 512), st.sampled_from([64, 100, 512]), st.sampled_from([0, 2, 8]))
def test_cut_covers_and_classes_hold(length, capacity, slack):
    parts = packing.cut(length, capacity, slack)
    assert sum(n for n, _ in parts) == length
    for n, k in parts:
        assert n >= 1 and n * k <= capacity and k == capacity // n


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(1, 700), max_size=60))
def test_packer_round_trip(lengths):
    packer = packing.HarmonicPacker(3, 128, 4)
    docs = {i: np.arange(1000 * i, 1000 * i + n, dtype="<u4") for i, n in enumerate(lengths)}
    rows = [r for i, ids in docs.items() for r in packer.add(i, ids)] + packer.finish()
    seqs, back = {}, {}
    for doc_id, start, length, total, seq, offset, raw in rows:
        assert total == len(docs[doc_id]) and len(raw) == 4 * length
        seqs.setdefault(seq, []).append((offset, length))
        back.setdefault(doc_id, []).append((start, np.frombuffer(raw, "<u4")))
    for i, ids in docs.items():
        assert np.concatenate([p for _, p in sorted(back[i], key=lambda x: x[0])]).tolist() == ids.tolist()
    used = []
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 128
        used.append(at)
    if len(used) > 20:
        assert sum(used) > 0.93 * 128 * len(used)


CASES = [(1, None), (2, ""), (None, "a b c"), (3, "x y " * 4000), (3, "x y " * 4000), (4, "same"), (4, "same")]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(i, t, 7, "z") for i, t in CASES], "doc_id long, text string, n_tokens int, length string")


def test_pack_rows(spark, frame):
    got = packing.pack(frame).collect()
    enc = encoder("byte_bpe_50k.json")
    assert sum(r.length for r in got) == sum(len(enc(t or "")) + 1 for _, t in CASES)
    assert all(zlib.crc32(r.ids) >= 0 and len(r.ids) == 4 * r.length for r in got)
    assert [r.doc_tokens for r in got if r.doc_id in (1, 2)] == [1, 1]
    assert packing.pack(frame.limit(0)).count() == 0


def test_count_rows(spark, frame):
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(frame).collect())
    want = sorted((i or 0, len((t or "").encode()), len(library(WORD).encode(t or "", add_special_tokens=False).ids)) for i, t in CASES)
    assert [g[:3] for g in got] == want and all(g[3] == (g[2] > 2048) for g in got)
    assert token_counts.count_tokens(frame.limit(0)).count() == 0


def test_counts_do_not_depend_on_the_table(spark, frame):
    small = token_counts.count_tokens(frame, sample_docs=1, entries=1, cache=2).collect()
    assert sorted(map(str, small)) == sorted(map(str, token_counts.count_tokens(frame).collect()))


def test_frequent_table_counts_every_document(spark):
    # 9000 documents; each word but the common one stands in two to four of them
    name = lambda i: "".join(chr(97 + int(d)) for d in f"{i % 3000:05d}")
    texts = [f"common {name(i)}" if i < 6000 else f"common {'z' * 40} {name(i % 2000)}" for i in range(9000)]
    seen = Counter(w for t in texts for w in t.split() if len(w) <= token_counts.TABLE_CHARS)
    df = spark.createDataFrame([(t,) for t in [*texts, None, ""]], "text string")
    table = token_counts.frequent_table(df, WORD)
    assert set(table) == set(seen) and len(table) == 3001
    assert all(table[w] == len(library(WORD).encode(w, add_special_tokens=False).ids) for w in table)
    assert list(token_counts.frequent_table(df, WORD, entries=2001)) == sorted(seen, key=lambda w: (-seen[w], w))[:2001]


def test_odd_words_are_whole_words(spark):
    rnd = random.Random(5)
    for _ in range(3000):
        text = "".join(rnd.choice("aZ1.' \n\t\r\x00\u00a0\u0301\u00e9\u4e2d") for _ in range(rnd.randint(0, 14)))
        plain, odd = token_counts.split(text)
        words = re.findall(r"[^ \t\n\r]+", text)
        assert odd == [w for w in words if re.search("[\x00\u00a0\u0301\u4e2d]", w)]
        assert "".join(plain) == "".join(w for w in words if not re.search("[\x00\u00a0\u0301\u4e2d]", w)).lower()


def test_sentencepiece_model(spark, frame):
    got = token_counts.count_tokens(frame, tokenizer="piece_bpe_32k.model").collect()
    assert all(r.n_tokens > 0 for r in got if r.n_bytes)

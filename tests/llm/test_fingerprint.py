"""Fingerprints: equal substrings, offsets, edits; the query against a plain version."""
import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from vigil.llm import fingerprint, queries

SF = "/root/testdata/sf0.01"


def test_query_equals_plain(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = {r.doc_id: r for r in queries.op3_fingerprints(spark, SF).collect()}
    assert len(got) == len(docs)
    alone = {}
    for k, (i, text) in enumerate(docs):
        following, r = docs[(k + 1) % len(docs)][1], got[i]
        edited = text[:len(text) - len(text) // 4] + following[:len(text) // 4]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        if k % 25 == 0:
            a, e, n = (fingerprint.fingerprints([t])[0] for t in (text, edited, following))
            assert (r.fingerprint, r.edited_fingerprint) == (a, e)
            assert (r.near_edited, r.near_next) == (fingerprint.likeness(a, e), fingerprint.likeness(a, n))
        assert alone.setdefault(text, r.fingerprint) == r.fingerprint
    assert len(set(alone.values())) == len(alone)
    near, far = np.array([r.near_edited for r in got.values()]), np.array([r.near_next for r in got.values()])
    assert np.median(near) > 0.65 and np.quantile(near, 0.01) > 0.4 and np.quantile(far, 0.95) < 0.3


def names(text, level):
    """Phrase names of one level of one text."""
    s, first = fingerprint.mix(np.array([ord(c) for c in text], dtype=np.uint64) + np.uint64(1)), np.array([0])
    for k in range(1, level + 1):
        s, first = fingerprint._collapse(s, first)
        at = np.flatnonzero(fingerprint._starts(s, first))
        s, first = fingerprint._names(s, at, k), np.array([0])
    return s


@settings(deadline=None, max_examples=60)
@given(st.text(alphabet="abcdefgh ", min_size=200, max_size=400), st.text(alphabet="xyz ", max_size=40), st.text(alphabet="xyz ", max_size=40))
def test_equal_substrings_share_their_interior(middle, before, after):
    a, b = names(middle, 1), names(before + middle + after, 1)
    inner = [int(x) for x in a[15:-15]]
    assert " ".join(map(str, inner)) in " ".join(map(str, map(int, b)))


@settings(deadline=None, max_examples=60)
@given(st.text(alphabet="ab", min_size=2, max_size=300))
def test_phrases_are_short(text):
    s, first = fingerprint._collapse(fingerprint.mix(np.array([ord(c) for c in text], dtype=np.uint64)), np.array([0]))
    gaps = np.diff(np.append(np.flatnonzero(fingerprint._starts(s, first)), len(s)))
    assert gaps.max() <= 6 and (len(s) < 3 or gaps[1:-1].min(initial=2) >= 2)


@settings(deadline=None, max_examples=40)
@given(st.lists(st.text(alphabet="abc \n", max_size=80), max_size=12), st.sampled_from([40, 64]))
def test_neither_batches_nor_windows_matter(texts, window):
    whole = fingerprint.fingerprints(texts)
    old, fingerprint.WINDOW = fingerprint.WINDOW, window
    try:
        assert [fingerprint.fingerprints([t])[0] for t in texts] == whole
    finally:
        fingerprint.WINDOW = old


def test_edge_rows(spark):
    rows = [(None, "nothing known"), (1, None), (1, ""), (2, "b" * 9), (2, "a" * 9), (2, "a" * 9), (5, "long é😀 " * 20000), (7, "last")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fingerprint string")
    order = sorted(((i is not None, i or 0, t or "") for i, t in rows))
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_chars, r.edited_sha256) for r in fingerprint.compare_edits(df.repartition(3)).collect())
    want = sorted((known, i, len(t), hashlib.sha256(fingerprint.edit(t, order[(k + 1) % len(order)][2]).encode()).hexdigest()) for k, (known, i, t) in enumerate(order))
    assert got == want
    assert fingerprint.compare_edits(df.limit(0)).count() == 0
    one = fingerprint.compare_edits(df.where("doc_id = 7")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert fingerprint.fingerprint_documents(df).columns == ["doc_id", "fingerprint"]

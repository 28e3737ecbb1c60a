"""N-gram Jaccard join against comparing everything with everything; its filters against the sets."""
import re
from random import Random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vigil.llm import links, ngram_join, queries

SF = "/root/testdata/sf0.01"
LOWER = {i: i + 32 for i in range(65, 91)}


def plain_set(text, words=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))) if w else frozenset()


def plain(rows, percent):
    """{id: component} from all pairs; rows that share an id are one node."""
    sets = [(i, plain_set(t)) for i, t in rows if i is not None]
    boss = {i: i for i, _ in sets}

    def find(x):
        while boss[x] != x:
            x = boss[x]
        return x
    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                boss[max(p, q)] = min(p, q)
    return {i: find(i) for i in boss}


def check(df, rows, percent, **more):
    got = ngram_join.join(df, percent / 100, **more).collect()
    want = plain(rows, percent)
    assert len(got) == len(rows)
    assert sorted((repr(r.doc_id), r.n_shingles) for r in got) == sorted((repr(i), len(plain_set(t))) for i, t in rows)
    for r in got:
        assert r.component_id == (None if r.doc_id is None else want[r.doc_id])


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op12_ngram_join(spark, SF).collect()
    want = plain(rows, 80)
    assert len(got) == len(rows) and {(r.doc_id, r.n_shingles, r.component_id) for r in got} == {(i, len(plain_set(t)), want[i]) for i, t in rows}


def copies(seed, sizes=(300, 90, 40, 12, 6), each=40):
    """Groups of copies that change more and more, all with one passage in common."""
    rng = np.random.default_rng(seed)
    passage, rows = [f"common{k}" for k in range(30)], []
    for words in sizes:
        base = [f"w{rng.integers(9000)}" for _ in range(words)]
        for k in range(each):
            own = list(base)
            for _ in range(rng.integers(0, 1 + max(1, words // 14))):
                own[rng.integers(len(own))] = f"v{rng.integers(9000)}"
            if rng.random() < 0.3:
                own = own[:len(own) * 9 // 10]
            if rng.random() < 0.3:
                base = own   # later copies are made from this one
            rows.append((len(rows) * 3 + 1, " ".join(own + passage * (k % 4 == 0))))
    return rows + [(5000 + k, " ".join(passage[k:] + [f"x{k}"])) for k in range(12)]


@pytest.mark.parametrize("block,percent", [(1024, 80), (4, 75)])
def test_groups_of_near_copies(spark, monkeypatch, block, percent):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(links, "CROWD", 3)
    rows = copies(block + percent)
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), rows, percent)


def test_hubs_outside_the_group(spark):
    """The tile's smallest member links to nothing, the others to each other in a chain."""
    words = [f"w{k}" for k in range(120)]
    rows = [(0, " ".join(words[:60] + [f"z{k}" for k in range(200)]))]
    rows += [(k, " ".join(words[4 * k:4 * k + 60])) for k in range(1, 16)]
    rows += [(100 + k, " ".join(words[:60] + [f"y{k}_{j}" for j in range(k % 5)])) for k in range(30)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows, 80)


def test_awkward_rows(spark):
    long = " ".join(f"L{k % 4001}w{k % 17}" for k in range(30_000))
    rows = [(1, "a b c d e f g h"), (9, "A B c d e f g h"), (9, "quite other words than those before them here"), (12, "quite OTHER words than those before them here"),
            (2, None), (3, ""), (4, " \t\n"), (5, "one"), (6, "ONE"), (7, "one two"), (None, "a b c d e f g h"), (None, None), (2, None), (8, "x y z w v"), (8, ""), (30, "x y z w v"),
            (40, long), (41, long + " end"), (40, long), (42, "東京 タワー été\xa0x \x0b b c"), (43, "東京 タワー été\xa0x b C"), (-5, "one two")]
    df = spark.createDataFrame([(*r, 7, "x", 1) for r in rows], "doc_id long, text string, n long, key string, comp long")
    got = ngram_join.join(df).collect()
    want = plain(rows, 80)
    assert len(got) == len(rows) and all(r.component_id == (None if r.doc_id is None else want[r.doc_id]) for r in got)
    assert want[12] == 1 and want[7] == -5 and {r.n_shingles for r in got if r.doc_id == 3} == {0}
    assert ngram_join.join(df.limit(0)).collect() == []


@given(st.integers(0, 2**32), st.integers(1, 60), st.integers(0, 20), st.integers(0, 20), st.integers(50, 95))
@settings(max_examples=300, deadline=None)
def test_filters_lose_no_pair(seed, size, more, drop, percent):
    random = Random(seed)
    left = {random.getrandbits(64) for _ in range(size)}
    right = set(random.sample(sorted(left), max(0, len(left) - drop))) | {random.getrandbits(64) for _ in range(more)}
    if not right:
        return
    a, b = (np.array(sorted(x), dtype=np.uint64) for x in (left, right))
    both = len(left & right)
    assert links.common(a, b) == both
    bits = ngram_join.signature_bits(max(1, min(len(a), len(b)) // 2))
    x, y = ngram_join.signature(a, bits), ngram_join.signature(b, 4 * bits)
    assert (ngram_join.fold(y, len(x)) == ngram_join.signature(b, bits)).all()
    assert 2 * both <= len(a) + len(b) - int(np.bitwise_count(x ^ ngram_join.fold(y, len(x))).sum())
    if 100 * both >= percent * len(left | right):
        packed = [len(s).to_bytes(8, "big") + w.tobytes() for s, w in ((a, x), (b, y))]
        assert ngram_join.may_link(*packed, percent) and ngram_join.may_link(*reversed(packed), percent)
        common = np.random.default_rng(seed).integers(0, 3, ngram_join.SLOTS, dtype=np.uint8)
        assert set(ngram_join.prefix(a, common, percent).tolist()) & set(ngram_join.prefix(b, common, percent).tolist())
        starts = ngram_join.band_starts(percent)
        bands = [int(np.searchsorted(starts, len(s), side="right")) for s in (a, b)]
        assert abs(bands[0] - bands[1]) <= 1

"""Near-duplicates against all-pairs brute force; sketches and components against plain versions."""
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vigil.llm import links, near_dup, queries

SF = "/root/testdata/sf0.01"
LOWER = {i: i + 32 for i in range(65, 91)}


def plain_set(text, words=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))) if w else frozenset()


def plain(rows, percent):
    """{id: (set size, component)} by comparing everything with everything."""
    sets, boss = {}, {}
    for i, t in rows:
        sets.setdefault(i, []).append(plain_set(t))
        boss[i] = i

    def find(x):
        while boss[x] != x:
            x = boss[x]
        return x
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = find(a), find(b)
                boss[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = plain(rows, 85)
    got = queries.op9_near_duplicates(spark, SF).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        assert (r.component_id, r.kept) == (want[r.doc_id], want[r.doc_id] == r.doc_id) and r.n_shingles == len(plain_set(texts[r.doc_id]))


@pytest.mark.parametrize("block", [1024, 16])
@pytest.mark.parametrize("threshold", [0.85, 0.8])
def test_groups_of_near_copies(spark, monkeypatch, block, threshold):
    monkeypatch.setattr(near_dup, "BLOCK", block)
    rng = np.random.default_rng(7)
    rows, base = [], [[f"w{rng.integers(5000)}" for _ in range(n)] for n in (160, 40, 12, 6)]
    for words in base:
        for _ in range(60):  # chains of copies that change more and more
            own = list(words)
            for k in rng.integers(len(own), size=rng.integers(0, max(2, len(own) // 12))):
                own[k] = f"x{rng.integers(5000)}"
            rows.append(" ".join(own))
    rows += rows[:20] + ["Common words that many texts share here " + f"y{k} z{k}" for k in range(40)] + ["one two", "ONE two", "one  two\n", "three"]
    order = rng.permutation(len(rows))
    data = [(int(10 * i), rows[k]) for i, k in enumerate(order)]
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(spark.createDataFrame(data, "doc_id long, text string").repartition(6), threshold).collect()}
    assert got == plain(data, round(100 * threshold))


def test_edge_rows(spark):
    text = "a b c d e f g h " * 3
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, text), (None, text), (7, text), (5, text), (5, text), (9, "A B"), (11, "a\tb"), (12, "é b"),
            (20, "long " * 40000 + text), (21, "long " * 40000 + text + " x")]
    df = spark.createDataFrame([(i, t, "q", 1, "l") for i, t in rows], "doc_id long, text string, source string, n int, lang string").withColumn("n_chars", near_dup.F.lit(1))
    got = sorted(((r.doc_id or -1, r.component_id, r.kept) for r in near_dup.near_duplicates(df).collect()), key=str)
    c = {1: 1, 2: 2, 3: 3, 7: 5, 5: 5, 9: 9, 11: 9, 12: 12, 20: 20}
    c[21] = plain([r for r in rows if r[0] in (20, 21)], 85)[21]
    assert got == sorted(((i or -1, c.get(i), c.get(i, i) == i) for i, _ in rows), key=str)
    kept = near_dup.keep_one(df)
    assert kept.columns == df.columns and sorted(r.doc_id or -1 for r in kept.collect()) == sorted([1, 2, 3, 5, 9, 12, *{20, c[21]}])
    assert near_dup.near_duplicates(df.limit(0)).count() == 0 and near_dup.keep_one(df.limit(0)).count() == 0


def test_an_id_with_several_texts(spark):
    """As a node of the components it joins its texts; where one document of each group is kept, each text is its own."""
    a, b = "a b c d e f g h i j k l m n o p q r s t", "quite other words than those before them stand here in this text of some length"
    rows = [(1, a), (9, a), (9, b), (12, b), (14, b + " end"), (9, ""), (20, b[:40]), (20, a[:12])]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(df, 0.8).collect())
    want = plain(rows, 80)
    assert got == sorted((i, len(plain_set(t)), want[i], want[i] == i) for i, t in rows) and want[14] == 1
    kept = sorted((r.doc_id, r.text) for r in near_dup.keep_one(df).collect())
    assert kept == sorted([(1, a), (12, b), (9, ""), (20, b[:40]), (20, a[:12])])


@settings(deadline=None, max_examples=100)
@given(st.lists(st.text(alphabet="abAB é\t\n\x0b\x1cZ", max_size=40), max_size=6))
def test_set_sizes(texts):
    got = [len(s) for s in near_dup.shingle_sets(pa.array(texts, pa.string()))]
    assert got == [len(plain_set(t)) for t in texts]


def test_estimate_is_close_and_corrected():
    rng = np.random.default_rng(3)
    errors = []
    for j in (0.0, 0.3, 0.6, 0.85, 0.95):
        for _ in range(60):
            n = 2000
            common = int(round(2 * n * j / (1 + j)))
            v = rng.integers(0, 2**64, size=2 * n, dtype=np.uint64)
            a, b = np.unique(v[:n]), np.unique(np.concatenate([v[:common], v[n:2 * n - common]]))
            x, y = near_dup.registers(a), near_dup.registers(b)
            errors.append(float(near_dup.estimate(np.array((x == y).sum()), np.array(((x > 0) | (y > 0)).sum()), np.array(float(n)), np.array(float(n)))) - j)
    assert abs(np.mean(errors)) < 0.01 and np.max(np.abs(errors)) < 5 * 0.5 / np.sqrt(near_dup.BINS)


@settings(deadline=None, max_examples=8)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=40))
def test_components(spark, pairs):
    boss = {x: x for p in pairs for x in p}

    def find(x):
        return x if boss[x] == x else find(boss[x])
    for a, b in pairs:
        boss[max(find(a), find(b))] = min(find(a), find(b))
    near_dup.checkpoint_dir(spark)
    got = {r.node: r.comp for r in links.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in pairs if a != b for x in (a, b)}


def test_a_long_chain(spark):
    near_dup.checkpoint_dir(spark)
    chain = [(k, k + 1) for k in range(300)]
    got = links.components(spark.createDataFrame(chain, "a long, b long"))
    assert {r.comp for r in got.collect()} == {0} and got.count() == 301

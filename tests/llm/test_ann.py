"""Nearest neighbours against brute force."""
import numpy as np
import pytest

from vigil.llm import ann, queries

SF = "/root/testdata/sf0.01"


def brute(rows, is_query, top):
    valid = {}
    for i, v in rows:
        if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v) and any(c != 0 for c in v):
            valid[i] = np.array(v, dtype=np.float64)
    dims = [len(v) for v in valid.values()]
    dim = max(set(dims), key=lambda d: (dims.count(d), d)) if dims else 0
    valid = {i: v for i, v in valid.items() if len(v) == dim}
    out = {}
    for q, x in valid.items():
        if is_query(q):
            found = sorted((-(x * v).sum(), i) for i, v in valid.items() if i != q)[:top]
            out[q] = [(i, -s) for s, i in found]
    return out


def collect(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q, found in out.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, len(found) + 1))
        assert [(s, -i) for _, i, s in found] == sorted(((s, -i) for _, i, s in found), reverse=True)
        out[q] = [(i, s) for _, i, s in found]
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) / max(1, len(w)) for q, w in want.items()])


def test_query_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got, want = collect(queries.op5_nearest_neighbours(spark, SF)), brute(rows, lambda i: i % 20 == 0, 20)
    assert set(got) == set(want) and recall(got, want) >= 0.9
    scores = {q: dict(w) for q, w in brute(rows, lambda i: i % 20 == 0, len(rows)).items()}
    assert all(abs(s - scores[q][i]) < 1e-12 for q, found in got.items() for i, s in found)
    assert all(len(f) == 20 for f in got.values())


@pytest.mark.parametrize("scaled", [False, True])
def test_many_lists_parts_and_blocks(spark, monkeypatch, scaled):
    for name, value in {"LIST": 24, "PART": 16, "SHARD": 200, "QUERY_BLOCK": 7, "DEGREE": 8}.items():
        monkeypatch.setattr(ann, name, value)
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(30, 12))
    x = centers[rng.integers(30, size=1500)] + 0.3 * rng.normal(size=(1500, 12))
    x /= np.linalg.norm(x, axis=1)[:, None]
    if scaled:
        x *= rng.uniform(0.5, 2.0, size=(1500, 1))
    rows = [(int(i), x[i].tolist()) for i in range(1500)] + [(2000 + i, x[3].tolist()) for i in range(500)]  # a very common vector
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got, want = collect(ann.nearest(df, "vec_id % 10 = 0")), brute(rows, lambda i: i % 10 == 0, 20)
    assert set(got) == set(want) and recall(got, want) >= 0.9
    assert got[2000] == want[2000] or recall({0: got[2000]}, {0: want[2000]}) >= 0.9


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [inf, 0.0]), (None, [1.0, 1.0]), (6, [1.0, 2.0, 3.0]),
            (7, [1.0, 0.0]), (8, [-1.0, 0.5]), (20, [0.5, 0.5]), (9, []), (40, [1.0, 0.0])]
    df = spark.createDataFrame([(i, v, 9) for i, v in rows], "vec_id long, embedding array<float>, rank int")
    got = collect(ann.nearest(df, "vec_id % 20 = 0"))
    assert got == brute(rows, lambda i: i % 20 == 0, 20) and set(got) == {0, 20, 40}
    assert ann.nearest(df.limit(0), "vec_id % 20 = 0").count() == 0
    assert ann.nearest(df.where("vec_id = 0"), "vec_id % 20 = 0").count() == 0
    assert ann.nearest(df, "vec_id > 1000").count() == 0
    big = collect(ann.nearest(spark.createDataFrame([(2**60, [1.0]), (2**60 + 1, [2.0]), (5, [3.0])], "vec_id long, embedding array<double>"), "vec_id = 5"))
    assert big == {5: [(2**60 + 1, 6.0), (2**60, 3.0)]}


def test_walk_finds_what_a_full_search_finds():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4000, 6))
    index = ann.fit(x, 300)
    q = rng.normal(size=(50, 6))
    walked = index.distances(q, 0.2, 4)
    full = np.sqrt(np.square(q[:, None] - index.points[None]).sum(2))
    inside = full <= full.min(1)[:, None] * 1.2
    assert np.isfinite(walked[inside]).mean() > 0.97 and np.allclose(walked[np.isfinite(walked)], full[np.isfinite(walked)])
    sizes = np.bincount(np.argmin(np.square(x[:, None, :] - index.points[None]).sum(2), axis=1), minlength=300)
    assert sizes.max() < 8 * sizes.mean()


def test_recall_holds_with_many_lists(spark, monkeypatch):
    """Uniform vectors, so many lists that the least ratio reads too small a share of them."""
    monkeypatch.setattr(ann, "LIST", 8)
    x = np.random.default_rng(3).normal(size=(6000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = collect(ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5), "vec_id % 20 = 0"))
    assert recall(got, brute(rows, lambda i: i % 20 == 0, 20)) >= 0.92


def test_ratio_reaches_every_list():
    """A query that lies on a centroid, with its neighbours in the farthest list."""
    index = ann.fit(np.arange(40.0)[:, None], 40)
    far = int(np.argmax(index.points[:, 0]))
    ratio = ann.fit_ratio(index, np.zeros((1, 1)), [[[far]]], 0.12)
    d = index.distances(np.zeros((1, 1)), ratio, 4)
    assert d[0, far] <= index.reach(d.min(1), ratio)[0] and ann.fit_ratio(index, np.zeros((0, 1)), [], 0.12) == 0.12

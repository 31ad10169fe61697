import numpy as np
import pytest

from pricewright.llm import neighbours
from pricewright.llm.neighbours import best_of_block, build_index, lifted, lifted_queries, lists_of_queries, nearest, search_graph

SCHEMA = "vec_id long, embedding array<float>, rank int"


def brute(rows, queries, k):
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], np.float32).astype(float)
    out = {}
    for i, v in queries:
        score = (vectors * np.array(v, np.float32).astype(float)).sum(axis=1)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
        out[i] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def points(n, seed=0, dims=16):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, dims))
    made = np.where(draw.random((n, 1)) < 0.5, centres[draw.integers(12, size=n)] + 0.1 * draw.normal(size=(n, dims)), draw.normal(size=(n, dims)))
    return [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(made)]


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_one_list_is_exact(spark):
    rows = points(300) + [(1000 + i, points(300)[7][1]) for i in range(30)]  # many copies of one vector
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
    got = answers(nearest(df, df.filter("vec_id % 20 = 7"), 20))
    want = brute(rows, [r for r in rows if r[0] % 20 == 7], 20)
    assert {q: [i for i, _ in a] for q, a in got.items()} == {q: [i for i, _ in a] for q, a in want.items()}
    assert all(abs(s - t) < 1e-12 for q in got for (_, s), (_, t) in zip(got[q], want[q]))


@pytest.mark.parametrize("blocks", [4096, 50])
def test_recall_over_many_lists(spark, monkeypatch, blocks):
    monkeypatch.setattr(neighbours, "LIST_ROWS", 60)
    monkeypatch.setattr(neighbours, "BLOCK_VECTORS", blocks)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 11)
    rows = points(1500, 3)
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
    got = answers(nearest(df, df.filter("vec_id % 20 = 0"), 10))
    want = brute(rows, [r for r in rows if r[0] % 20 == 0], 10)
    assert got.keys() == want.keys() and all(len(a) == 10 for a in got.values())
    found = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert found / (10 * len(want)) > 0.9


def test_graph_search_finds_the_nearest_centroids():
    vectors = np.array([v for _, v in points(2000, 5)])
    norm = np.linalg.norm(vectors, axis=1).max() * (1 + 1e-12)
    index = build_index(vectors, norm, 120)
    some = lifted(vectors[:100], norm)
    ids, far = search_graph(index, some, 32)
    exact = np.sqrt(((some[:, None] - index.centroids[None]) ** 2).sum(axis=2))
    assert np.mean(ids[:, 0] == exact.argmin(axis=1)) > 0.97
    assert np.allclose(far[:, 0], exact[np.arange(100), ids[:, 0]])


def test_bounds_and_ties():
    ids, vectors = np.array([5, 3, 9, 1]), np.ones((4, 2))
    q, v, s = best_of_block(ids, vectors, np.array([9]), np.ones((1, 2)), np.array([2.0]), 2)
    assert (q.tolist(), v.tolist(), s.tolist()) == ([9, 9], [1, 3], [2.0, 2.0])
    assert len(best_of_block(ids, vectors, np.array([9]), np.ones((1, 2)), np.array([2.5]), 2)[0]) == 0


def test_rows_of_any_kind(spark):
    rows = [
        (0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1), (2, None, 1), (3, [0.0, 0.0], 1), (4, [float("nan"), 1.0], 1),
        (5, [None, 1.0], 1), (6, [float("inf"), 1.0], 1), (None, [1.0, 1.0], 1), (7, [], 1), (8, [1.0, 2.0, 3.0], 1), (20, [-1.0, 0.25], 1), (40, [0.0, 0.0], 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = answers(nearest(df, df.filter("vec_id % 20 = 0"), 20))
    assert got == {0: [(1, 0.5), (20, -1.0)], 20: [(1, -0.375), (0, -1.0)]}
    assert nearest(df.limit(0), df, 20).collect() == []
    assert nearest(df, df.limit(0), 20).collect() == []


def test_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in df.collect()]
    got = answers(nearest(df, df.filter("vec_id % 20 = 0"), 20))
    want = brute(rows, [r for r in rows if r[0] % 20 == 0], 20)
    found = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert found / (20 * len(want)) >= 0.9


def test_queries_read_every_list_within_the_ratio():
    """Many lists, of vectors without structure."""
    vectors = np.random.default_rng(8).normal(size=(3000, 64))
    index = build_index(vectors, np.linalg.norm(vectors, axis=1).max() * (1 + 1e-12), 400)
    sizes = np.full(len(index.centroids), 7)
    queries = vectors[:50]
    far = np.sqrt(((lifted_queries(queries)[:, None] - index.centroids[None]) ** 2).sum(axis=2))
    most = 0
    for own, d in zip(lists_of_queries(index, queries, sizes, 20), far):
        within = np.flatnonzero(d <= d.min() * neighbours.SEARCH_RATIO)
        assert set(within) <= set(own) and own[0] == d.argmin()
        most = max(most, len(within))
    assert most > 192
    assert all(len(own) >= 400 for own in lists_of_queries(index, queries, sizes, 7 * 400))



def test_fitting_holds_blocks_of_distances(monkeypatch):
    sizes = []
    whole = neighbours._distances
    monkeypatch.setattr(neighbours, "_distances", lambda a, b: sizes.append(len(a)) or whole(a, b))
    vectors = np.random.default_rng(10).normal(size=(2000, 16))
    build_index(vectors, np.linalg.norm(vectors, axis=1).max() * (1 + 1e-12), 30)
    assert max(sizes) <= neighbours.AT_ONCE

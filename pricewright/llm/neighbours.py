"""Nearest neighbours by inner product over balanced posting lists.

Vectors are turned into points whose Euclidean order is the order of the inner product (one more dimension
fills every norm up to the largest).  Centroids come from a bounded sample that is halved again and again into
equal parts, so lists are balanced.  A graph over the centroids is held in memory and searched greedily for vectors;
queries, which are few and read many lists, are compared with all centroids.  Every vector goes to its nearest lists: boundary vectors are copied to further lists that are nearly as near.
A query reads all lists whose distance is within a ratio of its nearest one's, however many.  First its nearest
list alone gives it a bound, then the other lists return only what reaches the bound.

Lists lie on the cluster; long ones, and lists that very many queries read, are dealt out in blocks of bounded
size.  The driver holds the sample, the centroids and their graph, all bounded by parameters.

Defined results: vec_id is the key, rows that repeat one count as one candidate by their best vector, and as one
query by their smallest; rows with a NULL vec_id, and vectors that are NULL, empty, zero, hold NULL or
non-finite components, or have another length than most (the longer one, if as many), take no part; ties go to
the smaller vec_id; empty tables give none.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import shared_value, stored

SAMPLE = 20_000  # vectors the centroids are fitted on, about
LIST_ROWS = 512  # vectors in a list, about
MAX_LISTS = 4096
COPIES = 4  # lists that a vector goes to, at most
COPY_RATIO = 1.03  # of the nearest distance, for copies at the boundary
SEARCH_RATIO = 1.16  # of the nearest distance, for the lists that a query reads
BEAM = 32  # centroids kept by the graph search for a vector
DEGREE = 16
BLOCK_VECTORS = 4096
BLOCK_QUERIES = 8192
AT_ONCE = 512
SLACK = 1e-9  # matrix products differ from exact scores in the last digits


class Index(NamedTuple):
    centroids: np.ndarray
    graph: np.ndarray  # neighbours of each centroid
    entries: np.ndarray  # where searches begin
    norm: float  # the largest of all vectors


def _halved(points: np.ndarray, parts: int, draw: np.random.Generator) -> Iterator[np.ndarray]:
    """Means of `parts` equal shares of the points, cut across the direction between two distant points."""
    if parts <= 1 or len(points) < 2:
        yield points.mean(axis=0)
        return
    first = points[draw.integers(len(points))]
    one = points[np.argmax(((points - first) ** 2).sum(axis=1))]
    two = points[np.argmax(((points - one) ** 2).sum(axis=1))]
    left = parts // 2
    order = np.argsort(points @ (two - one), kind="stable")
    cut = len(points) * left // parts
    yield from _halved(points[order[:cut]], left, draw)
    yield from _halved(points[order[cut:]], parts - left, draw)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None] - 2 * a @ b.T, 0)


def _nearest(points: np.ndarray, centroids: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The nearest centroid of each point, `AT_ONCE` points at a time."""
    blocks = (points[at : at + AT_ONCE] for at in range(0, len(points), AT_ONCE))
    return np.concatenate([np.argmin(_distances(block, centroids) + weight, axis=1) for block in blocks])


def build_index(sample: np.ndarray, norm: float, lists: int) -> Index:
    points = lifted(sample, norm)
    draw = np.random.default_rng(0)
    centroids = np.array(list(_halved(points, max(1, min(lists, len(points))), draw)))
    for _ in range(4):  # towards the middle of what is nearest, a full list being further away
        weight = np.zeros(len(centroids))
        for _ in range(2):
            nearest = _nearest(points, centroids, weight)
            sizes = np.bincount(nearest, minlength=len(centroids))
            weight += 0.02 * (sizes / max(sizes.mean(), 1e-9) - 1).clip(-1, 3)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centroids)
    degree = min(DEGREE, len(centroids) - 1)
    graph = np.zeros((len(centroids), max(1, degree + min(2, degree))), np.int64)
    for at in range(0, len(centroids), AT_ONCE):
        near = np.argsort(_distances(centroids[at : at + AT_ONCE], centroids), axis=1, kind="stable")[:, 1 : degree + 1]
        graph[at : at + AT_ONCE, :degree] = near
    if degree:  # two far links each keep the graph in one piece
        n = len(centroids)
        graph[:, degree] = (np.arange(n) + 1) % n
        if graph.shape[1] > degree + 1:
            graph[:, degree + 1] = (np.arange(n) * 7 + n // 2) % n
    entries = np.unique(np.linspace(0, len(centroids) - 1, min(8, len(centroids))).astype(np.int64))
    return Index(centroids, graph, entries, norm)


def lifted(vectors: np.ndarray, norm: float) -> np.ndarray:
    scaled = vectors / norm
    return np.hstack([scaled, np.sqrt(np.maximum(0, 1 - (scaled * scaled).sum(axis=1)))[:, None]])


def lifted_queries(vectors: np.ndarray) -> np.ndarray:
    return np.hstack([vectors / np.linalg.norm(vectors, axis=1)[:, None], np.zeros((len(vectors), 1))])


def search_graph(index: Index, points: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Greedy search for all points together: (centroid numbers, distances), nearest first, -1 where fewer were met."""
    n, b = len(index.centroids), len(points)
    beam = min(beam, n)
    rows = np.arange(b)[:, None]
    seen = np.zeros((b, n), bool)
    ids = np.repeat(index.entries[None], b, axis=0)
    seen[rows, ids] = True

    def measure(which: np.ndarray) -> np.ndarray:
        d = index.centroids[which] - points[:, None]
        return np.einsum("ijk,ijk->ij", d, d)

    far = measure(ids)
    opened = np.zeros(ids.shape, bool)
    while True:
        waiting = np.where(opened, np.inf, far)
        best = np.argmin(waiting, axis=1)
        live = np.isfinite(waiting[np.arange(b), best])
        if not live.any():
            break
        opened[np.arange(b), best] = True
        following = index.graph[np.maximum(ids[np.arange(b), best], 0)]
        fresh = live[:, None] & ~seen[rows, following]
        order = np.sort(following, axis=1)  # a neighbour listed twice counts once
        seen_twice = np.zeros(following.shape, bool)
        if (order[:, 1:] == order[:, :-1]).any():
            for j in range(1, following.shape[1]):
                seen_twice[:, j] = (following[:, :j] == following[:, j : j + 1]).any(axis=1)
        fresh &= ~seen_twice
        seen[rows, following] |= fresh
        gained = np.where(fresh, measure(following), np.inf)
        ids = np.hstack([ids, np.where(fresh, following, -1)])
        far = np.hstack([far, gained])
        opened = np.hstack([opened, ~fresh])
        if ids.shape[1] > beam:
            keep = np.argsort(far, axis=1, kind="stable")[:, :beam]
            ids, far, opened = ids[rows, keep], far[rows, keep], opened[rows, keep]
    order = np.argsort(far, axis=1, kind="stable")
    return ids[rows, order], np.sqrt(far[rows, order])


def lists_of_vectors(index: Index, vectors: np.ndarray) -> list[np.ndarray]:
    """The lists of each vector: the nearest, and others nearly as near that are not next to one already taken."""
    ids, far = search_graph(index, lifted(vectors, index.norm), BEAM)
    out = []
    for own, d in zip(ids, far):
        near = own[(d <= d[0] * COPY_RATIO + 1e-12) & (own >= 0)]
        taken = [near[0]]
        for c, dist in zip(near[1:], d[1:]):
            if len(taken) == COPIES:
                break
            between = np.sqrt(((index.centroids[taken] - index.centroids[c]) ** 2).sum(axis=1)).min()
            if between >= dist * 0.5:
                taken.append(c)
        out.append(np.array(taken))
    return out


def lists_of_queries(index: Index, vectors: np.ndarray, sizes: np.ndarray, least: int) -> list[np.ndarray]:
    """The lists that each query reads, nearest first: within the ratio, and until `least` vectors are in reach."""
    far = np.sqrt(_distances(lifted_queries(vectors), index.centroids))  # MAX_LISTS columns at most
    out = []
    for d in far:
        own = np.argsort(d, kind="stable")
        d = d[own]
        reached = np.r_[0, np.cumsum(sizes[own])[:-1]]
        out.append(own[(d <= d[0] * SEARCH_RATIO + 1e-12) | (reached < least)])
    return out


def best_of_block(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, bounds: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query_id, vec_id, score) of the `k` best per query that reach its bound; scores are sums in a fixed order."""
    found = []
    for at in range(0, len(query_ids), AT_ONCE):
        q, own = queries[at : at + AT_ONCE], query_ids[at : at + AT_ONCE]
        scores = q @ vectors.T
        scores[own[:, None] == ids[None]] = -np.inf
        least = bounds[at : at + AT_ONCE]
        if len(ids) > k:
            least = np.maximum(least, np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k])
        slack = SLACK * (1 + np.where(np.isfinite(least), np.abs(least), 0))
        i, j = np.nonzero((scores >= (least - slack)[:, None]) & (scores > -np.inf))
        exact = np.concatenate([np.zeros(0), *[(q[i[c : c + 65536]] * vectors[j[c : c + 65536]]).sum(axis=1) for c in range(0, len(i), 65536)]])
        order = np.lexsort((ids[j], -exact, i))
        i, j, exact = i[order], j[order], exact[order]
        place = np.arange(len(i)) - np.searchsorted(i, i, "left")
        top = place < k
        found.append((own[i[top]], ids[j[top]], exact[top]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)


def usable(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, v): rows that take part, components as doubles."""
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()
    )
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(~bad & F.exists("v", lambda x: x != 0))
    widths = rows.groupBy(F.size("v").alias("width")).count().orderBy(F.col("count").desc(), F.col("width").desc())
    first = widths.first()
    return rows.filter(F.size("v") == (first.width if first else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _stacked(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.float64)


def _searched(posts: DataFrame, probes: DataFrame, k: int) -> DataFrame:
    """What each block of a list gives to the queries that read it."""

    def work(block: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(block) or not len(asked):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        q, v, s = best_of_block(
            block.vec_id.to_numpy(), _stacked(block.v), asked.query_id.to_numpy(), _stacked(asked.v), asked.bound.to_numpy(), k
        )
        return pd.DataFrame({"query_id": q, "vec_id": v, "score": s})

    # long lists in blocks of vectors, and lists that very many queries read in blocks of queries
    sizes = posts.groupBy("list").count().withColumnRenamed("count", "rows")
    asked = probes.groupBy("list").count().withColumnRenamed("count", "asked")
    layout = F.broadcast(  # a row for each list, at most MAX_LISTS
        sizes.join(asked, "list").select(
            "list", F.ceil(F.col("rows") / BLOCK_VECTORS).cast("int").alias("parts"), F.ceil(F.col("asked") / BLOCK_QUERIES).cast("int").alias("shares")
        )
    )
    left = posts.join(layout, "list").select(
        "list", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), "vec_id", "v"
    )
    right = probes.join(layout, "list").select(
        "list", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.pmod(F.xxhash64("query_id"), F.col("shares")).cast("int").alias("share"),
        "query_id", "v", "bound",
    )
    key = ["list", "part", "share"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(work, "query_id long, vec_id long, score double")


def nearest(df: DataFrame, queries: DataFrame, k: int, vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the `k` nearest found of every query; both frames have vec_id and the vector."""
    spark = df.sparkSession
    rows, wanted = usable(df, vector), usable(queries, vector)
    wanted = stored(wanted.groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v")))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    total, norm = rows.agg(F.count(F.lit(1)), F.max(square)).first()
    if not total or wanted.isEmpty():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    norm = float(np.sqrt(norm)) * (1 + 1e-12)
    share = min(1.0, SAMPLE / total)
    drawn = rows.filter(F.pmod(F.xxhash64(F.lit("sample"), "vec_id"), F.lit(1_000_000)) < max(1, int(share * 1_000_000)))
    sample = _matrix(drawn.orderBy("vec_id", "v").select("v").limit(2 * SAMPLE).toArrow().column("v").combine_chunks())
    if not len(sample):  # fewer than the draw can hit
        sample = _matrix(rows.orderBy("vec_id", "v").select("v").limit(SAMPLE).toArrow().column("v").combine_chunks())
    index = shared_value(spark, build_index(sample, norm, min(MAX_LISTS, -(-total // LIST_ROWS))))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(at, AT_ONCE)
                lists = lists_of_vectors(index.value, _matrix(part.column("v")))
                place = pa.array(np.repeat(np.arange(len(lists)), list(map(len, lists))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(lists).astype(np.int32)), part.column("vec_id").take(place), part.column("v").take(place)], ["list", "vec_id", "v"]
                )

    posts = stored(rows.mapInArrow(deal, "list int, vec_id long, v array<double>"))
    held = {r["list"]: r["count"] for r in posts.groupBy("list").count().collect()}  # a row for each list
    sizes = shared_value(spark, np.array([held.get(i, 0) for i in range(len(index.value.centroids))]))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(at, AT_ONCE)
                lists = lists_of_queries(index.value, _matrix(part.column("v")), sizes.value, 4 * k)
                counts = list(map(len, lists))
                place = pa.array(np.repeat(np.arange(len(lists)), counts))
                turn = np.concatenate([np.arange(c, dtype=np.int32) for c in counts])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(lists).astype(np.int32)), pa.array(turn), part.column("query_id").take(place)], ["list", "turn", "query_id"]
                )

    probes = stored(wanted.mapInArrow(ask, "list int, turn int, query_id long"))
    asked = probes.join(wanted, "query_id")
    first = stored(_searched(posts, asked.filter("turn = 0").withColumn("bound", F.lit(float("-inf"))), k))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    once = first.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    bound = once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") == k).select("query_id", F.col("score").alias("bound"))
    others = asked.filter("turn > 0").join(bound, "query_id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
    every = first.union(_searched(posts, others, k)).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return every.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

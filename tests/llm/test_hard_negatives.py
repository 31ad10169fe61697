import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricewright.llm.hard_negatives import blocks_of, hilbert_keys, mine, mined_digests, score_bounds

SCHEMA = "vec_id long, label int, embedding array<double>, `a.b` string, score int, block string"


def by_definition(rows, anchors, positives, negatives, lowest, highest):
    """rows: (id, label, vector of whole numbers), unique ids."""
    out = set()
    for a, own, v in rows:
        if not anchors(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, label) for i, label, w in rows if i != a)
        for p, positive, _ in [s for s in scored if s[2] == own][:positives]:
            fitting = [(n, i) for n, i, label in scored if label != own and lowest * -p <= 100 * -n <= highest * -p]
            out |= {(a, positive, rank + 1, i, -p, -n) for rank, (n, i) in enumerate(fitting[:negatives])}
    return out


def clustered(n, length, labels, seed, noise=0.05):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(length)] for _ in range(12)]
    rows = []
    for i in range(n):
        c = draw.randrange(12)
        label = c % labels if draw.random() < 0.9 else draw.randrange(labels)
        rows.append((i, label, [x + draw.gauss(0, noise) for x in centres[c]]))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(4)


def whole(rows):
    return [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows]


def found(mined):
    return {tuple(r) for r in mined.rows.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()}


@pytest.mark.parametrize("block_rows,wave_rows", [(1, 7), (16, 1000), (1000, 13)])
def test_equals_the_definition(spark, block_rows, wave_rows):
    rows = clustered(300, 6, 4, block_rows)
    rows += [(1000 + i, (label + i % 2) % 4, v) for i, (_, label, v) in enumerate(rows[:60])]  # copies, so ties
    mined = mine(frame(spark, rows), F.col("vec_id") % 9 == 0, "vec_id", F.col("label"), block_rows=block_rows, wave_rows=wave_rows)
    assert found(mined) == by_definition(whole(rows), lambda i: i % 9 == 0, 5, 10, 30, 90)


def test_other_windows(spark):
    rows = clustered(200, 3, 2, 8, noise=0.6)
    mined = mine(frame(spark, rows), F.col("vec_id") < 40, "vec_id", F.col("label"), positives=2, negatives=3, lowest=-50, highest=120, block_rows=8)
    assert found(mined) == by_definition(whole(rows), lambda i: i < 40, 2, 3, -50, 120)


def test_blocks_are_left_out(spark):
    rows = clustered(3000, 16, 6, 21)
    mined = mine(frame(spark, rows), F.col("vec_id") % 100 == 0, "vec_id", F.col("label"), block_rows=32)
    assert mined.share_read[0] < 0.2 and mined.share_read[1] < 0.5
    assert found(mined) == by_definition(whole(rows), lambda i: i % 100 == 0, 5, 10, 30, 90)


def test_bounds_hold_for_every_row_of_a_block(spark):
    rows = whole(clustered(400, 5, 3, 2))
    df = spark.createDataFrame(rows, "key long, label long, v array<int>")
    blocks = blocks_of(df, 5, 20).collect()
    anchors = np.array([v for _, _, v in rows[:30]])
    seen = []
    for b in blocks:
        v = np.frombuffer(b.v, np.int32).reshape(-1, 5)
        ids = np.frombuffer(b.ids, np.int64).tolist()
        assert len(ids) == len(v) <= 20 and ids == sorted(ids)
        seen += [(i, b.label, w) for i, w in zip(ids, v.tolist())]
        assert b.low == v.min(axis=0).tolist() and b.high == v.max(axis=0).tolist()
        low, high = score_bounds(anchors, np.array([b.low]), np.array([b.high]))
        scores = anchors @ v.T
        assert (low <= scores).all() and (scores <= high).all()
    assert sorted(seen) == rows


def test_hilbert_curve_meets_each_cell_once_and_moves_by_one():
    for axes, bits in ((1, 4), (2, 4), (3, 3), (5, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), axis=-1).reshape(-1, axes)
        keys = hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_missing_values_repeats_and_empty(spark):
    good = clustered(120, 4, 3, 5)
    bad = [(200, None, [1.0] * 4), (300, 1, None), (400, 1, [None] * 4), (500, 2, [float("nan")] * 4), (600, 2, [float("-inf")] * 4), (700, 0, [1.0]), (800, 1, []), (None, 1, [1.0] * 4)]
    expected = by_definition(whole(good), lambda i: i % 10 == 0, 5, 10, 30, 90)
    for rows in (good + bad, good + bad + good[:50]):
        assert found(mine(frame(spark, rows), F.col("vec_id") % 10 == 0, "vec_id", F.col("label"))) == expected
    empty = frame(spark, good).limit(0)
    assert mine(empty, F.col("vec_id") % 10 == 0, "vec_id", F.col("label")).rows.collect() == []
    assert found(mine(frame(spark, good), F.lit(False), "vec_id", F.col("label"))) == set()
    assert found(mine(frame(spark, good), F.lit(True), "vec_id", F.lit(1))) == set()  # no other label


def test_zero_vectors_and_negative_scores(spark):
    rows = [(0, 1, [0.0, 0.0]), (1, 1, [1.0, 1.0]), (2, 1, [-1.0, -1.0]), (3, 2, [0.0, 0.0]), (4, 2, [-2.0, 0.0]), (5, 2, [0.5, 0.5])]
    mined = mine(frame(spark, rows), F.lit(True), "vec_id", F.col("label"))
    assert found(mined) == by_definition(whole(rows), lambda i: True, 5, 10, 30, 90)


def test_contract_labels(spark):
    rows = [(i, i % 10, v) for i, _, v in clustered(400, 4, 5, 3)]
    changed = [(i, (label + 1) % 10 if i % 7 == 0 else label, v) for i, label, v in rows]
    got = {tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in mined_digests(frame(spark, rows)).collect()}
    assert got == by_definition(whole(changed), lambda i: i % 100 == 0, 5, 10, 30, 90)

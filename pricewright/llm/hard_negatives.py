"""Hard negatives from candidate blocks along a Hilbert curve, chosen by zone maps.

Rows are ordered by label and by the place of their vector on a Hilbert curve (over the dimensions that vary most),
cut into blocks of bounded size and stored as Parquet, one row a block: the ids, the vectors, the label, and a zone map, the
least and greatest value of each dimension.  From a zone map alone, interval arithmetic bounds the inner product of an
anchor with every row of the block from below and above; a block is read for an anchor only if those bounds meet
one of its windows and its label fits.

Anchors are searched in waves of bounded size, which tasks hold in memory together with the best rows found so far:

1. Positives.  Each anchor first reads the few blocks of its label with the greatest upper bounds; the score of its
   last positive there closes the window from below for the second reading, of all blocks that can still reach it.
2. Negatives.  Each positive opens a window of scores, in whole numbers.  Again a few promising blocks come first;
   where they fill a window, its lower end rises to the last score found before all blocks that meet a window are read.

Both readings of a search are whole, so results are exact whatever the blocks, the waves and the bounds; bounds only
spare work.  No row of a hot label meets another by itself: rows are in blocks, blocks meet waves of anchors.

Defined results: rows with a NULL `key`, a NULL label, or a vector that is NULL, empty, or holds NULL or non-finite
components take no part, nor do vectors of another length than most; rows that repeat a key count once, with the
smallest label and vector; ties go to the smaller key; anchors without positives or negatives give no rows; empty tables
give none.  Only the named columns are read, so further columns may have any name.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.joins import measured_side
from ..session import ensure_checkpoint_dir
from .common import shared_value, stored
from .vectors import matrix, products, quoted, whole_vectors

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LOWEST, HIGHEST = 30, 90  # percent of the positive's score
BLOCK_ROWS = 256
WAVE = 16_384  # anchors searched together
FIRST_BLOCKS = 4  # blocks that an anchor reads before its bounds are set
CURVE_DIMENSIONS = 12
CURVE_BITS = 5
CELLS = 1 << 22  # numbers of a score or bound matrix held at once
NONE = -(1 << 62)  # below every score
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


class Wave(NamedTuple):
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray


class Windows(NamedTuple):
    """Scores wanted of the rows of the anchor's own label (`same`) or of all others: `most` a window, the best first."""

    same: bool
    most: int
    low: np.ndarray  # anchors x windows
    high: np.ndarray


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of cells (rows of whole numbers below 2 ** bits) on the Hilbert curve through all of them."""
    x = cells.astype(np.int64).T.copy()
    first = x[0]  # a view: turns of the first axis by itself come to nothing
    for level in range(bits - 1, 0, -1):  # undo the turns of the cubes, from the largest
        half, rest = 1 << level, (1 << level) - 1
        for axis in x:
            swapped = np.where(axis & half, 0, (first ^ axis) & rest)
            first ^= np.where(axis & half, rest, swapped)
            axis ^= swapped
    for i in range(1, len(x)):  # Gray code over the axes
        x[i] ^= x[i - 1]
    turn = np.zeros_like(first)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> level & 1, (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in x:
            key = key << 1 | axis >> level & 1
    return key


def _spread(rows: DataFrame, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of every dimension; they steer the order of rows only."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, length))
        for batch in batches:
            v = matrix(batch.column("v")).astype(np.float64)
            if len(v):
                total += [np.full(length, len(v)), v.sum(axis=0), (v * v).sum(axis=0)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(3 * length)), pa.array(total.ravel())], ["place", "total"])

    total = np.zeros(3 * length)
    for row in rows.select("v").mapInArrow(sums, "place long, total double").groupBy("place").agg(F.sum("total").alias("total")).collect():
        total[row["place"]] = row["total"]
    n, one, two = total.reshape(3, length) / np.maximum(total[0], 1)
    return one, np.sqrt(np.maximum(two - one * one, 0))


def blocks_of(rows: DataFrame, length: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Stored blocks (block, label, ids, v, low, high) of rows (key, label, v), in the order of the curve."""
    mean, deviation = _spread(rows, length)
    axes = np.argsort(-deviation, kind="stable")[:CURVE_DIMENSIONS]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = matrix(batch.column("v"))[:, axes]
                cells = np.floor(((v - mean[axes]) / np.maximum(deviation[axes], 1e-9) + 3) / 6 * (1 << CURVE_BITS))
                key = hilbert_keys(np.clip(cells, 0, (1 << CURVE_BITS) - 1), CURVE_BITS)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], [*batch.schema.names, "place"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v, ids = matrix(batch.column("v")).astype(np.int32), batch.column("key").to_numpy()
            labels = batch.column("label").to_numpy()
            edges = np.flatnonzero(np.r_[True, labels[1:] != labels[:-1], True])
            out = []
            for a, z in zip(edges, edges[1:]):
                for at in range(a, z, block_rows):
                    part = slice(at, min(at + block_rows, z))
                    order = np.argsort(ids[part], kind="stable")
                    own = v[part][order]
                    out.append((labels[at], ids[part][order].tobytes(), own.tobytes(), own.min(axis=0), own.max(axis=0)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out]), pa.array([o[2] for o in out]),
                    pa.array([o[3] for o in out], pa.list_(pa.int32())), pa.array([o[4] for o in out], pa.list_(pa.int32())),
                ],
                ["label", "ids", "v", "low", "high"],
            )

    ordered = rows.mapInArrow(placed, "key long, label long, v array<int>, place long").repartitionByRange("label", "place", "key")
    ordered = ordered.sortWithinPartitions("label", "place", "key").select("key", "label", "v")
    found = ordered.mapInArrow(packed, "label long, ids binary, v binary, low array<int>, high array<int>")
    return stored(found.select(F.monotonically_increasing_id().alias("block"), "*"))


def score_bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each anchor with anything inside each zone."""
    plus, minus = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return products(plus, low) + products(minus, high), products(plus, high) + products(minus, low)


def _fitting(wave: Wave, label: int, same: bool) -> np.ndarray:
    return (wave.labels == label) == same


def _zones(batches: Iterator[pa.RecordBatch], anchors: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(block, label, low, high), so many zones together that a matrix of bounds has `CELLS` numbers at most."""
    most = max(1, CELLS // max(1, anchors))
    for batch in batches:
        for at in range(0, batch.num_rows, most):
            part = batch.slice(at, most)
            yield part.column("block").to_numpy(), part.column("label").to_numpy(), matrix(part.column("low")), matrix(part.column("high"))


def _promising(blocks: DataFrame, wave, windows) -> dict[int, list[int]]:
    """For each block the anchors that read it first: those to which it is one of the `FIRST_BLOCKS` with the greatest
    upper bounds.  At most `WAVE` times `FIRST_BLOCKS` pairs."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, aim = wave.value, windows.value
        bound = np.full((len(own.ids), FIRST_BLOCKS), NONE, np.int64)
        which = np.full(bound.shape, -1, np.int64)
        for block, label, low, high in _zones(batches, len(own.ids)):
            least, most = score_bounds(own.vectors, low, high)
            meets = ((own.labels[:, None] == label[None]) == aim.same) & (most >= aim.low.min(axis=1)[:, None]) & (least <= aim.high.max(axis=1)[:, None])
            joined = np.hstack([bound, np.where(meets, most, NONE)])
            numbers = np.hstack([which, np.broadcast_to(block, meets.shape)])
            order = np.argsort(-joined, axis=1, kind="stable")[:, :FIRST_BLOCKS]
            bound, which = np.take_along_axis(joined, order, axis=1), np.take_along_axis(numbers, order, axis=1)
        anchor, place = np.nonzero(bound > NONE)
        yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(which[anchor, place]), pa.array(bound[anchor, place])], ["anchor", "block", "bound"])

    order = Window.partitionBy("anchor").orderBy(F.col("bound").desc(), "block")
    found = blocks.select("block", "label", "low", "high").mapInArrow(best, "anchor long, block long, bound long")
    pairs: dict[int, list[int]] = {}
    for row in found.withColumn("turn", F.row_number().over(order)).filter(F.col("turn") <= FIRST_BLOCKS).collect():
        pairs.setdefault(row["block"], []).append(row["anchor"])
    return pairs


def _needed(blocks: DataFrame, wave, windows) -> DataFrame:
    """(block, anchors): blocks that a window of some anchor has to read, with the number of these anchors."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, aim = wave.value, windows.value
        for block, label, low, high in _zones(batches, len(own.ids)):
            least, most = score_bounds(own.vectors, low, high)
            meets = np.zeros(least.shape, bool)
            for w in range(aim.low.shape[1]):
                meets |= (most >= aim.low[:, w, None]) & (least <= aim.high[:, w, None])
            meets &= (own.labels[:, None] == label[None]) == aim.same
            count = meets.sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(block[count > 0]), pa.array(count[count > 0])], ["block", "anchors"])

    return blocks.select("block", "label", "low", "high").mapInArrow(work, "block long, anchors long")


def _searched(blocks: DataFrame, wave, windows, pairs=None) -> DataFrame:
    """(anchor, window, score, key): the best rows of every window, from the blocks in `pairs` or from all that meet it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, aim = wave.value, windows.value
        count, width = aim.low.shape
        score = np.full((count, width, aim.most), NONE, np.int64)
        key = np.full(score.shape, np.iinfo(np.int64).max)
        for batch in batches:
            for number, label, ids, v, low, high in zip(*(batch.column(n).to_pylist() for n in ("block", "label", "ids", "v", "low", "high"))):
                ids = np.frombuffer(ids, np.int64)
                v = np.frombuffer(v, np.int32).reshape(len(ids), -1)
                if pairs is not None:
                    anchors = np.array(pairs.value[number])
                else:
                    anchors = np.flatnonzero(_fitting(own, label, aim.same))
                    least, most = score_bounds(own.vectors[anchors], np.array([low]), np.array([high]))
                    anchors = anchors[((most >= aim.low[anchors]) & (least <= aim.high[anchors])).any(axis=1)]
                for at in range(0, len(anchors), max(1, CELLS // 8 // len(ids))):
                    some = anchors[at : at + max(1, CELLS // 8 // len(ids))]
                    _merge_block(own, aim, some, ids, v, score, key)
        anchor, window, place = np.nonzero(score > NONE)
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchor), pa.array(window), pa.array(score[anchor, window, place]), pa.array(key[anchor, window, place])], ["anchor", "window", "score", "key"]
        )

    found = blocks.select("block", "label", "ids", "v", "low", "high").mapInArrow(work, "anchor long, window long, score long, key long")
    order = Window.partitionBy("anchor", "window").orderBy(F.col("score").desc(), "key")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= windows.value.most)


def _merge_block(own: Wave, aim: Windows, some: np.ndarray, ids: np.ndarray, v: np.ndarray, score: np.ndarray, key: np.ndarray) -> None:
    """Bring the rows of one block into the best of the anchors `some`; ids ascend, so equal scores are in order."""
    found = products(own.vectors[some], v)
    found[own.ids[some][:, None] == ids[None]] = NONE
    order = np.argsort(-found, axis=1, kind="stable")
    ranked = np.take_along_axis(found, order, axis=1)
    for w in range(aim.low.shape[1]):
        start = (ranked > aim.high[some, w][:, None]).sum(axis=1)
        place = start[:, None] + np.arange(aim.most)[None]
        inside = place < len(ids)
        place = np.minimum(place, len(ids) - 1)
        new = np.take_along_axis(ranked, place, axis=1)
        floor = np.maximum(aim.low[some, w], score[some, w, -1])
        inside &= new >= floor[:, None]
        live = np.flatnonzero(inside.any(axis=1))
        if not len(live):
            continue
        new = np.where(inside, new, NONE)[live]
        new_key = np.where(inside, ids[np.take_along_axis(order, place, axis=1)], np.iinfo(np.int64).max)[live]
        rows = some[live]
        joined, keys = np.hstack([score[rows, w], new]), np.hstack([key[rows, w], new_key])
        best = np.lexsort((keys, -joined), axis=1)[:, : aim.most]
        score[rows, w], key[rows, w] = np.take_along_axis(joined, best, axis=1), np.take_along_axis(keys, best, axis=1)


def _search(blocks: DataFrame, wave, aim: Windows, total: int) -> tuple[DataFrame, float]:
    """Two readings: the promising blocks set the bounds, then every block that meets a window.  Also the share of all
    blocks that an anchor reads in the second one."""
    spark = blocks.sparkSession
    windows = shared_value(spark, aim)
    pairs = _promising(blocks, wave, windows)
    low = aim.low.copy()
    if pairs:
        chosen = spark.createDataFrame([(b,) for b in pairs], "block long")
        first = _searched(blocks.join(F.broadcast(chosen), "block"), wave, windows, shared_value(spark, pairs))
        for row in first.filter(F.col("rank") == aim.most).collect():  # one for each anchor and window
            low[row["anchor"], row["window"]] = row["score"]
    windows = shared_value(spark, aim._replace(low=low))
    needed = stored(_needed(blocks, wave, windows))
    read = needed.agg(F.coalesce(F.sum("anchors"), F.lit(0))).first()[0]
    wanted = measured_side(needed.select("block")).frame
    return _searched(blocks.join(wanted, "block"), wave, windows), read / (total * len(aim.low))


class Mined(NamedTuple):
    rows: DataFrame
    share_read: tuple[float, float]  # of (anchor, block) pairs, for positives and for negatives


def mine(
    df: DataFrame, anchors: Column, key: str, label: Column, vector: str = "embedding", positives: int = POSITIVES, negatives: int = NEGATIVES,
    lowest: int = LOWEST, highest: int = HIGHEST, scale: int = SCALE, block_rows: int = BLOCK_ROWS, wave_rows: int = WAVE,
) -> Mined:
    """For each anchor (a condition on `key`) and each of its best rows of the same label, the best rows of other labels
    whose score is between `lowest` and `highest` percent of the positive's."""
    spark = df.sparkSession
    columns = {"key": quoted(key).cast("long"), "label": label.cast("long"), "anchor": F.coalesce(anchors, F.lit(False))}
    rows, length, _ = whole_vectors(df.filter(quoted(key).isNotNull() & label.isNotNull()), columns, vector, scale)
    if not length:
        return Mined(spark.createDataFrame([], RESULT), (0.0, 0.0))
    rows = rows.groupBy("key").agg(F.min(F.struct("label", "v")).alias("r"), F.max("anchor").alias("anchor"))
    rows = stored(rows.select("key", "r.label", "r.v", "anchor"))
    blocks = blocks_of(rows.select("key", "label", "v"), length, block_rows)
    total = blocks.count()
    wanted = rows.filter("anchor")
    waves = -(-wanted.count() // wave_rows)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    read = np.zeros(2)
    for turn in range(waves):
        part = wanted.filter(F.pmod(F.xxhash64("key"), F.lit(waves)) == turn) if waves > 1 else wanted
        table = part.select("key", "label", "v").toArrow().combine_chunks()  # about `wave_rows` rows
        if not table.num_rows:
            continue
        own = Wave(table["key"].to_numpy(), table["label"].to_numpy(), matrix(table["v"].combine_chunks()).astype(np.int64))
        wave, n = shared_value(spark, own), len(own.ids)
        every = np.full((n, 1), 1 << 62, np.int64)
        found, share = _search(blocks, wave, Windows(True, positives, -every + 1, every), total)
        best, with_score = np.zeros((2, n, positives), np.int64)
        low, high = np.ones((n, positives), np.int64), np.zeros((n, positives), np.int64)  # no positive, empty window
        for row in found.collect():  # `positives` for each anchor
            at = row["anchor"], row["rank"] - 1
            best[at], with_score[at] = row["key"], row["score"]
            low[at], high[at] = -(-lowest * row["score"] // 100), highest * row["score"] // 100
        others, share_others = _search(blocks, wave, Windows(False, negatives, low, high), total)
        read += (share * n, share_others * n)
        _with_ids(others, own.ids, best, with_score).write.mode("append").parquet(path)
    if not waves:
        return Mined(spark.createDataFrame([], RESULT), (0.0, 0.0))
    return Mined(spark.read.schema(RESULT).parquet(path), tuple((read / wanted.count()).tolist()))


def _with_ids(found: DataFrame, anchors: np.ndarray, positives: np.ndarray, scores: np.ndarray) -> DataFrame:
    """The numbers of anchors and windows replaced by what they stand for."""
    names = shared_value(found.sparkSession, (anchors, positives, scores))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, positives, scores = names.value
        for batch in batches:
            anchor, window = batch.column("anchor").to_numpy(), batch.column("window").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchors[anchor]), pa.array(positives[anchor, window]), batch.column("rank"), batch.column("key"),
                    pa.array(scores[anchor, window]), batch.column("score"),
                ],
                ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
            )

    return found.mapInArrow(work, RESULT)


def mined_digests(df: DataFrame) -> DataFrame:
    """Every hundredth row as an anchor; every seventh has a wrong label."""
    label = F.col("label").cast("long")
    noisy = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine(df, F.col("vec_id") % 100 == 0, "vec_id", noisy).rows

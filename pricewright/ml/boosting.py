"""Boosted regression trees from gradient histograms, many fits in lock-step.

A tree grows level by level.  Each level is one aggregate over all rows: how many there are, and the sum of their
gradients, for every (fit, node, feature, bin).  Tasks add these up in arrays and hand on one row for each cell that is
not empty; the driver turns them into the best split of every node.  Only left children are counted, right ones being
the rest of their parent.

The state (bins, label, score of each fit) is kept in blocks of rows, one array a column; tasks add the few trees since
its last checkpoint by comparing whole columns.

Fits that differ in settings or in the rows held out share each pass: a comparison of several settings over all folds
takes as many passes as its longest fit, and the scores after every number of trees come with them.

Only some columns are counted: a feature whose bin follows from another's, as a lookup's does from its key, and features
of few bins that together have no more than a column may have, are read off the sums of one.

The trees of a forest (`Setting.bagged`) do not depend on each other: those of several numbers and of all fits grow in
lock-step too, as many at a time as a task has room for.

Gradients are rounded to multiples of a power of two and added up as whole numbers, so a model depends on the rows
alone, not on their order or partitions.  Rows and columns of a tree are drawn by hashes of the row and the tree.

The driver holds histograms: fits * 2 ** depth * features * bins cells at most, and none of a forest, whose splits
are found by the tasks that add up its cells.  The state is checkpointed every `REFRESH` trees, which cuts the lineage.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable, Iterable, Iterator
from dataclasses import asdict, dataclass, field, replace
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.cleaning import drop_unusable, require_columns
from ..operators.ordering import quantile_bins
from ..session import ensure_checkpoint_dir, importable_in_workers
from .split import SEED

REFRESH = 8  # trees between two checkpoints of the state
GRADIENT_BITS = 36  # the largest gradient takes up to so many bits, so that a double holds the sum of a batch exactly
BLOCK_ROWS = 1 << 14  # of a block at most; Arrow's batches are smaller by default
ROWS_PER_TASK = 200_000
LEAST_TASKS = 8
DRIVER_CELLS = 1 << 20  # so many cells of all tasks are added up by the driver, which saves a shuffle for every level
FOREST_BLOCK_ROWS = 1 << 16
FOREST_CELLS = 1 << 21  # so many cells of a forest's trees a task counts at a time
FOREST_ROWS_PER_TASK = 1_000_000  # a task of a forest hands on far more cells, whatever its rows
ALIKE = 12  # so many fits at most are told apart by the bits of a number
TIMES = 18  # a row is drawn less often than this for a tree of a forest
PAIRED = 32  # with more features than this, each is counted for itself
PAIR_CELLS = 1 << 16  # bins of one feature times those of another, to see whether one follows from the other
PACKED_BINS = 256


@dataclass(frozen=True)
class Setting:
    """One way to boost; the least rows of a node that is split are counted among the drawn ones."""

    name: str = "boosting"
    trees: int = 300
    rate: float = 0.05
    depth: int = 4
    subsample: float = 1.0  # share of the rows drawn for each tree
    columns: float = 1.0  # share of the features drawn for each tree
    least_rows: int = 2  # of a node that is split
    penalty: float = 0.0  # added to the row count of a leaf
    seed: int = SEED
    bagged: bool = False  # a forest: each tree fits the target itself, on as many rows as there are, drawn with repeats


def forest(name: str = "random_forest", trees: int = 200, depth: int = 6, seed: int = SEED) -> Setting:
    """The mean of trees that see all features: each adds its share."""
    return Setting(name, trees, 1.0 / trees, depth, seed=seed, bagged=True)


def published_settings(trees: int = 300) -> list[Setting]:
    """The two compared boosted models."""
    return [
        Setting("gbt", trees, 0.05, 4, subsample=0.85, least_rows=5),
        Setting("gbt_colsample", trees, 0.05, 4, subsample=0.85, columns=0.8, penalty=1.0),
    ]


@dataclass
class Tree:
    """Nodes in heap order; a node without a feature (-1) is a leaf."""

    feature: list[int]
    cut: list[int]  # bins up to this one go left
    value: list[float]
    rows: list[int]
    gain: list[float]

    def walk(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """The node that each row reaches after `levels` levels, or the leaf before."""
        feature, cut = np.array(self.feature), np.array(self.cut)
        node = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins))
        for _ in range(levels):
            own = feature[node]
            node = np.where(own < 0, node, 2 * node + 1 + (bins[rows, np.maximum(own, 0)] > cut[node]))
        return node

    def values(self, bins: np.ndarray, depth: int) -> np.ndarray:
        return np.array(self.value)[self.walk(bins, depth)]

    def reached(self, levels: int) -> list[int]:
        """For each of the 2 ** levels ways down, left first: the node at its end, or the leaf before."""
        ends = [0]
        for _ in range(levels):
            ends = [child for node in ends for child in ((2 * node + 1, 2 * node + 2) if self.feature[node] >= 0 else (node, node))]
        return ends

    def ways(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """The way down that each row takes (see `reached`); `bins` by feature.  Below a leaf it goes left.

        Whole columns are compared for every split, which for the few splits of a level is faster than looking up each row's own.
        """
        way = np.zeros(bins.shape[1], np.uint8 if levels <= 8 else np.uint32)
        for level in range(levels):
            right = np.zeros(len(way), bool)
            for place in range(1 << level):
                node = (1 << level) - 1 + place
                if self.feature[node] >= 0:
                    right |= (way == place) & (bins[self.feature[node]] > self.cut[node])
            way = (way << 1) | right
        return way

    def steps(self, bins: np.ndarray, setting: Setting) -> np.ndarray:
        """What the tree adds to the score of each row; `bins` by feature."""
        return (setting.rate * np.array(self.value)[self.reached(setting.depth)])[self.ways(bins, setting.depth)]


@dataclass
class Boosted:
    """A fitted model; `ends` are the upper ends of the bins of each feature."""

    setting: Setting
    features: list[str]
    ends: list[list[float]]
    base: float
    trees: list[Tree] = field(default_factory=list)

    def predict_rows(self, x: np.ndarray, trees: int | None = None) -> np.ndarray:
        bins = binned(x, self.ends)
        out = np.full(len(x), self.base)
        for tree in self.trees[:trees]:
            out += self.setting.rate * tree.values(bins, self.setting.depth)
        return out

    def transform(self, df: DataFrame, name: str = "prediction", trees: int | None = None) -> DataFrame:
        """`df` with the prediction; NULL where a feature is missing."""

        @F.pandas_udf("double")
        def predicted(*columns: pd.Series) -> pd.Series:
            x = np.stack([c.to_numpy(np.float64) for c in columns], axis=1)
            known = np.isfinite(x).all(axis=1)
            return pd.Series(np.where(known, self.predict_rows(np.where(known[:, None], x, 0.0), trees), np.nan)).where(known, None)

        return df.withColumn(name, predicted(*[F.col(f).cast("double") for f in self.features]))

    def importance(self) -> dict[str, float]:
        """Each feature's share of what all splits gained; in a forest every tree weighs the same."""
        gained = dict.fromkeys(self.features, 0.0)
        for tree in self.trees:
            weight = (sum(tree.gain) or 1.0) if self.setting.bagged else 1.0
            for own, gain in zip(tree.feature, tree.gain):
                if own >= 0:
                    gained[self.features[own]] += gain / weight
        total = sum(gained.values()) or 1.0
        return {f: g / total for f, g in gained.items()}

    def to_json(self) -> str:
        return json.dumps({**asdict(self), "setting": asdict(self.setting)})

    @staticmethod
    def from_json(text: str) -> "Boosted":
        d = json.loads(text)
        return Boosted(Setting(**d["setting"]), d["features"], d["ends"], d["base"], [Tree(**t) for t in d["trees"]])


def binned(x: np.ndarray, ends: list[list[float]]) -> np.ndarray:
    """The bin of every value; values above the last end are in the last bin."""
    return np.stack([np.minimum(np.searchsorted(e, x[:, i], side="left"), len(e) - 1) for i, e in enumerate(ends)], axis=1).astype(np.int64)


def drawn_rows(draw: np.ndarray, tree: int, seed: int, share: float) -> np.ndarray:
    """Whether each row is drawn for a tree, by a hash of the row's own draw, the tree and the seed."""
    return np.ones(len(draw), bool) if share >= 1 else _uniform(draw, tree, seed) < share


def drawn_times(draw: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is drawn for a tree of a forest: Poisson numbers of mean 1, by the same hash."""
    return np.searchsorted(_POISSON, _uniform(draw, tree, seed), side="right").astype(np.uint8)


_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(TIMES - 1)])


def _uniform(draw: np.ndarray, tree: int, seed: int) -> np.ndarray:
    z = draw.astype(np.uint64) + np.uint64((tree * 0x9E3779B97F4A7C15 + seed * 0xD1B54A32D192ED03) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    z ^= z >> np.uint64(31)
    return (z >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def drawn_columns(count: int, tree: int, setting: Setting) -> list[int]:
    if setting.columns >= 1:
        return list(range(count))
    return sorted(random.Random(f"{setting.seed}:{tree}").sample(range(count), max(1, math.ceil(setting.columns * count))))


@dataclass
class _Fit:
    setting: Setting
    held: int  # the fold left out; -1: the test rows
    model: Boosted
    pending: list[Tree]  # trees since the last checkpoint
    growing: Tree | None = None
    columns: list[int] = field(default_factory=list)
    sums: dict[int, np.ndarray] = field(default_factory=dict)  # node: counted columns x bins x (rows, gradient)
    turn: int = 0  # the number of the growing tree

    def light(self, **kept: object) -> "_Fit":
        """What tasks need of it, without the fitted trees and the sums."""
        return replace(self, **{"model": Boosted(self.setting, [], [], self.model.base), "pending": [], "sums": {}, **kept})


@dataclass
class Fitted:
    """`models` by (setting, fold left out, -1 for the test rows); `stages` after every number of trees."""

    models: dict[tuple[str, int], Boosted]
    stages: DataFrame  # setting, fold, trees, rows, r2, mae, rmse


def _trains(held: int, fold: np.ndarray, test: np.ndarray) -> np.ndarray:
    return ~test if held < 0 else fold != held


class Counted(NamedTuple):
    """The columns that are counted, and where each feature finds its own bins in them."""

    packed: list[list[int]]  # the features of each column; of several, the first varies fastest
    sizes: list[int]  # bins of each feature
    finds: list[tuple[int, np.ndarray]]  # of each feature: its column, and its bin in every cell of that

    @staticmethod
    def of(sizes: list[int], follows: dict[tuple[int, int], np.ndarray]) -> "Counted":
        """`follows[a, b]`: the bin of b for each bin of a, where it follows from that."""
        source, codes = {}, {}
        for f in sorted(range(len(sizes)), key=lambda f: (-sizes[f], f)):
            own = next((s for s in codes if (s, f) in follows), None)
            if own is None and sizes[f] == 1 and codes:
                own = next(iter(codes))
            source[f] = (f, np.arange(sizes[f])) if own is None else (own, follows.get((own, f), np.zeros(sizes[own], np.int64)))
            if own is None:
                codes[f] = None
        packed: list[list[int]] = []
        for f in sorted(codes, key=lambda f: (sizes[f], f)):
            if packed and math.prod(sizes[g] for g in packed[-1]) * sizes[f] <= PACKED_BINS:
                packed[-1].append(f)
            else:
                packed.append([f])
        for number, own in enumerate(packed):
            cell, step = np.arange(math.prod(sizes[f] for f in own)), 1
            for f in own:
                codes[f] = number, cell // step % sizes[f]
                step *= sizes[f]
        return Counted(packed, sizes, [(codes[s][0], bins[codes[s][1]]) for s, bins in (source[f] for f in range(len(sizes)))])

    def added(self, bins: np.ndarray) -> np.ndarray:
        """`bins`, by feature, with a row for every column of several features."""
        more = []
        for own in self.packed:
            if len(own) > 1:
                cell, step = np.zeros(bins.shape[1], bins.dtype), 1
                for f in own:
                    cell += bins[f] * bins.dtype.type(step)
                    step *= self.sizes[f]
                more.append(cell)
        return np.vstack([bins, *more]) if more else bins

    def rows(self) -> list[int]:
        """Where each column lies among the rows of `added`."""
        several = iter(range(len(self.sizes), len(self.sizes) + len(self.packed)))
        return [next(several) if len(own) > 1 else own[0] for own in self.packed]

    def widths(self) -> list[int]:
        """Bins of each column."""
        return [math.prod(self.sizes[f] for f in own) for own in self.packed]

    def needed(self, columns: list[int]) -> list[int]:
        """The columns from which these features are read."""
        return sorted({self.finds[f][0] for f in columns})

    def cells(self, sums: np.ndarray) -> np.ndarray:
        """Sums of each feature's own bins, from those of the columns."""
        out = np.zeros((len(self.finds), *sums.shape[1:]), sums.dtype)
        for f, (column, bins) in enumerate(self.finds):
            if len(self.packed[column]) == 1 and self.packed[column][0] == f:
                out[f, : len(bins)] = sums[column, : len(bins)]
            else:
                np.add.at(out[f], bins, sums[column, : len(bins)])
        return out


def _following(rows: DataFrame, ends: list[list[float]]) -> dict[tuple[int, int], np.ndarray]:
    """The bin of b for each bin of a, for all pairs of features where every row agrees on it: one pass over the rows."""
    sizes = [len(e) for e in ends]
    if len(ends) > PAIRED:
        return {}
    pairs = [(a, b) for b in range(len(ends)) for a in range(b) if min(sizes[a], sizes[b]) > 1 and sizes[a] * sizes[b] <= PAIR_CELLS]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = [np.zeros(sizes[a] * sizes[b], bool) for a, b in pairs]
        for x in _batched(batches, lambda batch: (batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1),)):
            bins = binned(x[0], ends).T
            for seen, (a, b) in zip(met, pairs):
                seen |= np.bincount(bins[a] * sizes[b] + bins[b], minlength=len(seen)) > 0
        out = [np.zeros((0, 5), np.int64)]
        for seen, (a, b) in zip(met, pairs):
            for one, other, table in ((a, b, seen.reshape(sizes[a], -1)), (b, a, seen.reshape(sizes[a], -1).T)):
                own = np.flatnonzero(table.any(axis=1))
                low, high = table[own].argmax(axis=1), table.shape[1] - 1 - table[own][:, ::-1].argmax(axis=1)
                out.append(np.stack([np.full(len(own), one), np.full(len(own), other), own, low, high], axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.concatenate(out).T], ["a", "b", "bin", "low", "high"])

    if not pairs:
        return {}
    seen = rows.select("x").mapInArrow(work, "a long, b long, bin long, low long, high long").groupBy("a", "b", "bin").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    a, b, own, low, high = _columns(seen, "a", "b", "bin", "low", "high")
    found: dict[tuple[int, int], np.ndarray] = {}
    for pair in {(i, j) for one in pairs for i, j in (one, one[::-1])}:
        which = (a == pair[0]) & (b == pair[1])
        if (low[which] == high[which]).all():
            found[pair] = np.zeros(sizes[pair[0]], np.int64)
            found[pair][own[which]] = low[which]
    return found


def _columns(df: DataFrame, *names: str) -> list[np.ndarray]:
    table = df.toArrow()
    return [table[n].to_numpy() for n in names]


def _batched(batches: Iterator[pa.RecordBatch], arrays: Callable[[pa.RecordBatch], tuple[np.ndarray, ...]]) -> Iterator[tuple[np.ndarray, ...]]:
    """Columns of about `BLOCK_ROWS` rows at a time, from batches of any size."""
    held: list[tuple[np.ndarray, ...]] = []
    count = 0
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            part = arrays(batch.slice(at, BLOCK_ROWS))
            if held and count + len(part[0]) > BLOCK_ROWS:
                yield tuple(map(np.concatenate, zip(*held)))
                held, count = [], 0
            held.append(part)
            count += len(part[0])
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


_STATE = "bins binary, label binary, fold binary, test binary, draw binary, scores binary"


class _Block(NamedTuple):
    """Some rows of the state."""

    bins: np.ndarray  # features, and columns of several, x rows
    label: np.ndarray
    fold: np.ndarray
    test: np.ndarray
    draw: np.ndarray
    scores: np.ndarray  # fits x rows; none before the first checkpoint

    @staticmethod
    def kinds(widest: int) -> list[type]:
        return [np.uint8 if widest <= 256 else np.uint16, np.float64, np.int32, np.bool_, np.int64, np.float64]


def _packed(blocks: Iterator[_Block], widest: int) -> Iterator[pa.RecordBatch]:
    for block in blocks:
        yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(c, k).tobytes()]) for c, k in zip(block, _Block.kinds(widest))], list(_Block._fields))


def _blocks(batches: Iterator[pa.RecordBatch], widest: int) -> Iterator[_Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            columns = [np.frombuffer(batch.column(c)[i].as_buffer(), k) for c, k in zip(_Block._fields, _Block.kinds(widest))]
            rows = len(columns[1])
            yield _Block(columns[0].reshape(-1, rows), *columns[1:5], columns[5].reshape(-1, rows))


def _merged(blocks: Iterator[_Block]) -> Iterator[_Block]:
    """Blocks of `FOREST_BLOCK_ROWS` rows, about: a pass over the many cells of a forest's level should serve many rows."""
    held: list[_Block] = []
    for block in blocks:
        if held and sum(len(b.label) for b in held) + len(block.label) > FOREST_BLOCK_ROWS:
            yield _Block(*[np.concatenate(c, axis=-1) for c in zip(*held)])
            held = []
        held.append(block)
    if held:
        yield _Block(*[np.concatenate(c, axis=-1) for c in zip(*held)])


def fit_all(
    df: DataFrame, features: list[str], target: str, settings: list[Setting], fold: Column | None = None, folds: int = 0, test: Column | None = None,
    keys: list[str] | None = None, bins: int = 256,
) -> Fitted:
    """Fit every setting without the test rows, and without each fold; score it on the rows left out after every tree.

    `keys` name a row (all columns by default): rows are drawn by them.  Rows with a missing feature or target go.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    importable_in_workers(spark)
    clean = drop_unusable(require_columns(df, [*features, target]), [*features, target])
    rows = clean.select(
        F.array(*[F.col(f).cast("double") for f in features]).alias("x"), F.col(target).cast("double").alias("label"),
        (fold if fold is not None else F.lit(-2)).cast("int").alias("fold"), F.coalesce(test if test is not None else F.lit(False), F.lit(False)).alias("test"),
        F.xxhash64(*[F.col(c) for c in (keys or df.columns)]).alias("draw"),
    ).checkpoint()
    count, low, high = rows.agg(F.count(F.lit(1)), F.min("label"), F.max("label")).first()
    tasks = max(LEAST_TASKS, -(-count // ROWS_PER_TASK))
    helds = [-1, *range(folds)]
    if not count:
        return Fitted({}, spark.createDataFrame([], _STAGES))
    values = rows.select(F.posexplode("x").alias("feature", "_v")).groupBy("feature", "_v").agg(F.count(F.lit(1)).alias("_n"))
    found = quantile_bins(values, "feature", bins)
    ends = [found[i] for i in range(len(features))]
    widest = max(map(len, ends))

    # labels as whole multiples of `unit`: means and gradients are exact sums
    unit = 2.0 ** (math.ceil(math.log2(max(high - low, abs(high), abs(low), 1e-300))) - GRADIENT_BITS)
    whole = F.round(F.col("label") / F.lit(unit)).cast("decimal(20,0)")
    means = rows.groupBy("fold", "test").agg(F.sum(whole).alias("s"), F.count(F.lit(1)).alias("n")).collect()  # a row for each fold, twice

    def mean(held: int | None) -> float:
        own = [r for r in means if held is None or (not r["test"] if held < 0 else r["fold"] != held)]
        return float(sum(r["s"] for r in own)) * unit / max(1, sum(r["n"] for r in own))

    # trees of a forest fit the distance from any one value; that all its fits share theirs lets them share sums
    fits = [_Fit(s, held, Boosted(s, features, ends, mean(None if s.bagged else held)), []) for s in settings for held in helds]
    counted = Counted.of([len(e) for e in ends], _following(rows, ends))
    widest = max(widest, *counted.widths())

    def arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
        return x, *[batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "fold", "test", "draw")]

    def prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
        for x, *plain in _batched(batches, arrays):
            yield _Block(counted.added(binned(x, ends).T), *plain, np.zeros((0, len(x))))

    # dealt in turn, so that rows of one key do not share a task
    state = rows.repartition(tasks).mapInArrow(lambda batches: _packed(prepared(batches), widest), _STATE).checkpoint()
    stages = _forests(state, [f for f in fits if f.setting.bagged], counted, widest, unit, count)
    every, fits = fits, [f for f in fits if not f.setting.bagged]
    last = max((f.setting.trees for f in fits), default=0)
    cells = sum(counted.widths())
    for turn in range(last):
        live = [f for f in fits if turn < f.setting.trees]
        for fit in live:
            size = (2 << fit.setting.depth) - 1
            fit.growing = Tree([-1] * size, [0] * size, [0.0] * size, [0] * size, [0.0] * size)
            fit.columns, fit.sums = drawn_columns(len(features), turn, fit.setting), {}
        for level in range(max(f.setting.depth for f in live)):
            _grow(state, fits, live, turn, level, counted, widest, unit, tasks * cells)
        for fit in live:
            fit.model.trees.append(fit.growing)
            fit.pending.append(fit.growing)
            fit.growing, fit.sums = None, {}
        if (turn + 1) % REFRESH == 0 or turn + 1 == last:
            stages += _staged(state, fits, widest)
            if turn + 1 < last:
                state = _advanced(state, fits, widest).checkpoint()
            for fit in fits:
                fit.pending = []
    return Fitted({(f.setting.name, f.held): f.model for f in every}, spark.createDataFrame(stages, _STAGES))


_STAGES = "setting string, fold int, trees int, rows long, r2 double, mae double, rmse double"


def best_stage(stages: DataFrame) -> DataFrame:
    """(setting, trees, folds, cv_r2, cv_std), one row: the setting and number of trees with the highest mean score over the folds.

    Among equal scores the fewest trees, then the first name.  A stage counts if every fold of its setting has a score.
    """
    scored = stages.filter("fold >= 0").groupBy("setting", "trees").agg(
        F.count("r2").alias("folds"), F.avg("r2").alias("cv_r2"), F.stddev_pop("r2").alias("cv_std")
    )
    whole = stages.filter("fold >= 0").groupBy("setting").agg(F.countDistinct("fold").alias("_folds"))
    complete = scored.join(F.broadcast(whole), "setting").filter(F.col("folds") == F.col("_folds")).drop("_folds")  # a row for each setting
    return complete.orderBy(F.desc("cv_r2"), "trees", "setting").limit(1)


def _kept(block: _Block, number: int, fit: _Fit, rows: np.ndarray) -> np.ndarray:
    """Scores of a fit at the last checkpoint, of some rows."""
    return block.scores[number][rows] if len(block.scores) else np.full(len(rows), fit.model.base)


def _score(block: _Block, number: int, fit: _Fit, rows: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """Scores of a fit with its pending trees, of some rows and their bins."""
    score = _kept(block, number, fit, rows)
    for tree in fit.pending:
        score += tree.steps(bins, fit.setting)
    return score


def _growing(live: list[_Fit], level: int) -> list[_Fit]:
    """The fits whose tree has nodes on this level."""
    nodes = range((1 << level) - 1, (2 << level) - 1)
    return [f for f in live if level < f.setting.depth and (level == 0 or any(f.growing.feature[(n - 1) // 2] >= 0 for n in nodes))]


def _grow(state: DataFrame, fits: list[_Fit], live: list[_Fit], turn: int, level: int, columns: Counted, widest: int, unit: float, task_cells: int) -> None:
    """Count one level of every growing tree and split its nodes; tasks hand on up to `task_cells` cells for each fit and node."""
    index = {id(f): i for i, f in enumerate(fits)}
    active = _growing(live, level)
    if not active:
        return
    numbers = [index[id(f)] for f in active]
    first, counted = (1 << level) - 1, max(1, (1 << level) // 2)  # the root, else left children
    light = [f.light(pending=f.pending) for f in active]
    features, lies, needed = len(columns.packed), columns.rows(), [columns.needed(f.columns) for f in active]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(light), counted, features, widest, 2), np.int64)
        lefts = [np.array([node >= first and (level == 0 or node % 2 == 1) for node in f.growing.reached(level)]) for f in light]
        for block in _blocks(batches, widest):
            trains: dict[int, np.ndarray] = {}
            drawn: dict[tuple[int, float], np.ndarray] = {}
            for place, (fit, number, left) in enumerate(zip(light, numbers, lefts)):
                draw = fit.setting.seed, fit.setting.subsample
                if draw not in drawn:
                    drawn[draw] = drawn_rows(block.draw, turn, *draw)
                if fit.held not in trains:
                    trains[fit.held] = _trains(fit.held, block.fold, block.test)
                way = fit.growing.ways(block.bins, level)
                rows = np.flatnonzero(trains[fit.held] & drawn[draw] & left[way])
                bins = block.bins[:, rows]
                gradient = np.rint((block.label[rows] - _score(block, number, fit, rows, bins)) / unit)
                node = way[rows].astype(np.intp) // (2 if level else 1) * widest
                for column in needed[place]:
                    cell = node + bins[lies[column]]
                    total[place, :, column, :, 0] += np.bincount(cell, minlength=counted * widest).reshape(counted, widest)
                    total[place, :, column, :, 1] += np.bincount(cell, gradient, counted * widest).astype(np.int64).reshape(counted, widest)
        flat = total.reshape(-1, 2)
        place = np.flatnonzero(flat[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(flat[place, 0]), pa.array(flat[place, 1])], ["place", "n", "g"])

    parts = state.mapInArrow(work, "place long, n long, g long")
    if task_cells * len(active) * counted > DRIVER_CELLS:
        parts = parts.groupBy("place").agg(F.sum("n").alias("n"), F.sum("g").alias("g"))
    sums = parts.toArrow()
    flat = np.zeros((2, len(numbers) * counted * features * widest), np.int64)
    for own, name in zip(flat, ("n", "g")):
        np.add.at(own, sums["place"].to_numpy(), sums[name].to_numpy())
    cells = flat.T.reshape(len(numbers), counted, features, widest, 2)
    for own, fit in zip(cells, active):
        tree = fit.growing
        if level == 0:
            fit.sums = {0: own[0]}
        else:
            parents, fit.sums = fit.sums, {}
            for i, left in enumerate(own):
                parent = (first + 2 * i - 1) // 2
                if tree.feature[parent] >= 0:
                    fit.sums[first + 2 * i], fit.sums[first + 2 * i + 1] = left, parents[parent] - left
        for node, cell in fit.sums.items():
            _split(tree, node, _best(columns.cells(cell), fit.columns, fit.setting, unit), fit.setting, unit)


class _Best(NamedTuple):
    """What is known of a node: its rows and gradient, and those of the left side of its best split, if it has one."""

    n: int
    g: int
    gain: float
    column: int
    cut: int
    rows: int
    gradient: int


def _best(cells: np.ndarray, columns: list[int], setting: Setting, unit: float) -> _Best:
    """The best split of a node; ties go to the first feature and the lowest cut."""
    n, g = (int(x) for x in cells[columns[0]].sum(axis=0))
    if n < max(2, setting.least_rows):
        return _Best(n, g, 0.0, -1, 0, 0, 0)
    best = (0.0, -1, 0, 0, 0)
    own = (g * unit) ** 2 / (n + setting.penalty)
    left = cells[columns].cumsum(axis=1)
    rows, gradient = left[:, :, 0].astype(np.float64), left[:, :, 1] * unit
    with np.errstate(divide="ignore", invalid="ignore"):
        gains = gradient**2 / (rows + setting.penalty) + (g * unit - gradient) ** 2 / (n - rows + setting.penalty) - own
    gains[(rows == 0) | (rows == n)] = -np.inf
    for i, (column, cut) in enumerate(zip(columns, gains.argmax(axis=1).tolist())):
        if gains[i, cut] > best[0] + 1e-12 * own:
            best = (float(gains[i, cut]), column, cut, int(left[i, cut, 0]), int(left[i, cut, 1]))
    return _Best(n, g, *best)


def _split(tree: Tree, node: int, best: _Best, setting: Setting, unit: float) -> None:
    """Value of the node, its split and the values of its sides."""
    def put(at: int, rows: int, gradient: int) -> None:
        tree.rows[at], tree.value[at] = rows, gradient * unit / (rows + setting.penalty) if rows + setting.penalty else 0.0

    put(node, best.n, best.g)
    if best.column >= 0:
        tree.feature[node], tree.cut[node], tree.gain[node] = best.column, best.cut, best.gain
        put(2 * node + 1, best.rows, best.gradient)
        put(2 * node + 2, best.n - best.rows, best.g - best.gradient)


def _staged(state: DataFrame, fits: list[_Fit], widest: int) -> list[tuple]:
    """Scores on the rows left out after each pending tree, from the state before them: one pass for all."""
    light = [f.light(pending=f.pending) for f in fits]
    longest = max(len(f.pending) for f in fits)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(light), longest, 5))
        for block in _blocks(batches, widest):
            out = {held: np.flatnonzero(~_trains(held, block.fold, block.test)) for held in {f.held for f in light}}
            bins = {held: block.bins[:, rows] for held, rows in out.items()}
            for i, fit in enumerate(light):
                rows = out[fit.held]
                score, y = _kept(block, i, fit, rows), block.label[rows]
                for t, tree in enumerate(fit.pending):
                    score += tree.steps(bins[fit.held], fit.setting)
                    total[i, t] += _errors(score, y, fit.model.base)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["place", "total"])

    total = np.zeros(len(fits) * longest * 5)
    for row in state.mapInArrow(work, "place long, total double").groupBy("place").agg(F.sum("total").alias("total")).collect():
        total[row["place"]] = row["total"]
    total = total.reshape(len(fits), longest, 5)
    out = []
    for i, fit in enumerate(fits):
        before = len(fit.model.trees) - len(fit.pending)
        for t in range(len(fit.pending)):
            out += _stage(fit, before + t + 1, total[i, t])
    return out


def _errors(score: np.ndarray, y: np.ndarray, base: float) -> list[float]:
    error = score - y
    return [len(y), (error * error).sum(), np.abs(error).sum(), (y - base).sum(), ((y - base) ** 2).sum()]


def _stage(fit: _Fit, trees: int, sums: np.ndarray) -> list[tuple]:
    """The row of `Fitted.stages` from sums of errors; none without rows left out."""
    n, squares, absolute, y, yy = sums
    if not n:
        return []
    spread = yy - y * y / n
    r2 = float(1 - squares / spread) if spread > 1e-12 * max(yy, 1e-300) else None
    return [(fit.setting.name, fit.held, trees, int(n), r2, float(absolute / n), float(math.sqrt(squares / n)))]


def _advanced(state: DataFrame, fits: list[_Fit], widest: int) -> DataFrame:
    """The state with the pending trees in its scores."""
    light = [f.light(pending=f.pending) for f in fits]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
        for block in _blocks(batches, widest):
            every = np.arange(len(block.label))
            yield block._replace(scores=np.stack([_score(block, number, fit, every, block.bins) for number, fit in enumerate(light)]))

    return state.mapInArrow(lambda batches: _packed(work(batches), widest), _STATE)


def _kinds(trains: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The kind of each row by the fits that train on it, -1 if none does; and for each kind, which fits those are."""
    code = np.zeros(len(trains[0]), np.intp)
    for i, own in enumerate(trains):
        code |= own.astype(np.intp) << i
    met = np.unique(code)
    met = met[met > 0]
    kind = np.full((1 << len(trains)), -1, np.int16)
    kind[met] = np.arange(len(met))
    return kind[code], (met[:, None] >> np.arange(len(trains)) & 1).astype(bool).reshape(-1, len(trains))


def _forests(state: DataFrame, fits: list[_Fit], columns: Counted, widest: int, unit: float, count: int) -> list[tuple]:
    """Grow the trees of all forests level by level, as many at a time as a task can count, and score the forests on the rows left out."""
    if not fits:
        return []
    tasks = min(max(LEAST_TASKS, -(-count // ROWS_PER_TASK)), max(state.sparkSession.sparkContext.defaultParallelism, -(-count // FOREST_ROWS_PER_TASK)))
    few = state.coalesce(tasks)
    live = []
    for turn in range(max(f.setting.trees for f in fits)):
        for fit in (f for f in fits if turn < f.setting.trees):
            size = (2 << fit.setting.depth) - 1
            fit.model.trees.append(Tree([-1] * size, [0] * size, [0.0] * size, [0] * size, [0.0] * size))
            live.append(replace(fit, growing=fit.model.trees[-1], columns=drawn_columns(len(columns.sizes), turn, fit.setting), sums={}, turn=turn))
    for level in range(max(f.setting.depth for f in fits)):
        active = _growing(live, level)
        at_once = max(1, FOREST_CELLS // ((1 << level) * sum(columns.widths())))
        for start in range(0, len(active), at_once):
            _grow_bagged(few, active[start : start + at_once], level, columns, widest, unit, tasks)
    return _forest_stages(few, fits, widest)


def _grow_bagged(state: DataFrame, active: list[_Fit], level: int, columns: Counted, widest: int, unit: float, tasks: int) -> None:
    """Count one level of some trees; tasks hand on one row for each node, and those that add them up find its split."""
    first, width = (1 << level) - 1, 1 << level
    sizes = columns.widths()
    starts = np.cumsum([0, *sizes])
    light, lies, needed = [f.light() for f in active], columns.rows(), [columns.needed(f.columns) for f in active]
    alike: dict[tuple, list[int]] = {}  # fits whose trees have the same rows to draw from and the same splits so far
    for place, fit in enumerate(light):
        splits = tuple(fit.growing.feature[:first]), tuple(fit.growing.cut[:first])
        alike.setdefault((fit.turn, fit.setting.seed, fit.setting.name, fit.held // ALIKE, splits, tuple(fit.columns)), []).append(place)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, len(light), width, starts[-1]), np.int64)
        centre = light[0].model.base
        for block in _merged(_blocks(batches, widest)):
            whole = np.rint((block.label - centre) / unit)
            times: dict[tuple[int, int], np.ndarray] = {}
            kinds: dict[tuple[int, ...], tuple[np.ndarray, np.ndarray]] = {}
            for (turn, seed, *_), places in alike.items():
                if (turn, seed) not in times:
                    times = {(turn, seed): drawn_times(block.draw, turn, seed)}
                helds = tuple(light[p].held for p in places)
                if helds not in kinds:
                    kinds[helds] = _kinds([_trains(held, block.fold, block.test) for held in helds])
                kind, trained = kinds[helds]
                tree, often = light[places[0]].growing, times[turn, seed]
                way = tree.ways(block.bins, level)
                rows = np.flatnonzero((often > 0) & (kind >= 0) & (np.array(tree.reached(level)) >= first)[way])
                bins, often = block.bins[:, rows], often[rows].astype(np.float64)
                gradient = whole[rows] * often
                node = kind[rows].astype(np.intp) * width + way[rows]
                for column in needed[places[0]]:
                    size, at = sizes[column], starts[column]
                    cell = node * size + bins[lies[column]]
                    for own, weight in zip(total, (often, gradient)):
                        sums = np.bincount(cell, weight, len(trained) * width * size).astype(np.int64).reshape(-1, width, size)
                        for place, takes in zip(places, trained.T):
                            own[place, :, at : at + size] += sums[0] if len(trained) == 1 else sums[takes].sum(axis=0)
        for place in range(len(light)):
            nodes = np.flatnonzero(total[0, place].any(axis=1))
            packed = [pa.array([own[place, n].astype(k).tobytes() for n in nodes], pa.binary()) for own, k in zip(total, (np.uint32, np.int64))]
            yield pa.RecordBatch.from_arrays([pa.array(place * width + nodes), *packed], ["place", "n", "g"])

    kinds = [(f.columns, f.setting) for f in active]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, place in enumerate(batch.column("place").to_pylist()):
                own = found.setdefault(place, np.zeros((starts[-1], 2), np.int64))
                for side, (name, kind) in enumerate((("n", np.uint32), ("g", np.int64))):
                    own[:, side] += np.frombuffer(batch.column(name)[i].as_buffer(), kind)
        best = []
        for place, own in found.items():
            cells = np.zeros((len(sizes), widest, 2), np.int64)
            for column, size in enumerate(sizes):
                cells[column, :size] = own[starts[column] : starts[column + 1]]
            best.append((place, *_best(columns.cells(cells), *kinds[place // width], unit)))
        yield pa.RecordBatch.from_pylist([dict(zip(kept.names, row)) for row in best], kept)

    kept = pa.schema([("place", pa.int64()), *[(n, pa.float64() if n == "gain" else pa.int64()) for n in _Best._fields]])
    told = ", ".join(["place long", *[f"`{n}` {'double' if n == 'gain' else 'long'}" for n in _Best._fields]])
    parts = state.mapInArrow(work, "place long, n binary, g binary").repartition(tasks, "place").mapInArrow(split, told)
    for row in parts.collect():
        fit = active[row["place"] // width]
        _split(fit.growing, first + row["place"] % width, _Best(*row[1:]), fit.setting, unit)


def _forest_stages(state: DataFrame, fits: list[_Fit], widest: int) -> list[tuple]:
    """Scores on the rows left out, with all trees: one pass for all fits."""
    light = [f.light(pending=f.model.trees) for f in fits]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(light), 5))
        for block in _merged(_blocks(batches, widest)):
            for i, fit in enumerate(light):
                rows = np.flatnonzero(~_trains(fit.held, block.fold, block.test))
                bins, score = block.bins[:, rows], np.full(len(rows), fit.model.base)
                for tree in fit.pending:
                    score += tree.steps(bins, fit.setting)
                total[i] += _errors(score, block.label[rows], fit.model.base)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["place", "total"])

    total = np.zeros(len(fits) * 5)
    for row in state.mapInArrow(work, "place long, total double").groupBy("place").agg(F.sum("total").alias("total")).collect():
        total[row["place"]] = row["total"]
    return [row for fit, sums in zip(fits, total.reshape(-1, 5)) for row in _stage(fit, len(fit.model.trees), sums)]

"""Train/test and fold assignment from a hash of the row key: the same on any cluster and after any retry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.cuts import cut_points, is_before
from ..session import ensure_checkpoint_dir

SEED = 42


def bucket(keys: list[str], buckets: int, seed: int = SEED) -> Column:
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")


def with_split(df: DataFrame, keys: list[str], test_pct: int = 20, seed: int = SEED) -> DataFrame:
    if not 10 <= test_pct <= 40:
        raise ValueError("the test share is 10 to 40 percent")
    return df.withColumn("is_test", bucket(keys, 100, seed) < test_pct)


def with_fold(df: DataFrame, keys: list[str], folds: int = 5, seed: int = SEED) -> DataFrame:
    """Fold numbers from another hash than the split, so that the two are independent."""
    if not 3 <= folds <= 10:
        raise ValueError("3 to 10 folds")
    return df.withColumn("fold", bucket(keys, folds, seed + 1))


def _drawn(df: DataFrame, keys: list[str], seed: int) -> tuple[DataFrame, list[str]]:
    """`df` with a seeded order of its rows: 120 bits of a hash of the key, then a hash of the whole row."""
    text = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("<null>")) for k in keys]))
    order = ["_draw0", "_draw1", "_draw2"]
    digits = [F.conv(F.substring(text, at, 15), 16, 10).cast("long") for at in (1, 16)]
    return df.withColumns(dict(zip(order, [*digits, F.shiftright(F.xxhash64(*df.columns), 2)]))), order


def _first_rows(df: DataFrame, keys: list[str], seed: int, counts: list[int]) -> tuple[DataFrame, list[str], list]:
    """The seeded order, and for each count the cut behind exactly so many rows."""
    ensure_checkpoint_dir(df.sparkSession)
    placed, order = _drawn(df, keys, seed)
    # three numbers a row, written once: every step of the search reads them
    cuts = cut_points(placed.select(*order).checkpoint(), order, [(0, c) for c in counts])
    if any(cut.at is not None and cut.before < c for c, cut in zip(counts, cuts)):  # equal rows on both sides of a cut
        placed, order = placed.withColumn("_draw3", F.monotonically_increasing_id()).checkpoint(), [*order, "_draw3"]
        cuts = cut_points(placed.select(*order), order, [(0, c) for c in counts])
    return placed, order, cuts


def with_exact_split(df: DataFrame, keys: list[str], test_pct: int = 20, seed: int = SEED) -> DataFrame:
    """`is_test` for exactly the given share of the rows, rounded up: those that come first in a seeded order.

    The last of them is found by counting ranges of the order; rows are neither sorted nor moved, and where they lie
    does not matter.  `keys` should name a row; rows of one key are ordered by their content, and equal rows
    are interchangeable.  `df` is read more than once.
    """
    if not 10 <= test_pct <= 40:
        raise ValueError("the test share is 10 to 40 percent")
    wanted = -(-df.count() * test_pct // 100)
    placed, order, (cut,) = _first_rows(df, keys, seed, [wanted])
    inside = F.lit(True) if cut.at is None else is_before([F.col(c) for c in order], [F.lit(v) for v in cut.at])
    return placed.withColumn("is_test", inside).drop(*order)


def with_exact_folds(df: DataFrame, keys: list[str], folds: int = 5, seed: int = SEED) -> DataFrame:
    """`fold` numbers whose sizes differ by one row at most, the larger ones first, from another order than the split."""
    if not 3 <= folds <= 10:
        raise ValueError("3 to 10 folds")
    total = df.count()
    ends = [sum(total // folds + (i < total % folds) for i in range(k + 1)) for k in range(folds - 1)]
    placed, order, cuts = _first_rows(df, keys, seed + 1, ends)
    fold = F.lit(folds - 1)
    for number, cut in reversed(list(enumerate(cuts))):
        inside = F.lit(True) if cut.at is None else is_before([F.col(c) for c in order], [F.lit(v) for v in cut.at])
        fold = F.when(inside, number).otherwise(fold)
    return placed.withColumn("fold", fold.cast("int")).drop(*order)

"""Vectors of whole numbers: exact arithmetic for operators whose results must not depend on the order of sums."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import stored

LIMIT = 1 << 26  # largest component: sums of squares over 512 dimensions stay below 2 ** 63
FLOAT_EXACT = 1 << 53


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_vectors(df: DataFrame, columns: dict[str, Column], vector: str, scale: int) -> tuple[DataFrame, int, int]:
    """Stored rows of `columns` and `v`, the array of floor(scale * x), the length of the vectors (0: no rows),
    and the largest absolute component.

    Rows whose vector is NULL, empty, or holds NULL or non-finite components are left out, and so are those of
    another length than most (the longer one, if as many).  Components beyond `LIMIT` raise a ValueError: sums
    over them would not be exact.
    """
    x = quoted(vector).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    bound = float(LIMIT + 1)
    whole = F.transform(x, lambda c: F.greatest(F.least(F.floor(c * F.lit(float(scale))).cast("double"), F.lit(bound)), F.lit(-bound)).cast("int"))
    rows = stored(df.filter(x.isNotNull() & (F.size(x) > 0) & finite).select(*[c.alias(n) for n, c in columns.items()], whole.alias("v")))
    largest = F.array_max(F.transform("v", lambda c: F.abs(c)))
    lengths = rows.groupBy(F.size("v").alias("length")).agg(F.count(F.lit(1)).alias("rows"), F.max(largest).alias("largest"))
    usual = lengths.orderBy(F.col("rows").desc(), F.col("length").desc()).first()
    if usual is None:
        return rows, 0, 0
    if usual["largest"] > LIMIT:
        raise ValueError(f"components beyond {LIMIT} / {scale} cannot be summed exactly")
    return rows.filter(F.size("v") == usual["length"]), usual["length"], usual["largest"]


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column without NULLs, all of one length."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two matrices of whole numbers, as int64."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if most < FLOAT_EXACT:  # every partial sum is a whole number that a double holds
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared Euclidean distances of the rows of two matrices of whole numbers, as int64."""
    one, two = a.astype(np.int64), b.astype(np.int64)
    return (one * one).sum(axis=1)[:, None] + (two * two).sum(axis=1)[None] - 2 * products(one, two)

"""Ridge regression for all folds and penalties from one pass over the rows.

All that least squares need of a fold are its moments: how many rows, sums, and sums of products.  Tasks add them up
for every fold; the moments of the training rows of a fold are those of all rows less its own.  A fit is the solution
of a small system on the driver, and its score on the fold left out follows from that fold's moments.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.cleaning import drop_unusable, require_columns
from ..session import importable_in_workers

ALPHAS = [0.01, 0.1, 1.0, 10.0, 100.0]
SCHEMA = "fold int, alpha double, rows_train long, rows_test long, intercept double, coefficients array<double>, r2 double"


def fold_moments(df: DataFrame, features: list[str], target: str, fold: Column, folds: int) -> tuple[np.ndarray, np.ndarray]:
    """(folds x n x n sums of products of (1, features..., target) less `pivot`, pivot).

    The pivot, one row of the table, keeps the sums small where values are far from zero.
    """
    importable_in_workers(df.sparkSession)
    names = [*features, target]
    clean = drop_unusable(require_columns(df, names), names)
    rows = clean.select(fold.cast("int").alias("fold"), F.array(*[F.col(c).cast("double") for c in names]).alias("x")).filter(F.col("fold").between(0, folds - 1))
    first = rows.first()
    width = len(names) + 1
    pivot = np.array(first["x"] if first else [0.0] * len(names))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((folds, width, width))
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1) - pivot
                z = np.hstack([np.ones((len(x), 1)), x])
                own = batch.column("fold").to_numpy()
                for k in range(folds):
                    total[k] += z[own == k].T @ z[own == k]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["place", "total"])

    total = np.zeros(folds * width * width)
    for row in rows.mapInArrow(work, "place long, total double").groupBy("place").agg(F.sum("total").alias("total")).collect():
        total[row["place"]] = row["total"]
    return total.reshape(folds, width, width), pivot


def solve(moments: np.ndarray, alpha: float) -> tuple[float, np.ndarray]:
    """(intercept, coefficients) around the pivot; the intercept is not penalised."""
    n = moments[0, 0]
    mean = moments[0, 1:] / n
    centred = moments[1:, 1:] - n * np.outer(mean, mean)
    penalised = centred[:-1, :-1] + alpha * np.eye(len(mean) - 1)
    coefficients = np.linalg.lstsq(penalised, centred[:-1, -1], rcond=None)[0]
    return float(mean[-1] - mean[:-1] @ coefficients), coefficients


def squared_error(moments: np.ndarray, intercept: float, coefficients: np.ndarray) -> tuple[float, float]:
    """Sums of squares over the rows of these moments: of the errors of a model, and around the mean of the target."""
    weights = np.concatenate([[-intercept], -coefficients, [1.0]])
    return float(weights @ moments @ weights), float(moments[-1, -1] - moments[0, -1] ** 2 / moments[0, 0])


def ridge_folds(df: DataFrame, features: list[str], target: str, fold: Column, folds: int, alphas: list[float] | None = None) -> DataFrame:
    """One row for each fold and penalty: the model fitted without the fold, and its score on it.

    Rows with a missing value or fold take no part; r2 is NULL for a fold whose target does not vary; folds that leave
    no row to train on, or have none, give no row.
    """
    moments, pivot = fold_moments(df, features, target, fold, folds)
    every, out = moments.sum(axis=0), []
    for k in range(folds):
        train = every - moments[k]
        if round(train[0, 0]) < 1 or moments[k][0, 0] < 1:
            continue
        for alpha in alphas or ALPHAS:
            intercept, coefficients = solve(train, alpha)
            errors, spread = squared_error(moments[k], intercept, coefficients)
            r2 = 1 - errors / spread if spread > 1e-12 * max(moments[k][-1, -1], 1e-300) else None
            shifted = float(intercept + pivot[-1] - pivot[:-1] @ coefficients)
            out.append((k, float(alpha), round(train[0, 0]), round(moments[k][0, 0]), shifted, coefficients.tolist(), r2))
    return df.sparkSession.createDataFrame(out, SCHEMA)

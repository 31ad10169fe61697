"""Regression metrics as one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import round_half_up
from ..operators.statistics import histogram


def regression_metrics(
    df: DataFrame, label: str, prediction: str, by: list[str] | None = None, digits: int = 4
) -> DataFrame:
    """(by..., rows, r2, mae, rmse); r2 is NULL where the label does not vary."""
    error = F.col(prediction) - F.col(label)
    stats = df.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(error * error).alias("_sse"),
        F.sum(F.abs(error)).alias("_sae"),
        F.var_pop(label).alias("_var"),
    )

    def rounded(value: Column, name: str) -> Column:
        return round_half_up(value, digits).alias(name)

    r2 = F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("_var") * F.col("rows"))
    return stats.select(
        *(by or []),
        "rows",
        rounded(r2, "r2"),
        rounded(F.try_divide(F.col("_sae"), F.col("rows")), "mae"),
        rounded(F.sqrt(F.try_divide(F.col("_sse"), F.col("rows"))), "rmse"),
    )


def residuals(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Actual, predicted, and their difference."""
    return df.withColumn("residual", F.col(prediction) - F.col(label))


def residual_histogram(df: DataFrame, label: str, prediction: str, bins: int = 20) -> DataFrame:
    return histogram(residuals(df, label, prediction), "residual", bins)

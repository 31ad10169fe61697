"""Pivots, correlation, histograms, rankings and group statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import as_col, finite_or_null, nan_to_null


def pivot_mean(
    df: DataFrame, index: str, column: str, values: list, measure: Column | str, fill: float | None = None
) -> DataFrame:
    """Mean of `measure` per index and pivot value; the value list is given, so no pass to find it.

    One conditional aggregate per pivot value: a single hash aggregation with map-side combine.
    """
    def cell(v: object) -> Column:
        mean = F.avg(F.when(F.col(column) == F.lit(v), nan_to_null(as_col(measure).cast("double"))))
        return (mean if fill is None else F.coalesce(mean, F.lit(fill))).alias(str(v))

    rows = df.filter(F.col(index).isNotNull())
    return rows.groupBy(index).agg(*[cell(v) for v in values])


def correlation_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, r): Pearson correlation below the diagonal, over rows where both values are finite numbers.

    NULL where a column does not vary.  One pass over the table, one row per pair after it.
    """
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[:i]]
    values = df.select(*[finite_or_null(F.col(c).cast("double")).alias(c) for c in columns])
    # Pairs as rows before a map-side aggregation: the buffer stays three aggregates wide, which keeps
    # it in generated code, and each task hands on one row per pair.
    entries = F.array(
        *[F.struct(F.lit(i).alias("_p"), F.col(a).alias("_x"), F.col(b).alias("_y")) for i, (a, b) in enumerate(pairs)]
    )
    both = values.select(F.inline(entries)).filter("_x is not null and _y is not null")
    spread = F.stddev_pop("_x") * F.stddev_pop("_y")
    found = both.groupBy("_p").agg(F.try_divide(F.covar_pop("_x", "_y"), spread).alias("r"))
    names = F.array(*[F.struct(F.lit(i).alias("_p"), F.lit(a).alias("a"), F.lit(b).alias("b")) for i, (a, b) in enumerate(pairs)])
    listed = df.sparkSession.range(1).select(F.inline(names))
    return listed.join(F.broadcast(found), "_p", "left").select("a", "b", "r")  # one row per pair


def histogram(df: DataFrame, value: Column | str, bins: int = 20) -> DataFrame:
    """(bin, bin_from, bin_to, rows): equal-width bins over the range of the finite values, empty ones included.

    `left_out` counts the others.
    """
    values = df.select(finite_or_null(as_col(value).cast("double")).alias("_v")).filter("_v is not null")
    spread = values.agg(F.min("_v").alias("lo"), F.max("_v").alias("hi")).filter("lo is not null")
    flat = F.col("lo") == F.col("hi")
    limits = spread.select(
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    placed = values.withColumn("_limits", limits.select(F.struct("lo", "hi")).scalar())
    lo, hi = F.col("_limits.lo"), F.col("_limits.hi")
    index = F.least(F.floor((F.col("_v") - lo) * F.lit(float(bins)) / (hi - lo)) + 1, F.lit(bins))
    counts = placed.groupBy(index.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("_n"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    axis = limits.select("lo", width.alias("w"), F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    return axis.join(F.broadcast(counts), "bin", "left").select(  # at most `bins` rows
        "bin",
        (F.col("lo") + (F.col("bin") - 1) * F.col("w")).alias("bin_from"),
        (F.col("lo") + F.col("bin") * F.col("w")).alias("bin_to"),
        F.coalesce("_n", F.lit(0)).alias("rows"),
    )


def left_out(df: DataFrame, value: Column | str) -> DataFrame:
    """One row: values that a histogram leaves out, and all rows."""
    v = as_col(value).cast("double")
    infinite = F.abs(v) == float("inf")
    return df.agg(
        F.count_if(v.isNull()).alias("null_rows"), F.count_if(F.isnan(v)).alias("nan_rows"), F.count_if(infinite).alias("infinite_rows"),
        F.count(F.lit(1)).alias("total_rows"),
    )


def group_mean(df: DataFrame, key: str, measure: Column | str, name: str) -> DataFrame:
    """Mean per non-null key, smallest first; NaN is passed over like NULL."""
    mean = F.avg(nan_to_null(as_col(measure).cast("double")))
    means = df.filter(F.col(key).isNotNull()).groupBy(key).agg(mean.alias(name))
    return means.orderBy(name, key)


def group_first(df: DataFrame, key: str, value: str, order: Column | str, name: str) -> DataFrame:
    """First value per key in `order` that is neither NULL nor NaN."""
    given = F.col(value).isNotNull()
    if dict(df.dtypes)[value] in ("double", "float"):
        given = given & ~F.isnan(value)
    rows = df.filter(F.col(key).isNotNull() & given)
    return rows.groupBy(key).agg(F.min_by(F.col(value), as_col(order)).alias(name))


def share_totals(df: DataFrame, key: str, pct: str, low: float = 95, high: float = 105) -> DataFrame:
    """(key, total_pct, ok): percentages added up per key and checked against the allowed range."""
    totals = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sum(pct).alias("total_pct"))
    return totals.withColumn("ok", F.col("total_pct").between(low, high))


def ranked(df: DataFrame, measure: str, key: str) -> DataFrame:
    """Ascending by measure; the key settles ties."""
    return df.orderBy(measure, key)


def top_k(df: DataFrame, measure: str, key: str, k: int) -> DataFrame:
    """The k largest, as a distributed top-k rather than a full sort."""
    return df.orderBy(F.desc(measure), key).limit(k)


def arg_max(df: DataFrame, metric: str, order: str) -> DataFrame:
    """The row with the largest metric; the first in `order` wins a tie."""
    return top_k(df, metric, order, 1)

"""Exact order statistics without bringing a group into one task.

Rows are cut into ranges of the order by Spark's range partitioning, as many as it takes to keep a range to about
`ROWS_PER_RANGE` rows.  Where the cuts lie only decides how even the ranges are; positions come from exact counts
per range, and rows are sorted within one range at a time, so the result is exact wherever they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import ensure_checkpoint_dir

ROWS_PER_RANGE = 200_000


def _ranged(df: DataFrame, order: list[str]) -> DataFrame:
    """`df` with `_range`: rows of a lower range come before rows of a higher one in `order`.

    The numbered ranges are checkpointed, so that a recomputed task cannot deal a row to another range.
    """
    ranges = max(1, -(-df.count() // ROWS_PER_RANGE))
    if ranges == 1:
        return df.withColumn("_range", F.lit(0))
    ensure_checkpoint_dir(df.sparkSession)
    return df.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()).checkpoint()


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, _v, _n): how often each value occurs; a hot key is spread over its values."""
    known = F.col(value).isNotNull()
    for key in keys:
        known = known & F.col(key).isNotNull()
    rows = df.filter(known).select(*keys, F.col(value).cast("double").alias("_v"))
    return rows.filter(~F.isnan("_v")).groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))


def exact_quantile(counts: DataFrame, keys: list[str], share: float = 0.5, name: str = "quantile") -> DataFrame:
    """Interpolated quantile per key of a `value_counts` table; one row when `keys` is empty.

    Ranges are cut by key and value: a key that holds much of the table is spread over many of them, and many
    small keys share one.
    """
    rows = counts.select(*keys, "_v", "_n")
    if rows.count() <= ROWS_PER_RANGE:  # few enough for one task, whatever the keys
        return _within_one_range(rows, keys, share, name)
    spread = _ranged(rows, [*keys, "_v"])

    # as many rows as ranges and keys from here to `wanted`
    sizes = spread.groupBy(*keys, "_range").agg(F.sum("_n").alias("_size"))
    group = Window.partitionBy(*keys)
    before = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    position = (F.sum("_size").over(group) - 1) * F.lit(float(share))
    placed = sizes.select(
        *keys, "_range", "_size", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"), position.alias("_position")
    )
    low, high = F.floor("_position"), F.ceil("_position")
    wanted = placed.filter((F.col("_start") <= high) & (F.col("_start") + F.col("_size") > low)).select(
        *keys, "_range", "_start", low.alias("_low"), high.alias("_high"), (F.col("_position") - low).alias("_between")
    )

    running = Window.partitionBy(*keys, "_range").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = spread.join(wanted, [*keys, "_range"]).withColumn("_until", F.col("_start") + F.sum("_n").over(running))

    return _interpolated(ranked, keys, name)


def _within_one_range(rows: DataFrame, keys: list[str], share: float, name: str) -> DataFrame:
    group = Window.partitionBy(*keys)
    running = group.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    position = (F.sum("_n").over(group) - 1) * F.lit(float(share))
    ranked = rows.withColumns({"_until": F.sum("_n").over(running), "_position": position})
    low = F.floor("_position")
    return _interpolated(ranked.withColumns({"_low": low, "_high": F.ceil("_position"), "_between": F.col("_position") - low}), keys, name)


def _interpolated(ranked: DataFrame, keys: list[str], name: str) -> DataFrame:
    def value_at(rank: str) -> Column:
        holds = (F.col("_until") > F.col(rank)) & (F.col("_until") - F.col("_n") <= F.col(rank))
        return F.max(F.when(holds, F.col("_v")))

    found = ranked.groupBy(*keys).agg(
        value_at("_low").alias("_a"), value_at("_high").alias("_b"), F.max("_between").alias("_between")
    )
    return found.select(*keys, (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_between")).alias(name))


def positions(df: DataFrame, value: str, tie_break: list[str], name: str = "position") -> DataFrame:
    """Zero-based position of every row in the order (value, tie_break); `value` must not be null."""
    if df.count() <= ROWS_PER_RANGE:  # few enough for one task
        return df.withColumn(name, F.row_number().over(Window.orderBy(value, *tie_break)).cast("long") - 1)
    spread = _ranged(df, [value, *tie_break])
    sizes = spread.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    starts = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_range").orderBy(value, *tie_break)
    ranked = spread.join(starts, "_range")
    return ranked.withColumn(name, F.col("_start") + F.row_number().over(within) - 1).drop("_range", "_start")


def quantile_bins(counts: DataFrame, group: str, bins: int) -> dict[int, list[float]]:
    """{group: upper ends} of at most `bins` bins of about equal weight, from (group, _v, _n) with whole-number groups.

    A group of no more distinct values than bins has one bin for each.  The driver receives the ends only.
    """
    spread = _ranged(counts.select(group, "_v", "_n"), [group, "_v"])
    sizes = spread.groupBy(group, "_range").agg(F.sum("_n").alias("_size"), F.count(F.lit(1)).alias("_values"))
    every = Window.partitionBy(group)
    before = every.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col(group).alias("_g"), F.col("_range").alias("_r"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"),
        F.coalesce(F.sum("_values").over(before), F.lit(0)).alias("_rank"), F.sum("_size").over(every).alias("_total"), F.sum("_values").over(every).alias("_distinct"),
    )
    running = Window.partitionBy(group, "_range").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = spread.withColumns({"_sum": F.sum("_n").over(running), "_place": F.row_number().over(running.orderBy("_v"))})
    ranked = ranked.join(F.broadcast(starts), (F.col(group) == F.col("_g")) & (F.col("_range") == F.col("_r")))  # a row for each range and group in it
    share = F.floor((F.col("_start") + F.col("_sum") - F.col("_n")) * F.lit(bins) / F.col("_total"))
    own_bin = F.when(F.col("_distinct") <= bins, F.col("_rank") + F.col("_place") - 1).otherwise(share)
    ends = ranked.groupBy(group, own_bin.alias("_bin")).agg(F.max("_v").alias("_upto")).orderBy(group, "_bin").collect()
    found: dict[int, list[float]] = {}
    for row in ends:
        found.setdefault(row[group], []).append(row["_upto"])
    return found

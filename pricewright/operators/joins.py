"""Joins whose small side is checked, orphan detection, and column-safe enrichment."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from ..session import ensure_checkpoint_dir

MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


class Side(NamedTuple):
    frame: DataFrame
    small: bool


def measured_side(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> Side:
    """Write `df` to the shared checkpoint folder once, measure it, and hint a broadcast only if it fits."""
    ensure_checkpoint_dir(df.sparkSession)
    stored = df.checkpoint()
    row_bytes = F.octet_length(F.to_json(F.struct(*[F.col(c) for c in stored.columns])))
    rows, size = stored.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes), F.lit(0))).first()
    small = rows <= max_rows and size <= max_bytes
    return Side(F.broadcast(stored) if small else stored, small)


def enrich(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "left") -> DataFrame:
    """Join where the right side wins on column names both sides have.

    No hint: Spark broadcasts the right side when its known size allows it and shuffles otherwise.
    """
    keys = [on] if isinstance(on, str) else list(on)
    clashing = [c for c in right.columns if c in left.columns and c not in keys]
    return left.drop(*clashing).join(right, keys, how)


def enrich_if_absent(left: DataFrame, right: DataFrame, on: str, column: str) -> DataFrame:
    """Left join one column, only when `left` does not have it yet."""
    return left if column in left.columns else left.join(right.select(on, column), on, "left")


def lookup_join(df: DataFrame, key: str, table: DataFrame, value: str, name: str, default: object = None) -> DataFrame:
    """`df` with the `value` that `table` (key, value) has at its key, for tables too long to write into the plan.

    The first value in order counts where a key is listed twice; NULL keys find nothing.
    """
    entries = table.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min(value).alias("_value"))
    found = F.col("_value") if default is None else F.coalesce("_value", F.lit(default))
    kept = [df[c] for c in df.columns if c != name]
    return df.join(measured_side(entries).frame, df[key] == F.col("_key"), "left").select(*kept, found.alias(name))


def keep_in(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows whose value is one of a short list."""
    return df.filter(F.col(column).isin(list(values)))


def keep_matching(df: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose value occurs in another table; for lists too long to write into the plan.

    The keys are made distinct first, so many copies of one key do not travel.
    """
    return df.join(keys.select(F.col(key).alias(column)).distinct(), column, "left_semi")


def orphans(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """One row: fact rows without a matching dimension row, and fact rows without a key.

    Facts are counted per key before the join, so a hot key is one row by then.  NULL keys of the
    dimension are ignored: with them, SQL's NOT IN would report no orphans at all.
    """
    per_key = fact.groupBy(F.col(fact_key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    known = dim.filter(F.col(dim_key).isNotNull()).select(F.col(dim_key).alias("_key")).distinct()
    marked = per_key.join(known.withColumn("_known", F.lit(True)), "_key", "left")
    lost = F.col("_known").isNull() & F.col("_key").isNotNull()
    return marked.agg(
        F.coalesce(F.sum(F.when(lost, F.col("_n"))), F.lit(0)).alias("orphan_rows"),
        F.coalesce(F.sum(F.when(F.col("_key").isNull(), F.col("_n"))), F.lit(0)).alias("null_key_rows"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
    )

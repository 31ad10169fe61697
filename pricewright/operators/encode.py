"""Categories to codes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.bins import lookup
from ..sources.tables import path_exists
from .joins import measured_side
from .ordering import positions


def first_seen_codes(df: DataFrame, category: str, order: str, code: str = "code") -> DataFrame:
    """(category, code): categories numbered from 0 by their first appearance in `order`."""
    firsts = df.filter(F.col(category).isNotNull()).groupBy(category).agg(F.min(order).alias("_first"))
    return positions(firsts, "_first", [category], code).select(category, F.col(code).cast("int").alias(code))


def extended_codes(codes: DataFrame, df: DataFrame, category: str, order: str, code: str = "code") -> DataFrame:
    """`codes` (category, code) and, behind its last number, the categories of `df` it lacks by their first appearance.

    The old numbers never change, whatever came since; an empty table of codes starts at 0.
    """
    known = codes.select(category, F.col(code).cast("int").alias(code))
    fresh = df.filter(F.col(category).isNotNull()).join(known, category, "left_anti")
    behind = known.agg(F.coalesce(F.max(code) + 1, F.lit(0)).alias("_next")).scalar()
    numbered = first_seen_codes(fresh, category, order, "_place")
    return known.unionByName(numbered.select(category, (F.col("_place") + behind).cast("int").alias(code)))


def append_codes(path: str, df: DataFrame, category: str, order: str, code: str = "code") -> DataFrame:
    """Append the new categories of `df` to the stored table of codes and return the whole table.

    Stored rows are never written again: a batch that is repeated after a failure finds its categories there.
    """
    spark = df.sparkSession
    schema = f"`{category}` string, `{code}` int"
    if path_exists(spark, path):
        stored = spark.read.schema(schema).parquet(path)
        before = stored.agg(F.coalesce(F.max(code), F.lit(-1))).first()[0]
    else:
        stored, before = spark.createDataFrame([], schema), -1
    extended_codes(stored, df, category, order, code).filter(F.col(code) > before).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def encode_first_seen(df: DataFrame, category: str, order: str, code: str) -> DataFrame:
    codes = measured_side(first_seen_codes(df, category, order, code))
    return df.join(codes.frame, category, "left").select(*df.columns, code)


def encode_fixed(value: Column | str, codes: Mapping[str, int], unknown: int = 0) -> Column:
    return lookup(value, codes, unknown)

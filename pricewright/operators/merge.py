"""Merging a batch into a stored table, the first row per key kept."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import ensure_checkpoint_dir
from ..sources.tables import path_exists
from .cleaning import keep_first

BUCKETS = 256


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def merge_first(path: str, batch: DataFrame, keys: list[str], order: list[str], buckets: int = BUCKETS) -> list[int]:
    """Merge `batch` into the Parquet table at `path`, which holds the first row of every key in `order`.

    The table lies in `buckets` folders by a hash of the key.  Only rows that the table lacks, or that come before
    the stored row of their key, count as changes, and only their buckets are written again; returns these.  Loads
    in any number and order give the table that one load of all rows gives.  A load that fails may leave some
    buckets merged; the same batch again completes it, because merging what is there already changes nothing.

    `order` ranks all rows of a key and has no NULLs; NULL is a key like any other.
    """
    spark = batch.sparkSession
    columns = batch.columns
    fresh = keep_first(batch, keys, order).withColumn("_bucket", _bucket(keys, buckets))
    if not path_exists(spark, path):
        fresh.hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(path)
        return sorted(r[0] for r in spark.read.parquet(path).select("_bucket").distinct().collect())
    ensure_checkpoint_dir(spark)
    stored = spark.read.schema(fresh.schema).parquet(path)
    known = stored.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.struct(*order).alias("_at"), F.lit(True).alias("_known"))
    same = reduce(lambda a, b: a & b, [fresh[k].eqNullSafe(known[f"_k{i}"]) for i, k in enumerate(keys)])
    changes = fresh.join(known, same, "left").filter(F.col("_known").isNull() | (F.struct(*[fresh[o] for o in order]) < F.col("_at")))
    changes = changes.select(*columns, "_bucket").checkpoint()
    touched = sorted(r[0] for r in changes.select("_bucket").distinct().collect())  # `buckets` at most
    if touched:
        merged = stored.filter(F.col("_bucket").isin(touched)).unionByName(changes)
        # checkpointed, because the folders that are read are written next
        whole = keep_first(merged, keys, order).checkpoint()
        writer = whole.hint("rebalance", "_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("_bucket").parquet(path)
    return touched


def merged_table(spark, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("_bucket")

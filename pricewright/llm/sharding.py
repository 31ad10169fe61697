"""Proportional stratified interleaving: every shard holds the mixture of the whole.

Rows are shuffled within their source by a seeded hash and ranked; rank r of n stands at the fraction
(r - u) / n.  u is one half for a source that has no other of about its size (within a power of two), and else
drawn from (0, 1) by a seeded hash of the source: sources of one size do not meet at the same places, and a long
tail of small sources lies evenly over the order.  Sorted by fraction, the sources interleave in proportion at
every place, so equal cuts of the order are shards of one mixture, with counts at most one apart.

Both orders are cut into buckets first, by the hash and by the fraction.  Either is even up to chance, whatever
the sizes of the sources, so that no task sorts a whole source: positions are counts of the buckets before plus a
rank in the bucket.

Defined results: a NULL source is a source of its own; a NULL text has no bytes and the CRC-32 of nothing;
rows that are equal in every column are interchangeable; an empty table gives none.  Columns of any name are kept,
as one struct on the way, and `shard` and `slot` replace columns of these names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .common import stored, text_bytes
from .vectors import quoted

BUCKET_ROWS = 50_000
SEED = 17
DRAWS = 1 << 30  # places between two ranks


def interleave(df: DataFrame, source: str, shards: int, seed: int = SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """`df` with shard (0 to shards - 1) and slot (gapless from 0); hashable columns only."""
    kept = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    rows = stored(
        df.select(
            F.struct(*map(quoted, kept)).alias("_row"),
            F.to_json(F.struct(quoted(source).alias("s"))).alias("_stratum"),
            F.xxhash64(F.lit(seed), *[F.coalesce(F.xxhash64(quoted(c)), F.lit(0)) for c in kept]).alias("_draw"),
        )
    )
    total = rows.count()
    buckets = max(1, -(-total // bucket_rows))

    rows = rows.withColumn("_bucket", F.pmod(F.col("_draw"), F.lit(buckets)))
    sizes = rows.groupBy("_stratum", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    stratum = Window.partitionBy("_stratum")  # at most `buckets` rows each
    before = stratum.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_stratum", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"), F.sum("_n").over(stratum).alias("_of")
    )
    within = Window.partitionBy("_stratum", "_bucket").orderBy("_draw", "_row")
    ranked = rows.join(starts, ["_stratum", "_bucket"]).withColumn("_rank", F.col("_start") + F.row_number().over(within))
    ranked = ranked.withColumn("_size", F.floor(F.log2("_of")))
    strata = sizes.groupBy("_stratum").agg(F.floor(F.log2(F.sum("_n"))).alias("_size"))
    alike = F.broadcast(strata.groupBy("_size").agg((F.count(F.lit(1)) > 1).alias("_alike")))  # a row for each power of two
    drawn = (F.pmod(F.xxhash64(F.lit(seed), F.lit("place"), "_stratum"), F.lit(DRAWS)) + 0.5) / float(DRAWS)
    placed = stored(
        ranked.join(alike, "_size")
        .withColumn("_fraction", (F.col("_rank") - F.when(F.col("_alike"), drawn).otherwise(0.5)) / F.col("_of"))
        .withColumn("_bucket", F.floor(F.col("_fraction") * buckets))
        .select("_row", "_stratum", "_draw", "_bucket", "_fraction")
    )

    sizes = placed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row per `bucket_rows` rows
    starts = sizes.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_bucket").orderBy("_fraction", "_stratum", "_draw", "_row")
    position = F.col("_start") + F.row_number().over(within) - 1
    ordered = placed.join(starts, "_bucket").withColumn("_position", position)
    return (
        ordered.withColumn("_shard", F.expr(f"(_position * {shards}L) div {max(total, 1)}L"))
        .withColumn("slot", F.expr(f"_position - (_shard * {total}L + {shards - 1}L) div {shards}L"))
        .withColumn("shard", F.col("_shard").cast("int"))
        .select(*[F.col("_row").getField(c).alias(c) for c in kept], "shard", "slot")
    )


def write_shards(interleaved: DataFrame, path: str, files_per_shard: int = 1) -> None:
    """One folder per shard, rows in slot order; a shard is written by `files_per_shard` tasks at least."""
    shards = interleaved.agg(F.max("shard")).first()[0]
    width = ((shards or 0) + 1) * files_per_shard
    interleaved.repartitionByRange(width, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def shard_digests(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Per row: id, size, CRC-32 of the text, and its place by the law of equal counts."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    narrow = docs.select("doc_id", "source", (text_bytes("text") + 1).alias("size"), F.crc32(text).alias("text_crc32"))
    return interleave(narrow, "source", shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source"
    )

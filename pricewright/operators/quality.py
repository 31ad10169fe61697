"""Row counts, checksums, rule reports and reject handling."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import importable_in_workers
from . import ordering

NULL_TEXT = "<null>"
STRETCH = 1000  # ranges whose hashes are joined in one row


def row_fingerprint(columns: list[str]) -> Column:
    """A 32-bit number from the row's text; NULL differs from empty text."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit(NULL_TEXT)) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def checksum(columns: list[str]) -> Column:
    """Sum of the fingerprints as text: the same for any order and partitioning of the rows.

    Upper and lower halves are summed as longs, which neither overflow nor need decimals per row.
    """
    number = row_fingerprint(columns)
    upper = F.coalesce(F.sum(F.shiftright(number, 16)), F.lit(0)).cast("decimal(20,0)")
    lower = F.coalesce(F.sum(number.bitwiseAND(F.lit(65535))), F.lit(0)).cast("decimal(20,0)")
    return (upper * F.lit(65536) + lower).cast("string")


def table_checksum(df: DataFrame, table: str, columns: list[str] | None = None) -> DataFrame:
    names = columns or df.columns
    summed = df.agg(F.count(F.lit(1)).alias("row_count"), checksum(names).alias("checksum"))
    return summed.select(F.lit(table).alias("table_name"), "row_count", "checksum")


PRIME = (1 << 31) - 1
BASES = (1_000_003, 998_244_353)
FIELDS = [f"{kind}{i}" for i in range(len(BASES)) for kind in "hp"]  # a hash and a power for each base


def _joined(parts: Column, hashes: Callable[[Column, int], Column], powers: Callable[[Column, int], Column]) -> Column:
    """Hashes of consecutive parts as one: (h1, p1) and (h2, p2) make (h1 * p2 + h2, p1 * p2), p being base ** rows."""
    start = F.struct(*[F.lit(int(n[0] == "p")).cast("long").alias(n) for n in FIELDS])

    def join(done: Column, part: Column) -> Column:
        fields = []
        for i in range(len(BASES)):
            h, p = hashes(part, i), powers(part, i)
            fields += [((done[f"h{i}"] * p + h) % PRIME).alias(f"h{i}"), ((done[f"p{i}"] * p) % PRIME).alias(f"p{i}")]
        return F.struct(*fields)

    return F.aggregate(parts, start, join)


def range_hashes(df: DataFrame, order: list[str], columns: list[str]) -> DataFrame:
    """(_range, _n, _s): for each range of the order the number of its rows, and their hash and power for each base.

    Rows are dealt and sorted by `order` and fingerprint, so that rows of one key need not share a range; only the
    fingerprints of a sorted range pass through its task, a batch at a time.
    """
    importable_in_workers(df.sparkSession)
    at = [f"_at{i}" for i in range(len(order))]
    rows = df.select(*[F.col(c).alias(a) for c, a in zip(order, at)], (row_fingerprint(columns) % PRIME).alias("_f"))
    ranges = max(1, -(-df.count() // ordering.ROWS_PER_RANGE))
    dealt = rows.repartitionByRange(ranges, *at, "_f") if ranges > 1 else rows.repartition(1)
    ranged = dealt.sortWithinPartitions(*at, "_f").select(F.spark_partition_id().alias("_range"), "_f")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows, hashes = 0, 0, [0] * len(BASES)
        for batch in batches:
            if batch.num_rows:
                number, f = batch.column("_range")[0].as_py(), batch.column("_f").to_numpy()
                rows += len(f)
                hashes = [int((h * pow(base, len(f), PRIME) + (f * _falling_powers(base, len(f)) % PRIME).sum()) % PRIME) for base, h in zip(BASES, hashes)]
        if rows:
            parts = [number, rows, *[x for base, h in zip(BASES, hashes) for x in (h, pow(base, rows, PRIME))]]
            yield pa.RecordBatch.from_pydict({name: [x] for name, x in zip(["_range", "_n", *FIELDS], parts)})

    schema = ", ".join(["_range long", "_n long", *[f"{name} long" for name in FIELDS]])
    return ranged.mapInArrow(work, schema).select("_range", "_n", F.struct(*FIELDS).alias("_s"))


@lru_cache(maxsize=8)
def _falling_powers(base: int, rows: int) -> np.ndarray:
    """base ** (rows - 1), ..., base ** 0, by PRIME."""
    powers = np.ones(1, np.int64)
    while len(powers) < rows:
        powers = np.concatenate([powers * pow(base, len(powers), PRIME) % PRIME, powers])
    return powers[len(powers) - rows :]


def ordered_checksum(df: DataFrame, table: str, order: list[str], columns: list[str] | None = None) -> DataFrame:
    """(table_name, row_count, checksum) where the checksum depends on the order of the rows by `order`.

    It is a polynomial over the fingerprints of the rows.  The hash of a stretch of rows, kept with the power of its
    length, joins with that of the next stretch; so rows are cut into ranges of the order, each range is hashed by
    itself, and ranges are joined in stretches.  How they are cut does not change the result.  Rows that `order` does
    not tell apart are taken by their fingerprints; NULL comes first.
    """
    parts = range_hashes(df, order, columns or df.columns)
    stretch = F.floor(F.col("_range") / STRETCH)
    for by in (stretch, F.lit(0)):
        several = F.sort_array(F.collect_list(F.struct("_range", "_s")))
        joined = _joined(several, lambda r, i: r["_s"][f"h{i}"], lambda r, i: r["_s"][f"p{i}"])
        parts = parts.groupBy(by.alias("_group")).agg(F.sum("_n").alias("_n"), joined.alias("_s")).withColumnRenamed("_group", "_range")
    digits = [F.lower(F.lpad(F.hex(F.col(f"_s.h{i}")), 8, "0")) for i in range(len(BASES))]
    text = parts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"), F.coalesce(F.max(F.concat(*digits)), F.lit("00000000" * len(BASES))).alias("checksum"))
    return text.select(F.lit(table).alias("table_name"), "row_count", "checksum")


def table_counts(tables: dict[str, DataFrame | None]) -> DataFrame:
    """(table_name, row_count, column_count, status); -1 and UNREADABLE for a table that could not be opened."""
    parts = []
    spark = next(df.sparkSession for df in tables.values() if df is not None)
    for name, df in tables.items():
        if df is None:
            line = spark.range(1).select(F.lit(-1).cast("long").alias("row_count"))
        else:
            line = df.agg(F.count(F.lit(1)).alias("row_count"))
        width = -1 if df is None else len(df.columns)
        parts.append(line.select(F.lit(name).alias("table_name"), "row_count", F.lit(width).alias("column_count")))
    status = F.when(F.col("row_count") < 0, "UNREADABLE").when(F.col("row_count") == 0, "EMPTY").otherwise("OK")
    return reduce(DataFrame.unionByName, parts).withColumn("status", status)


def readable_counts(spark: SparkSession, tables: dict[str, DataFrame | None]) -> DataFrame:
    """The same for tables that may fail while they are read: each is counted by itself, and one that fails gets -1."""
    lines = []
    for name, df in tables.items():
        try:
            rows = -1 if df is None else df.agg(F.count(F.lit(1)), F.max(F.xxhash64(*df.columns))).first()[0]  # every column is read
        except Exception:  # reported as unreadable
            rows = -1
        lines.append((name, rows, -1 if rows < 0 else len(df.columns), "UNREADABLE" if rows < 0 else "EMPTY" if rows == 0 else "OK"))
    return spark.createDataFrame(lines, "table_name string, row_count long, column_count int, status string")


def rule_report(table: str, df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, table_name, affected, total) for row-level rules: `rules` marks the affected rows.

    All rules of a table are counted in one pass.
    """
    names = list(rules)
    counts = df.agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(rules[n]).alias(f"_n{i}") for i, n in enumerate(names)]
    )
    entries = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"_n{i}").alias("affected")) for i, n in enumerate(names)])
    return counts.select(F.inline(entries), "total").select(
        "rule", F.lit(table).alias("table_name"), "affected", "total"
    )


def reject_reason(error: Column, payload: Column) -> Column:
    """Why a record is set aside; NULL for a usable one."""
    return F.when(error.isNotNull(), "source error").when(payload.isNull(), "empty")


def split_rejects(df: DataFrame, error: Column, payload: Column) -> tuple[DataFrame, DataFrame]:
    """Usable records, and the others with their reason."""
    marked = df.withColumn("reject_reason", reject_reason(error, payload))
    good = marked.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return good, marked.filter(F.col("reject_reason").isNotNull())

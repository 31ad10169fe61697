"""What the operators of this package share: stored tables, hash remainders, and batches bounded by text size."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import ensure_checkpoint_dir, importable_in_workers  # noqa: F401 (for the queries and the pipeline)

SLICE_BYTES = 2 * 1024 * 1024

Sliced = Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]
Mapped = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def stored(df: DataFrame) -> DataFrame:
    """Write `df` as Parquet below the shared checkpoint folder and read it back.

    Cuts the lineage where every executor can read it again, so a lost executor costs a re-read, and what
    was numbered or drawn before the write stays as it was.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names that `df` has no column of: the wanted ones, behind as many underscores as it takes."""
    taken, lead = {c.lower() for c in df.columns}, "_"
    while any(lead + w.lower() in taken for w in wanted):
        lead += "_"
    return [lead + w for w in wanted]


def remainder(column: str, divisor: int) -> Column:
    """CRC-32 of the column's text, modulo `divisor`; NULL for a NULL."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(divisor)


def text_bytes(column: str) -> Column:
    """UTF-8 length; a NULL counts as empty."""
    return F.coalesce(F.octet_length(F.col(column)), F.lit(0)).cast("long")


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a slice holds about `most` bytes of text, and one row at least."""
    sizes = batch.column(column).nbytes
    if sizes <= most or batch.num_rows <= 1:
        yield batch
        return
    start = held = 0
    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
    for i, size in enumerate(lengths):
        if i > start and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    yield batch.slice(start)


_KEPT: dict[str, dict] = {}


def kept_for(owner: str) -> dict:
    """What a worker process keeps between the tasks of one operator."""
    return _KEPT.setdefault(owner, {})


def give_back() -> None:
    """Return freed memory to the system: the workers share an executor's limit with its JVM."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc; what libraries free stays with the process without it
    if trim is not None:
        trim(0)


def drop_others(owner: str) -> None:
    """Free what other operators kept in this worker process: workers outlive the stages of a pipeline."""
    for other in [o for o in _KEPT if o != owner]:
        del _KEPT[other]
    give_back()


def tidy(work: Mapped) -> Mapped:
    """`work` for `mapInArrow`, in tasks that begin without what other operators kept, and end with no memory but their own."""
    owner = work.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_others(owner)
        yield from work(batches)
        give_back()

    return run


def map_texts(df: DataFrame, work: Sliced, schema: str, column: str = "text", most: int = SLICE_BYTES) -> DataFrame:
    """`mapInArrow` over batches whose text is bounded in size; `work` turns one batch into result batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.rename_columns(names), column, most):
                if part.num_rows:
                    yield from work(part)
            batch = part = None  # the next batch is read into the memory of this one
            pa.default_memory_pool().release_unused()

    run.__module__ = work.__module__
    names = df.columns  # Spark would read a dot in them as a field
    return df.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(tidy(run), schema)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def shared_value(spark: SparkSession, value: object):
    """A Python broadcast; callers state what bounds the value's size."""
    return spark.sparkContext.broadcast(value)

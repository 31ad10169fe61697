"""Benchmark decontamination by a prefix-filtered set join.

Items are cut into windows; a window is the list of its shingles.  Documents are read once: a task
finds the runs of consecutive shingles that occur in any item, and shorter runs than any window are dropped at
once.  Only these runs, as lists of shingle numbers, are joined: a window that a run contains must contain its
rarest shingle, so windows are joined by that one (rarity is counted over the runs of all documents), the
length of the run and the place of the shingle bound what can fit, and the window's list is compared with the
run's at that place.  Numbers stand for exact words, so equal lists are equal words.

Items are taken in blocks of bounded text, one pass over the documents each; a block's shingles are broadcast
under that bound.  No document is brought to another by a key that a hot passage could overload: identical
runs are compared once.

Defined results: a NULL or wordless text has no words and no hits; items without words take no part; items
with a NULL id mark words but are not counted; rows with one item id are one item; repeated document rows each
get their row; empty tables give no rows or no hits.  Other columns are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.joins import measured_side
from .common import free_names, map_texts, shared_value, stored
from .vectors import quoted

WINDOW = 13
SHINGLE = 3
PIECE = 4  # longest windows in a piece of a long run
BLOCK_BYTES = 4 * 1024 * 1024  # item text whose shingles are held in memory at once
WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")  # on lower-cased UTF-8: ASCII letters and digits, and all beyond ASCII


def words_of(text: bytes | None) -> list[bytes]:
    return WORDS.findall(text.lower()) if text else []


def item_block(items: DataFrame, number: int, blocks: int) -> list[tuple[str | None, bytes]]:
    """(item id, text) of one block of bounded size; the driver holds one block at a time."""
    mine = items.filter((F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number) & F.col("text").isNotNull())
    rows = mine.select(F.col("item_id").cast("string"), F.col("text").cast("binary")).collect()
    return [(r[0], bytes(r[1])) for r in rows]


def windows_of(block: list[tuple[str | None, bytes]], window: int, shingle: int) -> tuple[dict, list[tuple]]:
    """Shingles by width with their numbers, and (item id, words, shingle numbers) of every distinct window."""
    numbers: dict[int, dict] = defaultdict(dict)
    found = set()
    count = 0
    for item, text in block:
        words = words_of(text)
        width = min(shingle, len(words))
        if not words:
            continue
        known = numbers[width]
        ids = []
        for i in range(len(words) - width + 1):
            key = tuple(words[i : i + width])
            if key not in known:
                known[key] = count
                count += 1
            ids.append(known[key])
        n = min(window, len(words))
        found |= {(item, n, tuple(ids[i : i + n - width + 1])) for i in range(len(words) - n + 1)}
    return dict(numbers), sorted(found, key=repr)


def runs_of(words: list[bytes], numbers: dict, lengths: dict[int, tuple[int, int]]) -> list[tuple[int, list[int]]]:
    """(start, shingle numbers) of the maximal runs of known shingles that are as long as the shortest window.

    Long runs come in pieces that overlap by the longest window less one, so that a window lies whole in one.
    """
    runs = []
    for width, known in numbers.items():
        shortest, longest = lengths[width]
        ids = list(map(known.get, zip(*[words[i:] for i in range(width)])))
        at = [i for i, v in enumerate(ids) if v is not None]
        if len(at) < shortest:
            continue
        at = np.array(at)
        for part in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1):
            begin, end = int(part[0]), int(part[-1]) + 1
            if end - begin >= shortest:
                step = PIECE * longest
                for start in range(begin, end - shortest + 1, step):
                    runs.append((start, ids[start : min(start + step + longest - 1, end)]))
    return runs


RUNS = "array<struct<start:int,ids:array<int>>>"


def _document_runs(docs: DataFrame, numbers: dict, lengths: dict[int, tuple[int, int]], kind: str) -> DataFrame:
    shared = shared_value(docs.sparkSession, (numbers, lengths))  # bounded by the block's text

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        known, sizes = shared.value
        counts, runs = [], []
        for text in batch.column("text").to_pylist():
            words = words_of(text)
            counts.append(len(words))
            runs.append(runs_of(words, known, sizes))
        pair = pa.struct([("start", pa.int32()), ("ids", pa.list_(pa.int32()))])
        yield pa.RecordBatch.from_arrays(
            [batch.column("row_id"), batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(runs, pa.list_(pair))],
            ["row_id", "doc_id", "n_words", "runs"],
        )

    return map_texts(docs, work, f"row_id long, doc_id {kind}, n_words long, runs {RUNS}")


def _contained(runs: DataFrame, windows: DataFrame) -> DataFrame:
    """(ids, item_id, begin, end) for each window in each distinct run; places count from the run's start."""
    distinct = stored(runs.select("ids").groupBy("ids").agg(F.count(F.lit(1)).alias("n")))
    spread = distinct.select("ids", "n", F.posexplode("ids").alias("place", "number"))
    rarity = spread.groupBy("number").agg(F.sum("n").alias("n"))

    # each window's rarest shingle; the first one where several are as rare
    parts = windows.select("window_id", "ids", F.posexplode("ids").alias("offset", "number"))
    rated = parts.join(rarity, "number")
    rarest = rated.groupBy("window_id").agg(F.min(F.struct("n", "number", "offset")).alias("p"), F.count(F.lit(1)).alias("present"))
    prefix = windows.join(rarest, "window_id").filter(F.col("present") == F.size("ids")).select(
        "item_id", "n_words", F.col("ids").alias("wanted"), F.col("p.number").alias("number"), F.col("p.offset").alias("offset")
    )
    begin = F.col("place") - F.col("offset")
    fits = (F.size("ids") >= F.size("wanted")) & (begin >= 0) & (begin + F.size("wanted") <= F.size("ids"))
    pairs = spread.join(F.broadcast(prefix), "number").filter(fits)  # windows are bounded by the block
    exact = pairs.filter(F.slice("ids", begin + 1, F.size("wanted")) == F.col("wanted"))
    return exact.select("ids", "item_id", begin.alias("begin"), (begin + F.col("n_words")).alias("end"))


def _block_hits(docs: DataFrame, block: list, window: int, shingle: int, kind: str) -> tuple[DataFrame, DataFrame]:
    """(numbered rows with n_words, places of windows per row) for one block of items."""
    spark = docs.sparkSession
    numbers, windows = windows_of(block, window, shingle)
    widths = {n: w for w, known in numbers.items() for n in known.values()}
    lengths: dict[int, tuple[int, int]] = {}
    for _, _, ids in windows:
        least, most = lengths.get(widths[ids[0]], (len(ids), len(ids)))
        lengths[widths[ids[0]]] = min(least, len(ids)), max(most, len(ids))
    rows = _document_runs(docs, numbers, lengths, kind)
    # an Arrow table: a list would start a second Python daemon with workers of its own on every executor
    columns = {
        "window_id": pa.array(range(len(windows)), pa.int64()),
        "item_id": pa.array([item for item, _, _ in windows], pa.string()),
        "n_words": pa.array([n for _, n, _ in windows], pa.int32()),
        "ids": pa.array([ids for _, _, ids in windows], pa.list_(pa.int32())),
    }
    frame = spark.createDataFrame(pa.table(columns), "window_id long, item_id string, n_words int, ids array<int>")
    rows = stored(rows)
    runs = rows.select("row_id", F.explode("runs").alias("run")).select("row_id", "run.start", "run.ids")
    found = _contained(runs, frame)
    hits = runs.join(found, "ids").select(
        "row_id", "item_id", (F.col("start") + F.col("begin")).alias("begin"), (F.col("start") + F.col("end")).alias("end")
    )
    return rows.select("row_id", "doc_id", "n_words"), hits


def _covered(hits: DataFrame) -> DataFrame:
    """Per row: words under any window, and the items found."""
    order = Window.partitionBy("row_id").orderBy("begin", "end")
    places = hits.groupBy("row_id", "begin").agg(F.max("end").alias("end"))
    reached = F.coalesce(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    words = places.withColumn("new", F.greatest(F.col("end") - F.greatest("begin", reached), F.lit(0)))
    return words.groupBy("row_id").agg(F.sum("new").alias("n_hit"))


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, block_bytes: int = BLOCK_BYTES,
    hits_needed: int = 1, words_per_hit: int = 20,
) -> DataFrame:
    """Per row of `docs`: doc_id, n_words, n_hit, items (sorted ids), contaminated.

    A row is contaminated if at least `hits_needed` of `words_per_hit` of its words lie in benchmark windows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    numbered = docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", F.col("text").cast("binary").alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    if blocks > 1:  # every pass must see the same row numbers
        numbered = stored(numbered)
    rows, hits = None, None
    for number in range(blocks):
        more_rows, more_hits = _block_hits(numbered, item_block(items, number, blocks), window, shingle, kind)
        rows = more_rows if rows is None else rows
        hits = more_hits if hits is None else hits.unionByName(more_hits)
    hits = stored(hits)
    items_found = hits.filter(F.col("item_id").isNotNull()).select("row_id", "item_id").distinct()
    listed = items_found.groupBy("row_id").agg(F.sort_array(F.collect_list("item_id")).alias("items"))
    marked = rows.join(_covered(hits).join(listed, "row_id", "left"), "row_id", "left")
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    return marked.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * words_per_hit >= F.col("n_words") * hits_needed))


def contamination_digests(docs: DataFrame, items: DataFrame) -> DataFrame:
    found = contamination(docs, items)
    joined: Column = F.concat_ws(",", "items")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(joined, 256).alias("items_sha256"), "contaminated"
    )


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of `docs` that are not contaminated.  Equal texts share the verdict, so it is joined by the text's hash."""
    key = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    verdicts = contamination(docs.select(key.alias("doc_id"), "text"), items)
    (name,) = free_names(docs, "text_key")
    dirty = verdicts.filter("contaminated").select(F.col("doc_id").alias(name)).distinct()
    return docs.withColumn(name, key).join(measured_side(dirty).frame, name, "left_anti").select(*map(quoted, docs.columns))

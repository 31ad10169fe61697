"""Vector code compression: a codebook per part of a vector, learned with adaptive distance bounds.

Vectors of whole numbers are cut into equal parts, each with a codebook that starts as that part of the smallest
rows by `key`.  A round assigns every part to its nearest entry (ties to the lower index) and then moves each entry
to the floor of the mean of its parts; entries without parts stay.

Assignments after the first use the bounds that the one before has persisted.  Each part keeps an upper bound of the
distance to its own entry, its b next entries with a lower bound each, and one outer bound for all further
entries.  Entries that move by d change bounds by d at most, so most parts are settled without a single distance:
their own bound is below all others.  The rest are verified in whole numbers against their own entry and as many of
the b entries as their bounds leave open, and against all entries only where the outer bound is open too.  After
each assignment b falls to the most entries that any part needed, a twelfth of the entries at least.  Bounds are
rounded outwards, when they are reckoned and when they are stored (in 16 bits, so that a state takes little more room
than its vectors), and an equal bound counts as open, so codes are exact.

Rows stay where they are: an assignment is one map over the stored state, and sums leave a task as one row for each
entry and dimension.  The driver holds the codebooks (parts * entries * width numbers) and nothing of the rows.

Defined results: rows whose vector is NULL, empty, or holds NULL or non-finite components take no part, nor do
those of another length than most; repeated rows count each; a length that `parts` does not divide is a
ValueError; fewer rows than entries make a smaller codebook; NULL keys come last among the first entries; ties
among equal keys go to the smaller vector; empty tables give no rows.  Other columns are kept, whatever their
names: a row of the result has `row` (all columns but the vector), `code` and `error`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..operators.joins import measured_side
from .common import shared_value, stored
from .vectors import matrix, quoted, squared_distances, whole_vectors

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
FIRST_BOUNDS = 6  # b starts as the number of entries divided by this
LEAST_BOUNDS = 12  # and does not fall below the number of entries divided by this
OPEN = (1 << 16) - 1  # stands for a bound without limit


class Codes(NamedTuple):
    rows: DataFrame  # row struct, code array<int>, error long
    codebooks: np.ndarray  # parts x entries x width
    open_parts: list[float]  # share of the parts that each assignment after the first had to verify


def _below(squares: np.ndarray) -> np.ndarray:
    return np.nextafter(np.sqrt(squares.astype(np.float64)).astype(np.float32), np.float32(-np.inf))


def _above(squares: np.ndarray) -> np.ndarray:
    return np.nextafter(np.sqrt(squares.astype(np.float64)).astype(np.float32), np.float32(np.inf))


class State(NamedTuple):
    """Bounds of one part position for n rows."""

    code: np.ndarray  # n
    upper: np.ndarray  # n, at least the distance to the own entry
    near: np.ndarray  # n x b, the next entries, about in order of distance
    lower: np.ndarray  # n x (b + 1), at most the distances to them; the last one holds for all further entries
    need: np.ndarray  # n, how many of the b entries were looked at


def assign_all(x: np.ndarray, book: np.ndarray, b: int) -> State:
    """Distances to all entries; the b that come after the nearest are kept."""
    n, k = len(x), len(book)
    b = min(b, k - 1)
    square = squared_distances(x, book)
    order = np.argsort(square, axis=1, kind="stable")  # ties to the lower index
    ranked = np.take_along_axis(square, order[:, : b + 2], axis=1)
    lower = np.full((n, b + 1), np.float32(np.inf))
    lower[:, : ranked.shape[1] - 1] = _below(ranked[:, 1:])
    return State(order[:, 0], _above(ranked[:, 0]), order[:, 1 : b + 1], lower, np.full(n, b))


def assign_bounded(x: np.ndarray, book: np.ndarray, moved: np.ndarray, old: State, b: int) -> tuple[State, np.ndarray]:
    """The same from the bounds before the entries moved by `moved`; which rows had to be verified is returned too."""
    b = min(b, old.near.shape[1])
    inf = np.float32(np.inf)
    code, near = old.code.copy(), old.near[:, :b].copy()
    outer = old.lower[:, b:].min(axis=1, initial=inf)  # bounds that are not kept any more join the outer one
    upper = np.nextafter(old.upper + moved[code], inf)
    lower = np.hstack([np.nextafter(old.lower[:, :b] - moved[near], -inf), np.nextafter(outer - moved.max(initial=0), -inf)[:, None]])
    # the bound of a place holds for all behind it
    behind = np.minimum.accumulate(lower[:, ::-1], axis=1)[:, ::-1]
    need = np.zeros(len(x), np.int64)
    unsure = np.flatnonzero(upper >= behind[:, 0])
    if len(unsure):
        step = x[unsure].astype(np.int64) - book[code[unsure]]
        upper[unsure] = _above((step * step).sum(axis=1))
        need[unsure] = (behind[unsure] <= upper[unsure][:, None]).sum(axis=1)
    for m in np.unique(need[need > 0]):
        rows = np.flatnonzero(need == m)
        if m > b:
            found = assign_all(x[rows], book, b)
            code[rows], upper[rows], near[rows], lower[rows] = found.code, found.upper, found.near, found.lower
            continue
        some = np.hstack([code[rows][:, None], near[rows, :m]])
        step = x[rows][:, None].astype(np.int64) - book[some]
        square = (step * step).sum(axis=2)
        order = np.lexsort((some, square), axis=1)
        some, square = np.take_along_axis(some, order, axis=1), np.take_along_axis(square, order, axis=1)
        code[rows], upper[rows] = some[:, 0], _above(square[:, 0])
        near[rows, :m], lower[rows, :m] = some[:, 1:], _below(square[:, 1:])
    return State(code, upper, near, lower, np.minimum(need, b)), need > 0


class Form(NamedTuple):
    """How bounds are stored: 16-bit multiples of `unit`, rounded outwards, and entries in one byte if they fit."""

    parts: int
    unit: float
    entry: type

    def upper(self, bounds: np.ndarray) -> np.ndarray:
        return np.minimum(np.ceil(bounds.astype(np.float64) / self.unit), OPEN).astype(np.uint16)

    def lower(self, bounds: np.ndarray) -> np.ndarray:
        steps = np.clip(np.floor(bounds.astype(np.float64) / self.unit), 0, OPEN - 1)
        return np.where(np.isinf(bounds), OPEN, steps).astype(np.uint16)

    def bounds(self, steps: np.ndarray, towards: float) -> np.ndarray:
        found = np.nextafter((steps * self.unit).astype(np.float32), np.float32(towards))
        return np.where(steps == OPEN, np.float32(np.inf), found)


def _packed(states: list[State], form: Form) -> list[pa.Array]:
    """One binary value a row for all its parts."""

    def binary(values: np.ndarray) -> pa.Array:
        width = values[0].nbytes
        data = pa.py_buffer(np.ascontiguousarray(values).tobytes())
        return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(values), [None, data]).cast(pa.binary()) if width else pa.array([b""] * len(values), pa.binary())

    def stacked(field: str) -> np.ndarray:
        return np.stack([getattr(s, field) for s in states], axis=1)

    return [
        binary(stacked("code").astype(form.entry)), binary(form.upper(stacked("upper"))), binary(stacked("near").astype(form.entry)),
        binary(form.lower(stacked("lower"))), pa.array(stacked("need").max(axis=1), pa.int32()),
    ]


def _codes(batch: pa.RecordBatch, form: Form) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("code").to_pylist()), form.entry).reshape(batch.num_rows, form.parts).astype(np.int64)


def _unpacked(batch: pa.RecordBatch, form: Form) -> list[State]:
    def read(name: str, dtype: type) -> np.ndarray:
        return np.frombuffer(b"".join(batch.column(name).to_pylist()), dtype).reshape(batch.num_rows, form.parts, -1)

    code, upper = _codes(batch, form), form.bounds(read("upper", np.uint16)[:, :, 0], np.inf)
    lower = form.bounds(read("lower", np.uint16), -np.inf)
    near = read("near", form.entry).astype(np.int64) if lower.shape[2] > 1 else np.zeros((batch.num_rows, form.parts, 0), np.int64)
    return [State(code[:, j], upper[:, j], near[:, j], lower[:, j], np.zeros(0)) for j in range(form.parts)]


def _moved_entries(state: DataFrame, books: np.ndarray, form: Form) -> np.ndarray:
    """Each entry at the floor of the mean of its parts."""
    parts, k, width = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, k, width + 1), np.int64)
        for batch in batches:
            v = matrix(batch.column("v")).astype(np.int64).reshape(batch.num_rows, parts, width)
            code = _codes(batch, form)
            for j in range(parts):
                np.add.at(total[j, :, :width], code[:, j], v[:, j])
                total[j, :, width] += np.bincount(code[:, j], minlength=k)
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total.ravel()[place])], ["place", "total"])

    total = np.zeros(parts * k * (width + 1), np.int64)
    for row in state.select("v", "code").mapInArrow(sums, "place long, total long").groupBy("place").agg(F.sum("total").alias("total")).collect():
        total[row["place"]] = row["total"]
    total = total.reshape(parts, k, width + 1)
    count = total[:, :, width:]
    return np.where(count > 0, total[:, :, :width] // np.maximum(count, 1), books)


def compress(
    df: DataFrame, key: str, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> Codes:
    """Codes of all vectors under codebooks that are learned from all of them."""
    spark = df.sparkSession
    others = [c for c in df.columns if c != vector]
    rows, length, largest = whole_vectors(df, {"row": F.struct(*[quoted(c) for c in others])}, vector, scale)
    result = T.StructType([rows.schema["row"], T.StructField("code", T.ArrayType(T.IntegerType())), T.StructField("error", T.LongType())])
    if not length:
        return Codes(spark.createDataFrame([], result), np.zeros((parts, 0, 0), np.int64), [])
    if length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    width = length // parts
    first = rows.select(F.col("row").getField(key).alias("key"), "v").orderBy(F.col("key").asc_nulls_last(), "v").limit(entries).collect()
    books = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2)
    k = len(first)
    # entries stay within the range of the components, so no distance is above this
    form = Form(parts, max(1.0, 2.0 * largest * width**0.5) / (OPEN - 1), np.uint8 if k <= 256 else np.uint16)

    kept = T.StructType([
        rows.schema["row"], rows.schema["v"], *[T.StructField(n, T.BinaryType()) for n in ("code", "upper", "near", "lower")],
        T.StructField("need", T.IntegerType()), T.StructField("verified", T.IntegerType()),
    ])

    def cut(batch: pa.RecordBatch) -> np.ndarray:
        return matrix(batch.column("v")).reshape(batch.num_rows, parts, width)

    def beginning(shared, b: int):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    x = cut(batch)
                    states = [assign_all(x[:, j], shared.value[0][j], b) for j in range(parts)]
                    verified = pa.array(np.full(batch.num_rows, parts), pa.int32())
                    yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("v"), *_packed(states, form), verified], kept.names)

        return work

    def bounded(batch: pa.RecordBatch, shared, b: int) -> tuple[np.ndarray, list[State], np.ndarray]:
        x, verified = cut(batch), np.zeros(batch.num_rows, np.int32)
        states = []
        for j, old in enumerate(_unpacked(batch, form)):
            state, looked = assign_bounded(x[:, j], shared.value[0][j], shared.value[1][j], old, b)
            states.append(state)
            verified += looked
        return x, states, verified

    def following(shared, b: int):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    _, states, verified = bounded(batch, shared, b)
                    yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("v"), *_packed(states, form), pa.array(verified)], kept.names)

        return work

    def last(shared, b: int):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    x, states, _ = bounded(batch, shared, b)
                    code = np.stack([s.code for s in states], axis=1)
                    error = np.zeros(batch.num_rows, np.int64)
                    for j in range(parts):
                        step = x[:, j].astype(np.int64) - shared.value[0][j][code[:, j]]
                        error += (step * step).sum(axis=1)
                    offsets = pa.array(np.arange(0, code.size + 1, parts), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("row"), pa.ListArray.from_arrays(offsets, pa.array(code.ravel(), pa.int32())), pa.array(error)], ["row", "code", "error"]
                    )

        return work

    b = max(1, k // FIRST_BOUNDS)
    state = stored(rows.mapInArrow(beginning(shared_value(spark, (books,)), b), kept))
    shares = []
    for turn in range(rounds):
        before, books = books, _moved_entries(state, books, form)
        step = books - before
        moved = _above((step * step).sum(axis=2)) * (step != 0).any(axis=2)  # an entry that stays moves by nothing
        shared = shared_value(spark, (books, moved.astype(np.float32)))
        if turn:
            need, verified, n = state.agg(F.max("need"), F.sum("verified"), F.count(F.lit(1))).first()
            shares.append(verified / (n * parts))
            b = min(b, max(need, k // LEAST_BOUNDS, 1))
        if turn < rounds - 1:
            state = stored(state.mapInArrow(following(shared, b), kept))
    work = last(shared, b) if rounds else last(shared_value(spark, (books, np.zeros(books.shape[:2], np.float32))), b)
    return Codes(state.mapInArrow(work, result), books, shares)


def decoded(codes: np.ndarray, codebooks: np.ndarray) -> np.ndarray:
    """The vectors of whole numbers that codes (rows x parts) stand for."""
    return np.concatenate([codebooks[j][codes[:, j]] for j in range(len(codebooks))], axis=1)


def code_digests(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Per row: id, code in hex, squared error, error of all rows of the label, digest of the codebooks."""
    found = compress(df.select("vec_id", "label", vector), "vec_id", vector)
    digest = hashlib.sha256(",".join(map(str, found.codebooks.ravel().tolist())).encode()).hexdigest()
    two_digits = F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0")))
    rows = stored(found.rows.select("row.vec_id", "row.label", F.array_join(two_digits, "").alias("code"), "error"))
    sums = rows.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    joined = rows.join(measured_side(sums).frame, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))

"""SimHash near-duplicates by an inverted index over byte positions.

Fingerprints of eight bytes that differ in at most three bits agree in five byte positions at least.  Split
the positions into two halves of four: five agreements put three into one half, so both fingerprints
are in the posting list of one of the eight triples of positions within a half, under the same three
bytes.  For pairs that meet in a list the shared positional bytes are tallied, pairs that reach five are
verified by their differing bits.

Equal fingerprints are one entry, so copies never meet each other.  A list longer than `LONG_LIST` is dealt out
again under two further positions: its members share five bytes then, which leaves at most 2^24 of them, and
there the neighbours of an entry are looked up bit by bit instead of pair by pair.  What a list yields are
links to the smallest entry of each group in it, no more than it has entries.

Defined results: a NULL or wordless text has the fingerprint zero and links like any other; rows with a NULL
doc_id are linked too, and a component that has no other rows has a NULL component_id; repeated rows each get
their row; an empty table gives none.  Other columns are not read (or kept as they are by `keep_one_of_each`).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joins import measured_side
from .common import free_names, map_texts, stored, tidy
from .components import components
from .vectors import quoted

SHINGLE = 3
SEED = 42
DISTANCE = 3
SHARED_BYTES = 8 - DISTANCE  # the guaranteed minimum of equal positional bytes
LONG_LIST = 4096
SHORT_LIST = 16  # lists up to this length are compared together, many at a time
HASHED_AT_ONCE = 100_000
TRIPLES = [t for half in ((0, 1, 2, 3), (4, 5, 6, 7)) for t in combinations(half, 3)]
# Bit patterns that flip one to three bits.
FLIPS = np.array([sum(1 << b for b in bits) for n in (1, 2, 3) for bits in combinations(range(24), n)], np.uint64)


def fingerprint(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Majority of the bits of all shingles' hashes; bytes.split() and lower() act on ASCII alone."""
    words = text.lower().split() if text else []
    n = len(words)
    if not n:
        return 0
    width = min(shingle, n)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    begins = np.r_[0, ends[:-1] + 1][: n - width + 1].tolist()
    ends = ends[width - 1 :].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(begins), HASHED_AT_ONCE):
        hashes = np.array(
            [digest(joined[i:j], seed) for i, j in zip(begins[at : at + HASHED_AT_ONCE], ends[at : at + HASHED_AT_ONCE])], "<u8"
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(ones * 2 > len(begins), bitorder="little")
    return int.from_bytes(majority.tobytes(), "little")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE, name: str = "fingerprint", keep: list[str] | None = None) -> DataFrame:
    """`docs` (or its columns `keep`) with the fingerprint as a long."""
    kept = list(map(quoted, docs.columns if keep is None else keep))
    (held,) = free_names(docs, "text")
    frame = docs.select(*kept, F.col("text").cast("binary").alias(held))
    schema = docs.select(*kept).schema.add(name, "long")

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        marks = [_signed(fingerprint(t, shingle)) for t in batch.column(held).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(marks, pa.int64())], schema.names)

    return map_texts(frame, work, schema, held)


def _bits(values: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values.view(np.uint64))


def _shared_bytes(x: np.ndarray) -> np.ndarray:
    """Equal byte positions of pairs, given their differing bits."""
    return (x.view(np.uint8).reshape(*x.shape, 8) == 0).sum(axis=-1)


def _roots(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest index of each index's group, by repeated lowering along the pairs."""
    root = np.arange(n)
    for a, b in pairs:
        while len(a):
            ra, rb = root[a], root[b]
            apart = ra != rb
            if not apart.any():
                break
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while (root[root] != root).any():
                root = root[root]
    return root


def _close_pairs(prints: np.ndarray, distance: int, rows: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of one list, by tally and check, `rows` entries against all at a time."""
    for at in range(0, len(prints), rows):
        x = prints[at : at + rows, None] ^ prints[None, at:]
        i, j = np.nonzero(np.triu(np.ones(x.shape, bool), 1))
        d = x[i, j]
        reach = _shared_bytes(d) >= 8 - distance
        i, j, d = i[reach], j[reach], d[reach]
        near = _bits(d) <= distance
        yield i[near] + at, j[near] + at


def _flipped_pairs(prints: np.ndarray, free: tuple[int, ...], distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a list whose members differ in the bytes `free` only: every entry with up to three bits flipped, looked up."""
    raw = prints.view(np.uint8).reshape(-1, 8)
    rest = sum(raw[:, p].astype(np.uint64) << np.uint64(8 * k) for k, p in enumerate(free))
    order = np.argsort(rest, kind="stable")
    sorted_rest = rest[order]
    for flip in FLIPS[np.bitwise_count(FLIPS) <= distance]:
        wanted = rest ^ flip
        at = np.minimum(np.searchsorted(sorted_rest, wanted), len(order) - 1)
        hit = np.flatnonzero(sorted_rest[at] == wanted)
        yield hit, order[at[hit]]


def _list_links(prints: np.ndarray, shared: tuple[int, ...], distance: int, long_list: int) -> tuple[np.ndarray, np.ndarray]:
    """(entry, smallest entry of its group) within one posting list, entries alone left out."""
    if len(prints) > long_list and len(shared) >= 5:
        pairs = _flipped_pairs(prints, tuple(p for p in range(8) if p not in shared), distance)
    else:
        pairs = _close_pairs(prints, distance)
    root = _roots(len(prints), pairs)
    moved = np.flatnonzero(root != np.arange(len(prints)))
    return prints[moved], prints[root[moved]]


def _keys(places: list[tuple[int, ...]]) -> Column:
    """Array of (list number, its bytes) of a fingerprint."""
    entries = []
    for number, places_of in enumerate(places):
        mask = sum(0xFF << (8 * p) for p in places_of)
        entries.append(F.struct(F.lit(number).alias("list"), F.col("print").bitwiseAND(F.lit(_signed(mask))).alias("bytes")))
    return F.array(*entries)


def _short_links(prints: np.ndarray, lists: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Close pairs of many short lists: every entry against the ones up to SHORT_LIST places on, if of the same list."""
    found = [(prints[:0], prints[:0])]
    for step in range(1, SHORT_LIST):
        i = np.flatnonzero(lists[step:] == lists[:-step])
        if not len(i):
            break
        x = prints[i] ^ prints[i + step]
        i = i[(_shared_bytes(x) >= 8 - distance) & (_bits(x) <= distance)]
        found.append((prints[i + step], prints[i]))
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _search(entries: DataFrame, places: list[tuple[int, ...]], distance: int, long_list: int) -> DataFrame:
    """Links found in the posting lists; `entries` has list, bytes, print, and every list lies in one partition."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(pair: tuple[np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
            a, b = pair
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        def whole(prints: list[np.ndarray], number: int) -> Iterator[pa.RecordBatch]:
            joined = np.concatenate(prints)
            if len(joined) > 1:
                yield from links(_list_links(joined, places[number], distance, long_list))

        held: list[np.ndarray] = []  # of the list that may go on in the next batch
        current = None
        for batch in batches:
            number, key, prints = (batch.column(i).to_numpy() for i in range(3))
            if not len(number):
                continue
            prints = prints.view(np.uint64)
            starts = np.flatnonzero(np.r_[True, (number[1:] != number[:-1]) | (key[1:] != key[:-1])])
            sizes = np.diff(np.r_[starts, len(number)])
            if (int(number[0]), int(key[0])) != current:
                if held:
                    yield from whole(held, current[0])
                held = []
            if len(starts) > 1:
                yield from whole([*held, prints[: starts[1]]], int(number[0]))
                held = []
                inner = np.repeat(np.arange(len(starts)), sizes)
                short = np.repeat(sizes <= SHORT_LIST, sizes)
                short[: starts[1]] = short[starts[-1] :] = False
                yield from links(_short_links(prints[short], inner[short], distance))
                for k in (np.flatnonzero(sizes[1:-1] > SHORT_LIST) + 1).tolist():
                    yield from whole([prints[starts[k] : starts[k + 1]]], int(number[starts[k]]))
            held.append(prints[starts[-1] :].copy())
            current = (int(number[-1]), int(key[-1]))
        if held:
            yield from whole(held, current[0])

    ordered = entries.repartition("list", "bytes").sortWithinPartitions("list", "bytes", "print")
    return ordered.select("list", "bytes", "print").mapInArrow(tidy(work), "a long, b long")


def close_fingerprints(prints: DataFrame, distance: int = DISTANCE, long_list: int = LONG_LIST) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (column `print`) at most `distance` bits apart."""
    index = prints.select("print", F.explode(_keys(TRIPLES)).alias("k")).select("k.list", "k.bytes", "print")
    # counted apart and joined: a window would hold a long list in one task
    lengths = index.groupBy("list", "bytes").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sized = stored(index.join(lengths, ["list", "bytes"]))
    short = _search(sized.filter(F.col("n") <= long_list), TRIPLES, distance, long_list)
    # longer lists under two further positions; five shared bytes contain the triple and one such pair
    wider = [(number, tuple(sorted((*t, *pair)))) for number, t in enumerate(TRIPLES) for pair in combinations(set(range(8)) - set(t), 2)]
    places = [p for _, p in wider]
    options = F.array(*[F.struct(F.lit(n).alias("of"), k.alias("k")) for n, k in _wider_keys(wider)])
    long = sized.filter(F.col("n") > long_list).select("list", "print", F.explode(options).alias("o"))
    dealt = long.filter(F.col("o.of") == F.col("list")).select(F.col("o.k.list").alias("list"), F.col("o.k.bytes").alias("bytes"), "print")
    return short.union(_search(dealt, places, distance, long_list))


def _wider_keys(wider: list[tuple[int, tuple[int, ...]]]):
    for place, (number, positions) in enumerate(wider):
        mask = sum(0xFF << (8 * p) for p in positions)
        yield number, F.struct(F.lit(place).alias("list"), F.col("print").bitwiseAND(F.lit(_signed(mask))).alias("bytes"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, long_list: int = LONG_LIST) -> DataFrame:
    """Per row of `docs`: doc_id, fingerprint (long), root (smallest fingerprint of the component), component_id."""
    marked = stored(with_fingerprints(docs, shingle, keep=["doc_id"]))
    return _grouped(marked, distance, long_list).select("doc_id", "fingerprint", "root", "component_id")


def _grouped(marked: DataFrame, distance: int, long_list: int = LONG_LIST) -> DataFrame:
    """`marked`, which has doc_id and fingerprint, with root and component_id."""
    entries = stored(marked.groupBy(F.col("fingerprint").alias("print")).agg(F.min("doc_id").alias("first")))
    links = close_fingerprints(entries.select("print"), distance, long_list)
    grouped = components(links.select("a", "b"))
    rooted = entries.join(grouped, entries.print == grouped.node, "left").select("print", "first", F.coalesce("root", "print").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(smallest, "root").select(F.col("print").alias("fingerprint"), "root", "component_id")
    return marked.join(named, "fingerprint")


def fingerprint_digests(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of each component: of its smallest doc_id, and of repeated rows one.

    The rows are written once with their fingerprints and numbers; what goes is chosen among these, and only its
    numbers come back to the texts: broadcast if they are few, else by a shuffle.
    """
    mark, number = free_names(docs, "fingerprint", "number")
    rows = stored(with_fingerprints(docs, shingle, mark).withColumn(number, F.monotonically_increasing_id()))
    narrow = rows.select("doc_id", quoted(mark).alias("fingerprint"), F.xxhash64("text").alias("hash"), quoted(number).alias("number"))
    found = stored(_grouped(narrow, distance).select("root", "doc_id", "fingerprint", "hash", "number"))
    # a NULL id comes last, and equal rows are told apart by their numbers
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fingerprint", "hash", "number")).alias("first")
    kept = found.groupBy("root").agg(first).select(F.col("first.number").alias("number"))
    gone = found.join(kept, "number", "left_anti").select(F.col("number").alias(number))
    return rows.join(measured_side(gone).frame, number, "left_anti").select(*map(quoted, docs.columns))

"""Class-based n-grams: exchange clustering, class transitions, word emissions.

Training tokens are counted over the whole corpus.  Every word seen `LEAST` times or more is in a learned class.  The
most frequent words (the core) are exchanged one at a time for the class that raises the likelihood of the class
bigrams most, which gives the classes their start.  The other words of the head then join the class of highest
likelihood, and rounds in Spark exchange the words of the head, half of them at a time, against the class bigrams of
the round; a round that does not raise the likelihood is not kept, and ends them.  Words beyond the head, whose number
grows with the corpus, choose their class in one further round, by their neighbours' classes.  Words seen less often
and unknown ones share the last class.  A text's probability is the product of class transitions, smoothed by the
classes' own frequencies, and of the words' shares in their class, which leave room for one unknown word in the last.

Counts are summed in Spark.  Words above `HEAD` in rank are looked up in a table of fixed size that is broadcast;
the others are joined by word.  What reaches the driver is bounded: the head, the bigram counts of core words, and
those of classes.

Defined results: a NULL text counts as empty and has the end token alone; a NULL doc_id is not held out; rows
that repeat are each counted and each get their row; an empty table gives none; a base score with
nothing learned is that of the formula (one unknown token in a vocabulary of none).  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import map_texts, remainder, shared_value, slices, stored

CORE = 1_000  # words that are exchanged one by one before the rounds
CLASSES = 64  # at most 250: a class is stored as a byte
LEAST = 2  # occurrences of a word in a learned class
ROUNDS = 3  # of exchanges in Spark, after the one in which the head's other words join
HEAD = 200_000  # words looked up in memory, at most
STEPS = 64  # steps of counts per power of two, to find where the head ends
HELD_WORDS = 300_000  # distinct words a task holds before it emits their counts
HELD_CELLS = 1 << 20  # cells of the most frequent words, which a task holds in an array
HELD_CODES = 1 << 22  # cells of other words, each for one occurrence, that a task holds before it adds them up and emits them
ENCODED_BYTES = 8 << 20  # of texts whose words are looked up together, which sets the head up once
AT_ONCE = 256  # words whose classes are chosen together
PASSES = 12
BACKOFF = 5.0  # weight of the classes' own frequencies in a transition


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all values, where each begins and the last ends) of a binary column."""
    _, offsets, values = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int32)
    return np.frombuffer(values or b"", np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary column of the values between each of `ends` and the next."""
    offsets = ((ends - ends[0]) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words, where each text's begin and the last ends) of binary texts: split at ASCII white space, ASCII letters lowered."""
    raw, ends = _flat(texts)
    lowered = pc.ascii_lower(_binary(raw, ends).view(pa.string()))
    lists = pc.ascii_split_whitespace(lowered)
    words = lists.values.view(pa.binary())
    some = pc.binary_length(words).to_numpy() > 0  # white space at either end leaves an empty one
    return words.filter(pa.array(some)), np.r_[0, np.cumsum(some)][lists.offsets.to_numpy()]


def _trained(docs: DataFrame, divisor: int, held: int) -> DataFrame:
    out = F.coalesce(remainder("doc_id", divisor) == held, F.lit(False))
    return docs.select("doc_id", out.alias("held_out"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, n) over the training rows; a task adds up before anything is shuffled."""

    def added(words: list[pa.Array], counts: list[np.ndarray]) -> tuple[list[pa.Array], list[np.ndarray]]:
        coded = pa.concat_arrays(words).dictionary_encode()
        n = np.zeros(len(coded.dictionary), np.int64)
        np.add.at(n, coded.indices.to_numpy(), np.concatenate(counts))
        return [coded.dictionary], [n]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = [], []

        def emitted() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([words[0], pa.array(counts[0])], ["word", "n"])

        for batch in batches:
            for part in slices(batch, "text"):
                coded = words_of(part.column("text"))[0].dictionary_encode()
                words.append(coded.dictionary)
                counts.append(np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary)).astype(np.int64))
                if sum(map(len, words)) > 2 * HELD_WORDS:
                    words, counts = added(words, counts)
                    if len(words[0]) > HELD_WORDS:
                        yield emitted()
                        words, counts = [], []
        if words:
            words, counts = added(words, counts)
            yield emitted()

    partial = rows.filter("not held_out").select("text").mapInArrow(count, "word binary, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


class Head(NamedTuple):
    """The most frequent words, by number in falling order of count, and what the corpus adds up to."""

    number: dict[bytes, int]
    counts: np.ndarray
    ends: int
    tokens: int  # all training tokens, ends included
    distinct: int
    rare: int  # words seen less than LEAST times, in the whole corpus
    core: int  # words below this number are exchanged one by one
    movable: int  # words below this number are in learned classes


def _head(counts: DataFrame, ends: int, core: int, size: int) -> Head:
    total, distinct, rare = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.count_if(F.col("n") < LEAST)
    ).first()
    step = F.floor(F.log2("n") * STEPS)
    above, lowest = 0, None
    for r in counts.groupBy(step.alias("step")).count().orderBy(F.col("step").desc()).collect():  # STEPS rows per power of two
        above += r["count"]
        if above > size:
            break
        lowest = r["step"]
    frequent = counts.filter(step >= lowest) if lowest is not None else counts.limit(0)
    top = frequent.toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    words, n = top.column("word").to_pylist(), top.column("n").to_numpy()
    movable = int((n >= LEAST).sum())
    return Head({w: i for i, w in enumerate(words)}, n, ends, total + ends, distinct + int(ends > 0), rare, min(core, movable), movable)


# Symbols: the numbers of the head's words, then the end of a text, then any word outside the head.
# Classes: the learned ones, then the end, then the rest: words seen too rarely, unknown, or not yet in a class.


def _weight(counts: np.ndarray) -> np.ndarray:
    """log10 of what a word weighs within its class."""
    return np.log10(np.where(counts >= LEAST, counts, counts + 1.0))


SYMBOLS = ["low", "high"]  # a text's symbols, each in two columns of 16 bits


def _symbols(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, where each text's begin and the last ends) from the columns `SYMBOLS`."""
    low, ends = _flat(batch.column("low"))
    high, _ = _flat(batch.column("high"))
    return low.view(np.uint16).astype(np.int32) | high.view(np.uint16).astype(np.int32) << 16, ends // 2


def _classes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return _flat(batch.column("classes"))


def _encoded(rows: DataFrame, head: Head, kind: str) -> DataFrame:
    """Per row: symbols of its tokens, sums over its head words, and its words outside the head with their places."""
    shared = shared_value(rows.sparkSession, (pa.array(list(head.number), pa.binary()), head.counts))  # bounded by HEAD

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        known, counts = shared.value
        outside, end = len(counts) + 1, len(counts)
        weight, log = np.r_[_weight(counts), 0.0, 0.0], np.r_[np.log10(counts + 1.0), 0.0, 0.0]
        words, ends = words_of(batch.column("text"))
        symbols = pc.index_in(words, value_set=known).fill_null(outside).to_numpy()
        at = np.flatnonzero(symbols == outside)
        logs, weights = log[symbols], weight[symbols]
        texts = list(zip(ends[:-1].tolist(), ends[1:].tolist()))
        tails = np.searchsorted(at, ends)
        tail = pa.StructArray.from_arrays(
            [pa.array((at - ends[np.searchsorted(ends, at, side="right") - 1]).astype(np.int32)), words.take(pa.array(at))], ["place", "word"]
        )
        closed = np.insert(symbols, ends[1:], end)
        sizes = ends + np.arange(len(ends))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), batch.column("held_out"), pa.array(np.diff(sizes).astype(np.int64)),
                pa.array((np.diff(ends) - np.diff(tails)).astype(np.int64)), pa.array([logs[i:j].sum() for i, j in texts], pa.float64()),
                pa.array([weights[i:j].sum() for i, j in texts], pa.float64()),
                _binary(closed.astype(np.uint16), sizes), _binary((closed >> 16).astype(np.uint16), sizes),
                pa.ListArray.from_arrays(pa.array(tails.astype(np.int32)), tail),
            ],
            ["doc_id", "held_out", "n_tokens", "known", "base", "weight", *SYMBOLS, "tail"],
        )

    schema = (
        f"doc_id {kind}, held_out boolean, n_tokens long, known long, base double, weight double, low binary, high binary, "
        "tail array<struct<place:int,word:binary>>"
    )
    return stored(map_texts(rows, work, schema, most=ENCODED_BYTES).withColumn("row_id", F.monotonically_increasing_id()))


def _square(found: pa.Table, size: int) -> np.ndarray:
    table = np.zeros(size * size, np.int64)
    table[found.column("key").to_numpy()] = found.column("n").to_numpy()
    return table.reshape(size, size)


Flat = Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]


def _whole_texts(batches: Iterator[pa.RecordBatch], flat: Flat, most: int = 1 << 20) -> Iterator[np.ndarray]:
    """The values of whole texts, about `most` at a time, in pieces that all end with a text's end."""
    for batch in batches:
        values, ends = flat(batch)
        at = 0
        while at < len(ends) - 1:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, side="right")) - 1)
            yield values[ends[at] : ends[to]].astype(np.int64)
            at = to


def _cells(rows: DataFrame, columns: list[str], flat: Flat, codes: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """How often each code below size * size is made of the values of `columns`, as a square that the driver holds too."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros(size * size, np.int64)
        for values in _whole_texts(batches, flat):
            dense += np.bincount(codes(values), minlength=size * size)
        code = np.flatnonzero(dense)
        for i in range(0, len(code), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(code[i : i + 100_000]), pa.array(dense[code[i : i + 100_000]])], ["key", "n"])

    cells = rows.select(*columns).mapInArrow(count, "key long, n long")
    return _square(cells.groupBy("key").agg(F.sum("n").alias("n")).toArrow(), size)


# Cells of words travel in blocks: a row for a block and all its cells, keys in 16 bits, counts in 8 bits or, if larger, in 64.
PACKED = "block int, keys binary, counts binary, large_keys binary, large_counts binary"
KEYS = 1 << 16


class Blocks(NamedTuple):
    """Where cells of words are: word w is in block w % count, and its cells stand from w // count * width on."""

    count: int  # the block of this number has the class bigrams
    width: int

    @staticmethod
    def of(words: int, width: int) -> Blocks:
        return Blocks(max(1, -(-words // (KEYS // width))), width)

    def first(self, word: np.ndarray) -> np.ndarray:
        return word % self.count * KEYS + word // self.count * self.width


def _packed(code: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Rows for cells in order; a code is block * KEYS + key."""
    block = code // KEYS
    of = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(code) else np.zeros(0, np.int64)
    large, key, ends = n > 255, (code % KEYS).astype(np.uint16), np.r_[of, len(code)]
    columns = []
    for mine, kind in ((~large, np.uint8), (large, np.int64)):
        cuts = np.r_[0, np.cumsum(mine)][ends]
        columns += [_binary(key[mine], cuts), _binary(n[mine].astype(kind), cuts)]
    return pa.RecordBatch.from_arrays([pa.array(block[of].astype(np.int32)), *columns], ["block", "keys", "counts", "large_keys", "large_counts"])


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(block, keys, counts) of parts of the rows; no key comes twice in a part."""
    for at, kind in ((1, np.uint8), (3, np.int64)):
        keys, ends = _flat(batch.column(at))
        keys, ends, counts = keys.view(np.uint16), ends // 2, _flat(batch.column(at + 1))[0].view(kind)
        for block, i, j in zip(batch.column(0).to_pylist(), ends[:-1].tolist(), ends[1:].tolist()):
            if j > i:
                yield block, keys[i:j], counts[i:j]


def _core_bigrams(trained: DataFrame, head: Head) -> np.ndarray:
    """Counts of neighbours among core words, the end and all others, the end standing before each text too."""
    core, end, size = head.core, len(head.counts), head.core + 2

    def codes(flat: np.ndarray) -> np.ndarray:
        symbol = np.where(flat < core, flat, np.where(flat == end, core, core + 1))
        return np.r_[core, symbol[:-1]] * size + symbol

    return _cells(trained, SYMBOLS, _symbols, codes, size)


def _class_bigrams(trained: DataFrame, member: np.ndarray, groups: int) -> np.ndarray:
    size = groups + 2
    shared = shared_value(trained.sparkSession, member)  # bounded by HEAD

    def codes(flat: np.ndarray) -> np.ndarray:
        own = shared.value[flat].astype(np.int64)
        return np.r_[groups, own[:-1]] * size + own

    return _cells(trained, SYMBOLS, _symbols, codes, size)


def _contexts(trained: DataFrame, head: Head, member: np.ndarray, groups: int) -> tuple[DataFrame, np.ndarray]:
    """Cells of the head's movable words, a row for each block of words, and the class bigrams.

    Keys: the class before the word, that after it (plus the number of classes), or itself after it (the last key).
    A task adds up its cells before anything is shuffled; a partition of the blocks then holds HEAD times the keys of a
    word, over the number of shuffle partitions.
    """
    spark, movable, size = trained.sparkSession, head.movable, groups + 2
    shared = shared_value(spark, member)  # bounded by HEAD
    width = 2 * size + 1
    blocks = Blocks.of(movable, width)
    frequent = min(movable, HELD_CELLS // width)
    kind = np.uint32 if blocks.count < KEYS else np.int64

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = blocks.first(np.arange(movable)).astype(kind)
        bigrams, dense = np.zeros(size * size, np.int64), np.zeros(frequent * width, np.int64)
        waiting, held = [], 0

        def emitted() -> pa.RecordBatch:
            code = np.sort(np.concatenate(waiting))
            starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
            return _packed(code[starts].astype(np.int64), np.diff(np.r_[starts, len(code)]))

        for flat in _whole_texts(batches, _symbols):
            own = shared.value[flat].astype(np.int64)
            before, after = np.r_[groups, own[:-1]], np.r_[own[1:], groups]
            bigrams += np.bincount(before * size + own, minlength=size * size)
            again = np.r_[flat[1:] == flat[:-1], False]  # a text closes with the end, so the next one is of the text
            at = np.flatnonzero(flat < frequent)
            cell = flat[at] * width
            codes = np.concatenate([cell + before[at], cell + size + after[at], cell[again[at]] + 2 * size])
            dense += np.bincount(codes, minlength=len(dense))
            at = np.flatnonzero((flat >= frequent) & (flat < movable))
            cell = first[flat[at]]
            codes = [cell + before[at].astype(kind), cell + (size + after[at]).astype(kind), cell[again[at]] + kind(2 * size)]
            waiting += codes
            held += sum(map(len, codes))
            if held > HELD_CODES:
                yield emitted()
                waiting, held = [], 0
        if held:
            yield emitted()
        at = np.flatnonzero(dense)
        code = blocks.first(at // width) + at % width
        order = np.argsort(code)
        yield _packed(code[order], dense[at[order]])
        at = np.flatnonzero(bigrams)
        yield _packed(blocks.count * KEYS + at, bigrams[at])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, keys, n in _unpacked(batch):
                if block not in sums:
                    sums[block] = np.zeros(KEYS, np.int64)
                sums[block][keys] += n
        for block, cells in sums.items():
            at = np.flatnonzero(cells)
            yield _packed(block * KEYS + at, cells[at])

    width_of_shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = trained.select(*SYMBOLS).mapInArrow(count, PACKED).repartition(width_of_shuffle, "block").mapInArrow(add_up, PACKED)
    cells = stored(cells)
    table = np.zeros(size * size, np.int64)
    for batch in cells.filter(F.col("block") == blocks.count).toArrow().to_batches():
        for _, keys, n in _unpacked(batch):
            table[keys] = n
    return cells.filter(F.col("block") < blocks.count), table.reshape(size, size)


def _plogp(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1)), 0.0)


def exchange(table: np.ndarray, movable: int, classes: int, passes: int = PASSES) -> np.ndarray:
    """Class of each symbol.  The first `movable` are exchanged between `classes` classes, each other one is its own.

    One word at a time goes to the class with the highest likelihood of the class bigrams, all else staying.
    """
    size = len(table)
    groups = max(1, min(classes, movable))
    member = np.r_[np.arange(movable) % groups, np.arange(size - movable) + groups].astype(np.int64)
    total = size - movable + groups
    one = np.zeros((size, total))
    one[np.arange(size), member] = 1
    outgoing, incoming = table @ one, table.T @ one  # of a word into classes, and from classes into it
    left = one.T @ outgoing  # class bigrams
    for _ in range(passes if groups > 1 else 0):
        moves = 0
        for w in range(movable):
            own, after, before, self_loop = member[w], outgoing[w], incoming[w], table[w, w]
            # take the word out of its class
            left[own] -= after
            left[:, own] -= before
            left[own, own] += self_loop
            a, b = after.copy(), before.copy()
            a[own] -= self_loop
            b[own] -= self_loop
            rows, columns = left.sum(axis=1) + b, left.sum(axis=0) + a
            # what each candidate gains in cells, less in the sums of its row and column
            block = left[:groups]
            gain = (_plogp(block + a) - _plogp(block)).sum(axis=1)
            block = left[:, :groups].T
            gain += (_plogp(block + b) - _plogp(block)).sum(axis=1)
            at = np.arange(groups)
            d = left[at, at]
            gain += _plogp(d + a[at] + b[at] + self_loop) - _plogp(d + a[at]) - _plogp(d + b[at]) + _plogp(d)
            gain -= _plogp(rows[:groups] + after.sum()) - _plogp(rows[:groups]) + _plogp(columns[:groups] + before.sum()) - _plogp(columns[:groups])
            best = int(np.argmax(gain))
            if gain[best] <= gain[own] + 1e-9:
                best = own
            left[best] += a
            left[:, best] += b
            left[best, best] += self_loop
            if best != own:
                outgoing[:, own] -= table[:, w]
                outgoing[:, best] += table[:, w]
                incoming[:, own] -= table[w]
                incoming[:, best] += table[w]
                member[w] = best
                moves += 1
        if not moves:
            break
    return member


def likelihood(table: np.ndarray) -> float:
    """Of class bigrams, up to what does not depend on the classes."""
    t = table.astype(float)
    return float(_plogp(t).sum() - _plogp(t.sum(axis=0)).sum() - _plogp(t.sum(axis=1)).sum())


def best_classes(after: np.ndarray, before: np.ndarray, loop: np.ndarray, own: np.ndarray, table: np.ndarray, groups: int) -> np.ndarray:
    """For each word the learned class of highest likelihood, all other words staying where they are.

    `after` and `before` count the classes next to each word, `loop` itself next to itself; `table` has the class
    bigrams with the word in its own class, which it leaves only for a better one.
    """
    at, learned = np.arange(len(own)), np.flatnonzero(own < groups)
    a, b = after.astype(float), before.astype(float)
    a[at, own] -= loop
    b[at, own] -= loop
    gain = np.zeros((len(own), groups))
    for x, other, raw, t in ((a, before, after, table), (b, after, before, table.T)):
        w, k = np.nonzero(x)
        if len(w):
            cell = t[:groups].T[k].astype(float)  # of each class with each neighbouring class, the word taken out
            mine = k == own[w]
            cell[mine] -= other[w[mine], :groups]
            hit = np.flatnonzero(own[w] < groups)
            cell[hit, own[w[hit]]] -= raw[w[hit], k[hit]]
            both = np.flatnonzero(mine & (own[w] < groups))
            cell[both, own[w[both]]] += loop[w[both]]
            starts = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
            gain[w[starts]] += np.add.reduceat(_plogp(cell + x[w, k][:, None]) - _plogp(cell), starts)
        n = raw.sum(axis=1)
        sums = np.tile(t.sum(axis=1)[:groups].astype(float), (len(own), 1))
        sums[learned, own[learned]] -= n[learned]
        gain -= _plogp(sums + n[:, None]) - _plogp(sums)
    d = np.tile(np.diag(table)[:groups].astype(float), (len(own), 1))
    d[learned, own[learned]] -= (after[at, own] + before[at, own] - loop)[learned]
    x, y = a[:, :groups], b[:, :groups]
    gain += _plogp(d + x + y + loop[:, None]) - _plogp(d + x) - _plogp(d + y) + _plogp(d)
    best = gain.argmax(axis=1)
    stay = learned[gain[learned, best[learned]] <= gain[learned, own[learned]] + 1e-9]
    best[stay] = own[stay]
    return best


def _chosen(contexts: DataFrame, head: Head, member: np.ndarray, table: np.ndarray, groups: int, number: int) -> tuple[np.ndarray, np.ndarray]:
    """(words, classes) of the words in `contexts` that may move in a round: those without a class in the first, then half of all."""
    size = groups + 2
    shared = shared_value(contexts.sparkSession, (member, table))
    blocks, movable = Blocks.of(head.movable, 2 * size + 1), head.movable

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        member, table = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                cells = np.zeros(KEYS, np.int64)
                for block, key, n in _unpacked(batch.slice(i, 1)):
                    cells[key] = n
                words = np.arange(block, movable, blocks.count)
                keys = cells[: len(words) * blocks.width].reshape(len(words), blocks.width)
                half = (words * 2_654_435_761 >> 16) % 2 == number % 2
                free = np.flatnonzero(member[words] > groups if number == 0 else half)
                for j in range(0, len(free), AT_ONCE):
                    at, word = keys[free[j : j + AT_ONCE]], words[free[j : j + AT_ONCE]]
                    best = best_classes(at[:, size:-1], at[:, :size], at[:, -1], member[word].astype(np.int64), table, groups)
                    yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int32)), pa.array(best.astype(np.int16))], ["word", "class"])

    found = contexts.mapInArrow(choose, "word int, class smallint").toArrow()
    return found.column("word").to_numpy(), found.column("class").to_numpy()


def cluster_head(trained: DataFrame, head: Head, classes: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, int, list[float]]:
    """(class of each symbol, class bigrams, number of learned classes, likelihood after each round that was kept)."""
    groups = max(1, min(classes, head.core))
    start = exchange(_core_bigrams(trained, head), head.core, classes)
    member = np.full(len(head.counts) + 2, groups + 1, np.int16)
    member[: head.core] = start[: head.core]
    member[len(head.counts)] = groups
    contexts, table = _contexts(trained, head, member, groups)
    reached: list[float] = []
    for number in range(rounds + 1):
        if not head.movable:
            break
        word, best = _chosen(contexts, head, member, table, groups, number)
        moves = best != member[word]
        if not moves.any():
            if number == 0:
                reached.append(likelihood(table))
            continue
        moved = member.copy()
        moved[word[moves]] = best[moves]
        if number < rounds:
            more, after = _contexts(trained, head, moved, groups)
        else:  # no round is left to read the cells of words
            more, after = None, _class_bigrams(trained, moved, groups)
        value = likelihood(after)
        if number and value <= reached[-1]:
            break
        member, contexts, table = moved, more, after
        reached.append(value)
    return member, table, groups, reached


def _tail_classes(trained: DataFrame, head: Head, member: np.ndarray, table: np.ndarray, groups: int) -> DataFrame:
    """(word, n, class) of every training word outside the head, by the classes next to its occurrences."""
    size = groups + 2
    shared = shared_value(trained.sparkSession, (member, table))  # bounded by HEAD

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        member, _ = shared.value
        for batch in batches:
            (symbols, ends), tail = _symbols(batch), batch.column("tail")
            own = np.r_[groups, member[symbols]].astype(np.int32)  # one place on
            place = np.repeat(ends[:-1], tail.value_lengths().to_numpy()) + tail.flatten().field("place").to_numpy()
            yield pa.RecordBatch.from_arrays([tail.flatten().field("word"), pa.array(own[place] * size + own[place + 2])], ["word", "sides"])

    def classed(words: pa.Array, sides: np.ndarray, table: np.ndarray) -> pa.RecordBatch:
        coded = words.dictionary_encode()
        row = coded.indices.to_numpy()
        total = np.bincount(row, minlength=len(coded.dictionary))
        rest = np.full(len(total), groups + 1)
        often = np.flatnonzero(total >= LEAST)
        for i in range(0, len(often), AT_ONCE):
            some = often[i : i + AT_ONCE]
            mine = slice(*np.searchsorted(row, [some[0], some[-1] + 1]))  # equal words stand together
            at, inside = np.searchsorted(some, row[mine]), np.isin(row[mine], some)
            before, after = (
                np.bincount(at[inside] * size + side[mine][inside], minlength=len(some) * size).reshape(-1, size) for side in (sides // size, sides % size)
            )
            rest[some] = best_classes(after, before, np.zeros(len(some), np.int64), rest[some], table, groups)
        return pa.RecordBatch.from_arrays([coded.dictionary, pa.array(total.astype(np.int64)), pa.array(rest.astype(np.int16))], ["word", "n", "class"])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, table = shared.value
        words, sides = [], []  # the last word's, which may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            words, sides = [*words, batch.column(0)], [*sides, batch.column(1).to_numpy()]
            if words[0][0] == batch.column(0)[-1]:
                continue
            every, of = pa.concat_arrays(words), np.concatenate(sides)
            until = pc.index(every, every[-1]).as_py()
            yield classed(every.slice(0, until), of[:until], table)
            words, sides = [every.slice(until)], [of[until:]]
        if words:
            yield classed(pa.concat_arrays(words), np.concatenate(sides), table)

    seen = trained.select(*SYMBOLS, "tail").mapInArrow(neighbours, "word binary, sides int")
    sorted_out = seen.repartition("word").sortWithinPartitions("word")  # a word outside the head is one of HEAD tokens at most
    return stored(sorted_out.mapInArrow(choose, "word binary, n long, class smallint"))


def _in_classes(encoded: DataFrame, member: np.ndarray, kind: str, tail: DataFrame | None) -> DataFrame:
    """Per row: the classes of its tokens as bytes, and its sums, those of words outside the head included."""
    shared = shared_value(encoded.sparkSession, member.astype(np.uint8))  # bounded by HEAD
    sums = ["doc_id", "held_out", "n_tokens", "known", "base", "weight"]
    fields = f"doc_id {kind}, held_out boolean, n_tokens long, known long, base double, weight double"

    def narrowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols, ends = _symbols(batch)
            made = _binary(shared.value[symbols], ends)
            yield pa.RecordBatch.from_arrays([batch.column("row_id"), *[batch.column(c) for c in sums], made], ["row_id", *sums, "classes"])

    rows = encoded.select("row_id", *sums, *SYMBOLS).mapInArrow(narrowed, f"row_id long, {fields}, classes binary")
    if tail is None:
        return stored(rows.drop("row_id"))
    places = encoded.select("row_id", F.explode("tail").alias("t")).select("row_id", "t.place", "t.word")
    n = F.coalesce("n", F.lit(0))
    found = places.join(tail, "word", "left").groupBy("row_id").agg(
        F.collect_list(F.when(F.col("class").isNotNull(), F.struct("place", "class"))).alias("placed"),  # of one text
        F.count("class").alias("more_known"), F.sum(F.log10(n + 1.0)).alias("more_base"),
        F.sum(F.log10(F.when(n >= LEAST, n).otherwise(n + 1.0))).alias("more_weight"),
    )

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for text, placed in zip(batch.column("classes"), batch.column("placed")):
                own = np.frombuffer(text.as_py(), np.uint8).copy()
                if placed.is_valid and len(placed):
                    own[placed.values.field("place").to_numpy()] = placed.values.field("class").to_numpy()
                made.append(own.tobytes())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in sums], pa.array(made, pa.binary())], [*sums, "classes"])

    joined = rows.join(found, "row_id", "left").withColumns({
        "known": F.col("known") + F.coalesce("more_known", F.lit(0)),
        "base": F.col("base") + F.coalesce("more_base", F.lit(0.0)),
        "weight": F.col("weight") + F.coalesce("more_weight", F.lit(0.0)),
    })
    return stored(joined.select(*sums, "classes", "placed").mapInArrow(merged, f"{fields}, classes binary"))


class Model(NamedTuple):
    transition: np.ndarray  # log10 of a class after a class
    share: np.ndarray  # log10 of one occurrence within its class


def fit(table: np.ndarray, rare: int, groups: int) -> Model:
    """From the class bigrams; `rare` words are in the last class, and one unknown one."""
    seen = table.sum(axis=0).astype(float)
    wanted = seen + np.r_[np.zeros(groups), 1.0, 1.0]
    share = wanted / wanted.sum()
    chance = (table + BACKOFF * share[None]) / (table.sum(axis=1, keepdims=True) + BACKOFF)
    within = np.r_[np.maximum(seen[:groups], 1), 1.0, seen[groups + 1] + rare + 1.0]
    return Model(np.log10(np.maximum(chance, 1e-300)), -np.log10(within))  # a class without words is never met


class Learned(NamedTuple):
    head: Head
    encoded: DataFrame
    member: np.ndarray
    groups: int
    tail: DataFrame | None  # None if the head holds every word of the corpus
    reached: list[float]


def learn(docs: DataFrame, divisor: int, held: int, core: int, classes: int, head_size: int, kind: str) -> Learned:
    if not 0 < classes <= 250:
        raise ValueError("classes must be between 1 and 250")
    rows = _trained(docs, divisor, held)
    counts = stored(word_counts(rows))
    head = _head(counts, rows.filter("not held_out").count(), core, head_size)
    encoded = _encoded(rows, head, kind)
    trained = encoded.filter("not held_out")
    member, table, groups, reached = cluster_head(trained, head, classes)
    whole = head.distinct - int(head.ends > 0) == len(head.counts)
    return Learned(head, encoded, member, groups, None if whole else _tail_classes(trained, head, member, table, groups), reached)


def word_classes(
    docs: DataFrame, divisor: int = 7, held: int = 2, core: int = CORE, classes: int = CLASSES, head_size: int = HEAD
) -> DataFrame:
    """(word, n, class) of every training word; those seen less than LEAST times are in the last class."""
    made = learn(docs, divisor, held, core, classes, head_size, docs.schema["doc_id"].dataType.simpleString())
    frame = pa.table({
        "word": pa.array(list(made.head.number), pa.binary()), "n": pa.array(made.head.counts, pa.int64()),
        "class": pa.array(made.member[: len(made.head.counts)], pa.int16()),
    })
    of_head = docs.sparkSession.createDataFrame(frame)  # HEAD rows at most
    return of_head if made.tail is None else of_head.unionByName(made.tail)


def score_documents(
    docs: DataFrame, divisor: int = 7, held: int = 2, core: int = CORE, classes: int = CLASSES, head_size: int = HEAD
) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    made = learn(docs, divisor, held, core, classes, head_size, kind)
    head, groups, size = made.head, made.groups, made.groups + 2
    placed = _in_classes(made.encoded, made.member, kind, made.tail)

    def pairs(flat: np.ndarray) -> np.ndarray:
        return np.r_[groups, flat[:-1]] * size + flat

    table = _cells(placed.filter("not held_out"), ["classes"], _classes, pairs, size)
    shared = shared_value(docs.sparkSession, fit(table, head.rare, groups))

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        for batch in batches:
            path = []
            for text in batch.column("classes").to_pylist():
                own = np.frombuffer(text, np.uint8).astype(np.int64)
                path.append(float((m.transition[np.r_[groups, own[:-1]], own] + m.share[own]).sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(path, pa.float64())], [*batch.schema.names[:-1], "path"])

    walked = placed.mapInArrow(
        paths, f"doc_id {kind}, held_out boolean, n_tokens long, known long, base double, weight double, path double"
    )
    scale = F.lit(float(np.log10(head.tokens + 1.0 * (head.distinct + 1))))
    end_log = F.lit(float(np.log10(head.ends + 1.0)))
    score = F.col("path") + F.col("weight")
    return walked.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.lit(int(head.ends > 0))).cast("long").alias("n_known"),
        F.lit(head.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + end_log - F.col("n_tokens") * scale).alias("base_score"),
        score.alias("score"),
        F.pow(F.lit(10.0), -score / F.col("n_tokens")).alias("perplexity"),
    )

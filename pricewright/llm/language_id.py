"""Language identification by rank-order profiles.

A profile lists the most frequent character n-grams (one to three, inside words and at their edges) of a language
by rank.  A document's own n-grams are ranked by frequency, and the language whose ranks are least out of
place is predicted.  n-grams that occur equally often share the best rank among them, so that no order of equal
ones plays a part.

Profiles come from counts over all training documents, summed in Spark; what is broadcast is their top, which is
bounded by the number of languages (checked) times the length of a profile.

Defined results: a NULL text or one without a letter is `und` with score 0; so is every text if nothing was
learned; documents with a NULL lang are not learned from; a NULL doc_id is not held out; ties go to the
language that sorts first; repeated rows each get their row; an empty table gives none.  Other columns are not
read (or kept as they are by `known_languages`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import map_texts, remainder, shared_value, stored, tidy

LONGEST = 3
PROFILE = 400
MAX_LANGUAGES = 2_000
FLUSH = 1_000_000  # counted n-grams a task holds before it merges or emits them
BITS = 21  # a code point; three of them fill a long

Profiles = dict[str, tuple[np.ndarray, np.ndarray]]  # n-grams in order, and their ranks


def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    table = np.zeros(0x110000, bool)
    table[[c for c in range(0x110000) if chr(c).isalpha()]] = True
    return table


_LETTERS: list[np.ndarray] = []


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of the letters of a whole text, and how often each occurs; a blank stands for a word's edge."""
    if not _LETTERS:
        _LETTERS.append(_letters())
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    codes = np.r_[32, np.where(_LETTERS[0][codes], codes, 32), 32]
    edge = codes == 32
    codes = codes[~(edge & np.r_[False, edge[:-1]])]  # one blank between words
    if len(codes) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = codes == 32
    keys = [codes[~edge]]
    if LONGEST >= 2:
        keys.append((codes[:-1] << BITS) | codes[1:])
    if LONGEST >= 3:  # none across a word's edge
        inside = ~edge[1:-1]
        keys.append(((codes[:-2] << 2 * BITS) | (codes[1:-1] << BITS) | codes[2:])[inside])
    every = np.concatenate(keys)
    every.sort()
    starts = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
    return every[starts], np.diff(np.r_[starts, len(every)])


def ranks(counts: np.ndarray) -> np.ndarray:
    """How many n-grams occur more often than each."""
    falling = np.sort(-counts)
    return np.searchsorted(falling, -counts, "left")


def language_profiles(docs: DataFrame, learn, size: int = PROFILE) -> DataFrame:
    """(lang, gram, place) of the `size` most frequent n-grams of each language; `learn` says which rows to use."""
    rows = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        waiting = 0

        def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
            keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            return keys, np.bincount(place, np.concatenate([n for _, n in parts])).astype(np.int64)

        def emitted() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                keys, n = merged(parts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(n)], ["lang", "gram", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys, n = grams(text)
                if len(keys):
                    held.setdefault(lang, []).append((keys, n))
                    waiting += len(keys)
                if waiting > FLUSH:
                    held = {lang: [merged(parts)] for lang, parts in held.items()}
                    waiting = sum(len(parts[0][0]) for parts in held.values())
                    if waiting > FLUSH // 2:
                        yield from emitted()
                        held, waiting = {}, 0
        yield from emitted()

    kind = docs.schema["lang"].dataType.simpleString()
    counted = rows.mapInArrow(tidy(count), f"lang {kind}, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    # a filter on the row number itself lets every task before the shuffle keep its first `size` only
    first = counted.withColumn("number", F.row_number().over(order)).filter(F.col("number") <= size)
    return first.select("lang", "gram", (F.col("number") - 1).alias("place"))


def collected(profiles: DataFrame) -> Profiles:
    """The profiles on the driver: `MAX_LANGUAGES` of them at most."""
    profiles = stored(profiles)
    if profiles.select("lang").distinct().count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    table = profiles.orderBy("lang", "gram").toArrow().to_pydict()
    made: dict[str, tuple[list, list]] = {}
    for lang, gram, place in zip(table["lang"], table["gram"], table["place"]):
        made.setdefault(lang, ([], []))
        made[lang][0].append(gram)
        made[lang][1].append(place)
    return {lang: (np.array(g, np.int64), np.array(p, np.int64)) for lang, (g, p) in made.items()}


def predict(text: str | None, profiles: Profiles, size: int = PROFILE) -> tuple[str, float]:
    """The language least out of place, and how near the text is to its profile (0 to 1)."""
    keys, counts = grams(text)
    if not len(keys) or not profiles:
        return "und", 0.0
    place = ranks(counts)
    top = place < size
    keys, place = keys[top], place[top]
    best, least = "und", None
    for lang, (known, rank) in profiles.items():
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        away = np.where(known[at] == keys, np.minimum(np.abs(rank[at] - place), size), size).sum()
        if least is None or away < least:
            best, least = lang, away
    return best, 1.0 - float(least) / (size * len(keys))


def identify(docs: DataFrame, profiles: Profiles, size: int = PROFILE, keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (doc_id) of every row, lang_pred and score."""
    kept = ["doc_id"] if keep is None else keep
    frame = docs.select(*kept, F.col("text").alias("_text"))
    schema = docs.select(*kept).schema.add("lang_pred", "string").add("score", "double")
    shared = shared_value(docs.sparkSession, profiles)

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [predict(t, shared.value, size) for t in batch.column("_text").to_pylist()]
        columns = [batch.column(i) for i in range(len(kept))]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], schema.names
        )

    return map_texts(frame, work, schema, "_text")


def held_out_identification(docs: DataFrame, divisor: int = 3, held: int = 1) -> DataFrame:
    """Every row with its predicted language, learned from rows whose id's CRC-32 modulo `divisor` is not `held`."""
    out = F.coalesce(remainder("doc_id", divisor) == held, F.lit(False))
    profiles = collected(language_profiles(docs, ~out))
    return identify(docs, profiles).select("doc_id", out.alias("held_out"), "lang_pred", "score")


def known_languages(docs: DataFrame) -> DataFrame:
    """The rows of `docs` in which a learned language is recognised; profiles come from all rows with a lang.

    A text without an n-gram of any profile has score 0, and goes as one without a letter does.
    """
    profiles = collected(language_profiles(docs, F.lit(True)))
    shared = shared_value(docs.sparkSession, profiles)
    place = docs.columns.index("text")

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield batch.filter(pa.array([predict(t, shared.value)[1] > 0 for t in batch.column(place).to_pylist()], pa.bool_()))

    return map_texts(docs, work, docs.schema)

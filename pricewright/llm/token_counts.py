"""Token counts by rank-synchronous merging of byte pairs in numpy arrays.

A text is cut at white space, where this vocabulary's tokens always end.  The distinct pieces of a batch
become pre-tokens; all of them are held in one ragged pair of arrays (symbol, sequence), and every round
merges, in all sequences at once, the pair that has the lowest rank in its sequence.  A sequence leaves when it
has no pair left; the symbols that survive are its tokens.

Defined results: a NULL text counts as empty (0 tokens); strings of special tokens inside a text are one
token each, as the library's default has it; repeated rows each get their row; an empty table gives none.
Other columns are not read.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .common import kept_for, map_texts, text_bytes

CACHED_PIECES = 400_000  # pieces whose count a worker remembers; beyond it the memory is emptied and filled anew
NO_RANK = np.iinfo(np.int32).max

NEWER = "\u0370"  # from here on, characters may be unassigned or have a lower case that depends on their place

# The vocabulary's own pre-token pattern, for lower-cased ASCII pieces and for all others; a space divides pieces.
ASCII_PRE_TOKENS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ a-z0-9]+| ")
PRE_TOKENS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+| ")
SPACES = re.compile("[\t-\r \x85\xa0  -     　]+")
PYTHON_ONLY_SPACES = re.compile("[\x1c-\x1f]")  # str.split() splits there, the vocabulary's pattern does not


def _byte_characters() -> list[str]:
    """The printable stand-in for each byte that byte-level vocabularies use."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    stand_ins, spare = {}, 256
    for b in range(256):
        if b in printable:
            stand_ins[b] = chr(b)
        else:
            stand_ins[b], spare = chr(spare), spare + 1
    return [stand_ins[b] for b in range(256)]


class PairMerger:
    """Merge table of a byte-level vocabulary with word ends, and the counting of pieces with it."""

    def __init__(self, path: str) -> None:
        self.path, self.library = path, None
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges") or model.get("continuing_subword_prefix"):
            raise ValueError("a byte-level pair-merging vocabulary with word ends is needed")
        vocabulary, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        names = _byte_characters()
        self.byte_of = {c: b for b, c in enumerate(names)}
        self.inner = np.array([vocabulary[c] for c in names], np.int64)
        self.last = np.array([vocabulary[c + suffix] for c in names], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocabulary[a] for a, _ in pairs], np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], np.int64)
        self.made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        self.width = max(vocabulary.values()) + 1
        keys = left * self.width + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        # a product that an earlier rule consumes must be offered to that rule before its pair is merged again
        first_use = np.full(self.width, NO_RANK, np.int64)
        np.minimum.at(first_use, left, np.arange(len(pairs)))
        np.minimum.at(first_use, right, np.arange(len(pairs)))
        self.one_by_one = first_use[self.made] < np.arange(len(pairs))
        special = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.seen: dict[str, int] = {}

    def pre_tokens(self, pieces: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Bytes of the pre-tokens of all pieces, the piece each belongs to, and special tokens per piece."""
        special = np.zeros(len(pieces), np.int64)
        ascii_at, other_at, found, owners = [], [], [], []
        for i, piece in enumerate(pieces):
            if (self.special is not None and "<|" in piece) or piece[0] >= NEWER or max(piece) >= NEWER:
                parts = self.special.split(piece) if self.special is not None else [piece]
                special[i] = len(parts) - 1
                tokens = [t for part in parts for t in self._slow_pre_tokens(part)]
                found += tokens
                owners += [i] * len(tokens)
            else:
                (ascii_at if piece.isascii() else other_at).append(i)
        owner = [np.array(owners, np.int64)]
        for at, pattern in ((ascii_at, ASCII_PRE_TOKENS), (other_at, PRE_TOKENS)):
            joined = unicodedata.normalize("NFC", " ".join([pieces[i] for i in at])).lower()
            tokens = [t.encode() for t in pattern.findall(joined)]
            gap = np.fromiter((t == b" " for t in tokens), bool, len(tokens))
            owner.append(np.array(at, np.int64)[np.cumsum(gap)[~gap]])
            found += [t for t in tokens if t != b" "]
        return found, np.concatenate(owner), special

    def _slow_pre_tokens(self, part: str) -> list[bytes]:
        if not any(unicodedata.category(c) == "Cn" for c in part):
            # lower case goes by single characters, so there is no final sigma
            plain = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            return [p.encode() for p in PRE_TOKENS.findall(plain)]
        # the case and composition of unassigned characters depend on the library's own tables
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        plain = self.library.normalizer.normalize_str(part)
        return [bytes(map(self.byte_of.__getitem__, p)) for p, _ in self.library.pre_tokenizer.pre_tokenize_str(plain)]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def count(self, tokens: list[bytes]) -> np.ndarray:
        """Symbols that survive in each pre-token; all sequences take one step a round."""
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        result = np.zeros(len(tokens), np.int64)
        if not len(tokens):
            return result
        raw = np.frombuffer(b"".join(tokens), np.uint8)
        owner = np.repeat(np.arange(len(tokens)), lengths)
        final = np.zeros(len(raw), bool)
        final[np.cumsum(lengths) - 1] = True
        symbol = np.where(final, self.last[raw], self.inner[raw])
        rank = np.full(len(symbol), NO_RANK, np.int32)  # of the pair that begins here
        inside = np.flatnonzero(~final)
        rank[inside] = self._rank(symbol[inside], symbol[inside + 1])
        while len(symbol):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[starts, len(owner)])
            lowest = np.minimum.reduceat(rank, starts)
            done = lowest == NO_RANK
            if done.any():
                result[owner[starts[done]]] = sizes[done]
                stay = np.repeat(~done, sizes)
                symbol, owner, rank = symbol[stay], owner[stay], rank[stay]
                lowest, sizes = lowest[~done], sizes[~done]
                if not len(symbol):
                    break
            each = np.repeat(lowest, sizes)
            hit = np.flatnonzero(rank == each)
            single = self.one_by_one[each[hit]]
            touching = np.r_[False, hit[1:] == hit[:-1] + 1]
            if touching.any():  # a run of one symbol: take every second pair from its left end
                run = np.maximum.accumulate(np.where(touching, 0, np.arange(len(hit))))
                keep = (np.arange(len(hit)) - run) % 2 == 0
                hit, single = hit[keep], single[keep]
            if single.any():
                first = np.r_[True, owner[hit[1:]] != owner[hit[:-1]]]
                hit = hit[first | ~single]
            symbol[hit] = self.made[rank[hit]]
            gone = np.zeros(len(symbol), bool)
            gone[hit + 1] = True
            changed = np.zeros(len(symbol), bool)
            changed[hit] = True
            before = hit[hit > 0] - 1
            before = np.where(gone[before], before - 1, before)
            changed[before[before >= 0]] = True
            symbol, owner, rank, changed = symbol[~gone], owner[~gone], rank[~gone], changed[~gone]
            at = np.flatnonzero(changed)
            rank[at] = NO_RANK
            at = at[at + 1 < len(symbol)]
            at = at[owner[at] == owner[at + 1]]
            rank[at] = self._rank(symbol[at], symbol[at + 1])
        return result

    def count_texts(self, texts: list[str | None]) -> list[int]:
        pieces = [_pieces(t) for t in texts]
        seen = self.seen
        if len(seen) > CACHED_PIECES:
            seen.clear()
        new = list(set(chain.from_iterable(pieces)).difference(seen))
        if new:
            tokens, owner, special = self.pre_tokens(new)
            sums = np.bincount(owner, self.count(tokens), len(new)).astype(np.int64) + special
            seen.update(zip(new, sums.tolist()))
        return [sum(map(seen.__getitem__, ps)) for ps in pieces]


def _pieces(text: str | None) -> list[str]:
    if not text:
        return []
    if PYTHON_ONLY_SPACES.search(text):
        return [p for p in SPACES.split(text) if p]
    return text.split()


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 2048, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: id, n_bytes, n_tokens, over_limit."""
    narrow = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"), text_bytes(text).alias("n_bytes"))
    kind = docs.schema[id_column].dataType.simpleString()
    merger: list[PairMerger] = []

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not merger:
            merger.append(_merger(vocabulary))
        counts = merger[0].count_texts(batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
        )

    counted = map_texts(narrow, work, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def _merger(path: str) -> PairMerger:
    """One table and one memory of pieces per worker process."""
    kept = kept_for(__name__)
    if path not in kept:
        kept[path] = PairMerger(path)
    return kept[path]

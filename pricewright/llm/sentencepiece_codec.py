"""SentencePiece models run by the tokenizers library.

The model file is read field by field; its normaliser, white-space marker, pieces with scores and byte
fallback are rebuilt as a tokenizer of that library.  Where no piece has the marker after another character,
a text is the concatenation of chunks that begin with a run of markers, so each distinct chunk of a batch is
encoded once, in multithreaded batches.  What the library gives for a chunk is verified against the
sentencepiece library and decoded again; a text passes if all of its chunks pass.

Defined results: NULL and empty texts have no tokens and decode to the empty text; repeated rows each get
their row; an empty table gives none.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from collections.abc import Iterator
from functools import cached_property
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import kept_for, map_texts, tidy

MARK = "▁"
CACHED_CHUNKS = 100_000  # chunks whose tokens a worker remembers; beyond it the memory is emptied and filled anew
GROUP = 200  # chunks encoded as one string
LEARNED = 50 * GROUP  # chunks whose tokens the libraries hold at once; a chunk takes about a kilobyte there
ROWS_DECODED = 256
CHUNKS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")

# Field numbers and values of the model format.
PIECES, TRAINER, NORMALISER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_TYPE = 1, 2, 3
TRAINER_MODEL_TYPE, TRAINER_BYTE_FALLBACK = 3, 35
CHARS_MAP, ADD_DUMMY_PREFIX, REMOVE_EXTRA_SPACES, ESCAPE_SPACES = 2, 3, 4, 5
UNIGRAM, PAIR_MERGES = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def wire_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of one message: varints as int, everything else as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) if kind != 2 else varint()
        if size is None or at + size > len(data):
            raise ValueError("not a SentencePiece model")
        yield key >> 3, data[at : at + size]
        at += size


class Model:
    """What a model file says."""

    def __init__(self, path: str) -> None:
        self.path = path
        self.pieces: list[tuple[str, float, int]] = []
        trainer: dict[int, int | bytes] = {}
        normaliser: dict[int, int | bytes] = {}
        with open(path, "rb") as file:
            for field, value in wire_fields(file.read()):
                if field == PIECES:
                    piece = dict(wire_fields(value))
                    score = struct.unpack("<f", piece[PIECE_SCORE])[0] if PIECE_SCORE in piece else 0.0
                    self.pieces.append((piece.get(PIECE_TEXT, b"").decode(), score, piece.get(PIECE_TYPE, NORMAL)))
                elif field == TRAINER:
                    trainer = dict(wire_fields(value))
                elif field == NORMALISER:
                    normaliser = dict(wire_fields(value))
        self.kind = trainer.get(TRAINER_MODEL_TYPE, UNIGRAM)
        self.byte_fallback = bool(trainer.get(TRAINER_BYTE_FALLBACK, 0))
        self.chars_map = normaliser.get(CHARS_MAP, b"")
        self.add_prefix = bool(normaliser.get(ADD_DUMMY_PREFIX, 1))
        self.remove_extra = bool(normaliser.get(REMOVE_EXTRA_SPACES, 1))
        self.escape = bool(normaliser.get(ESCAPE_SPACES, 1))
        self.ids = {p: i for i, (p, _, _) in enumerate(self.pieces)}
        self.is_byte = np.array([t == BYTE for _, _, t in self.pieces], np.int64)
        self.unknown = next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)
        inner_mark = any(t == NORMAL and re.search(f"[^{MARK}]{MARK}", p) for p, _, t in self.pieces)
        user_defined = any(t == USER_DEFINED for _, _, t in self.pieces)
        self.chunked = not (self.chars_map or self.remove_extra or inner_mark or user_defined) and self.escape and self.add_prefix

    def merges(self) -> list[tuple[str, str]]:
        """Pairs in merging order: the score of the piece that a pair makes decides."""
        ids = {p: i for i, (p, _, t) in enumerate(self.pieces) if t in (NORMAL, USER_DEFINED)}
        found = []
        for piece, score, kind in self.pieces:
            if kind in (NORMAL, USER_DEFINED):
                for cut in range(1, len(piece)):
                    left, right = piece[:cut], piece[cut:]
                    if left in ids and right in ids:
                        found.append((-score, ids[piece], ids[left], ids[right], left, right))
        found.sort()
        return [(left, right) for *_, left, right in found]

    def tokenizer(self, whole_texts: bool = True):
        """The model in the tokenizers library; without the normaliser for chunks that are normalised already."""
        from tokenizers import AddedToken, Tokenizer, decoders, models, normalizers

        names = [p for p, _, _ in self.pieces]
        if self.kind == UNIGRAM:
            core = models.Unigram([(p, s) for p, s, _ in self.pieces], self.unknown, self.byte_fallback)
        elif self.kind == PAIR_MERGES:
            core = models.BPE(
                {p: i for i, p in enumerate(names)}, self.merges(), unk_token=names[self.unknown], fuse_unk=True,
                byte_fallback=self.byte_fallback,
            )
        else:
            raise ValueError("only unigram and pair-merging models are supported")
        made = Tokenizer(core)
        made.add_tokens([AddedToken(p, normalized=False) for p, _, t in self.pieces if t == USER_DEFINED])
        if whole_texts:
            steps = [normalizers.Precompiled(self.chars_map)] if self.chars_map else []
            if self.remove_extra:
                steps += [normalizers.Strip(), normalizers.Replace(_spaces(), " ")]
            if self.add_prefix:
                steps.append(normalizers.Prepend(" "))
            if self.escape:
                steps.append(normalizers.Replace(" ", MARK))
            made.normalizer = normalizers.Sequence(steps)
        steps = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        made.decoder = decoders.Sequence(steps + ([decoders.Strip(" ", 1, 0)] if self.add_prefix else []))
        return made


def _spaces():
    from tokenizers import Regex

    return Regex(" {2,}")


class Encoded(NamedTuple):
    """The tokens of one text: ids as little-endian 32-bit integers, and what the checks found."""

    ids: bytes
    parity: bool
    round_trip: bool


class Codec:
    """Encodes and decodes batches of texts in one worker process."""

    def __init__(self, path: str, threads: int) -> None:
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        import sentencepiece
        from tokenizers import decoders

        self.model = Model(path)
        self.reference = sentencepiece.SentencePieceProcessor(model_file=path)
        self.threads = threads
        if self.model.chunked:
            from tokenizers import Regex, pre_tokenizers

            self.by_chunk = self.model.tokenizer(whole_texts=False)
            self.by_chunk.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*"), "isolated")
            self.by_chunk.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
            self.mark = np.array([self.model.ids[MARK]], "<i4").tobytes()
        self.seen: dict[str, bytes] = {}
        self.differs: set[str] = set()  # chunks that the two libraries encode differently
        self.lossy: set[str] = set()  # chunks that decoding does not give back

    @cached_property
    def whole(self):
        """For whole texts, and for decoding; texts in chunks do without it."""
        return self.model.tokenizer()

    def encode(self, texts: list[str | None]) -> list[Encoded]:
        if not self.model.chunked:
            plain = [t or "" for t in texts]
            made = self.whole.encode_batch_fast(plain, add_special_tokens=False)
            wanted = self.reference.encode(plain, num_threads=self.threads)
            back = self.whole.decode_batch([e.ids for e in made], skip_special_tokens=False)
            return [
                Encoded(np.array(e.ids, "<i4").tobytes(), e.ids == w, t == d) for e, w, t, d in zip(made, wanted, plain, back)
            ]
        chunks = [_chunks(t) for t in texts]
        if len(self.seen) > CACHED_CHUNKS:
            self.seen.clear()
            self.differs.clear()
            self.lossy.clear()
        new = list(set(chain.from_iterable(chunks)).difference(self.seen))
        for start in range(0, len(new), LEARNED):
            self._learn(new[start : start + LEARNED])
        find = self.seen.__getitem__
        return [
            Encoded(
                b"".join(map(find, cs)),
                not self.differs or self.differs.isdisjoint(cs),
                not (t and MARK in t) and (not self.lossy or self.lossy.isdisjoint(cs)),
            )
            for t, cs in zip(texts, chunks)
        ]

    def _learn(self, chunks: list[str]) -> None:
        """Encode distinct chunks with the library, many in one string, and check them."""
        bare = [c for c in chunks if c[-1] == MARK]  # would run into the chunk after it
        full = [c for c in chunks if c[-1] != MARK]
        chunks = bare + full
        groups = [[c] for c in bare] + [full[i : i + GROUP] for i in range(0, len(full), GROUP)]
        made = self.by_chunk.encode_batch(["".join(g) for g in groups], add_special_tokens=False)
        # a marker alone is a prefix, which the reference does not add to an empty text
        wanted = iter(self.reference.encode([c[1:] for c in chunks], num_threads=self.threads))
        back = self.by_chunk.decode_batch([m.ids for m in made], skip_special_tokens=False)
        for group, m, text in zip(groups, made, back):
            ids, words = m.ids, np.array(m.word_ids)
            flat = np.array(ids, "<i4").tobytes()
            cuts = [0, *(np.flatnonzero(words[1:] != words[:-1]) + 1).tolist(), len(ids)]
            for chunk, i, j, want in zip(group, cuts, cuts[1:], wanted):
                self.seen[chunk] = flat[4 * i : 4 * j]
                if ids[i:j] != want and chunk != MARK:
                    self.differs.add(chunk)
            if text != "".join(group).replace(MARK, " "):
                each = self.by_chunk.decode_batch([ids[i:j] for i, j in zip(cuts, cuts[1:])], skip_special_tokens=False)
                self.lossy |= {c for c, t in zip(group, each) if t != c.replace(MARK, " ")}

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.whole.decode_batch(ids, skip_special_tokens=False)


def _chunks(text: str | None) -> list[str]:
    if not text:
        return []
    if MARK in text or "  " in text or text[0] == " " or text[-1] == " ":
        return CHUNKS.findall(MARK + text.replace(" ", MARK))
    return (MARK + text.replace(" ", f" {MARK}")).split(" ")


def codec(path: str, threads: int) -> Codec:
    kept = kept_for(__name__)
    if (path, threads) not in kept:
        kept[path, threads] = Codec(path, threads)
    return kept[path, threads]


def _id_lists(coded: list[Encoded]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(c.ids) // 4 for c in coded])
    flat = np.frombuffer(b"".join(c.ids for c in coded), "<i4")
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))


def encode_documents(docs: DataFrame, model: str, threads: int = 2, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: id, ids, n_tokens, n_byte_tokens, parity, round_trip."""
    kind = docs.schema[id_column].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        runner = codec(model, threads)
        coded = runner.encode(batch.column("text").to_pylist())
        ids = _id_lists(coded)
        ends = ids.offsets.to_numpy()
        is_byte = np.r_[0, np.cumsum(runner.model.is_byte[ids.flatten().to_numpy()])]
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"),
            "ids": ids,
            "n_tokens": pa.array(np.diff(ends), pa.int64()),
            "n_byte_tokens": pa.array(is_byte[ends[1:]] - is_byte[ends[:-1]], pa.int64()),
            "parity": pa.array([c.parity for c in coded], pa.bool_()),
            "round_trip": pa.array([c.round_trip for c in coded], pa.bool_()),
        })

    schema = f"doc_id {kind}, ids array<int>, n_tokens long, n_byte_tokens long, parity boolean, round_trip boolean"
    return map_texts(docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text")), work, schema)


def decode_documents(coded: DataFrame, model: str, threads: int = 2, id_column: str = "doc_id", ids: str = "ids") -> DataFrame:
    """One row per row: id and the text that the ids stand for; NULL ids give the empty text."""
    kind = coded.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_DECODED):
                part = batch.slice(start, ROWS_DECODED)
                texts = codec(model, threads).decode([i or [] for i in part.column("ids").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return coded.select(F.col(id_column).alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(tidy(run), f"doc_id {kind}, text string")


def encoding_digests(docs: DataFrame, model: str, threads: int = 2) -> DataFrame:
    """Per row: counts, SHA-256 of the ids as little-endian 32-bit integers, and what the checks found."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        runner = codec(model, threads)
        coded = runner.encode(batch.column("text").to_pylist())
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"),
            "n_tokens": pa.array([len(c.ids) // 4 for c in coded], pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(c.ids).hexdigest() for c in coded], pa.string()),
            "parity": pa.array([c.parity for c in coded], pa.bool_()),
            "round_trip": pa.array([c.round_trip for c in coded], pa.bool_()),
        })

    return map_texts(docs.select("doc_id", "text"), work, f"doc_id {kind}, n_tokens long, ids_sha256 string, parity boolean, round_trip boolean")

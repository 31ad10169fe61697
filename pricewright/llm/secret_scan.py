"""Secrets in texts and in what is encoded inside them.

A worklist holds layers of a document, the text itself first.  Each layer is scanned, then unwrapped: URL
and Unicode escapes are resolved over the whole layer, base64 runs are decoded, alone and joined over line breaks,
each from its first four characters on, for a word may be glued to its front.  Decoded bytes are read as text: as
UTF-8, or as Latin-1 where they are not, and in both orders of UTF-16 where they have NULs.  Compressed streams in
them are inflated, from every mark of one on (gzip, zlib, bz2, xz, lzma, members of ZIP files; a raw deflate
stream has no mark: it is looked for at the first byte only and counts if it comes to its end), all streams that follow one another to their end.  Layers
that were not seen before are unwrapped in turn, until none is new.  Every layer knows, per character, which span of
the original text it stands for, so what is found in it is reported in places of the original.

What is inflated stands for one span as a whole.  Beyond `INFLATED_BYTES` it is read in pieces, each a layer that
is done with before the next is inflated: a piece takes along the end of the one before it, and an encoded run
that goes on; a run too long for that is decoded as it comes, into a stream of its own.

Defined results: a NULL text counts as empty and has no spans; repeated rows each get their row; an empty
table gives none; other columns are not read (or kept as they are by `redact_documents`).  Streams that end too
early or break are read up to there.  `cut_layers` counts the layers that were cut into pieces; none is dropped.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import map_texts

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # runs of 20 or more; a run is taken whole
HEX = re.compile(r"[0-9a-f]{24,}")
SHORTEST_VALUE = 6

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPES = re.compile(r"(?:\\u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|(?:\\x[0-9A-Fa-f]{2})+|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
BASE64_PARTS = re.compile(r"[A-Za-z0-9]{16,}={0,2}")
LINE_END = re.compile(r"\r?\n")
SHORT_LINE = re.compile(r"[A-Za-z0-9+/_-]{1,15}(?![A-Za-z0-9+/_-])={0,2}")
SHORTEST_RUN = 16
STREAM = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9](?:1AY&SY|\x17rE8P\x90)|\xfd7zXZ\0|\x5d\0\0[\0-\xff]{2}|PK\x03\x04", re.DOTALL)
LZMA_MEMORY = 128 * 1024 * 1024  # an lzma stream without a container says itself how much memory it takes
INFLATED_BYTES = 16 * 1024 * 1024  # of a compressed layer held at a time
OVERLAP = 64 * 1024  # characters that a piece takes along from the one before it
RUN_CHARACTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-\r\n"
PLACEHOLDER = "[REDACTED]"

Span = tuple[int, int, int]  # start, kind, end: sorts by start, then kind as listed


def find(text: str) -> list[Span]:
    """Spans of one layer: leftmost, not overlapping within a kind."""
    spans = []
    if ":" in text or "=" in text:
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= SHORTEST_VALUE]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    spans.sort()
    return spans


class Layer:
    """Decoded text and what it stands for in the original.

    Character i stands for [start[i], end[i]); without these, for the span `whole`; without that, for itself.
    """

    def __init__(self, text: str, start: array | None = None, end: array | None = None, whole: tuple[int, int] | None = None) -> None:
        self.text, self.start, self.end, self.whole = text, start, end, whole

    def origin(self, begin: int, end: int) -> tuple[int, int]:
        if self.whole is not None:
            return self.whole
        return (begin, end) if self.start is None else (self.start[begin], self.end[end - 1])


def _resolved(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with every escape replaced by what it stands for."""
    if layer.whole is not None:
        made, n = pattern.subn(lambda m: "".join(c for c, _, _ in decode(m[0])), layer.text)
        return Layer(made, whole=layer.whole) if n else None
    parts, start, end, at = [], array("q"), array("q"), 0

    def copy(until: int) -> None:
        parts.append(layer.text[at:until])
        if layer.start is None:
            start.extend(range(at, until))
            end.extend(range(at + 1, until + 1))
        else:
            start.extend(layer.start[at:until])
            end.extend(layer.end[at:until])

    for match in pattern.finditer(layer.text):
        copy(match.start())
        for char, i, j in decode(match[0]):
            a, b = layer.origin(match.start() + i, match.start() + j)
            parts.append(char)
            start.append(a)
            end.append(b)
        at = match.end()
    if not at:
        return None
    copy(len(layer.text))
    return Layer("".join(parts), start, end)


def _percent(run: str) -> list[tuple[str, int, int]]:
    return _utf8(bytes.fromhex(run.replace("%", "")), 3)


def _utf8(data: bytes, width: int) -> list[tuple[str, int, int]]:
    """Characters of the bytes with the place of each, a byte being `width` characters of the source."""
    out, at = [], 0
    for char in data.decode("utf-8", "replace"):
        size = len(char.encode()) if char != "�" or data[at : at + 3] == b"\xef\xbf\xbd" else 1
        out.append((char, at * width, min(at + size, len(data)) * width))
        at = min(at + size, len(data) - 1)
    return out


def _escape(run: str) -> list[tuple[str, int, int]]:
    if run.startswith("\\x"):
        return _utf8(bytes.fromhex(run.replace("\\x", "")), 4)
    if run.startswith("\\u") and run[2] != "{":
        data = bytes.fromhex(run.replace("\\u", ""))
        out, at = [], 0
        for char in data.decode("utf-16-be", "replace"):
            size = 12 if ord(char) > 0xFFFF else 6
            out.append((char, at, at + size))
            at += size
        return out
    digits, base = (run[3:-1], 16) if run[:3] in ("\\u{", "&#x", "&#X") else (run[2:-1], 10) if run[0] == "&" else (run[2:], 16)
    code = int(digits, base)
    return [(chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "�", 0, len(run))]


def _texts(data: bytes) -> Iterator[tuple[str, np.ndarray]]:
    """The bytes as text, and the byte that each character begins at, with the end behind the last."""
    raw = np.frombuffer(data, np.uint8)
    try:
        yield data.decode("utf-8"), np.r_[np.flatnonzero(raw & 0xC0 != 0x80), len(raw)]
    except UnicodeDecodeError:
        yield data.decode("latin-1"), np.arange(len(raw) + 1)
    if 0 not in data:
        return
    # behind an odd number of bytes the other order sees the text too, but with its spans a byte off
    for order, skipped in (("le", 0), ("be", 0), ("le", 1), ("be", 1))[: 4 if data[0] else 2]:
        pairs = data[skipped:]
        pairs += b"\0" * (len(pairs) % 2)
        text = pairs.decode(f"utf-16-{order}", "surrogatepass")
        wide = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4") > 0xFFFF
        yield text, np.minimum(np.r_[0, np.cumsum(2 + 2 * wide)] + skipped, len(data))


def _opener(data: bytes):
    if data[:2] == b"\x1f\x8b" or data[:1] == b"\x78":
        return zlib.decompressobj(47)
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if data[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    if data[:3] == b"\x5d\0\0":
        return lzma.LZMADecompressor(lzma.FORMAT_ALONE, LZMA_MEMORY)
    return None


class _Inflater:
    """Compressed streams one after the other, and what stands behind the last as it is; fed bit by bit.

    Bytes that are no stream from the start give nothing, or themselves if `plain`.  `opener` is that of a first
    stream without a mark.  `unread` tells how many of the last bytes belong to no stream.
    """

    def __init__(self, plain: bool = False, opener=None) -> None:
        self.opener, self.head, self.plain, self.ended, self.unread = opener, b"", plain, False, 0

    def feed(self, data: bytes) -> Iterator[bytes]:
        while data:
            if self.ended:
                self.unread = len(data)
                if self.plain:
                    yield data
                return
            if self.opener is None:
                data, self.head = (self.head + data).lstrip(b"\0"), b""
                if len(data) < 6:  # a stream's mark may be still to come
                    self.head = data
                    return
                self.opener, given = _opener(data), False
                if self.opener is None:
                    self.ended = True
                    continue
            else:
                given = self.plain
            try:
                rest = data
                while not self.opener.eof:
                    made = self.opener.decompress(rest, INFLATED_BYTES)
                    rest = getattr(self.opener, "unconsumed_tail", b"")
                    if made:
                        given = self.plain = True
                        yield made
                    elif not rest:
                        return
            except (zlib.error, OSError, lzma.LZMAError, EOFError, MemoryError):
                self.ended = True
                if given:  # broken in the middle
                    return
                continue
            data, self.opener = self.opener.unused_data, None


class _Stream:
    """Layers of a text that comes bit by bit and stands for the span `whole`."""

    def __init__(self, whole: tuple[int, int], encoding: str = "utf-8") -> None:
        self.whole, self.held, self.run = whole, "", None
        self.decoder = codecs.getincrementaldecoder(encoding)("replace")

    def feed(self, data: bytes) -> Iterator[Layer]:
        yield from self._read(self.decoder.decode(data))

    def close(self) -> Iterator[Layer]:
        yield from self._read(self.decoder.decode(b"", True))
        if self.run is not None:
            yield from self.run.close()
        if self.held:
            yield Layer(self.held, whole=self.whole)

    def _read(self, text: str) -> Iterator[Layer]:
        if self.run is not None:
            rest = text.lstrip(RUN_CHARACTERS)
            more = text[: len(text) - len(rest)]
            yield from self.run.feed(more)
            self.held, text = (self.held + more)[-OVERLAP:], rest
            if not rest:
                return
            yield from self.run.close()
            self.run = None
        self.held += text
        if len(self.held) < INFLATED_BYTES:
            return
        yield Layer(self.held, whole=self.whole)
        start = len(self.held.rstrip(RUN_CHARACTERS))
        if len(self.held) - start > INFLATED_BYTES // 2:
            self.run = _Run(self.whole)
            yield from self.run.feed(self.held[start:])
            start = len(self.held)
        self.held = self.held[max(0, min(start, len(self.held) - OVERLAP)) :]


class _Run:
    """Layers of a base64 run that comes bit by bit: its own characters, and what they hold."""

    def __init__(self, whole: tuple[int, int]) -> None:
        self.whole, self.tail, self.left = whole, "", ""
        self.inflater, self.inner = _Inflater(plain=True), _Stream(whole)

    def feed(self, text: str) -> Iterator[Layer]:
        if not text:
            return
        piece = self.tail + text
        self.tail = piece[-OVERLAP:]
        yield Layer(piece, whole=self.whole)
        bare = self.left + text.replace("\r", "").replace("\n", "").replace("-", "+").replace("_", "/")
        whole = len(bare) // 4 * 4
        self.left = bare[whole:]
        yield from self._held(bare[:whole])

    def close(self) -> Iterator[Layer]:
        if len(self.left) > 1:
            yield from self._held(self.left + "=" * (4 - len(self.left)))
        yield from self.inner.close()

    def _held(self, bare: str) -> Iterator[Layer]:
        for made in self.inflater.feed(base64.b64decode(bare)):
            yield from self.inner.feed(made)


def _is_raw_stream(data: bytes) -> bool:
    """Whether a deflate stream without a container begins here and comes to its end: chance bytes often inflate to some."""
    opener, rest = zlib.decompressobj(-15), data
    try:
        while not opener.eof:
            made = opener.decompress(rest, INFLATED_BYTES)
            rest = opener.unconsumed_tail
            if not (made or rest):
                return False
    except (zlib.error, MemoryError):
        return False
    return True


def _inflated(data: bytes, whole: tuple[int, int]) -> Iterator[tuple[Layer, bool]]:
    """The layers that compressed streams hold, in pieces if one is long; its second piece is marked."""
    if _is_raw_stream(data):
        yield from _streams(_Inflater(opener=zlib.decompressobj(-15)), data, whole)
    view, done = memoryview(data), 0
    for mark in STREAM.finditer(data):
        at = mark.start()
        if at < done:  # of a stream that was read
            continue
        if mark[0] == b"PK\x03\x04":
            if data[at + 8 : at + 10] != b"\x08\0":
                continue
            at += 30 + int.from_bytes(data[at + 26 : at + 28], "little") + int.from_bytes(data[at + 28 : at + 30], "little")
            opener = zlib.decompressobj(-15)
        else:
            opener = _opener(mark[0] + b"\0\0")
        inflater, found = _Inflater(opener=opener), False
        for layer in _streams(inflater, view[at:], whole):
            found = True
            yield layer
        if found:
            done = len(data) - inflater.unread


def _streams(inflater: _Inflater, data: bytes | memoryview, whole: tuple[int, int]) -> Iterator[tuple[Layer, bool]]:
    streams: list[_Stream] = []
    pieces = []

    def marked(number: int, layers: Iterator[Layer]) -> Iterator[tuple[Layer, bool]]:
        for layer in layers:
            pieces[number] += 1
            yield layer, pieces[number] == 2

    for piece in inflater.feed(data):
        if not streams:
            streams = [_Stream(whole, e) for e in ("utf-8", "utf-16-le", "utf-16-be")[: 3 if 0 in piece else 1]]
            pieces = [0] * len(streams)
        for number, stream in enumerate(streams):
            yield from marked(number, stream.feed(piece))
    for number, stream in enumerate(streams):
        yield from marked(number, stream.close())


def _wrapped(text: str, runs: list[tuple[int, int]]) -> Iterator[list[tuple[int, int]]]:
    """Lines that may be one run: all that follow each other, and those of one width with the lines around them.

    A wrapped run has lines of one width and a shorter last one; a word that ends the line before it, or is all of
    the line after it, would shift or spoil what is decoded.
    """
    block: list[tuple[int, int]] = []
    for i, (begin, end) in enumerate(runs):
        block.append((begin, end))
        after = LINE_END.match(text, end) if text[end - 1] != "=" else None
        if after and i + 1 < len(runs) and runs[i + 1][0] == after.end():
            continue
        if after and (last := SHORT_LINE.match(text, after.end())):
            block.append(last.span())
        if len(block) > 1:
            yield block
            width, at = [e - b for b, e in block], 0
            while at < len(block):
                to = at + 1
                while to < len(block) and width[to] == width[at]:
                    to += 1
                for lines in (block[max(0, at - 1) : to + 1], block[at : to + 1], block[at:to]):
                    if 1 < len(lines) < len(block):
                        yield lines
                at = to
        block = []


def _decoded(run: str) -> tuple[str, bytes] | None:
    """A run without padding, and what it holds."""
    bare = run.rstrip("=")
    bare = bare[: len(bare) - (len(bare) % 4 == 1)]
    try:
        return bare, base64.b64decode(bare.replace("-", "+").replace("_", "/") + "=" * (-len(bare) % 4))
    except (binascii.Error, ValueError):
        return None


def _blob_layers(layer: Layer) -> Iterator[tuple[Layer, bool]]:
    """What base64 runs hold: text, or compressed streams of it."""
    runs = []
    for match in BASE64.finditer(layer.text):
        run = match[0]
        runs.append(match.span())
        tries = {(match.start(), run)}
        if re.search("[+/_-]", run):  # a path or a name may be glued to the run
            tries |= {(match.start() + m.start(), m[0]) for m in BASE64_PARTS.finditer(run)}
        # so may be a word: a run that begins behind it is met from one of the four places on
        tries |= {(at + k, part[k:]) for at, part in tries for k in (1, 2, 3) if len(part) - k >= SHORTEST_RUN}
        for at, part in sorted(tries):
            if decoded := _decoded(part):
                yield from _held_layers(layer, *decoded, np.arange(at, at + len(part)))
    for lines in _wrapped(layer.text, runs):
        if decoded := _decoded("".join(layer.text[b:e] for b, e in lines)):
            yield from _held_layers(layer, *decoded, np.concatenate([np.arange(b, e) for b, e in lines]))


def _held_layers(layer: Layer, bare: str, data: bytes, places: np.ndarray) -> Iterator[tuple[Layer, bool]]:
    """The layers in decoded bytes; character i of the run stands at `places[i]`."""
    if not data:
        return
    yield from _inflated(data, layer.origin(int(places[0]), int(places[-1]) + 1))
    for text, byte in _texts(data):
        if layer.whole is not None:
            yield Layer(text, whole=layer.whole), False
            continue
        first = places[byte[:-1] * 8 // 6]
        last = places[np.minimum(-(-byte[1:] * 8 // 6), len(bare)) - 1]
        if layer.start is None:
            last = last + 1
        else:
            first, last = np.frombuffer(layer.start, np.int64)[first], np.frombuffer(layer.end, np.int64)[last]
        yield Layer(text, array("q", first.astype(np.int64).tobytes()), array("q", last.astype(np.int64).tobytes())), False


def _unwrapped(layer: Layer) -> Iterator[tuple[Layer, bool]]:
    if "%" in layer.text and (made := _resolved(layer, PERCENT, _percent)):
        yield made, False
    if ("\\" in layer.text or "&#" in layer.text) and (made := _resolved(layer, ESCAPES, _escape)):
        yield made, False
    yield from _blob_layers(layer)


def scan(text: str | None) -> tuple[list[Span], list[Span], int, int]:
    """(base spans, all spans, layers and pieces of layers below the text, layers cut into pieces)."""
    base = find(text) if text else []
    spans, layers, cut = set(base), 0, 0
    if not text:
        return base, base, 0, 0
    known = set()
    work = [_unwrapped(Layer(text))]
    while work:  # depth first, so that of a layer in pieces one is held at a time
        inner, was_cut = next(work[-1], (None, False))
        if inner is None:
            work.pop()
            continue
        cut += was_cut
        if not inner.text:
            continue
        # the same text at another place is another layer
        digest = (hashlib.sha256(inner.text.encode("utf-8", "surrogatepass")).digest(), inner.origin(0, 1), inner.origin(len(inner.text) - 1, len(inner.text)))
        if digest in known:
            continue
        known.add(digest)
        layers += 1
        for begin, kind, end in find(inner.text):
            a, b = inner.origin(begin, end)
            spans.add((a, kind, b))
        work.append(_unwrapped(inner))
    return base, sorted(spans), layers, cut


def redact(text: str, spans: list[Span]) -> str:
    """The text with every span, overlapping ones as one, replaced by the placeholder."""
    parts, at = [], 0
    for begin, _, end in sorted(spans):
        if end <= at:
            continue
        if begin >= at:
            parts += [text[at:begin], PLACEHOLDER]
        at = end
    return "".join(parts) + text[at:]


SPAN_TYPE = "array<struct<kind:string,start:long,end:long>>"


def _arrow_spans(rows: list[list[Span]]) -> pa.Array:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    return pa.array([[(KINDS[k], a, b) for a, k, b in r] for r in rows], kind)


def scan_documents(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: id, base spans, all spans, number of layers, layers that were cut into pieces."""
    kind = docs.schema[id_column].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [scan(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"),
            "base": _arrow_spans([f[0] for f in found]),
            "spans": _arrow_spans([f[1] for f in found]),
            "layers": pa.array([f[2] for f in found], pa.int64()),
            "cut_layers": pa.array([f[3] for f in found], pa.int64()),
        })

    narrow = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    return map_texts(narrow, work, f"doc_id {kind}, base {SPAN_TYPE}, spans {SPAN_TYPE}, layers long, cut_layers long")


def redact_documents(docs: DataFrame, text: str = "text", length: str | None = None) -> DataFrame:
    """`docs` with the secrets in its texts replaced; `length` names a column that holds the text's length."""
    place = docs.columns.index(text)

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = batch.column(place).to_pylist()
        clean = [t if t is None or not (s := scan(t)[1]) else redact(t, s) for t in texts]
        yield batch.set_column(place, batch.schema.field(place), pa.array(clean, batch.schema.field(place).type))

    made = map_texts(docs, work, docs.schema, text)
    if length is None:
        return made
    kind = docs.schema[length].dataType
    return made.withColumn(length, F.when(F.col(text).isNull(), F.col(length)).otherwise(F.char_length(F.col(text)).cast(kind)))


def joined(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def secret_digests(docs: DataFrame) -> DataFrame:
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    found = scan_documents(docs)
    return found.select(
        "doc_id", *[count(k) for k in KINDS], F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"), "layers"
    )

import struct

import public_tokenizers
import sentencepiece
import numpy as np

from pricewright.llm.sentencepiece_codec import Codec, Model, decode_documents, encode_documents, encoding_digests

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "  a  b ", "▁x▁ y", "a\nb\tc", "中文字", "<s> </s> <unk> <0x0A>", "😀é́", "a" * 3000, "   ", "\x00a", "x ▁ y", "a b",
    "The quick brown fox", "word " * 2000,
]


def ids(coded):
    return np.frombuffer(coded.ids, "<i4").tolist()


def test_encoding_equals_the_reference_library():
    codec, reference = Codec(PATH, 2), sentencepiece.SentencePieceProcessor(model_file=PATH)
    coded = codec.encode(ODD)
    assert [ids(c) for c in coded] == reference.encode(ODD)
    assert all(c.parity for c in coded)
    assert codec.decode([ids(c) for c in coded]) == [t.replace("▁", " ") for t in ODD]
    assert [c.round_trip for c in coded] == ["▁" not in t for t in ODD]
    assert [e.ids for e in Model(PATH).tokenizer().encode_batch(ODD[1:])] == reference.encode(ODD[1:])


def message(*fields):
    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    made = b""
    for number, value in fields:
        if isinstance(value, int):
            made += varint(number << 3) + varint(value)
        elif isinstance(value, float):
            made += varint(number << 3 | 5) + struct.pack("<f", value)
        else:
            made += varint(number << 3 | 2) + varint(len(value)) + value
    return made


def test_unigram_model(tmp_path):
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), ("▁", -2.0, 1), ("▁a", -1.5, 1), ("a", -3.0, 1), ("b", -3.1, 1), ("ab", -2.5, 1), ("ba", -2.9, 1)]
    data = b"".join(message((1, message((1, p.encode()), (2, s), (3, t)))) for p, s, t in pieces)
    data += message((2, message((3, 1))), (3, message((1, b"identity"), (3, 1), (4, 1), (5, 1))))
    path = tmp_path / "small.model"
    path.write_bytes(data)
    codec, reference = Codec(str(path), 1), sentencepiece.SentencePieceProcessor(model_file=str(path))
    texts = ["ab ba", "abab  baa ", "a", "bab aab"]
    coded = codec.encode(texts)
    assert [ids(c) for c in coded] == reference.encode(texts)
    assert all(c.parity for c in coded)


def test_rows_of_any_kind(spark):
    reference = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = [(i, t, 1) for i, t in enumerate(ODD)] + [(3, ODD[3], 2), (90, None, 3), (None, "x y", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    coded = encode_documents(docs, PATH)
    got = sorted(((r.doc_id, list(r.ids), r.n_tokens, r.parity) for r in coded.collect()), key=repr)
    want = [(i, reference.encode(t or ""), len(reference.encode(t or "")), True) for i, t, _ in rows]
    assert got == sorted(want, key=repr)
    back = sorted(map(tuple, decode_documents(coded, PATH).collect()), key=repr)
    assert back == sorted(((i, (t or "").replace("▁", " ")) for i, t, _ in rows), key=repr)
    assert encode_documents(docs.limit(0), PATH).collect() == []


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = encoding_digests(docs, PATH).collect()
    reference = sentencepiece.SentencePieceProcessor(model_file=PATH)
    counts = {r.doc_id: len(reference.encode(r.text)) for r in docs.collect()}
    assert {r.doc_id: r.n_tokens for r in got} == counts
    assert all(r.parity and r.round_trip for r in got)

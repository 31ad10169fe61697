import random

import pytest
from tokenizers import Tokenizer
import public_tokenizers

from pricewright.llm.token_counts import PairMerger, count_tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
BITS = [
    "a", "b", "ab", "the", "ing", "'s", " ", "\n", "<|endoftext|>", "<|startoftext|>", "é", "é", "Σ", "İ", "1", "23", "!!",
    "aaaa", "ß", "中文", "\x1c", "　", "😀", "<|", "|>", "'LL", "ΑΣ", "́", "Ｆ", "͸", "\U00032808",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, texts):
    return [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_counts_equal_the_library(library):
    draw = random.Random(7)
    texts = ["".join(draw.choice(BITS) for _ in range(draw.randint(0, 30))) for _ in range(3000)]
    texts += ["a" * 3000, "ab" * 2000, "x" * 5001, "lalala" * 700, "", " ", None]
    assert PairMerger(PATH).count_texts(texts) == expected(library, texts)


def test_every_assigned_low_character(library):
    texts = [chr(c) for c in range(0x3000)] + [f"a{chr(c)}b" for c in range(0x3000)]
    assert PairMerger(PATH).count_texts(texts) == expected(library, texts)


def test_forgetting_pieces_changes_nothing(monkeypatch, library):
    monkeypatch.setattr("pricewright.llm.token_counts.CACHED_PIECES", 3)
    merger = PairMerger(PATH)
    texts = [f"word{i} the and again{i % 5}" for i in range(50)]
    assert [merger.count_texts([t])[0] for t in texts] == expected(library, texts)


def test_rows_of_any_kind(spark, library):
    rows = [(1, "Hello there", 5), (1, "Hello there", 5), (2, None, 6), (None, "é" * 40, 7), (3, "", 8), (4, "word " * 50_000, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted(map(tuple, count_tokens(docs, PATH).collect()), key=repr)
    counts = expected(library, [t for _, t, _ in rows])
    want = [(i, len((t or "").encode()), n, n > 2048) for (i, t, _), n in zip(rows, counts)]
    assert got == sorted(want, key=repr)
    assert count_tokens(docs.limit(0), PATH).collect() == []


def test_given_documents(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r.n_tokens for r in count_tokens(docs, PATH).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert got == dict(zip([r.doc_id for r in rows], expected(library, [r.text for r in rows])))

"""What tasks leave behind in a worker process, which outlives the stages of a pipeline."""

import random
import re
import sys

import public_tokenizers
import pyarrow as pa
import pytest

from pricewright.llm import common, language_id, simhash
from pricewright.llm.common import drop_others, importable_in_workers, kept_for, tidy
from pricewright.llm.decontamination import contamination
from pricewright.llm.sentencepiece_codec import Codec


def own_mb():
    """Memory of this process without mapped files."""
    with open("/proc/self/smaps_rollup") as file:
        return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", file.read()))) / 1024


def test_tasks_begin_without_the_memory_of_others():
    kept_for("another operator")["key"] = kept_for(language_id.__name__)["key"] = "kept"

    def work(batches):
        yield from batches

    work.__module__ = language_id.__name__
    batch = pa.RecordBatch.from_pydict({"n": [1, 2]})
    assert list(tidy(work)(iter([batch]))) == [batch]
    assert list(common._KEPT) == [language_id.__name__]
    drop_others("none")


class Recorded:
    """A frame that notes the functions given to mapInArrow."""

    def __init__(self, frame, found):
        self.frame, self.found = frame, found

    def __getattr__(self, name):
        def call(*args):
            if name == "mapInArrow":
                self.found.append(args[0])
            return Recorded(getattr(self.frame, name)(*args), self.found)

        return call


def test_posting_lists_drop_what_others_kept(spark):
    found = []
    entries = spark.createDataFrame([(0, 1, 2)], "list int, bytes long, print long")
    simhash._search(Recorded(entries, found), simhash.TRIPLES, 3, 10)
    for function in found:
        kept_for("another operator")["key"] = "kept"
        assert list(function(iter([]))) == []
        assert "another operator" not in common._KEPT
    assert len(found) == 1


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="memory is read from /proc")
def test_codec_holds_little_while_it_learns():
    """New chunks reach the libraries in bounded groups, and no tokenizer is built that chunks do not need."""
    draw = random.Random(3)
    made = Codec(public_tokenizers.path("piece_bpe_32k.model"), 2)
    assert made.model.chunked and "whole" not in vars(made)
    sizes = []
    learn = made._learn
    made._learn = lambda chunks: (sizes.append(len(chunks)), learn(chunks))
    text = " ".join("".join(draw.choices("abcdefghijklmnop", k=9)) for _ in range(25_000))
    (coded,) = made.encode([text])
    assert coded.parity and coded.round_trip
    assert sum(sizes) >= 24_000 and max(sizes) <= 10_000
    assert made.decode([[int(i) for i in memoryview(coded.ids).cast("i")]]) == [text]


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="memory is read from /proc")
def test_freed_memory_goes_back():
    """Small blocks freed by a library stay in its pools, but not once a task of another operator begins."""
    import ctypes

    libc = ctypes.CDLL(None)
    libc.malloc.restype = ctypes.c_void_p
    if not hasattr(libc, "malloc_trim"):
        pytest.skip("no glibc")
    drop_others("none")
    before = own_mb()
    blocks = [libc.malloc(4096) for _ in range(30_000)]
    for block in blocks:
        ctypes.memset(block, 1, 4096)
    for block in blocks[:-1]:  # the last one keeps the others from being cut off the heap's end
        libc.free(ctypes.c_void_p(block))
    held = own_mb() - before
    drop_others("none")
    assert held > 90 and own_mb() - before < 40
    libc.free(ctypes.c_void_p(blocks[-1]))


def test_windows_need_no_python_workers(spark):
    """Windows become a frame by Arrow; a list of rows would run a second Python daemon on every executor."""
    importable_in_workers(spark)
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k l m n")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "b c d e f g h i j k l m n"), (None, "d e")], "item_id long, text string")
    used = []
    make = type(spark).createDataFrame
    type(spark).createDataFrame = lambda self, data, *a, **k: (used.append(type(data)), make(self, data, *a, **k))[1]
    try:
        (row,) = contamination(docs, items).collect()
    finally:
        type(spark).createDataFrame = make
    assert used == [pa.Table]
    assert (row.n_words, row.n_hit, row["items"], row.contaminated) == (14, 13, ["1"], True)

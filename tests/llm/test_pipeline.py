import random

import public_tokenizers
import sentencepiece
from test_decontamination import brute as contaminated
from test_language_id import brute_grams
from test_secret_scan import HEX
from test_simhash import brute_components, brute_print

from pyspark.sql.types import StructType

import corpus_pipeline
from pricewright.llm.common import stored
from pricewright.llm.secret_scan import PLACEHOLDER, redact, scan
from pricewright.llm.sharding import interleave


def expected(rows, items):
    """doc_id to token ids, stage by stage, with plain Python."""
    rows = [r for r in rows if brute_grams(r[1])]
    prints = [brute_print(r[1]) for r in rows]
    roots = brute_components(prints)
    first = {}
    for r, p in zip(rows, prints):
        old = first.get(roots[p])
        key = (r[0] is None, r[0] or 0)
        if old is None or key < (old[0] is None, old[0] or 0):
            first[roots[p]] = r
    kept = list(first.values())
    dirty = {i for i, (_, _, _, _, bad) in zip([d for d, _ in sorted([(r[0], r[1]) for r in kept], key=repr)], contaminated([(r[0], r[1]) for r in kept], items)) if bad}
    kept = [r for r in kept if r[0] not in dirty]
    encoder = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return {r[0]: encoder.encode(redact(r[1], scan(r[1])[1])) for r in kept}


def test_planted_cases(spark, tmp_path):
    draw = random.Random(8)
    say = lambda n: " ".join(f"word{draw.randrange(3000)}" for _ in range(n))
    base = [say(200) for _ in range(8)]
    near = base[0].split()
    near[50] = "other"
    item = say(30)
    rows = [(i, t, "en", "s", len(t), 1) for i, t in enumerate(base)]
    rows += [(100, base[1], "en", "s", 1, 2), (100, base[1], "en", "s", 1, 2), (101, " ".join(near), "en", "s", 1, 2)]
    rows += [(200, f"{say(20)} {item} {say(20)}", "en", "s", 1, 3), (201, f"{say(60)} token = {HEX} {say(60)}", None, "s", 1, 3)]
    rows += [(300, None, "en", "s", None, 4), (301, "12 34 !", "en", None, 7, 4), (302, "", None, "s", 0, 4), (303, say(30_000), "en", "s", 1, 4)]
    items = [(1, item), (2, say(20))]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _row int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == expected(rows, items)
    assert 200 not in got and 100 not in got and 201 in got
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path)).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "_row"], name
    last = {r.doc_id: r for r in docs.collect()}
    assert PLACEHOLDER in last[201].text and HEX not in last[201].text and last[201].n_chars == len(last[201].text)


NAMES = [
    "_row", "_id", "_null", "_print", "_keep", "_text", "__text", "_text_key", "_fingerprint", "_number", "fingerprint", "number", "hash", "root", "component_id",
    "first", "place", "key", "verdict", "_Fingerprint2", "a.b", "with space", "back`tick", "_stratum", "_draw", "_bucket", "_n", "_start", "_of", "_rank",
    "_size", "_alike", "_fraction", "_position", "_shard", "n", "gram", "score", "lang_pred", "row_id", "begin", "end", "items", "contaminated", "words",
]


def test_columns_of_any_name(spark, tmp_path):
    """Further columns come out of every stage, and of the shards, as they went in."""
    texts = ["plain words of one text here", "plain words of one text here", "quite another text with some words", f"token = {HEX} at last"]
    rows = [(i, t, "en", "s", len(t), *[f"{n} of {i}" for n in NAMES]) for i, t in enumerate(texts)]
    fields = [("doc_id", "long"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "long"), *[(n, "string") for n in NAMES]]
    schema = StructType()
    for name, kind in fields:
        schema = schema.add(name, kind)
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, texts[2])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = [{0, 1, 2, 3}, {0, 2, 3}, {0, 3}, {0, 3}]
    for (name, stage), ids in zip(corpus_pipeline.STAGES, left):
        docs = stored(stage(spark, docs, str(tmp_path)))
        assert docs.columns == [n for n, _ in fields], name
        found = docs.collect()
        assert {r[0] for r in found} == ids, name
        assert all(r[5 + i] == f"{n} of {r[0]}" for r in found for i, n in enumerate(NAMES)), name
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {0, 3}
    placed = interleave(spark.read.parquet(f"{tmp_path}/documents.parquet"), "source", 2)
    assert placed.columns == [n for n, _ in fields] + ["shard", "slot"]
    assert all(r[5 + i] == f"{n} of {r[0]}" for r in placed.collect() for i, n in enumerate(NAMES))


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_given_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    got = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, folder).collect()}
    assert got == expected([tuple(r) for r in docs], items)

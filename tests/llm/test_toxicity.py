import random

import numpy as np

from pricewright.llm.toxicity import Rows, fit_chain, fit_linear, labelled_rows, score_chain, toxicity

BAD = ["ugh", "bah", "yuck"]


def corpus(n=400, seed=4):
    draw = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        toxic, quality = int(draw.random() < 0.25), int(draw.random() < 0.7)
        words = [f"w{draw.randrange(200)}" for _ in range(draw.randint(5, 60))]
        if toxic:
            words += draw.sample(BAD, 2)
        if not quality:
            words += ["junk", "|"] * 3
        draw.shuffle(words)
        docs.append((i, " ".join(words), 0.5))
        labels.append((i, quality, toxic))
    return docs, labels


def test_gradient_steps_reach_the_optimum():
    draw = np.random.default_rng(1)
    rows = Rows(60, np.repeat(np.arange(60), 3), draw.integers(0, 8, 180))
    truth = (draw.random(60) < 0.4).astype(float)
    model = fit_linear(rows, np.zeros((60, 0)), truth, 8)
    off = model.probability(rows, np.zeros((60, 0))) - truth
    assert abs(off.sum()) < 1e-2  # the constant has no penalty, so the mean fits


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string, p_toxic double")
    train = spark.createDataFrame([x for x in labels if x[0] % 2], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity(frame, train).collect()}
    assert len(got) == len(docs)
    held = [x for x in labels if x[0] % 2 == 0]
    assert np.mean([got[i].toxic == bool(t) for i, _, t in held]) > 0.97
    assert np.mean([got[i].quality == bool(q) for i, q, _ in held]) > 0.97
    assert all(0 <= got[i].p_toxic <= 1 for i, _, _ in held)


def test_chain_feeds_earlier_probabilities(spark):
    docs, labels = corpus(120)
    frame = spark.createDataFrame(docs, "doc_id long, text string, x double")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    chain = fit_chain(frame, marks, ["quality", "toxic"])
    assert [len(m.extra) for m in chain.models] == [1, 2]
    assert labelled_rows(frame, marks, ["toxic"], most=30).count() <= 45


def test_rows_of_any_kind(spark):
    rows = [(1, "good words here"), (1, "good words here"), (2, None), (None, "ugh"), (3, ""), (4, "ugh bah yuck " * 20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = [(1, 1, 0), (1, 0, 0), (2, None, None), (None, 1, 1), (3, 1, 0), (99, 1, 1)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity(docs, marks).collect()
    assert sorted(repr(r.doc_id) for r in got) == sorted(repr(r[0]) for r in rows)
    assert {r.p_toxic for r in got} == {0.0} and not any(r.toxic for r in got)
    empty = toxicity(docs, marks.limit(0)).collect()
    assert {(r.p_quality, r.p_toxic, r.toxic) for r in empty} == {(None, None, False)}
    assert toxicity(docs.limit(0), marks).collect() == []
    chain = fit_chain(docs, marks, ["toxic"])
    assert score_chain(docs, chain).columns == ["doc_id", "p_toxic", "toxic"]


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = toxicity(docs, labels)
    got = scored.join(labels.select("doc_id", labels.toxic.alias("truth")), "doc_id").collect()
    assert scored.count() == docs.count()
    assert sum(r.toxic == bool(r.truth) for r in got) / len(got) > 0.93


def test_rows_of_the_sample_are_bounded(spark):
    """One labelled id on many rows of different text."""
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(5_000)] + [(2, "other")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    found = labelled_rows(docs, labels, ["quality", "toxic"], most=100).collect()
    assert 50 <= len(found) <= 150
    assert len(labelled_rows(docs, labels, ["quality", "toxic"], most=10_000).collect()) == 5_001

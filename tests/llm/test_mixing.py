import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pricewright.llm.mixing import contract_targets, mix, mixed_documents, mixture_digests, route, weighted_targets


def cheapest(supply, members, quotas, repeats):
    """(words, cost) of the best integer flow, by augmenting along the cheapest path one word at a time (Bellman-Ford)."""
    start, end = "start", "end"
    arcs = []  # [from, to, room, cost], a reverse arc behind each
    for p, words in enumerate(supply):
        for r in range(repeats):
            arcs += [[start, ("p", p), words, r], [("p", p), start, 0, -r]]
        for s in members[p]:
            arcs += [[("p", p), ("s", s), 10**9, 0], [("s", s), ("p", p), 0, 0]]
    for s, quota in enumerate(quotas):
        arcs += [[("s", s), end, quota, 0], [end, ("s", s), 0, 0]]
    sent = cost = 0
    while True:
        far, by = {start: 0}, {}
        changed = True
        while changed:
            changed = False
            for i, (a, b, room, price) in enumerate(arcs):
                if room and a in far and far[a] + price < far.get(b, 10**9):
                    far[b], by[b], changed = far[a] + price, i, True
        if end not in far:
            return sent, cost
        at = end
        while at != start:
            i = by[at]
            arcs[i][2] -= 1
            arcs[i ^ 1][2] += 1
            at = arcs[i][0]
        sent, cost = sent + 1, cost + far[end]


def test_flow_is_greatest_and_cheapest():
    draw = random.Random(4)
    for _ in range(60):
        sources = draw.randrange(1, 5)
        members = [draw.sample(range(sources), draw.randrange(0, sources + 1)) for _ in range(draw.randrange(1, 6))]
        supply = [draw.randrange(0, 9) for _ in members]
        quotas = [draw.randrange(0, 20) for _ in range(sources)]
        flow, cost = route(supply, members, quotas, 3)
        assert (sum(flow.values()), cost) == cheapest(supply, members, quotas, 3)
        for p, words in enumerate(supply):
            assert sum(flow.get((p, s), 0) for s in range(sources)) <= 3 * words
        for s, quota in enumerate(quotas):
            assert sum(w for (_, t), w in flow.items() if t == s) <= quota


def test_targets_share_the_excess_until_none_is_above():
    draw = random.Random(5)
    for _ in range(50):
        sizes = {f"s{i}": draw.randrange(0, 1000) for i in range(draw.randrange(1, 8))}
        weights = {s: draw.choice([1.0, 2.0, 3.0]) for s in sizes}
        total = 1.5 * sum(sizes.values())
        wanted, open_sources, left = {}, dict(weights), total
        while open_sources:  # from the definition
            share = {s: left * w / sum(open_sources.values()) for s, w in open_sources.items()}
            above = [s for s in share if share[s] > 2 * sizes[s]]
            wanted |= {s: 2.0 * sizes[s] for s in above} if above else share
            left -= sum(2.0 * sizes[s] for s in above)
            open_sources = {s: w for s, w in open_sources.items() if s in above or above and s not in above} if above else {}
            for s in above:
                del open_sources[s]
        found = weighted_targets(sizes, weights, total, 2.0)
        assert found == pytest.approx(wanted) and sum(found.values()) == pytest.approx(total)


def test_given_documents_come_near_their_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixture_digests(docs).collect()
    given = {r.doc_id: r for r in docs.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(given)
    words = {i: len(r.text.replace("\x0b", " ").replace("\x0c", " ").split()) for i, r in given.items()}
    sizes = Counter()
    for i, r in given.items():
        sizes[r.source] += words[i]
    targets = contract_targets(dict(sizes))
    taken = Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == targets[r.source]
        assert r.size == 0 or r.taken % r.size == 0 and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= 0.002 * targets[s]
    again = mixture_digests(docs.repartition(7)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


SCHEMA = "id long, words long, tags array<string>, `row` string, `a.b` string, draw string, nth int, copies string"


def overlapping(spark, n=300, seed=6):
    draw = random.Random(seed)
    tags = [["a"], ["b"], ["a", "b"], ["b", "c"], ["a", "b", "c"], [None], [None, "c"], []]
    rows = [(i, draw.choice([0, 1, 5, 20, 100, 400]), draw.choice(tags), f"r{i}", "x", "y", i, "z") for i in range(n)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def mixed(df, targets, repeats=3):
    return mix(df, "id", F.col("tags"), F.col("words"), lambda sizes: {s: float(targets.get(s, 0)) for s in sizes}, repeats=repeats)


def test_overlapping_sources(spark):
    rows, df = overlapping(spark)
    targets = {"a": 15_000, "b": 3_000, "c": 14_000, None: 2_500}
    found = mixed(df, targets)
    out = found.rows.collect()
    given = {r[0]: r for r in rows}
    assert sorted(r.row.id for r in out) == sorted(given)
    taken = Counter()
    for r in out:
        _, words, tags, *others = given[r.row.id]
        assert r.size == words and [r.row["row"], r.row["a.b"], r.row.draw, r.row.nth, r.row.copies] == others
        assert 0 <= r.copies <= 3 and r.copies == sum(c.copies for c in r.by_source) and r.taken == r.copies * words
        for c in r.by_source:
            assert c.source in tags and c.copies > 0
            taken[c.source] += c.copies * words
    assert {s: taken[s] for s in found.taken} == found.taken
    for s, target in targets.items():
        assert abs(taken[s] - target) <= 0.005 * target
    again = mixed(df.repartition(5), targets)
    assert sorted((r.row.id, r.copies) for r in again.rows.collect()) == sorted((r.row.id, r.copies) for r in out)


def test_one_long_document_across_an_end(spark):
    rows = [(i, 5000 if i % 40 == 0 else 3, ["a"], "", "", "", 0, "") for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    for target in (700, 5_600, 30_500, 52_000):
        assert abs(mixed(df, {"a": target}, repeats=2).taken["a"] - target) <= 3


def test_unreachable_target_takes_all(spark):
    rows, df = overlapping(spark, 40)
    found = mixed(df, {"a": 10**9, "b": 10**9, "c": 10**9, None: 10**9}, repeats=2)
    for r in found.rows.collect():
        assert r.copies == (2 if r.size and r.sources else 0)


def test_null_text_null_source_repeats_and_empty(spark):
    schema = "doc_id long, text string, source string"
    rows = [(1, None, "s"), (2, "", None), (3, "a b\tc", None), (3, "a b\tc", None), (None, "x y", None), (5, "one", "s"), (6, "é ü z", "t")]
    out = sorted(mixture_digests(spark.createDataFrame(rows, schema)).collect(), key=repr)
    sizes = Counter((r.doc_id, r.size) for r in out)
    assert sizes == Counter({(1, 0): 1, (2, 0): 1, (3, 3): 2, (None, 2): 1, (5, 1): 1, (6, 2): 1})
    assert {(r.source, r.source_size) for r in out} == {("s", 1), ("t", 2), (None, 8)}
    targets = contract_targets({"s": 1, "t": 2, None: 8})
    assert all(r.target == targets[r.source] and r.taken <= 2 * r.size for r in out)
    assert mixture_digests(spark.createDataFrame([], schema)).collect() == []
    assert all(r.taken == 0 for r in mixture_digests(spark.createDataFrame([(1, None, "s")], schema)).collect())


def test_documents_are_repeated(spark):
    _, df = overlapping(spark, 60)
    found = mixed(df, {"a": 1_000, "b": 1_000, "c": 500})
    counts = Counter(r.id for r in mixed_documents(df, found, "id").collect())
    assert counts == Counter(dict(itertools.chain(((r.row.id, r.copies) for r in found.rows.collect() if r.copies))))

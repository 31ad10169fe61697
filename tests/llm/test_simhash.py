import random
import re

import numpy as np
import pytest
import xxhash

from pricewright.llm.components import components
from pricewright.llm.simhash import _flipped_pairs, _list_links, _roots, close_fingerprints, fingerprint, fingerprint_digests, keep_one_of_each

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_print(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    width = min(3, len(words))
    hashes = [xxhash.xxh64(" ".join(words[i : i + width]).encode(), seed=42).intdigest() for i in range(len(words) - width + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, distance=3):
    """value -> smallest value reachable."""
    values = sorted(set(values))
    root = {v: v for v in values}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if bin(a ^ b).count("1") <= distance:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {v: top(v) for v in values}


def expected(rows):
    prints = [brute_print(t) for _, t, *_ in rows]
    root = brute_components(prints)
    first = {}
    for (doc_id, *_), p in zip(rows, prints):
        if doc_id is not None:
            first[root[p]] = min(first.get(root[p], doc_id), doc_id)
    return sorted(((r[0], f"{p:016x}", first.get(root[p])) for r, p in zip(rows, prints)), key=repr)


def test_fingerprints():
    texts = ["", None, "one", "one Two", "a b c", "a b c d é Ü ß", " \t\n", "x y " * 500, "a\x0bb\x0cc\x1cd e\x85f g"]
    for t in texts:
        assert fingerprint(None if t is None else t.encode()) == brute_print(t)
    long = " ".join(str(i % 977) for i in range(250_000))
    assert fingerprint(long.encode()) == brute_print(long)


def crowd(seed, n, spread):
    draw = random.Random(seed)
    centres = [draw.getrandbits(64) for _ in range(6)]
    out = set(centres) | {draw.getrandbits(64) for _ in range(n)}
    for _ in range(n):
        v = draw.choice(centres)
        for _ in range(draw.randint(1, spread)):
            v ^= 1 << draw.randrange(64)
        out.add(v)
    return sorted(out)


@pytest.mark.parametrize("long_list", [4096, 3])
def test_links_connect_what_is_close(spark, long_list):
    values = crowd(5, 150, 7)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = close_fingerprints(spark.createDataFrame(signed, "print long"), long_list=long_list)
    for a, b in links.collect():
        assert bin((a ^ b) & (2**64 - 1)).count("1") or a != b
    found = {r.node & (2**64 - 1): r.root & (2**64 - 1) for r in components(links).collect()}
    want = brute_components(values)
    groups = lambda m: {frozenset(k for k in m if m[k] == r) for r in set(m.values())}
    assert groups(found) == {g for g in groups(want) if len(g) > 1}


def test_long_lists_by_flipping_bits():
    draw = random.Random(3)
    base = draw.getrandbits(40) << 24
    values = np.array(sorted({base | (draw.getrandbits(24) & 0x3FFFF) for _ in range(900)}), np.uint64)
    shared = (3, 4, 5, 6, 7)
    a = _roots(len(values), _flipped_pairs(values, (0, 1, 2), 3))
    want = brute_components([int(v) for v in values])
    assert [int(values[i]) for i in a] == [want[int(v)] for v in values]
    for limit in (10, 10_000):
        left, right = _list_links(values, shared, 3, limit)
        assert {int(x): int(y) for x, y in zip(left, right)} == {k: v for k, v in want.items() if k != v}


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 3), (20, 21), (30, 30), (5, 40), (40, 41), (41, 42), (42, 43), (43, 44)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 1, 8: 1, 9: 1, 20: 20, 21: 20, 30: 30, 5: 5, 40: 5, 41: 5, 42: 5, 43: 5, 44: 5}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def sample_rows():
    draw = random.Random(11)
    base = [" ".join(f"w{draw.randrange(500)}" for _ in range(300)) for _ in range(5)]
    rows = [(i, t, i) for i, t in enumerate(base)]
    for i in range(40):
        words = draw.choice(base).split()
        for _ in range(draw.randint(0, 3)):
            words[draw.randrange(len(words))] = "changed"
        rows.append((100 + i, " ".join(words), i))
    return rows + [(3, base[3], 1), (60, None, 2), (61, "", 3), (None, base[0], 4), (None, "alone here now", 5), (62, "short", 6), (62, "short", 6), (62, "other text entirely", 7)]


def test_rows_of_any_kind(spark):
    rows = sample_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, root long")
    assert sorted(map(tuple, fingerprint_digests(docs).collect()), key=repr) == expected(rows)
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    components_found = {(c, g) for _, _, c in expected(rows) for g in [None]}
    roots = brute_components([brute_print(t) for _, t, _ in rows])
    assert len(ids) == len(set(roots.values())) and {c for c, _ in components_found} == set(ids)
    assert fingerprint_digests(docs.limit(0)).collect() == []
    assert keep_one_of_each(docs.limit(0)).collect() == []


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, fingerprint_digests(docs).collect()), key=repr) == expected(rows)

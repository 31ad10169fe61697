import hashlib
import random
import re

from pricewright.llm.decontamination import clean_documents, contamination, contamination_digests

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=13):
    out = []
    for doc_id, text in docs:
        mine, hit, found = words(text), set(), set()
        for item_id, item in items:
            theirs = words(item)
            n = min(window, len(theirs))
            wanted = {tuple(theirs[i : i + n]) for i in range(len(theirs) - n + 1)} if n else set()
            for p in range(len(mine) - n + 1 if n else 0):
                if tuple(mine[p : p + n]) in wanted:
                    hit |= set(range(p, p + n))
                    if item_id is not None:
                        found.add(str(item_id))
        out.append((doc_id, len(mine), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(mine)))
    return sorted(out, key=repr)


def rows(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in df.collect()), key=repr)


def drawn(seed, n, vocabulary=9):
    draw = random.Random(seed)
    return [" ".join(f"W{draw.randrange(vocabulary)}é" for _ in range(draw.randrange(0, 40))) for _ in range(n)]


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id int, text string")


def test_equals_brute_force(spark):
    items = list(enumerate(drawn(1, 8))) + [(20, "W1é"), (21, "w2É w3é"), (21, "again other words"), (None, "w4é w5é w6é"), (30, None), (31, "?!"), (32, "W1é")]
    texts = drawn(2, 25) + ["x " * 50 + (t or "") + " tail" * 7 for _, t in items[:6]]
    docs = list(enumerate(texts)) + [(3, texts[3]), (None, texts[4]), (90, None), (91, ""), (92, "... ---")]
    d, i = frames(spark, docs, items)
    want = brute(docs, items)
    assert rows(contamination(d, i)) == want
    assert rows(contamination(d, i, block_bytes=60)) == want
    assert rows(contamination(d, i, window=4, shingle=2)) == brute(docs, items, 4)


def test_digest_and_extra_columns(spark):
    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    docs = spark.createDataFrame([(1, f"a b {text} c", 7, "x"), (2, "clean words", 8, "y")], "doc_id long, text string, n_words int, items string")
    items = spark.createDataFrame([(10, text, 1), (9, text.upper(), 2)], "item_id int, text string, n_hit int")
    got = {r.doc_id: r for r in contamination_digests(docs, items).collect()}
    assert (got[1].n_words, got[1].n_hit, got[1].n_items, got[1].contaminated) == (17, 14, 2, True)
    assert got[1].items_sha256 == hashlib.sha256(b"10,9").hexdigest()
    assert (got[2].n_hit, got[2].n_items, got[2].contaminated) == (0, 0, False)
    kept = clean_documents(docs, items)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [2]


def test_empty_tables_and_long_texts(spark):
    d, i = frames(spark, [(1, "a b c " * 60_000)], [(1, "a b c a b c a b c a b c a b c")])
    assert rows(contamination(d, i)) == [(1, 180_000, 180_000, ["1"], True)]
    assert rows(contamination(d, i.limit(0))) == [(1, 180_000, 0, [], False)]
    assert rows(contamination(d.limit(0), i)) == []

import math
import random
import re
import zlib
from collections import Counter

import numpy as np

import pricewright.llm.brown_lm as brown_lm
from pricewright.llm.brown_lm import LEAST, best_classes, exchange, learn, likelihood as likelihood_of, score_documents, word_classes

WORD = re.compile("[^\x20\x09-\x0d]+")


def tokens(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def brute_base(rows):
    counts = Counter()
    for i, t in rows:
        if not held(i):
            counts.update(tokens(t) + [None])
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        ws = tokens(t) + [None]
        score = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in ws)
        out.append((i, held(i), len(ws), sum(counts[w] > 0 for w in ws), total, round(score, 6)))
    return sorted(out, key=repr)


def likelihood(table, member):
    groups = member.max() + 1
    one = np.eye(groups)[member]
    cells = one.T @ table @ one
    f = lambda x: np.sum(x[x > 0] * np.log(x[x > 0]))
    return f(cells) - f(cells.sum(axis=0)) - f(cells.sum(axis=1))


def test_exchange_reaches_a_local_optimum():
    draw = np.random.default_rng(3)
    for _ in range(5):
        table = draw.poisson(1.5, (14, 14)) * draw.integers(0, 2, (14, 14))
        start = np.r_[np.arange(11) % 3, 3, 4, 5]
        member = exchange(table, 11, 3, passes=50)
        best = likelihood(table, member)
        assert best >= likelihood(table, start) - 1e-9
        for w in range(11):
            for c in range(3):
                other = member.copy()
                other[w] = c
                if other.max() == member.max():
                    assert likelihood(table, other) <= best + 1e-6


def test_exchange_finds_planted_classes():
    draw = random.Random(1)
    table = np.zeros((9, 9), int)
    for _ in range(4000):  # three classes in a cycle
        c = draw.randrange(3)
        table[c * 3 + draw.randrange(3), (c + 1) % 3 * 3 + draw.randrange(3)] += 1
    member = exchange(table, 9, 3)
    assert [len(set(member[c * 3 : c * 3 + 3])) for c in range(3)] == [1, 1, 1] and len(set(member)) == 3


def corpus():
    draw = random.Random(5)
    noun, verb = [f"N{i}" for i in range(30)], [f"v{i}é" for i in range(30)]
    rows = [(i, " ".join(draw.choice(noun if k % 2 else verb) for k in range(draw.randint(1, 50)))) for i in range(150)]
    return rows + [(1000 + i, f"rare{i} word{i % 9} \x1c x\x0by") for i in range(60)]


def odd_rows():
    return [(7, None), (8, ""), (None, "N1 v1é N2"), (3, "N1 N2"), (3, "N1 N2"), (2001, "never seen before at all"), (2002, "N1 v2é " * 30_000)]


def got(df):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect()), key=repr)


def test_base_scores(spark):
    rows = corpus() + odd_rows()
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double")
    want = brute_base(rows)
    assert got(score_documents(docs)) == want
    assert got(score_documents(docs, core=10, classes=4, head_size=20)) == want
    assert score_documents(docs.limit(0)).collect() == []


def test_best_class_is_that_of_highest_likelihood():
    draw = np.random.default_rng(8)
    for _ in range(6):
        bigrams = draw.poisson(1.2, (16, 16)) * draw.integers(0, 2, (16, 16))
        member = np.r_[draw.integers(0, 3, 8), [0, 1, 2], [4] * 3, 3, 4]  # the last two: the end, and the rest
        one = np.eye(5, dtype=int)[member]
        table = one.T @ bigrams @ one
        words = np.arange(14)
        best = best_classes(bigrams[:14] @ one, bigrams.T[:14] @ one, np.diag(bigrams)[:14], member[:14], table, 3)
        for w in words:
            reached = []
            for c in range(3):
                other = member.copy()
                other[w] = c
                cells = np.eye(5, dtype=int)[other]
                reached.append(likelihood_of(cells.T @ bigrams @ cells))
            assert reached[best[w]] >= max(reached) - 1e-6


SETTINGS = [{"core": 15, "classes": 5, "head_size": 40}, {"core": 1000, "classes": 4, "head_size": 10_000}, {"core": 3, "classes": 3, "head_size": 12}]


def brute_scores(rows, known, groups):
    """Scores of all rows, and p(next | class) of every word, one unknown and the end; `known` has each word's (n, class)."""
    end, rest = groups, groups + 1
    of = lambda w: known.get(w, (0, rest))[1]
    table = np.zeros((groups + 2, groups + 2))
    for i, t in rows:
        if not held(i):
            path = [end, *[of(w) for w in tokens(t)], end]
            for x, y in zip(path, path[1:]):
                table[x, y] += 1
    seen = table.sum(axis=0)
    wanted = seen.copy()
    wanted[[end, rest]] += 1
    move = (table + 5.0 * wanted / wanted.sum()) / (table.sum(axis=1, keepdims=True) + 5.0)
    room = seen[rest] + sum(c == rest for _, c in known.values()) + 1

    def share(w):
        n, c = known.get(w, (0, rest))
        return (n + 1) / room if c == rest else n / seen[c]

    scores = []
    for _, t in rows:
        at, total = end, 0.0
        for w in tokens(t):
            total += math.log10(move[at, of(w)]) + math.log10(share(w))
            at = of(w)
        scores.append(round(total + math.log10(move[at, end]), 5))
    sums = [sum(move[x, of(w)] * share(w) for w in [*known, "unknown!"]) + move[x, end] for x in range(groups + 2) if seen[x] or x in (end, rest)]
    return scores, sums


def test_scores_and_probabilities_by_brute_force(spark):
    """Scores follow from the words' classes; the probabilities of all words, an unknown one and the end add up to 1."""
    rows = corpus() + odd_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    for settings in SETTINGS:
        known = {bytes(r.word).decode(): (r.n, r["class"]) for r in word_classes(docs, **settings).collect()}
        assert {w: n for w, (n, _) in known.items()} == counts
        groups = settings["classes"] if settings["core"] > settings["classes"] else settings["core"]
        assert all((c < groups) == (n >= LEAST) and (n >= LEAST or c == groups + 1) for n, c in known.values())
        want, sums = brute_scores(rows, known, groups)
        assert all(abs(s - 1) < 1e-9 for s in sums)
        got_scores = sorted((r.doc_id or -1, round(r.score, 5)) for r in score_documents(docs, **settings).collect())
        assert got_scores == sorted((i or -1, s) for (i, _), s in zip(rows, want))


def test_likelihood_rises_and_partitions_do_not_matter(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string")
    made = learn(docs, 7, 2, 6, 4, 10_000, "bigint")
    assert len(made.reached) > 1 and all(b > a for a, b in zip(made.reached, made.reached[1:]))
    again = learn(docs.repartition(5), 7, 2, 6, 4, 10_000, "bigint")
    assert (made.member == again.member).all() and made.reached == again.reached
    nouns = {made.member[made.head.number[f"n{i}".encode()]] for i in range(30)}
    verbs = {made.member[made.head.number[f"v{i}é".encode()]] for i in range(30)}
    assert not nouns & verbs


def test_cells_of_many_words_travel_in_one_row(spark, monkeypatch):
    """Cells equal those counted by brute force, also where a task emits in pieces; a row holds a whole block of words."""
    monkeypatch.setattr(brown_lm, "HELD_CELLS", 50)  # most words are not in the array of the frequent ones
    monkeypatch.setattr(brown_lm, "HELD_CODES", 500)
    rows = [*corpus(), (9001, "same " * 700), (9003, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    made = learn(docs, 7, 2, 6, 4, 10_000, "bigint")
    head, groups, size = made.head, made.groups, made.groups + 2
    contexts, table = brown_lm._contexts(made.encoded.filter("not held_out"), head, made.member, groups)
    want, bigrams = np.zeros((head.movable, 2 * size + 1), int), np.zeros((size, size), int)
    for i, t in rows:
        if not held(i):
            path = [len(head.counts), *[head.number[w.encode()] for w in tokens(t)], len(head.counts)]
            for x, y in zip(path, path[1:]):
                a, b = made.member[x], made.member[y]
                bigrams[a, b] += 1
                if y < head.movable:
                    want[y, a] += 1
                if x < head.movable:
                    want[x, size + b] += 1
                    want[x, -1] += x == y
    found = contexts.toArrow().to_batches()
    blocks = brown_lm.Blocks.of(head.movable, 2 * size + 1)
    assert sum(b.num_rows for b in found) == blocks.count < head.movable
    got_cells = np.zeros((blocks.count, brown_lm.KEYS), int)
    for batch in found:
        for block, keys, n in brown_lm._unpacked(batch):
            got_cells[block, keys] += n
    first = blocks.first(np.arange(head.movable))
    assert (got_cells.ravel()[first[:, None] + np.arange(2 * size + 1)] == want).all() and got_cells.sum() == want.sum()
    assert (table == bigrams).all()


def test_the_last_round_counts_no_cells_of_words(spark, monkeypatch):
    calls, count = [], brown_lm._contexts
    monkeypatch.setattr(brown_lm, "_contexts", lambda *a: calls.append(a) or count(*a))
    learn(spark.createDataFrame(corpus(), "doc_id long, text string"), 7, 2, 6, 4, 10_000, "bigint")
    assert 1 < len(calls) <= brown_lm.ROUNDS + 1


def test_classes_beat_the_base_on_held_out_texts(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string")
    rows = score_documents(docs, classes=6).filter("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    scored = score_documents(docs)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(scored) == brute_base(rows)
    out = scored.filter("held_out").collect()
    assert sum(r.score for r in out) > sum(r.base_score for r in out)

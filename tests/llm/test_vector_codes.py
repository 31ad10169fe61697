import hashlib
import math
import random

import numpy as np
import pytest

from pricewright.llm.vector_codes import assign_all, assign_bounded, code_digests, compress, decoded
from pricewright.llm.vectors import LIMIT, products, squared_distances


def by_definition(rows, parts, entries, rounds):
    """rows: (key, vector of whole numbers), plain Python."""
    rows = sorted(rows)
    width = len(rows[0][1]) // parts
    cut = [[v[j * width : (j + 1) * width] for j in range(parts)] for _, v in rows]
    books = [[cut[i][j] for i in range(min(entries, len(rows)))] for j in range(parts)]

    def assigned():
        return [[min((sum((a - b) ** 2 for a, b in zip(x[j], e)), i) for i, e in enumerate(books[j])) for j in range(parts)] for x in cut]

    for _ in range(rounds):
        found = assigned()
        for j in range(parts):
            for e in range(len(books[j])):
                own = [x[j] for x, f in zip(cut, found) if f[j][1] == e]
                if own:
                    books[j][e] = [sum(c) // len(own) for c in zip(*own)]
    return [[(d, e) for d, e in f] for f in assigned()], books


def vectors(n, length, seed, spread=1.0):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, spread) for _ in range(length)] for _ in range(7)]
    return [[c + draw.gauss(0, 0.2) for c in draw.choice(centres)] for _ in range(n)]


@pytest.mark.parametrize("parts,entries,rounds", [(4, 16, 0), (4, 16, 1), (4, 16, 5), (2, 3, 4), (1, 1, 2), (8, 300, 2)])
def test_equals_the_definition(spark, parts, entries, rounds):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors(260, 8, parts + rounds))]
    rows += [(1000 + i, rows[i][1]) for i in range(40)]  # copies
    df = spark.createDataFrame(rows, "id long, v array<double>").repartition(3)
    found = compress(df, "id", "v", parts, entries, rounds)
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    codes, books = by_definition(whole, parts, entries, rounds)
    assert found.codebooks.tolist() == books
    out = sorted((r.row.id, list(r.code), r.error) for r in found.rows.collect())
    assert out == [(i, [e for _, e in c], sum(d for d, _ in c)) for (i, _), c in zip(sorted(whole), codes)]
    assert len(found.open_parts) == max(0, rounds - 1) and all(0 <= s <= 1 for s in found.open_parts)
    stood_for = decoded(np.array([c for _, c, _ in out]), found.codebooks)
    assert [int(((a - np.array(v)) ** 2).sum()) for a, (_, v) in zip(stood_for, sorted(whole))] == [e for _, _, e in out]


def test_bounds_hold_and_spare_work():
    draw = np.random.default_rng(3)
    x = (draw.normal(size=(3000, 4)) * 100).astype(np.int64)
    book = x[:32].copy()
    state, b, share = assign_all(x, book, 8), 8, []
    for _ in range(8):
        moved = book.copy()
        for e in range(32):
            own = x[state.code == e]
            if len(own):
                moved[e] = own.sum(axis=0) // len(own)
        step = moved - book
        far = np.nextafter(np.sqrt((step * step).sum(axis=1).astype(np.float64)).astype(np.float32), np.float32(np.inf)) * (step != 0).any(axis=1)
        book = moved
        state, looked = assign_bounded(x, book, far, state, b)
        share.append(looked.mean())
        true = np.sqrt(((x[:, None] - book[None]) ** 2).sum(axis=2))
        assert (state.code == true.argmin(axis=1)).all()
        assert (state.upper >= true[np.arange(len(x)), state.code]).all()
        for place in range(b):
            assert (state.lower[:, place] <= true[np.arange(len(x)), state.near[:, place]]).all()
        known = np.hstack([state.code[:, None], state.near])
        rest = true.copy()
        np.put_along_axis(rest, known, np.inf, axis=1)
        assert (state.lower[:, b] <= rest.min(axis=1)).all()
        b = max(int(state.need.max()), 4)
        state = state._replace(near=state.near[:, :b], lower=np.hstack([state.lower[:, :b], state.lower[:, b:].min(axis=1, keepdims=True)]))
    assert share[-1] < 0.5


def test_exact_beyond_doubles():
    draw = random.Random(9)
    a = np.array([[draw.randrange(-LIMIT, LIMIT) for _ in range(6)] for _ in range(20)])
    b = np.array([[draw.randrange(-LIMIT, LIMIT) for _ in range(6)] for _ in range(15)])
    assert products(a, b).tolist() == [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a]
    assert squared_distances(a, b).tolist() == [[sum((int(x) - int(y)) ** 2 for x, y in zip(p, q)) for q in b] for p in a]


SCHEMA = "vec_id long, embedding array<float>, label int, code string, `a.b` string"


def test_digests_with_missing_values(spark):
    draw = random.Random(11)
    good = [(i, [draw.uniform(-1, 1) for _ in range(16)], draw.choice([None, 1, 2])) for i in range(100)]
    bad = [(200, None, 1), (201, [None] * 16, 1), (202, [float("nan")] * 16, 2), (203, [float("inf")] + [0.0] * 15, 2), (204, [], 1), (205, [1.0], None)]
    df = spark.createDataFrame([(i, v, label, "c", "d") for i, v, label in good + bad], SCHEMA)
    out = {r.vec_id: r for r in code_digests(df).collect()}
    assert sorted(out) == list(range(100))
    kept = df.filter("vec_id < 100").collect()
    whole = [(r.vec_id, [math.floor(256 * x) for x in r.embedding]) for r in kept]
    codes, books = by_definition(whole, 16, 64, 2)
    errors = {i: sum(d for d, _ in c) for (i, _), c in zip(sorted(whole), codes)}
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    for (i, _), c in zip(sorted(whole), codes):
        row = out[i]
        assert (row.code, row.error, row.codebooks_sha256) == ("".join(f"{e:02x}" for _, e in c), errors[i], digest)
        assert row.label_error == sum(errors[j] for j, _, label in good if label == good[i][2])


def test_no_vectors_and_vectors_that_cannot_be_cut(spark):
    assert code_digests(spark.createDataFrame([], SCHEMA)).collect() == []
    assert code_digests(spark.createDataFrame([(1, None, 1, "", "")], SCHEMA)).collect() == []
    with pytest.raises(ValueError):
        code_digests(spark.createDataFrame([(1, [1.0] * 17, 1, "", "")], SCHEMA))
    with pytest.raises(ValueError):
        code_digests(spark.createDataFrame([(1, [1e9] * 16, 1, "", "")], SCHEMA))


def test_other_columns_and_equal_rows(spark):
    rows = [(5, [0.5] * 16, None, "x", "y")] * 3 + [(None, [0.25] * 16, 3, "n", "m")]
    found = compress(spark.createDataFrame(rows, SCHEMA), "vec_id", rounds=2)
    out = found.rows.collect()
    assert sorted((r.row.vec_id or 0, r.row.code, r.row["a.b"], r.error) for r in out) == [(0, "n", "m", 0), (5, "x", "y", 0), (5, "x", "y", 0), (5, "x", "y", 0)]
    assert found.codebooks.shape == (16, 4, 1)

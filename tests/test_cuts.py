import random

from pyspark.sql import functions as F

from pricewright.operators.cuts import Cut, cut_points, is_before


def expected(rows, group, total):
    """Rows: (group, order tuple, weight)."""
    before = 0
    for _, at, weight in sorted(r for r in rows if r[0] == group):
        if before + weight > total:
            return Cut(at, before)
        before += weight
    return Cut(None, before)


def frame(spark, rows):
    return spark.createDataFrame([(g, *at, w) for g, at, w in rows], "g long, a long, b long, w long").repartition(3)


def test_cuts_of_weights_in_groups(spark):
    draw = random.Random(1)
    rows = [(draw.randrange(3), (draw.randrange(-(1 << 60), 1 << 60), i), draw.randrange(50)) for i in range(400)]
    wanted = [(g, t) for g in range(4) for t in (0, 1, 500, 1700, 2500, 10**6)]
    for few in (1, 16, 1000):
        assert cut_points(frame(spark, rows), ["a", "b"], wanted, weight="w", group="g", fetched=few, counts=64) == [expected(rows, *w) for w in wanted]


def test_one_value_may_hold_most_rows(spark):
    rows = [(0, (7 if i % 3 else i, i * i), 1) for i in range(300)]
    wanted = [(0, t) for t in (0, 1, 2, 3, 5, 100, 201, 299, 300)]
    assert cut_points(frame(spark, rows), ["a", "b"], wanted, fetched=4) == [expected(rows, *w) for w in wanted]


def test_many_ranges_are_joined(spark):
    draw = random.Random(2)
    rows = [(g, (draw.randrange(1000), i), 1) for g in range(90) for i in range(30)]
    wanted = [(g, t) for g in range(90) for t in (3, 17)]
    assert cut_points(frame(spark, rows), ["a", "b"], wanted, group="g", fetched=2) == [expected(rows, *w) for w in wanted]


def test_repeated_rows_and_no_rows(spark):
    rows = [(0, (1, 1), 2)] * 5
    assert cut_points(frame(spark, rows), ["a", "b"], [(0, 5)], weight="w", fetched=1) == [Cut((1, 1), 0)]
    assert cut_points(frame(spark, rows).limit(0), ["a", "b"], [(0, 5)]) == [Cut(None, 0)]


def test_is_before(spark):
    rows = [(a, b) for a in range(3) for b in range(3)]
    df = spark.createDataFrame(rows, "a int, b int").filter(is_before([F.col("a"), F.col("b")], [F.lit(1), F.lit(2)]))
    assert sorted(map(tuple, df.collect())) == [r for r in rows if r < (1, 2)]

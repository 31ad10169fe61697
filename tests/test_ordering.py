"""Order statistics over many small ranges: the same results, and no range that a hot key or value fills."""

import random
import statistics as st

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pricewright.operators import cleaning, ordering


@pytest.fixture(params=[7, 60])
def narrow(request, monkeypatch):
    monkeypatch.setattr(ordering, "ROWS_PER_RANGE", request.param)
    return request.param


def skewed(spark, n=900):
    draw = random.Random(6)
    data = [(i, "hot" if i % 3 else f"k{i % 40}", float(draw.randrange(400)) if i % 5 else None) for i in range(n)]
    return spark.createDataFrame(data, "id int, k string, v double"), data


def test_quantiles(spark, narrow):
    df, data = skewed(spark)
    got = dict(rows(ordering.exact_quantile(ordering.value_counts(df, ["k"], "v"), ["k"])))
    by_key = {}
    for _, k, v in data:
        if v is not None:
            by_key.setdefault(k, []).append(v)
    assert got == {k: st.median(v) for k, v in by_key.items()}
    every = [v for _, _, v in data if v is not None]
    assert ordering.exact_quantile(ordering.value_counts(df, [], "v"), []).first()[0] == st.median(every)


def test_positions(spark, narrow):
    df, data = skewed(spark)
    known = df.fillna(-1.0)
    got = {r.id: r.position for r in ordering.positions(known, "v", ["id"]).collect()}
    order = sorted(data, key=lambda r: (-1.0 if r[2] is None else r[2], r[0]))
    assert got == {r[0]: i for i, r in enumerate(order)}


def test_median_fill(spark, narrow):
    df, data = skewed(spark, 300)
    by_key = {}
    for _, k, v in data:
        by_key.setdefault(k, []).append(v)
    medians = {k: st.median([x for x in v if x is not None]) for k, v in by_key.items() if any(x is not None for x in v)}
    filled = {i: medians.get(k) if v is None else v for i, k, v in data}
    overall = st.median([v for v in filled.values() if v is not None])
    got = {r.id: r.v for r in cleaning.fill_null_median(df, ["v"], "k").collect()}
    assert got == {i: overall if v is None else v for i, v in filled.items()}


def test_no_range_is_large(spark, narrow):
    df, _ = skewed(spark)
    counts = ordering.value_counts(df, ["k"], "v")
    largest = ordering._ranged(counts, ["k", "_v"]).groupBy("_range").count().agg(F.max("count")).first()[0]
    assert largest <= 3 * narrow
    hot = df.select("id", F.lit(1.0).alias("v"))  # one value everywhere: the tie-break spreads it
    assert ordering._ranged(hot, ["v", "id"]).groupBy("_range").count().agg(F.max("count")).first()[0] <= 3 * narrow

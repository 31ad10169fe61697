from __future__ import annotations

import random
import statistics as st

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from pricewright.operators import cleaning, encode, joins, ordering, quality, reshape, statistics


# -- order statistics -------------------------------------------------------------------


def test_quantile_per_key_matches_brute_force_under_skew(spark):
    rng = random.Random(7)
    data = [("hot", float(rng.choice([1, 1, 1, 2, 3, rng.randint(0, 5000)]))) for _ in range(3000)]
    data += [(k, rng.uniform(-5, 5)) for k in "abcdef" for _ in range(rng.randint(1, 9))]
    data += [("hot", None), (None, 3.0), ("a", float("nan"))]
    df = spark.createDataFrame(data, "k string, v double")
    got = dict(rows(ordering.exact_quantile(ordering.value_counts(df, ["k"], "v"), ["k"])))
    groups: dict[str, list[float]] = {}
    for k, v in data:
        if k is not None and v is not None and v == v:
            groups.setdefault(k, []).append(v)
    assert got == pytest.approx({k: st.median(v) for k, v in groups.items()})


@pytest.mark.parametrize("share", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_global_quantile(spark, share):
    values = [float(x * x % 977) for x in range(1500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = ordering.exact_quantile(ordering.value_counts(df, [], "v"), [], share).first()[0]
    assert got == pytest.approx(float(np.quantile(values, share)))


def test_quantile_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    found = ordering.exact_quantile(ordering.value_counts(df, [], "v"), []).collect()
    assert [r[0] for r in found] in ([], [None])


def test_positions_are_dense_and_ordered(spark):
    data = [(i, (i * 37) % 50) for i in range(400)]
    df = spark.createDataFrame(data, "id int, v int")
    got = {r["id"]: r["position"] for r in ordering.positions(df, "v", ["id"]).collect()}
    expected = {i: p for p, (i, _) in enumerate(sorted(data, key=lambda r: (r[1], r[0])))}
    assert got == expected


# -- cleaning ------------------------------------------------------------------------------


def test_keep_first_keeps_the_first_and_null_keys_are_equal(spark):
    data = [("a", 1, "x"), ("a", 0, "y"), (None, 2, "p"), (None, 1, "q"), ("b", 5, "z")]
    df = spark.createDataFrame(data, "k string, o int, v string")
    kept = cleaning.keep_first(df, ["k"], ["o"])
    assert rows(kept, "k", "v") == sorted([("a", "y"), ("b", "z"), (None, "q")], key=repr)
    assert rows(cleaning.keep_first(kept, ["k"], ["o"])) == rows(kept)


def test_duplicate_report(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert rows(cleaning.duplicate_report(df, ["k"])) == [(5, 3, 2)]
    assert rows(cleaning.duplicate_report(df.filter("k = 'z'"), ["k"])) == [(0, 0, 0)]


def test_keep_positive_drops_zero_negative_and_null(spark):
    df = spark.createDataFrame([(1.0, 1), (0.0, 1), (1.0, -1), (None, 1)], "p double, n int")
    assert rows(cleaning.keep_positive(df, ["p", "n"])) == [(1.0, 1)]


def test_drop_unusable(spark):
    data = [(1.0, 1), (float("inf"), 1), (float("nan"), 1), (2.0, None)]
    df = spark.createDataFrame(data, "a double, b int")
    assert rows(cleaning.drop_unusable(df, ["a", "b"])) == [(1.0, 1)]


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert rows(cleaning.null_profile(df)) == [("a", 1, 3), ("b", 2, 3)]


def test_required_columns(spark):
    with pytest.raises(ValueError, match="c"):
        cleaning.require_columns(spark.range(1), ["id", "c"])


def pandas_fill(data: pd.DataFrame, column: str, key: str) -> list[float]:
    medians = data.dropna(subset=[key]).groupby(key)[column].median()
    grouped = data[column].fillna(data[key].map(medians))
    return list(grouped.fillna(grouped.median()))


@pytest.mark.parametrize("broadcast", [True, False])
def test_fill_null_median_matches_two_pass_fill(spark, monkeypatch, broadcast):
    rng = random.Random(3)
    data = []
    for i in range(300):
        key = rng.choice(["hot", "hot", "hot", "b", "void", None])
        missing = key == "void" or rng.random() < 0.3
        data.append((i, key, None if missing else round(rng.uniform(0, 100), 2)))
    if not broadcast:
        monkeypatch.setattr(cleaning, "measured_side", lambda df: joins.measured_side(df, max_rows=1))
    df = spark.createDataFrame(data, "i int, k string, v double")
    filled = {r["i"]: r["v"] for r in cleaning.fill_null_median(df, ["v", "absent"], "k").collect()}
    frame = pd.DataFrame(data, columns=["i", "k", "v"])
    assert [filled[i] for i in frame["i"]] == pytest.approx(pandas_fill(frame, "v", "k"))


def test_fill_without_key_column_uses_the_overall_median(spark):
    df = spark.createDataFrame([(1.0,), (None,), (4.0,), (9.0,)], "v double")
    assert rows(cleaning.fill_null_median(df, ["v"], "k")) == [(1.0,), (4.0,), (4.0,), (9.0,)]


def test_fill_of_a_column_without_any_value(spark):
    df = spark.createDataFrame([("a", None), (None, None)], "k string, v double")
    assert rows(cleaning.fill_null_median(df, ["v"], "k"), "v") == [(None,), (None,)]


@pytest.mark.parametrize("last", [2, None])
def test_fill_gives_doubles_with_and_without_gaps(spark, last):
    df = spark.createDataFrame([("a", 1), ("a", last)], "k string, v int")
    assert cleaning.fill_null_median(df, ["v"], "k").dtypes == [("k", "string"), ("v", "double")]


# -- joins ------------------------------------------------------------------------------------


def test_enrich_lets_the_right_side_win(spark):
    left = spark.createDataFrame([("a", 1, 5), ("b", 2, 6)], "k string, score int, x int")
    right = spark.createDataFrame([("a", 9)], "k string, score int")
    out = joins.enrich(left, right, "k")
    assert rows(out, "k", "x", "score") == [("a", 5, 9), ("b", 6, None)]
    assert rows(joins.enrich(left, right, "k", "inner"), "k") == [("a",)]


def test_enrich_if_absent(spark):
    left = spark.createDataFrame([("a", 1)], "k string, score int")
    right = spark.createDataFrame([("a", 9)], "k string, score int")
    assert rows(joins.enrich_if_absent(left, right, "k", "score")) == [("a", 1)]
    assert rows(joins.enrich_if_absent(left.drop("score"), right, "k", "score")) == [("a", 9)]


def test_membership_filters(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    keys = spark.createDataFrame([("a",), ("a",), (None,)], "x string")
    assert rows(joins.keep_in(df, "k", ["a"])) == [("a",), ("a",)]
    assert rows(joins.keep_matching(df, "k", keys, "x")) == [("a",), ("a",)]


def test_orphans_are_found_despite_null_keys(spark):
    fact = spark.createDataFrame([("a",), ("z",), ("z",), (None,)], "k string")
    dim = spark.createDataFrame([("a",), ("a",), (None,)], "d string")
    assert rows(joins.orphans(fact, "k", dim, "d")) == [(2, 1, 4)]


def test_measured_side_hints_only_what_fits(spark):
    df = spark.range(50).withColumn("t", F.lit("x" * 100))
    assert joins.measured_side(df).small
    assert not joins.measured_side(df, max_rows=10).small
    assert not joins.measured_side(df, max_bytes=100).small


# -- reshaping ------------------------------------------------------------------------------------


def test_explode_list_with_position(spark):
    df = spark.createDataFrame([("a", [5, 6]), ("b", []), ("c", None)], "k string, xs array<int>")
    assert rows(reshape.explode_list(df, "xs", "x", "n"), "k", "n", "x") == [("a", 1, 5), ("a", 2, 6)]


def test_field_by_key_falls_back(spark):
    data = [({"uc": "5"}, "uc"), ({"diamonds": "7"}, "uc"), ({"other": "1"}, "uc"), ({}, None)]
    df = spark.createDataFrame(data, "m map<string,string>, key string")
    got = df.select(reshape.field_by_key("m", "key", "diamonds", "0").alias("v"))
    assert [r["v"] for r in got.collect()] == ["5", "7", "0", "0"]


def test_unnest_series(spark):
    df = spark.createDataFrame([("g", {2024: [1.0, 2.0], 2025: [3.0]})], "g string, s map<int,array<double>>")
    got = rows(reshape.unnest_series(df, "s"), "g", "year", "month_num", "value")
    assert got == [("g", 2024, 1, 1.0), ("g", 2024, 2, 2.0), ("g", 2025, 1, 3.0)]


def test_join_text(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],), (None,)], "xs array<string>")
    assert [r[0] for r in df.select(reshape.join_text("xs")).collect()] == ["a, b", "", ""]


def test_grid_has_every_combination_without_a_join(spark):
    df = spark.range(4)
    grid = reshape.with_grid(df, [("it's", 1.5, 1), ("b", 2.0, 2)], ["name", "x", "n"])
    assert grid.count() == 8
    assert rows(grid.filter("id = 0"), "name", "x", "n") == [("it's", 1.5, 1), ("b", 2.0, 2)]
    assert "Join" not in grid._jdf.queryExecution().executedPlan().toString()


# -- encoding -----------------------------------------------------------------------------------------


def test_codes_follow_first_appearance(spark):
    data = [(3, "b"), (1, "c"), (2, "a"), (4, "c"), (5, None)]
    df = spark.createDataFrame(data, "o int, g string")
    assert rows(encode.first_seen_codes(df, "g", "o", "code")) == [("a", 1), ("b", 2), ("c", 0)]
    coded = encode.encode_first_seen(df, "g", "o", "code")
    assert rows(coded, "o", "code") == [(1, 0), (2, 1), (3, 2), (4, 0), (5, None)]


def test_fixed_codes(spark):
    df = spark.createDataFrame([("x",), ("?",)], "g string")
    assert [r[0] for r in df.select(encode.encode_fixed("g", {"x": 4})).collect()] == [4, 0]


# -- statistics -------------------------------------------------------------------------------------------


def test_pivot_mean_and_fill(spark):
    data = [("a", "x", 1.0), ("a", "x", 3.0), ("b", "y", 5.0), (None, "x", 7.0)]
    df = spark.createDataFrame(data, "i string, c string, v double")
    assert rows(statistics.pivot_mean(df, "i", "c", ["x", "y"], "v")) == [("a", 2.0, None), ("b", None, 5.0)]
    assert rows(statistics.pivot_mean(df, "i", "c", ["x", "y"], "v", fill=0.0)) == [("a", 2.0, 0.0), ("b", 0.0, 5.0)]


def test_correlation_matches_pandas_and_survives_constants(spark):
    rng = random.Random(1)
    data = [(x := rng.random(), None if i % 5 == 0 else x * 2 + rng.random(), 4.0, rng.random()) for i in range(200)]
    frame = pd.DataFrame(data, columns=list("abcd")).astype(float)
    df = spark.createDataFrame(data, "a double, b double, c double, d double")
    got = {(r["a"], r["b"]): r["r"] for r in statistics.correlation_pairs(df, list("abcd")).collect()}
    expected = frame.corr()
    assert len(got) == 6
    for (a, b), r in got.items():
        if "c" in (a, b):
            assert r is None
        else:
            assert r == pytest.approx(expected.loc[a, b])


def test_correlation_of_an_empty_table_lists_every_pair(spark):
    df = spark.createDataFrame([], "a double, b double")
    assert rows(statistics.correlation_pairs(df, ["a", "b"])) == [("b", "a", None)]


def test_histogram_matches_numpy(spark):
    rng = random.Random(5)
    values = [rng.gauss(0, 1) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    counts, edges = np.histogram(values, bins=20)
    got = statistics.histogram(df, "v", 20).orderBy("bin").collect()
    assert [r["rows"] for r in got] == list(counts)
    assert [r["bin_from"] for r in got] == pytest.approx(list(edges[:-1]))


def test_histogram_of_one_value(spark):
    got = statistics.histogram(spark.createDataFrame([(2.0,), (2.0,)], "v double"), "v", 4).orderBy("bin").collect()
    assert [r["rows"] for r in got] == list(np.histogram([2.0, 2.0], bins=4)[0])
    assert (got[0]["bin_from"], got[-1]["bin_to"]) == (1.5, 2.5)


def test_group_statistics(spark):
    data = [("a", 2, None), ("a", 3, 5.0), ("a", 9, 7.0), ("b", 1, 1.0), (None, 1, 3.0)]
    df = spark.createDataFrame(data, "k string, o int, v double")
    assert [tuple(r) for r in statistics.group_mean(df, "k", "v", "m").collect()] == [("b", 1.0), ("a", 6.0)]
    assert rows(statistics.group_first(df, "k", "v", "o", "f")) == [("a", 5.0), ("b", 1.0)]


def test_share_totals(spark):
    df = spark.createDataFrame([("a", 60), ("a", 40), ("b", 80)], "k string, pct int")
    assert rows(statistics.share_totals(df, "k", "pct")) == [("a", 100, True), ("b", 80, False)]


def test_rankings(spark):
    df = spark.createDataFrame([("a", 1.0, 2), ("b", 5.0, 1), ("c", 5.0, 0)], "k string, v double, o int")
    assert [r["k"] for r in statistics.ranked(df, "v", "k").collect()] == ["a", "b", "c"]
    assert [r["k"] for r in statistics.top_k(df, "v", "k", 2).collect()] == ["b", "c"]
    assert statistics.arg_max(df, "v", "o").first()["k"] == "c"


# -- quality --------------------------------------------------------------------------------------------------


def test_checksum_ignores_order_and_sees_changes(spark):
    df = spark.createDataFrame([(i, None if i % 3 else str(i)) for i in range(50)], "a int, b string")
    one = rows(quality.table_checksum(df, "t"))
    assert one == rows(quality.table_checksum(df.repartition(7).orderBy(F.desc("a")), "t"))
    assert one != rows(quality.table_checksum(df.withColumn("b", F.coalesce("b", F.lit(""))), "t"))


def test_table_counts(spark):
    got = rows(quality.table_counts({"x": spark.range(3), "y": spark.range(0), "z": None}))
    assert got == [("x", 3, 1, "OK"), ("y", 0, 1, "EMPTY"), ("z", -1, -1, "UNREADABLE")]


def test_rule_report(spark):
    got = rows(quality.rule_report("t", spark.range(4), {"odd": F.col("id") % 2 == 1, "big": F.col("id") > 9}))
    assert got == [("big", "t", 0, 4), ("odd", "t", 2, 4)]


def test_split_rejects(spark):
    df = spark.createDataFrame([("a", None, "v"), ("b", "boom", "v"), ("c", None, None)], "k string, e string, v string")
    good, bad = quality.split_rejects(df, F.col("e"), F.col("v"))
    assert rows(good, "k") == [("a",)]
    assert rows(bad, "k", "reject_reason") == [("b", "source error"), ("c", "empty")]


def test_ordered_checksum_sees_the_order_and_not_the_partitions(spark, monkeypatch):
    from pricewright.operators import ordering, quality

    given = [(i, f"v{i % 7}") for i in range(500)]

    def result(pairs, parts, **settings):
        for name, value in settings.items():
            monkeypatch.setattr(quality if name == "STRETCH" else ordering, name, value)
        df = spark.createDataFrame(pairs, "k long, v string").repartition(parts)
        return tuple(quality.ordered_checksum(df, "t", ["k"], ["v"]).first())

    fingerprints = spark.createDataFrame(given, "k long, v string").orderBy("k").select(quality.row_fingerprint(["v"])).collect()
    hashes = []
    for base in quality.BASES:
        h = 0
        for (f,) in fingerprints:
            h = (h * base + f) % quality.PRIME
        hashes.append(f"{h:08x}")
    expected = ("t", 500, "".join(hashes))
    assert result(given, 1) == result(given, 6) == expected
    assert result(given, 3, ROWS_PER_RANGE=40, STRETCH=3) == expected
    swapped = [(1, "v2"), (2, "v1")] + [g for g in given if g[0] not in (1, 2)]
    assert result(swapped, 2) != expected
    assert result([], 1) == ("t", 0, "0" * 16)


def test_ordered_checksum_spreads_a_hot_key_and_collects_no_range(spark, monkeypatch):
    from pricewright.operators import ordering, quality

    given = [(None if i % 5 == 0 else 1, f"v{i}") for i in range(600)]
    df = spark.createDataFrame(given, "k long, v string").repartition(3)
    whole = tuple(quality.ordered_checksum(df, "t", ["k"], ["v"]).first())
    monkeypatch.setattr(ordering, "ROWS_PER_RANGE", 50)
    hashes = quality.range_hashes(df, ["k"], ["v"])
    sizes = [r["_n"] for r in hashes.collect()]
    assert sum(sizes) == 600 and len(sizes) > 6 and max(sizes) < 200  # one key has 480 rows
    assert tuple(quality.ordered_checksum(df, "t", ["k"], ["v"]).first()) == whole
    assert "collect_list" not in hashes._jdf.queryExecution().toString()


def test_histogram_leaves_infinities_out(spark):
    from pricewright.operators.statistics import histogram, left_out

    values = [1.0, 2.0, 3.0, 5.0, float("inf"), float("-inf"), float("nan"), None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [tuple(r) for r in histogram(df, "v", 4).orderBy("bin").collect()] == [(1, 1.0, 2.0, 1), (2, 2.0, 3.0, 1), (3, 3.0, 4.0, 1), (4, 4.0, 5.0, 1)]
    assert tuple(left_out(df, "v").first()) == (1, 1, 2, 8)
    assert histogram(df.filter("isnan(v)"), "v", 4).count() == 0


def test_fill_report_says_what_the_fill_does(spark):
    from pricewright.operators.cleaning import fill_null_median, fill_report

    nan = float("nan")
    data = [("a", 1.0, None), ("a", None, None), ("a", nan, None), ("b", None, None), ("b", None, None), (None, None, None), (None, 4.0, None)]
    df = spark.createDataFrame(data, "k string, v double, w double")
    assert [tuple(r) for r in fill_report(df, ["v", "w", "absent"], "k").collect()] == [("v", 5, 2, 3, 0, 7), ("w", 7, 0, 0, 7, 7)]
    assert fill_null_median(df, ["v", "w"], "k").agg(F.count("v"), F.count("w")).first() == (7, 0)
    assert [tuple(r) for r in fill_report(df, ["v"]).collect()] == [("v", 5, 0, 5, 0, 7)]
    assert [tuple(r) for r in fill_report(df.limit(0), ["v"], "k").collect()] == [("v", 0, 0, 0, 0, 0)]

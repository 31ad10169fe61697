from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from pricewright import fixed_values as fv
from pricewright.plans import star
from pricewright.schemas import (
    ESPORTS_RECORD,
    REGION_RECORD,
    SEGMENT_RECORD,
    STATS_RECORD,
    TABLES,
    TOPUP_RECORD,
    conform,
)
from pricewright.sources import pages, raw, tables


def read_document(spark, tmp_path, document, multi_line=True):
    path = tmp_path / "doc.json"
    path.write_text(json.dumps(document, indent=2, ensure_ascii=False), encoding="utf-8")
    return raw.read_raw(spark, str(path), multi_line)


def test_written_documents_are_plain_nested_json(spark, tmp_path):
    path = str(tmp_path / "raw")
    document = {"topup": {'k"ey': {"game": "é"}}, "stats": {"a": None}}
    raw.write_raw(raw.document_frame(spark, document), path)
    text = [line for part in (tmp_path / "raw").glob("part-*") for line in part.read_text("utf-8").splitlines()]
    assert json.loads(text[0]) == document


def test_round_trip_of_the_embedded_snapshot(spark, documents):
    topup, rejects = raw.branch_records(documents, "topup", TOPUP_RECORD)
    assert topup.count() == 6 and rejects.count() == 0
    assert topup.select(F.sum(F.size("tiers"))).first()[0] == 51
    stats, _ = raw.branch_records(documents, "stats", STATS_RECORD)
    assert stats.filter(F.col("registered_users_millions").isNull()).count() == 5
    esports, _ = raw.branch_records(documents, "esports", ESPORTS_RECORD)
    assert esports.agg(F.sum("prize_pool_2025_usd")).first()[0] == 10484061


def test_metadata_keys_are_no_records_and_bad_ones_are_set_aside(spark, tmp_path):
    document = {
        "topup": {
            "a": {"game": "A", "tiers": [{"uc": 5, "price_usd": 1.5, "label": "x"}]},
            "b": {"_error": "timeout"},
            "c": {},
            "d": None,
            "_meta": {"extracted_at": "now"},
            "_live": [{"scraped_label": "x"}],
        },
        "stats": {"_error": "branch down", "_extracted_at": "now"},
    }
    docs = read_document(spark, tmp_path, document)
    good, bad = raw.branch_records(docs, "topup", TOPUP_RECORD)
    assert rows(good, "game_key", "game") == [("a", "A")]
    assert rows(bad, "game_key", "reject_reason") == [("b", "source error"), ("c", "empty"), ("d", "empty")]
    good, bad = raw.branch_records(docs, "stats", STATS_RECORD)
    assert good.count() == 0
    assert rows(bad, "payload", "reject_reason") == [("branch down", "source error")]


def test_a_record_of_the_wrong_type_does_not_spoil_the_others(spark, tmp_path):
    docs = read_document(spark, tmp_path, {"topup": {"a": {"game": "A"}, "b": [1, 2], "c": "text"}})
    good, _ = raw.branch_records(docs, "topup", TOPUP_RECORD)
    assert ("a", "A") in rows(good, "game_key", "game")


def test_configured_keys_in_order(spark):
    records = spark.createDataFrame([("z", 1), ("a", 2), ("other", 3)], "game_key string, v int")
    keys = raw.key_list(spark, ["z", "missing", "a"])
    assert rows(raw.configured_only(records, keys), "ordinal", "game_key", "v") == [(0, "z", 1), (2, "a", 2)]
    kept = raw.configured_only(records, keys, keep_absent=True)
    assert rows(kept, "ordinal", "v") == [(0, 1), (1, None), (2, 2)]


def test_market_lookups(documents):
    regions = raw.market_table(documents, "regional_price_index", "region", REGION_RECORD)
    assert rows(regions.select("region", "price_index", F.size("countries")))[0] == ("East_Asia", 1.2, 3)
    segments = raw.market_table(documents, "spending_segments", "segment", SEGMENT_RECORD)
    assert rows(segments, "segment", "threshold_monthly_usd") == [("dolphin", 10), ("minnow", 0), ("whale", 100)]


def test_source_registry(spark):
    sources = raw.source_registry(spark)
    assert sources.count() == 25
    assert rows(raw.source_counts(sources)) == [("analytics", 13), ("esports", 5), ("top_up_platforms", 7)]


def test_csv_round_trip_and_missing_tables(spark, tmp_path, tables=None):
    from pricewright.sources.tables import Paths, csv_rejects, read_csv, read_csv_tables, write_csv

    paths = Paths(str(tmp_path))
    data = star.fact_revenue_monthly(star.monthly_series(spark))
    write_csv(data, paths.processed("fact_revenue_monthly"))
    found = read_csv_tables(spark, paths)
    assert list(found) == ["fact_revenue_monthly"]
    assert rows(found["fact_revenue_monthly"]) == rows(data)
    (tmp_path / "processed" / "dim_age").mkdir()
    (tmp_path / "processed" / "dim_age" / "part.csv").write_text("game_key,game,age_band,pct,game_median_age,age_price_sensitivity,source_url\na,A,x,notanumber,1,low,u\n")
    with pytest.raises(Exception):
        read_csv(spark, paths.processed("dim_age"), "dim_age", strict=True).collect()
    assert read_csv(spark, paths.processed("dim_age"), "dim_age").count() == 0
    assert csv_rejects(spark, paths.processed("dim_age"), "dim_age").count() == 1


def test_tables_are_read_from_the_first_source_that_has_them(spark, tmp_path):
    paths = tables.Paths(str(tmp_path))
    data = star.fact_revenue_monthly(star.monthly_series(spark))
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, "fact_revenue_monthly", paths, "default")
    tables.write_csv(data.limit(3), paths.processed("fact_revenue_monthly"))
    assert tables.read_table(spark, "fact_revenue_monthly", paths).count() == 3
    tables.write_parquet(data.limit(4), paths.warehouse("fact_revenue_monthly"))
    assert tables.read_table(spark, "fact_revenue_monthly", paths).count() == 4
    spark.sql("CREATE DATABASE IF NOT EXISTS readers")
    tables.write_catalog(data, "fact_revenue_monthly", "readers")
    assert tables.read_table(spark, "fact_revenue_monthly", paths, "readers").count() == 36


def test_conform_checks_columns(spark):
    with pytest.raises(ValueError, match="age_band"):
        conform(spark.createDataFrame([("a",)], "game_key string"), "dim_age")
    assert set(TABLES) == set(fv_tables())


def fv_tables():
    return ["dim_game", "fact_pricing", "dim_age", "fact_competition", "fact_revenue_monthly", "ml_features"]


PAGE = """
<html><head><style>.product-item{}</style><script>var x = "<div class='product-item'>";</script></head><body>
<div class="list">
 <div class="card product-item"><h3 class="item-title"> Gold <b>pack</b> </h3><br><span class="sale-price">$1 </span></div>
 <div class="package-box"><p class="name">No price</p></div>
 <div class="diamond"><span class="amount">5</span><div class="package-inner"><i class="name">Inner</i><em class="price">7</em></div></div>
 <div class="product-items"><p class="name">Not an item</p><p class="price">9</p></div>
 <div class="diamond-x"><p class="title">Last</p><p class="price">8<p></div>
 <div class="package"><p class="title">Sixth</p><p class="price">8</p></div>
</div></body></html>
"""


def test_product_items_cut_before_the_check_and_follow_nesting(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, "<p>nothing</p>")], "page_id int, html string")
    got = rows(pages.extract_product_items(df, "html"), "page_id", "item_no", "label", "price")
    # the second has no price; the third takes its name from the item nested in it; the sixth is cut
    assert got == [(1, 1, "Goldpack", "$1"), (1, 3, "Inner", "5"), (1, 4, "Inner", "7"), (1, 5, "Last", "8")]


def test_items_by_pattern_use_up_their_place(spark):
    html = "".join(f'<a href="/{i}">{"" if i == 1 else i}</a>' for i in range(8))
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    got = pages.extract_items(df, "html", r"<a [^>]*>[^<]*</a>", r">([^<]*)<", r'href="([^"]*)"', first=3)
    assert rows(got, "item_no", "label", "price") == [(1, "0", "/0"), (3, "2", "/2")]


def test_fixed_values_agree_with_each_other():
    assert {r: x for r, x, _, _ in fv.REGIONS} == {r: x for r, (x, _) in fv.MARKET_REGIONS.items()}
    assert set(fv.FEATURES) == set(fv.FEATURE_LABELS)
    assert list(fv.TOPUP) == list(fv.STATS) == list(fv.ESPORTS) == fv.GAME_KEYS

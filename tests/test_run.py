from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from pricewright import fixed_values as fv
from pricewright.ml import models
from pricewright.operators.quality import table_checksum
from pricewright.plans import load, run
from pricewright.schemas import TABLES
from pricewright.session import ensure_checkpoint_dir
from pricewright.sources.raw import embedded_document
from pricewright.sources.tables import Paths, read_csv_tables


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    paths = Paths(str(tmp_path_factory.mktemp("run") / "root"))
    run.ensure_built(spark, paths)
    return paths


def test_build_happens_once(spark, root):
    assert not run.ensure_built(spark, root)


def test_stored_tables_equal_built_ones(spark, root, tables):
    for name, df in read_csv_tables(spark, root).items():
        assert rows(df) == rows(tables[name])
    assert spark.read.option("header", True).csv(root.report("feature_correlation")).count() == 36


def test_load_is_repeatable_and_audited(spark, root, tables):
    spark.sql("CREATE DATABASE IF NOT EXISTS market")
    target = lambda df, name: df.write.mode("overwrite").saveAsTable(f"market.{name}")
    for _ in range(2):
        results, counts, checks = run.load(spark, root, target)
    assert {r.table: r.rows for r in results} == {n: tables[n].count() for n in TABLES}
    assert {r["status"] for r in counts.collect()} == {"OK"}
    assert {r["affected"] for r in checks.collect()} == {0}
    loaded = spark.table("market.fact_pricing")
    assert loaded.count() == 51 and loaded.columns[-1] == "loaded_at"
    copy = spark.read.parquet(root.warehouse("fact_pricing"))
    assert "loaded_at" not in copy.columns
    audit = spark.read.parquet(root.audit_log)
    assert audit.count() == 12
    assert audit.select("table_name", "checksum").distinct().count() == 6
    expected = table_checksum(copy, "fact_pricing").first()["checksum"]
    assert [r.checksum for r in results if r.table == "fact_pricing"] == [expected]


def test_failing_target_is_reported_and_keeps_the_copy(spark, tmp_path, tables):
    paths = Paths(str(tmp_path))

    def broken(df, name):
        raise RuntimeError("no connection")

    result = load.load_table(tables["dim_age"], "dim_age", paths, broken)
    assert (result.rows, result.status, result.note) == (0, "FAILED", "no connection")
    assert spark.read.parquet(paths.warehouse("dim_age")).count() == 24
    load.append_audit(spark, [result], paths.audit_log)
    assert rows(spark.read.parquet(paths.audit_log), "table_name", "rows_loaded", "status") == [("dim_age", 0, "FAILED")]


def test_empty_table_is_skipped(spark, tmp_path, tables):
    paths = Paths(str(tmp_path))
    for df in (None, tables["dim_age"].limit(0)):
        assert load.load_table(df, "dim_age", paths).status == "SKIPPED"
    assert not (tmp_path / "warehouse").exists()


def test_integrity_finds_orphans(spark, tables):
    games = tables["dim_game"].filter("game_key <> 'mlbb'")
    checks = load.integrity({"dim_game": games, "fact_pricing": tables["fact_pricing"]})
    assert rows(checks, "affected", "total") == [(18, 51)]


def test_training_phase_stores_model_scores_and_reports(spark, root):
    seconds = run.run(spark, root, "ml", learners=[models.gradient_boosting(5), models.ridge()])
    assert list(seconds) == ["ml"]
    scores = spark.read.json(root.report("model_scores"))
    assert scores.filter("is_best").count() == 1 and scores.count() == 2
    assert spark.read.json(root.report("demo_scores")).count() == 4
    assert spark.read.json(root.report("run_times")).filter(F.col("phase") == "ml").count() == 1


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(run, "build_session", lambda app: spark)
    run.main(["--root", str(tmp_path), "--phase", "extract"])
    assert capsys.readouterr().out.startswith("extract: ")
    assert (tmp_path / "raw" / "master_raw" / "_SUCCESS").exists()


def test_unknown_phase(spark, root):
    with pytest.raises(ValueError):
        run.run(spark, root, "deploy")


def test_extract_stores_page_items(spark, tmp_path):
    paths = Paths(str(tmp_path))
    pages = spark.createDataFrame(
        [(1, '<div class="product-item"><b class="name">A</b><i class="price">1</i></div>')], "page_id int, html string"
    )
    run.extract(spark, paths, pages=pages)
    assert spark.read.parquet(f"{paths.root}/raw/page_items").count() == 1


def test_a_broken_input_shows_in_the_stored_reports(spark, tmp_path):
    document = embedded_document()
    key = fv.GAME_KEYS[0]
    tiers = document["topup"][key]["tiers"]
    document["topup"][key]["tiers"] = [*tiers, tiers[0], {**tiers[1], "label": "free", "price_usd": 0}]
    document["stats"][key]["age_distribution"] = {"13-17": 50}
    paths = Paths(str(tmp_path / "root"))
    folder = tmp_path / "root" / "raw" / "master_raw"
    folder.mkdir(parents=True)
    (folder / "part-0.json").write_text(json.dumps(document) + "\n{broken\n", encoding="utf-8")
    spark.sql("CREATE DATABASE IF NOT EXISTS broken_run")
    for phase in ("transform", "load"):
        run.run(spark, paths, phase, target=lambda df, name: df.write.mode("overwrite").saveAsTable(f"broken_run.{name}"))
    quality = {(r.rule, r.table_name): r.affected for r in spark.read.json(paths.report("quality")).collect()}
    assert quality["duplicate key", "raw tiers"] == 1
    assert quality["price not positive", "raw tiers"] == 1
    assert quality["age shares off 95 to 105", "dim_age"] == 1
    assert quality["duplicate key", "fact_pricing"] == 0
    assert spark.read.json(paths.report("rejects")).filter("reject_reason = 'unreadable'").count() == 1
    counts = {r.table_name: (r.row_count, r.column_count) for r in spark.read.json(paths.report("table_counts")).collect()}
    assert counts["dim_game"] == (6, 22) and counts["fact_pricing"] == (51, 19)
    assert spark.read.json(paths.report("integrity")).agg(F.sum("affected")).first()[0] == 0


def test_checkpoint_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = ensure_checkpoint_dir(spark)
    assert folder and (configured is None or folder == configured)

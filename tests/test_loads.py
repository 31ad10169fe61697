"""Loads that fail, sources that cannot be read, tables that are stale, and loads one after the other."""

from __future__ import annotations

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from pricewright import fixed_values as fv
from pricewright.operators.encode import append_codes, extended_codes
from pricewright.operators.merge import merge_first, merged_table
from pricewright.operators.quality import readable_counts
from pricewright.plans import load, run
from pricewright.sources import tables as sources
from pricewright.sources.raw import embedded_document


def audit(spark, paths):
    return rows(spark.read.parquet(paths.audit_log), "table_name", "rows_loaded", "status", "run")


def current(spark, paths, table="dim_age"):
    return spark.read.parquet(paths.warehouse(table)).count()


def test_each_load_is_a_version(spark, tmp_path, tables):
    paths = sources.Paths(str(tmp_path))
    seen = []
    for n, run_name in ((24, "a"), (5, "b"), (7, "c"), (9, "d")):
        result = load.load_table(tables["dim_age"].limit(n), "dim_age", paths, lambda df, name: seen.append(df.count()), run_name)
        assert (result.rows, result.status, result.run) == (n, "SUCCESS", run_name) and current(spark, paths) == n
    assert seen == [24, 5, 7, 9]
    assert spark.read.parquet(f"{paths.versions('dim_age')}/a").count() == 24  # an old reader goes on
    sources.drop_old_versions(spark, paths, "dim_age", 2)
    assert sorted(os.listdir(paths.versions("dim_age"))) == ["c", "d"] and current(spark, paths) == 9
    sources.switch_pointer(spark, paths.pointer("dim_age"), f"{paths.versions('dim_age')}/c")
    sources.drop_old_versions(spark, paths, "dim_age", 1)
    assert sorted(os.listdir(paths.versions("dim_age"))) == ["c", "d"]  # the current one stays


def test_a_failing_copy_leaves_the_old_table_and_one_line(spark, tmp_path, tables):
    paths = sources.Paths(str(tmp_path))
    called = []
    load.append_audit(spark, [load.load_table(tables["dim_age"], "dim_age", paths, lambda *a: called.append(a), "one")], paths.audit_log)
    broken = tables["dim_age"].withColumn("pct", F.when(F.col("pct") > 0, F.raise_error(F.lit("torn"))).cast("int"))
    result = load.load_table(broken, "dim_age", paths, lambda *a: called.append(a), "two")
    assert result.status == "FAILED" and "torn" in result.note and len(called) == 1
    load.append_audit(spark, [result], paths.audit_log)
    assert current(spark, paths) == 24 and sources.read_pointer(spark, paths.pointer("dim_age")).endswith("/one")
    assert audit(spark, paths) == [("dim_age", 0, "FAILED", "two"), ("dim_age", 24, "SUCCESS", "one")]
    misshapen = load.load_table(tables["dim_age"].drop("pct"), "dim_age", paths, lambda *a: None, "three")
    assert misshapen.status == "FAILED" and current(spark, paths) == 24


def test_a_failing_switch_leaves_the_old_table(spark, tmp_path, tables, monkeypatch):
    paths = sources.Paths(str(tmp_path))
    load.load_table(tables["dim_age"], "dim_age", paths, lambda *a: None, "one")
    monkeypatch.setattr(load, "switch_pointer", lambda *a: (_ for _ in ()).throw(OSError("no space")))
    result = load.load_table(tables["dim_age"].limit(3), "dim_age", paths, lambda *a: None, "two")
    assert (result.status, result.note) == ("FAILED", "no space") and current(spark, paths) == 24


def test_a_failing_target_leaves_the_new_copy_and_one_line(spark, tmp_path, tables):
    paths = sources.Paths(str(tmp_path))
    load.load_table(tables["dim_age"], "dim_age", paths, lambda *a: None, "one")

    def broken(df, name):
        raise RuntimeError("no connection")

    results, counts, _ = load.load_all({"dim_age": tables["dim_age"].limit(3), "dim_game": tables["dim_game"]}, paths, broken)
    assert {(r.table, r.status) for r in results} == {("dim_age", "FAILED"), ("dim_game", "FAILED")}
    assert len({r.run for r in results}) == 1 and current(spark, paths) == 3
    assert [(t, n, s) for t, n, s, _ in audit(spark, paths)] == [("dim_age", 0, "FAILED"), ("dim_game", 0, "FAILED")]
    assert {r.table_name: r.row_count for r in counts.collect()}["fact_pricing"] == -1


def test_catalog_tables_change_their_place_in_one_step(spark, tmp_path, tables):
    spark.sql("CREATE DATABASE IF NOT EXISTS placed")
    root = str(tmp_path)
    for n in (10, 4):
        sources.write_catalog(tables["dim_age"].limit(n), "dim_age", "placed", root)
        assert spark.table("placed.dim_age").count() == n
    assert len(os.listdir(f"{root}/catalog/dim_age")) == 2
    sources.write_catalog(tables["dim_age"].limit(2).withColumn("more", F.lit(1)), "dim_age", "placed", root)
    assert spark.table("placed.dim_age").columns[-1] == "more" and spark.table("placed.dim_age").count() == 2


def spoil(folder, pattern):
    for path in glob.glob(f"{folder}/{pattern}"):
        os.chmod(path, 0o644)
        with open(path, "wb") as f:
            f.write(b"not what it says it is")
        crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
        if os.path.exists(crc):
            os.remove(crc)


def test_broken_sources_fall_to_the_next(spark, tmp_path, tables):
    paths, data = sources.Paths(str(tmp_path)), tables["dim_age"]
    spark.sql("CREATE DATABASE IF NOT EXISTS fallen")
    sources.write_csv(data.limit(3).coalesce(1), paths.processed("dim_age"))
    sources.write_parquet(data.limit(4).repartition(2), paths.warehouse("dim_age"))
    sources.write_catalog(data.coalesce(1), "dim_age", "fallen", str(tmp_path))

    def read():
        report = []
        return sources.read_table(spark, "dim_age", paths, "fallen", report).count(), [(s, status) for _, s, status, _ in report]

    assert read() == (24, [("catalog", "READ")])
    spoil(tmp_path / "catalog" / "dim_age", "*/part-*.parquet")
    spark.catalog.refreshTable("fallen.dim_age")
    assert read() == (4, [("catalog", "UNREADABLE"), ("warehouse", "READ")])
    spoil(tmp_path / "warehouse" / "dim_age.parquet", "part-00001*.parquet")  # one file of several
    assert read() == (3, [("catalog", "UNREADABLE"), ("warehouse", "UNREADABLE"), ("processed", "READ")])
    spoil(tmp_path / "processed" / "dim_age", "part-*.csv")
    with pytest.raises(OSError, match="no source can be read"):
        read()
    found = sources.read_tables(spark, paths, "fallen")
    assert found == {}
    lines = {(r.table_name, r.source): (r.status, r.reason) for r in spark.read.json(paths.report("sources")).collect()}
    assert lines["dim_age", "processed"][0] == "UNREADABLE" and "columns" in lines["dim_age", "processed"][1]
    assert lines["dim_game", "catalog"][0] == "ABSENT"


def test_a_table_that_fails_while_it_is_counted(spark, tmp_path, tables):
    path = str(tmp_path / "t")
    tables["dim_age"].repartition(2).write.parquet(path)
    df = spark.read.parquet(path)
    spoil(path, "part-00001*.parquet")
    counts = {r.table_name: tuple(r)[1:] for r in readable_counts(spark, {"torn": df, "none": None, "ages": tables["dim_age"], "no rows": tables["dim_age"].limit(0)}).collect()}
    assert counts == {"torn": (-1, -1, "UNREADABLE"), "none": (-1, -1, "UNREADABLE"), "ages": (24, 7, "OK"), "no rows": (0, 7, "EMPTY")}


def test_seconds_of_a_failing_phase_are_kept(spark, tmp_path, monkeypatch):
    paths = sources.Paths(str(tmp_path))
    monkeypatch.setattr(run, "transform", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run.run(spark, paths, "all")
    lines = spark.read.json(paths.report("run_times"))
    assert rows(lines, "phase", "status") == [("extract", "SUCCESS"), ("transform", "FAILED")]


def write_document(folder, document):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/part-0.json", "w", encoding="utf-8") as f:
        f.write(json.dumps(document) + "\n")


def test_only_what_is_stale_is_built(spark, tmp_path, tables):
    paths = sources.Paths(str(tmp_path))
    document = embedded_document()
    write_document(paths.raw, document)
    assert run.build_stale(spark, paths) == list(run.INPUTS)
    assert run.build_stale(spark, paths) == []
    for name, df in sources.read_csv_tables(spark, paths).items():
        assert rows(df) == rows(tables[name])
    key = fv.GAME_KEYS[0]
    document["esports"][key] = {**document["esports"][key], "competition_score": 1}
    write_document(paths.raw, document)
    assert run.build_stale(spark, paths) == ["fact_competition", "ml_features"]
    document["topup"][key]["tiers"] = document["topup"][key]["tiers"][:2]
    write_document(paths.raw, document)
    assert run.build_stale(spark, paths) == ["fact_pricing"]
    assert run.build_stale(spark, paths, rate=17_000.0) == list(run.INPUTS)
    assert run.build_stale(spark, paths, rate=17_000.0) == []
    os.rename(f"{paths.processed('dim_age')}/_SUCCESS", f"{paths.processed('dim_age')}/_GONE")
    assert run.build_stale(spark, paths, rate=17_000.0) == ["dim_age"]


def test_a_build_that_fails_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    paths = sources.Paths(str(tmp_path))
    write = run.write_csv
    monkeypatch.setattr(run, "write_csv", lambda df, path: 1 / 0 if "dim_age" in path else write(df, path))
    with pytest.raises(ZeroDivisionError):
        run.build_stale(spark, paths)
    monkeypatch.setattr(run, "write_csv", write)
    assert run.build_stale(spark, paths) == ["dim_age", "fact_competition", "fact_revenue_monthly", "ml_features"]


def test_build_from_the_command_line(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(run, "build_session", lambda app: spark)
    run.main(["--root", str(tmp_path), "--phase", "build"])
    assert capsys.readouterr().out.startswith("build: ") and sources.all_built(spark, sources.Paths(str(tmp_path)))


def test_loads_one_after_the_other_equal_one_load(spark, tmp_path):
    given = [(i % 40 if i % 9 else None, i // 3, f"v{i}", i) for i in range(300)]
    df = spark.createDataFrame(given, "k long, at long, v string, no long")
    one = str(tmp_path / "one")
    merge_first(one, df, ["k"], ["at", "no"], 8)
    expected = rows(merged_table(spark, one))
    assert len(expected) == 41
    for name, order in (("forth", [0, 1, 2, 3]), ("back", [3, 2, 1, 0])):
        path = str(tmp_path / name)
        for turn in order:
            merge_first(path, df.filter(F.pmod("no", F.lit(4)) == turn), ["k"], ["at", "no"], 8)
        assert rows(merged_table(spark, path)) == expected
        files = sorted(glob.glob(f"{path}/*/*.parquet"))
        assert merge_first(path, df.filter("no % 4 = 1"), ["k"], ["at", "no"], 8) == []
        fresh = spark.createDataFrame([(1000, 0, "new", 1000)], df.schema)
        touched = merge_first(path, fresh, ["k"], ["at", "no"], 8)
        assert len(touched) == 1
        kept = [f for f in files if f"_bucket={touched[0]}/" not in f]
        assert set(kept) <= set(glob.glob(f"{path}/*/*.parquet")) and len(kept) < len(files)
        assert merged_table(spark, path).count() == 42
    assert merge_first(one, df.limit(0), ["k"], ["at", "no"], 8) == []


def test_codes_stay_when_batches_come(spark, tmp_path):
    path = str(tmp_path / "codes")
    def batch(*pairs):
        return spark.createDataFrame(list(pairs), "category string, no long")
    assert rows(append_codes(path, batch(("b", 1), ("a", 2), ("b", 3), (None, 0)), "category", "no")) == [("a", 1), ("b", 0)]
    for _ in range(2):  # the same batch again changes nothing
        assert rows(append_codes(path, batch(("d", 1), ("a", 2), ("c", 0)), "category", "no")) == [("a", 1), ("b", 0), ("c", 2), ("d", 3)]
    assert rows(append_codes(path, batch(), "category", "no")) == [("a", 1), ("b", 0), ("c", 2), ("d", 3)]
    empty = spark.createDataFrame([], "category string, code int")
    assert rows(extended_codes(empty, batch(("x", 5), ("y", 4)), "category", "no")) == [("x", 1), ("y", 0)]

"""The phases of a run: extract, transform, load, ml.  Each rereads what the one before stored."""

from __future__ import annotations

import argparse
import hashlib
import time
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import fixed_values as fv
from ..ml import models
from ..ml.scoring import demo_scenarios, score
from ..operators.cleaning import duplicate_report, fill_report
from ..operators.quality import rule_report
from ..operators.statistics import share_totals
from ..schemas import STATS_RECORD, TABLE_KEYS, TOPUP_RECORD
from ..session import build_session
from ..sources.pages import extract_product_items
from ..sources.raw import DOCUMENT_ORDER, branch_records, document_frame, embedded_document, key_list, read_raw, write_raw
from ..sources.tables import Paths, all_built, csv_rejects, path_exists, read_csv, read_csv_tables, write_csv, write_catalog
from . import views
from .load import Target, load_all
from .star import FILLED, build_tables, known_games, ml_features, priced_tiers, raw_tiers

PHASES = ["extract", "transform", "load", "ml"]
BUILD = "build"  # by itself only: what is stale of the tables


def extract(spark: SparkSession, paths: Paths, documents: DataFrame | None = None, pages: DataFrame | None = None) -> None:
    """Store raw documents (the embedded snapshot by default) and the items of stored pages, if any."""
    write_raw(documents if documents is not None else document_frame(spark, embedded_document()), paths.raw)
    if pages is not None:
        extract_product_items(pages, "html").write.mode("overwrite").parquet(f"{paths.root}/raw/page_items")


def transform(spark: SparkSession, paths: Paths, game_keys: list[str] | None = None, rate: float = fv.IDR_PER_USD) -> dict[str, DataFrame]:
    """Build and store the six tables, the rejects and the two heatmap frames."""
    keys = game_keys or fv.GAME_KEYS
    documents = read_raw(spark, paths.raw)
    tables, rejects = build_tables(documents, keys, rate)
    for name, df in tables.items():
        if name != "ml_features":
            write_csv(df, paths.processed(name))
    stored = read_csv_tables(spark, paths, [n for n in tables if n != "ml_features"])
    # from the stored tables, so that the raw documents are not worked through again
    features = ml_features(
        stored["dim_game"], stored["fact_competition"], stored["dim_age"], key_list(spark, keys), rate
    )
    write_csv(features, paths.processed("ml_features"))
    misfits = reduce(DataFrame.unionByName, [csv_rejects(spark, paths.processed(n), n) for n in stored])
    rejects.unionByName(misfits, allowMissingColumns=True).write.mode("overwrite").json(paths.report("rejects"))
    stored["ml_features"] = read_csv(spark, paths.processed("ml_features"), "ml_features")
    quality_report(documents, stored, keys).coalesce(1).write.mode("overwrite").json(paths.report("quality"))
    star = views.Star.of(stored)
    write_csv(views.correlation(star), paths.report("feature_correlation"))
    write_csv(views.price_by_region(star), paths.report("price_by_region"))
    return stored


def quality_report(documents: DataFrame, tables: dict[str, DataFrame], game_keys: list[str]) -> DataFrame:
    """(rule, table_name, affected, total): what was dropped, filled, repeated or adds up wrongly, one pass per table.

    Duplicates and invalid rows are counted on the raw tiers, before they are dropped; gaps and keys on the tables.
    """
    keys = key_list(documents.sparkSession, game_keys)
    topup, _ = branch_records(documents, "topup", TOPUP_RECORD)
    stats, bad_stats = branch_records(documents, "stats", STATS_RECORD)
    raw = raw_tiers(topup, keys)
    repeated = duplicate_report(raw, ["game_key", "tier_label"]).select(
        F.lit("duplicate key").alias("rule"), F.lit("raw tiers").alias("table_name"), F.col("rows_dropped").alias("affected"), F.col("rows_in").alias("total")
    )
    invalid = {n: ~F.coalesce((F.col(n) > 0) & ~F.isnan(n), F.lit(False)) for n in ("price", "total_currency")}
    parts = [repeated, rule_report("raw tiers", raw, {f"{n} not positive": rule for n, rule in invalid.items()})]
    unfilled = {"fact_pricing": priced_tiers(topup, keys), "dim_game": known_games(stats, bad_stats, keys)}
    for name, df in unfilled.items():
        filled = fill_report(df, FILLED[name], "game_key")
        parts.append(filled.select(F.concat("column_name", F.lit(" filled")).alias("rule"), F.lit(name).alias("table_name"), (F.col("gaps") - F.col("left_open")).alias("affected"), F.col("total_rows").alias("total")))
    for name, df in tables.items():
        missing = {f"{c} missing": F.col(c).isNull() for c in df.columns}
        parts.append(rule_report(name, df, missing).filter("affected > 0"))
        doubled = duplicate_report(df, TABLE_KEYS[name])
        parts.append(doubled.select(F.lit("duplicate key").alias("rule"), F.lit(name).alias("table_name"), F.col("rows_dropped").alias("affected"), F.col("rows_in").alias("total")))
    if "dim_age" in tables:
        parts.append(rule_report("dim_age", share_totals(tables["dim_age"], "game_key", "pct"), {"age shares off 95 to 105": ~F.col("ok")}))
    return reduce(DataFrame.unionByName, parts)


def load(spark: SparkSession, paths: Paths, target: Target = write_catalog):
    return load_all(read_csv_tables(spark, paths), paths, target)


def train(
    spark: SparkSession, paths: Paths, learners: list[models.Learner] | None = None,
    features: list[str] | None = None, folds: int = 5, test_pct: int = 20, parallelism: int = 4,
) -> models.Comparison:
    """Compare the learners, save the best one with its genre codes, score the demo scenarios, report."""
    names = features or fv.FEATURES
    data = read_csv(spark, paths.processed("ml_features"), "ml_features")
    result = models.compare(
        data, TABLE_KEYS["ml_features"], learners, names, fv.TARGET, folds, test_pct, parallelism=parallelism
    )
    best = result.best()
    pipeline = models.as_pipeline(result.models[best], names)
    models.save_model(pipeline, paths.model, spark)
    codes = data.select("genre", "genre_encoded").distinct()
    codes.write.mode("overwrite").parquet(f"{paths.model}_genre_codes")
    weights = models.importance(data, pipeline, names)
    write_csv(weights.coalesce(1), paths.report("importance"))
    score(demo_scenarios(spark), pipeline, codes).coalesce(1).write.mode("overwrite").json(paths.report("demo_scores"))
    top = [r["feature"] for r in weights.limit(5).collect()]
    verdict = views.model_verdict(result.scores).withColumns(
        {
            "is_best": F.col("model") == best, "trained_at": F.current_timestamp(),
            "top_features": F.when(F.col("model") == best, F.array(*[F.lit(f) for f in top])),
        }
    )
    verdict.coalesce(1).write.mode("overwrite").json(paths.report("model_scores"))
    return result


def ensure_built(spark: SparkSession, paths: Paths) -> bool:
    """Build the tables from the embedded snapshot unless all six are there; True when it had to."""
    if all_built(spark, paths):
        return False
    if not path_exists(spark, paths.raw):
        extract(spark, paths)
    transform(spark, paths)
    return True


# Which raw branches and tables each table is made of, in the order of building.
INPUTS = {
    "dim_game": ["stats"], "fact_pricing": ["topup"], "dim_age": ["stats"], "fact_competition": ["esports"], "fact_revenue_monthly": [],
    "ml_features": ["dim_game", "fact_competition", "dim_age"],
}
BUILD_RULES = 1  # raised when the way a table is made changes


def input_fingerprints(documents: DataFrame, game_keys: list[str], rate: float) -> dict[str, str]:
    """For each table a digest of all it is made of: its branches and their order, its tables, and the parameters."""
    def branch(name: str) -> Column:
        content = F.xxhash64(F.to_json(F.col(name)), F.to_json(F.struct(F.col(DOCUMENT_ORDER))))
        return F.concat_ws(":", F.count(name), F.sum(F.shiftright(content, 32)), F.sum(content.bitwiseAND(F.lit((1 << 32) - 1))))

    branches = documents.agg(*[branch(b).alias(b) for b in sorted({i for own in INPUTS.values() for i in own} - set(INPUTS))]).first().asDict()
    found: dict[str, str] = {}
    for table, inputs in INPUTS.items():
        parts = [table, str(BUILD_RULES), ",".join(game_keys), repr(rate), *[found.get(i) or branches[i] for i in inputs]]
        found[table] = hashlib.sha256("|".join(parts).encode()).hexdigest()
    return found


def build_stale(spark: SparkSession, paths: Paths, game_keys: list[str] | None = None, rate: float = fv.IDR_PER_USD) -> list[str]:
    """Build the tables whose inputs have changed since they were built, and those made of them; returns their names.

    The manifest is written behind each table, so a build that fails goes on where it stopped.
    """
    keys = game_keys or fv.GAME_KEYS
    if not path_exists(spark, paths.raw):
        extract(spark, paths)
    documents = read_raw(spark, paths.raw)
    wanted = input_fingerprints(documents, keys, rate)
    stored: dict[str, str] = {}
    if path_exists(spark, paths.manifest):
        stored = {r["table_name"]: r["fingerprint"] for r in spark.read.schema("table_name string, fingerprint string").json(paths.manifest).collect()}
    stale = [t for t in INPUTS if stored.get(t) != wanted[t] or not path_exists(spark, f"{paths.processed(t)}/_SUCCESS")]
    tables, _ = build_tables(documents, keys, rate)
    for name in stale:
        if name == "ml_features":  # from the stored tables, as in `transform`
            made = read_csv_tables(spark, paths, INPUTS[name])
            tables[name] = ml_features(made["dim_game"], made["fact_competition"], made["dim_age"], key_list(spark, keys), rate)
        write_csv(tables[name], paths.processed(name))
        stored[name] = wanted[name]
        lines = spark.createDataFrame(list(stored.items()), "table_name string, fingerprint string")
        lines.coalesce(1).write.mode("overwrite").json(paths.manifest)
    return stale


def run(
    spark: SparkSession, paths: Paths, phase: str = "all", target: Target | None = None,
    learners: list[models.Learner] | None = None, pages: DataFrame | None = None, game_keys: list[str] | None = None,
    rate: float = fv.IDR_PER_USD, folds: int = 5, test_pct: int = 20, documents: DataFrame | None = None,
) -> dict[str, float]:
    """Run one phase, or all in order; returns the seconds of each.

    Target tables are catalog tables below the root, unless another target is given.
    """
    into = target or partial(write_catalog, root=paths.root)
    steps: dict[str, Callable[[], object]] = {
        "extract": lambda: extract(spark, paths, documents, pages),
        "transform": lambda: transform(spark, paths, game_keys, rate),
        "load": lambda: load(spark, paths, into),
        "ml": lambda: train(spark, paths, learners, folds=folds, test_pct=test_pct),
        BUILD: lambda: build_stale(spark, paths, game_keys, rate),
    }
    if phase != "all" and phase not in steps:
        raise ValueError(f"unknown phase {phase}")
    seconds = {}
    for name in PHASES if phase == "all" else [phase]:
        started, status = time.perf_counter(), "FAILED"
        try:
            steps[name]()
            status = "SUCCESS"
        finally:  # a phase that fails leaves its time too
            seconds[name] = round(time.perf_counter() - started, 2)
            line = spark.createDataFrame([(name, seconds[name], status)], "phase string, seconds double, status string")
            line.coalesce(1).withColumn("ended_at", F.current_timestamp()).write.mode("append").json(paths.report("run_times"))
    return seconds


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Price analytics run")
    parser.add_argument("--root", required=True, help="folder for all inputs and outputs, reachable by every executor")
    parser.add_argument("--phase", choices=[*PHASES, BUILD, "all"], default="all")
    parser.add_argument("--pages", help="Parquet folder of stored pages (column html) to take items from")
    parser.add_argument("--keys", help="comma-separated game keys, in order; the built-in list by default")
    parser.add_argument("--rate", type=float, default=fv.IDR_PER_USD, help="rupiah per dollar")
    parser.add_argument("--database", help="database of the target tables")
    parser.add_argument("--folds", type=int, default=5)
    parser.add_argument("--test-pct", type=int, default=20, help="share of rows held out for testing")
    parser.add_argument("--trees", type=int, default=300, help="trees of the boosted models; forests have two thirds")
    parsed = parser.parse_args(arguments)
    spark = build_session("pricewright")
    paths = Paths(parsed.root)
    taken = run(
        spark, paths, parsed.phase,
        target=partial(write_catalog, database=parsed.database, root=paths.root),
        learners=models.default_learners(parsed.trees, max(1, parsed.trees * 2 // 3)),
        pages=spark.read.parquet(parsed.pages) if parsed.pages else None,
        game_keys=parsed.keys.split(",") if parsed.keys else None,
        rate=parsed.rate, folds=parsed.folds, test_pct=parsed.test_pct,
    )
    for name, seconds in taken.items():
        print(f"{name}: {seconds:.2f} s")

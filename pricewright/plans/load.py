"""Loading finished tables: Parquet copy, target table, audit log, integrity checks, summary."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import suppress
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..operators.joins import orphans
from ..operators.quality import checksum, readable_counts
from ..schemas import AUDIT_LOG, PARTITIONED_BY, TABLES, conform
from ..sources.tables import Paths, drop_old_versions, path_exists, read_parquet, switch_pointer, write_catalog, write_parquet

KEPT_VERSIONS = 3  # of a table, the current one included

# Replaces a table: (rows, table name).  `write_catalog`, or `write_jdbc` with its url bound.
Target = Callable[[DataFrame, str], None]

# (fact table, key, dimension table)
INTEGRITY_RULES = [
    ("fact_pricing", "game_key", "dim_game"),
    ("dim_age", "game_key", "dim_game"),
    ("fact_competition", "game_key", "dim_game"),
    ("fact_revenue_monthly", "game_key", "dim_game"),
    ("ml_features", "game_key", "dim_game"),
]


@dataclass(frozen=True)
class Loaded:
    table: str
    rows: int
    checksum: str
    status: str
    note: str = ""
    run: str = ""


def new_run() -> str:
    """The name of a load; names of later loads come later in order."""
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def load_table(df: DataFrame | None, table: str, paths: Paths, target: Target = write_catalog, run: str | None = None) -> Loaded:
    """Write the Parquet copy as a new version, switch the table's pointer to it, then replace the target from it.

    All or nothing: the pointer is switched after the version is complete and its rows are counted, so a reader
    finds the old table or the new one, never a part of either.  Rows and checksum are observed while the version is
    written, so the input is computed once.  A failure is reported, not raised: before the switch the old copy stays
    current, and a failing target leaves the new one in place.
    """
    run = run or new_run()
    spark = SparkSession.active()
    try:
        if df is None or df.isEmpty():
            return Loaded(table, 0, "", "SKIPPED", "no rows", run)
        rows = conform(df, table)
        seen = Observation(f"load {table}")
        observed = rows.observe(seen, F.count(F.lit(1)).alias("rows"), checksum(rows.columns).alias("checksum"))
        version = f"{paths.versions(table)}/{run}"
        write_parquet(observed, version, PARTITIONED_BY.get(table))
        stored = read_parquet(spark, version, table)
        if stored.count() != seen.get["rows"]:
            raise OSError(f"{version}: not all rows were written")
        switch_pointer(spark, paths.pointer(table), version)
        target(stored.withColumn("loaded_at", F.current_timestamp()), table)
    except Exception as error:
        return Loaded(table, 0, "", "FAILED", str(error), run)
    return Loaded(table, seen.get["rows"], seen.get["checksum"], "SUCCESS", "", run)


def append_audit(spark: SparkSession, results: list[Loaded], path: str) -> None:
    """Add one line per load attempt, with the name of its run; skipped tables leave none."""
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    lines = [(r.table, r.rows, r.checksum, r.status, now, r.note, r.run) for r in results if r.status != "SKIPPED"]
    if lines:
        spark.createDataFrame(lines, AUDIT_LOG).coalesce(1).write.mode("append").parquet(path)


def integrity(tables: dict[str, DataFrame]) -> DataFrame:
    """(rule, affected, total): orphans and missing keys of every fact against its dimension."""
    out = None
    for fact, key, dim in INTEGRITY_RULES:
        if fact in tables and dim in tables:
            found = orphans(tables[fact], key, tables[dim], key).select(
                F.lit(f"{fact}.{key} in {dim}").alias("rule"),
                (F.col("orphan_rows") + F.col("null_key_rows")).alias("affected"),
                F.col("total_rows").alias("total"),
            )
            out = found if out is None else out.unionByName(found)
    return out


def load_all(
    tables: dict[str, DataFrame], paths: Paths, target: Target = write_catalog
) -> tuple[list[Loaded], DataFrame, DataFrame]:
    """Load every table; stores and returns the results, the row and column counts and the integrity report."""
    spark, run = next(iter(tables.values())).sparkSession, new_run()
    results = [load_table(tables[name], name, paths, target, run) for name in TABLES if name in tables]
    append_audit(spark, results, paths.audit_log)
    stored = {}
    for name in TABLES:
        if name in tables and path_exists(spark, paths.warehouse(name)):
            with suppress(Exception):  # what cannot be opened counts as unreadable below
                stored[name] = read_parquet(spark, paths.warehouse(name), name)
    counts = readable_counts(spark, {name: stored.get(name) for name in TABLES})
    sound = {r["table_name"] for r in counts.collect() if r["row_count"] >= 0}  # a row for each table
    checks = integrity({name: df for name, df in stored.items() if name in sound})
    for name in tables:
        drop_old_versions(spark, paths, name, KEPT_VERSIONS)
    counts.coalesce(1).write.mode("overwrite").json(paths.report("table_counts"))  # a row per table
    if checks is not None:
        checks.coalesce(1).write.mode("overwrite").json(paths.report("integrity"))  # a row per rule
    summary = spark.createDataFrame(
        [(r.table, r.rows, r.status, sum(x.rows for x in results), paths.root) for r in results],
        "table_name string, rows_loaded bigint, status string, total_rows bigint, root string",
    ).withColumn("loaded_at", F.current_timestamp())
    summary.coalesce(1).write.mode("overwrite").json(paths.report("load_summary"))
    return results, counts, checks

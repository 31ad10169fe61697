"""Reading and writing the tables: CSV, Parquet, catalog and JDBC."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import TABLES, conform, fields


@dataclass(frozen=True)
class Paths:
    """Folders of one run, all under one root that every executor can reach."""

    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw/master_raw"

    def processed(self, table: str) -> str:
        return f"{self.root}/processed/{table}"

    def warehouse(self, table: str) -> str:
        """The Parquet folder of the table: the version that its pointer names, if it has one."""
        spark = SparkSession.getActiveSession()
        current = read_pointer(spark, self.pointer(table)) if spark else None
        return current or f"{self.root}/warehouse/{table}.parquet"

    @property
    def manifest(self) -> str:
        return f"{self.root}/processed/_manifest"

    def versions(self, table: str) -> str:
        return f"{self.root}/warehouse/versions/{table}"

    def pointer(self, table: str) -> str:
        return f"{self.root}/warehouse/current/{table}"

    @property
    def audit_log(self) -> str:
        return f"{self.root}/warehouse/etl_audit_log"

    @property
    def model(self) -> str:
        return f"{self.root}/outputs/model"

    def report(self, name: str) -> str:
        return f"{self.root}/outputs/reports/{name}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asks the file system the path belongs to, local or remote."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def read_pointer(spark: SparkSession, path: str) -> str | None:
    """The one line of a pointer file; None where there is none."""
    files, target = _file_system(spark, path)
    if not files.exists(target):
        return None
    stream = files.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def switch_pointer(spark: SparkSession, path: str, value: str) -> None:
    """Replace a pointer in one step: a new file is written beside it and renamed over it."""
    files, target = _file_system(spark, path)
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    fresh = fs.Path(f"{path}.{uuid.uuid4().hex}")
    stream = files.create(fresh, True)
    stream.write(bytearray(value.encode()))
    stream.close()
    overwrite = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    overwrite[0] = fs.Options.Rename.OVERWRITE
    context = fs.FileContext.getFileContext(files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(fresh), files.makeQualified(target), overwrite)


def drop_old_versions(spark: SparkSession, paths: Paths, table: str, keep: int) -> None:
    """Delete all but the latest `keep` versions of a table; names of versions ascend, and the current one stays."""
    files, folder = _file_system(spark, paths.versions(table))
    if not files.exists(folder):
        return
    current = read_pointer(spark, paths.pointer(table)) or ""
    names = sorted(status.getPath().getName() for status in files.listStatus(folder))
    for name in names[:-keep]:
        if not current.endswith(f"/{name}"):
            files.delete(_file_system(spark, f"{paths.versions(table)}/{name}")[1], True)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, table: str, strict: bool = False) -> DataFrame:
    """A CSV table in its schema; `strict` fails on the first row that does not fit, else such rows are left out.

    `csv_rejects` has the rows that were left out.
    """
    if strict:
        return spark.read.schema(TABLES[table]).option("header", True).option("mode", "FAILFAST").csv(path)
    return _csv_with_misfits(spark, path, table).filter("_corrupt_record is null").drop("_corrupt_record")


def csv_rejects(spark: SparkSession, path: str, table: str) -> DataFrame:
    """(table_name, payload, reject_reason): the rows of a CSV table that do not fit its schema."""
    misfits = _csv_with_misfits(spark, path, table).filter("_corrupt_record is not null")
    return misfits.select(F.lit(table).alias("table_name"), F.col("_corrupt_record").alias("payload"), F.lit("unreadable").alias("reject_reason"))


def _csv_with_misfits(spark: SparkSession, path: str, table: str) -> DataFrame:
    schema = StructType([*fields(TABLES[table]).fields, StructField("_corrupt_record", StringType())])
    reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
    rows = reader.option("columnNameOfCorruptRecord", "_corrupt_record").csv(path)
    # always true; it names the other columns, because Spark does not read the unparsed text alone
    return rows.filter(F.pmod(F.xxhash64(*rows.columns[:-1]), F.lit(2)) >= 0)


def read_csv_tables(spark: SparkSession, paths: Paths, tables: list[str] | None = None) -> dict[str, DataFrame]:
    """The CSV tables that exist; missing ones are skipped."""
    names = tables or list(TABLES)
    return {t: read_csv(spark, paths.processed(t), t) for t in names if path_exists(spark, paths.processed(t))}


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace a Parquet folder; with partition columns, rows are rebalanced so that files keep a fair size."""
    if not partition_by:
        df.write.mode("overwrite").parquet(path)
    else:
        df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def read_parquet(spark: SparkSession, path: str, table: str) -> DataFrame:
    return conform(spark.read.parquet(path), table)


def write_catalog(df: DataFrame, table: str, database: str | None = None, root: str | None = None) -> None:
    """Replace a catalog table.

    With `root`, its files lie below that folder, each load in a folder of its own, and an existing table of the
    same columns changes its location in one step; without, Spark's own replacement is used.
    """
    name = f"{database}.{table}" if database else table
    if root is None:
        df.write.mode("overwrite").saveAsTable(name)
        return
    spark, path = df.sparkSession, f"{root}/catalog/{table}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    if spark.catalog.tableExists(name):
        if spark.table(name).dtypes == df.dtypes:
            quoted = path.replace("'", "\\'")
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{quoted}'")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(name, path, source="parquet")


def write_jdbc(df: DataFrame, table: str, url: str, properties: dict[str, str]) -> None:
    """Replace a database table; each partition is one connection, so cap them for the server's sake."""
    limit = int(properties.get("numPartitions", "16"))
    df.write.mode("overwrite").option("numPartitions", limit).jdbc(url, table, properties=properties)


def _checked_catalog(spark: SparkSession, name: str, table: str) -> DataFrame:
    found = spark.table(name)
    conform(found, table)
    files = found.inputFiles()
    if files and all(f.endswith(".parquet") for f in files):
        spark.read.option("mergeSchema", True).parquet(*files).schema  # reads every footer
    return found


def _checked_parquet(spark: SparkSession, path: str, table: str) -> DataFrame:
    conform(spark.read.option("mergeSchema", True).parquet(path), table)  # reads every footer, in a Spark job
    return read_parquet(spark, path, table)


def _checked_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    found, wanted = spark.read.option("header", True).csv(path).columns, fields(TABLES[table]).fieldNames()
    if found != wanted:
        raise ValueError(f"{table}: columns {found} in place of {wanted}")
    return read_csv(spark, path, table)


def read_table(
    spark: SparkSession, table: str, paths: Paths, database: str | None = None, report: list[tuple] | None = None
) -> DataFrame:
    """First source that has the table and can be read: catalog, Parquet warehouse, CSV.

    A source counts as readable after the footers of its Parquet files, or the header of its CSV, and its columns
    have been checked.  `report` receives (table, source, status, reason) for every source up to the one taken.
    """
    name = f"{database}.{table}" if database else table
    plain, processed, lines = paths.warehouse(table), paths.processed(table), [] if report is None else report
    sources: list[tuple[str, Callable[[], bool], Callable[[], DataFrame]]] = [
        ("catalog", lambda: spark.catalog.tableExists(name), lambda: _checked_catalog(spark, name, table)),
        ("warehouse", lambda: path_exists(spark, plain), lambda: _checked_parquet(spark, plain, table)),
        ("processed", lambda: path_exists(spark, processed), lambda: _checked_csv(spark, processed, table)),
    ]
    reasons = []
    for source, exists, read in sources:
        if not exists():
            lines.append((table, source, "ABSENT", ""))
            continue
        try:
            found = read()
        except Exception as error:  # the next source may do; the reason is reported
            reasons.append(f"{source}: {str(error).splitlines()[0]}")
            lines.append((table, source, "UNREADABLE", reasons[-1]))
            continue
        lines.append((table, source, "READ", ""))
        return found
    if reasons:
        raise OSError(f"{table}: no source can be read; {'; '.join(reasons)}")
    raise FileNotFoundError(f"{table}: not in the catalog, the warehouse or the processed folder")


def read_tables(spark: SparkSession, paths: Paths, database: str | None = None) -> dict[str, DataFrame]:
    """Every table from its first readable source; which ones were taken or passed over is stored with the reports."""
    report: list[tuple] = []
    found = {}
    for table in TABLES:
        try:
            found[table] = read_table(spark, table, paths, database, report)
        except OSError:  # not found or unreadable; the report says which
            continue
    lines = spark.createDataFrame(report, "table_name string, source string, status string, reason string")
    lines.coalesce(1).write.mode("overwrite").json(paths.report("sources"))
    return found


def all_built(spark: SparkSession, paths: Paths) -> bool:
    """Whether every table has been written completely."""
    return all(path_exists(spark, f"{paths.processed(t)}/_SUCCESS") for t in TABLES)

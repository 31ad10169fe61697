"""Deduplication, validity filters, null handling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numbers import finite_or_null, nan_to_null
from ..session import ensure_checkpoint_dir
from .joins import measured_side
from .ordering import exact_quantile, value_counts


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def keep_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """First row per key in `order`, which must rank every row of a key.

    The `== 1` filter lets Spark cut each key down to one row per input partition before the shuffle,
    so copies of one key, however many, do not meet in one task.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter(F.col("_rank") == 1).drop("_rank")


def duplicate_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows read, distinct keys, rows that `keep_first` drops."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_in"),
        F.count(F.lit(1)).alias("rows_kept"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("rows_dropped"),
    )


def keep_positive(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows where every listed column is above zero; NULL and NaN count as invalid."""
    return df.filter(reduce(lambda a, b: a & b, [(F.col(c) > 0) & ~F.isnan(c) for c in columns]))


def drop_unusable(df: DataFrame, columns: list[str]) -> DataFrame:
    """Infinities and NaN become NULL, then rows with a NULL in any listed column go."""
    cleaned = df.withColumns({c: finite_or_null(c) for c in columns if c in _floats(df)})
    return cleaned.dropna(subset=columns)


def _floats(df: DataFrame) -> set[str]:
    return {name for name, kind in df.dtypes if kind in ("double", "float")}


def _missing(column: str, floating: bool) -> Column:
    return F.col(column).isNull() | F.isnan(column) if floating else F.col(column).isNull()


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, null_rows, total_rows) for every listed column, in one pass; NaN counts as NULL."""
    names, floats = columns or df.columns, _floats(df)
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(_missing(c, c in floats)).alias(f"_n{i}") for i, c in enumerate(names)],
    )
    entries = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("null_rows")) for i, c in enumerate(names)]
    )
    return counts.select(F.inline(entries), "total_rows")


def fill_null_median(df: DataFrame, columns: list[str], key: str | None = None) -> DataFrame:
    """Fill NULLs and NaN with the median of the row's group, then with the overall median of the result.

    Listed columns the table lacks are skipped, and so is the group step when it lacks the key.  One
    counting pass decides which columns have gaps at all; the listed columns are doubles afterwards, with or
    without gaps.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    df = df.withColumns({c: nan_to_null(F.col(c).cast("double")) for c in present})
    gaps = df.agg(*[F.count_if(F.col(c).isNull()) for c in present]).first()
    out = df
    for column, nulls in zip(present, gaps):
        if nulls:
            out = _fill_one(df, out, column, key if key in df.columns else None)
    return out.select(*df.columns)


def fill_report(df: DataFrame, columns: list[str], key: str | None = None) -> DataFrame:
    """(column_name, gaps, from_group, from_all, left_open, total_rows): what `fill_null_median` does to each column.

    Gaps are counted per key before they are added up, so a hot key is one row by then.
    """
    present = [c for c in columns if c in df.columns]
    keys = [key] if key in df.columns else []
    values = df.select(*[F.col(k).alias("_key") for k in keys], *[nan_to_null(F.col(c).cast("double")).alias(f"_c{i}") for i, c in enumerate(present)])
    counts = [F.count(f"_c{i}").alias(f"_k{i}") for i in range(len(present))]
    per_key = values.groupBy(*(["_key"] if keys else [])).agg(F.count(F.lit(1)).alias("_n"), *counts)
    grouped = F.col("_key").isNotNull() if keys else F.lit(False)
    totals = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        *[F.coalesce(F.sum(F.col("_n") - F.col(f"_k{i}")), F.lit(0)).alias(f"_g{i}") for i in range(len(present))],
        *[F.coalesce(F.sum(F.when(grouped & (F.col(f"_k{i}") > 0), F.col("_n") - F.col(f"_k{i}"))), F.lit(0)).alias(f"_f{i}") for i in range(len(present))],
        *[F.coalesce(F.sum(f"_k{i}"), F.lit(0)).alias(f"_a{i}") for i in range(len(present))],
    )

    def entry(i: int, name: str) -> Column:
        rest = F.col(f"_g{i}") - F.col(f"_f{i}")
        known = F.col(f"_a{i}") > 0
        return F.struct(
            F.lit(name).alias("column_name"), F.col(f"_g{i}").alias("gaps"), F.col(f"_f{i}").alias("from_group"),
            F.when(known, rest).otherwise(F.lit(0)).alias("from_all"), F.when(known, F.lit(0)).otherwise(rest).alias("left_open"),
        )

    return totals.select(F.inline(F.array(*[entry(i, c) for i, c in enumerate(present)])), "total_rows")


def _fill_one(source: DataFrame, out: DataFrame, column: str, key: str | None) -> DataFrame:
    value = F.col(column)
    if key is None:
        overall = exact_quantile(value_counts(source, [], column), [], name="_overall")
        return out.withColumn(column, F.coalesce(value, overall.scalar()))

    # Everything that is needed comes from this one table, written once: how often each value occurs with each
    # key, NULL being a value and a key here too.
    ensure_checkpoint_dir(source.sparkSession)
    every = source.groupBy(F.col(key).alias("_key"), value.alias("_v")).agg(F.count(F.lit(1)).alias("_n")).checkpoint()
    known = every.filter("_key is not null and _v is not null")
    medians = measured_side(exact_quantile(known, ["_key"], name="_median"))
    gaps = every.filter("_v is null").select("_key", "_n")  # one row per key
    candidates = [value, F.col("_median")]
    if not gaps.join(medians.frame, "_key", "left_anti").isEmpty():
        candidates.append(_overall_after(every, gaps, medians.frame).scalar())

    def fill(rows: DataFrame) -> DataFrame:
        joined = rows.join(medians.frame, rows[key] == F.col("_key"), "left").drop("_key")
        return joined.withColumn(column, F.coalesce(*candidates)).drop("_median")

    if medians.small:
        return fill(out)
    # too many groups to broadcast: shuffle only the rows that have a gap
    whole = out.filter(F.col(column).isNotNull())
    return whole.unionByName(fill(out.filter(F.col(column).isNull())))


def _overall_after(every: DataFrame, gaps: DataFrame, medians: DataFrame) -> DataFrame:
    """Median of the group-filled column: the known values, and each group's median once per gap."""
    filled = gaps.join(medians, "_key").select(F.col("_median").alias("_v"), "_n")
    after = every.filter("_v is not null").select("_v", "_n").unionByName(filled)
    return exact_quantile(after.groupBy("_v").agg(F.sum("_n").alias("_n")).checkpoint(), [], name="_overall")

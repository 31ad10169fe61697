"""Nested columns to rows, and lists to text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import as_col


def explode_list(df: DataFrame, column: str, item: str = "item", position: str | None = None) -> DataFrame:
    """One row per list element, optionally with its 1-based position."""
    rest = [c for c in df.columns if c != column]
    if position is None:
        return df.select(*rest, F.explode(column).alias(item))
    out = df.select(*rest, F.posexplode(column).alias(position, item))
    return out.withColumn(position, F.col(position) + 1)


def explode_map(df: DataFrame, column: str, key: str, value: str) -> DataFrame:
    """One row per map entry."""
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.explode(column).alias(key, value))


def field_by_key(entries: Column | str, key: Column | str, fallback_key: str, default: object = 0) -> Column:
    """Map entry under a per-row key, else under the fallback key, else the default."""
    found = F.coalesce(F.element_at(as_col(entries), as_col(key)), F.element_at(as_col(entries), F.lit(fallback_key)))
    return F.coalesce(found, F.lit(default))


def unnest_series(
    df: DataFrame, series: str, outer: str = "year", position: str = "month_num", value: str = "value"
) -> DataFrame:
    """A map of lists (outer key -> values) as (outer, 1-based position, value) rows."""
    return explode_list(explode_map(df, series, outer, "_list"), "_list", value, position)


def join_text(items: Column | str, separator: str = ", ") -> Column:
    """List as text; a missing list is empty text."""
    return F.array_join(F.coalesce(as_col(items), F.array().cast("array<string>")), separator)


def _sql_text(value: str | int | float) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else str(value)


def with_grid(df: DataFrame, rows: list[tuple], columns: list[str]) -> DataFrame:
    """Every row of `df` with every row of a small fixed table.

    The table is written into the plan and generated row by row, so there is no join and no shuffle.
    """
    fields = [", ".join(f"{_sql_text(v)} AS {c}" for c, v in zip(columns, row)) for row in rows]
    entries = F.expr("array(" + ", ".join(f"struct({f})" for f in fields) + ")")
    return df.select("*", F.inline(entries))

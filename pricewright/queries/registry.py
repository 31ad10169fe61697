"""Registered queries on the given tables, each with SQL for the same result where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# -- SQL text helpers; constants are typed as doubles because plain ones would be decimals -----------


def sql_round(expression: str, digits: int) -> str:
    return f"floor(({expression}) * 1e{digits} + 0.5e0) / 1e{digits}"


def sql_cents(expression: str) -> str:
    return f"CAST(floor(({expression}) * 1e2 + 0.5e0) AS BIGINT)"


def sql_trunc(expression: str) -> str:
    return f"CAST(trunc({expression}) AS BIGINT)"


def sql_literal(value: object) -> str:
    if isinstance(value, float):
        return f"{value!r}e0"
    return f"'{value}'" if isinstance(value, str) else str(value)


def sql_values(rows: list[tuple], name: str, columns: list[str]) -> str:
    body = ", ".join("(" + ", ".join(sql_literal(v) for v in row) + ")" for row in rows)
    return f"(VALUES {body}) AS {name}({', '.join(columns)})"


def sql_below(expression: str, bounds: list[tuple], otherwise: object) -> str:
    whens = " ".join(f"WHEN {expression} < {b} THEN {sql_literal(label)}" for b, label in bounds)
    return f"CASE {whens} ELSE {sql_literal(otherwise)} END"


def sql_at_least(expression: str, bounds: list[tuple], otherwise: object) -> str:
    whens = " ".join(f"WHEN {expression} >= {b} THEN {sql_literal(label)}" for b, label in bounds)
    return f"CASE {whens} ELSE {sql_literal(otherwise)} END"


def sql_lookup(expression: str, entries: dict, default: object) -> str:
    whens = " ".join(f"WHEN {sql_literal(k)} THEN {sql_literal(v)}" for k, v in entries.items())
    return f"CASE {expression} {whens} ELSE {'NULL' if default is None else sql_literal(default)} END"

"""Collects the queries of the plan modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def expanded(sql: str) -> str:
    """sql with half_even(x, digits) spelt out: rounding by the binary value, ties to even, as functions.scalars.round_half_even() does."""
    while (at := sql.find("half_even(")) >= 0:
        depth, k, comma = 1, at + len("half_even("), 0
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            comma = k if sql[k] == "," and depth == 1 else comma
            k += 1
        x, scale = sql[at + len("half_even(") : comma], 10 ** int(sql[comma + 1 : k - 1])
        down, two = f"floor(v * {scale}::DOUBLE)", f"{2 * scale}::DOUBLE"
        high = "(v * 134217729::DOUBLE - (v * 134217729::DOUBLE - v))"
        middle = f"(2 * {down} + 1)"
        lost = f"(({high} * {two} - {middle}) + (v - {high}) * {two})"
        part = f"CASE WHEN v * {two} <> {middle} THEN v * {two} - {middle} ELSE {lost} END"
        rounded = f"list_transform([CAST({x} AS DOUBLE)], lambda v: CASE WHEN v IS NULL THEN NULL WHEN {part} > 0 THEN {down} + 1 WHEN {part} < 0 THEN {down} ELSE {down} + {down} % 2 END / {scale})[1]"
        sql = sql[:at] + rounded + sql[k:]
    return sql


def query(sql: str | None) -> Callable[[Query], Query]:
    """Registers a query under its name, with its SQL twin if there is one."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = expanded(sql)
        return f

    return add

"""Name -> Spark query and name -> oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog.tables import BARS_SQL, NEWS_SQL, Tables
from tickerloom.session import pin_semantics

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Prices are single quotients and volumes sums of whole numbers: equal bit by bit.
EXACT = {"open", "high", "low", "close", "volume"}


def parse_digits(doubles: str) -> dict[str, int]:
    """'a b:2' -> {'a': 6, 'b': 2}; '*' stands for all doubles of a query without SQL."""
    pairs = [item.partition(":") for item in doubles.split()]
    return {name: int(digits or 6) for name, _, digits in pairs}


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    kinds = dict(df.dtypes)
    if "*" in digits:
        digits = {name: digits["*"] for name, kind in kinds.items() if kind == "double" and name not in EXACT}
    missing = ({n for n, kind in kinds.items() if kind in ("double", "float")} - EXACT) ^ set(digits)
    if missing:
        raise ValueError(f"double columns and rounding differ in {sorted(missing)}")
    return df.withColumns({name: F.round(F.col(name) + off_tie(places), places) for name, places in digits.items()})


def off_tie(places: int) -> float:
    """A shift far below the last digit kept and far above float noise: exact halves
    (prices are short decimals) then round alike however their last bit came out."""
    return 1.7 * 10.0 ** -(places + 3)


def query(name: str, doubles: str = "", sql: str | None = None):
    """Register `function(t: Tables) -> DataFrame`.

    `doubles` lists the double columns with the digits both sides round them to. The
    SQL may use the tables `bars` and `news` besides the driver's.
    """
    digits = parse_digits(doubles)

    def register(function: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return rounded(function(Tables(pin_semantics(spark), folder)), digits)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = oracle(sql, digits)
        return function

    return register


def oracle(sql: str, digits: dict[str, int]) -> str:
    body = sql.strip()
    used = [(table, text) for table, text in (("bars", BARS_SQL), ("news", NEWS_SQL)) if table in body]
    prefix = ", ".join(f"{table} AS MATERIALIZED ({text})" for table, text in used)
    replaced = ", ".join(f"round({name} + {off_tie(places):.4e}::DOUBLE, {places}) + 0.0 AS {name}" for name, places in digits.items())
    columns = f"* REPLACE ({replaced})" if digits else "*"
    # A statement with CTEs of its own (recursive ones included) keeps them inside.
    inner = f"SELECT {columns} FROM ({body})"
    return f"WITH {prefix} {inner}" if prefix else inner

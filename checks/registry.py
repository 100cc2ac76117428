"""Query registration, input tables and fixtures."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
FIXTURES: dict[str, str] = {}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _names(sql: str, known) -> list[str]:
    return [n for n in known if re.search(rf"\b{n}\b", sql)]


def with_fixtures(sql: str) -> str:
    """Prefix a query with the fixtures it names, in definition order."""
    wanted: list[str] = []
    seen: set[str] = set()

    def add(text: str) -> None:
        for name in _names(text, FIXTURES):
            if name not in seen:
                seen.add(name)
                add(FIXTURES[name])
                wanted.append(name)

    add(sql)
    parts = [f"{n} AS ({FIXTURES[n]})" for n in wanted]
    if not parts:
        return sql
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def fixture(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A fixture over the given tables, from the same SQL text the oracle uses."""
    sql = with_fixtures(f"SELECT * FROM {name}")
    base = [f"{t} AS (SELECT * FROM parquet.`{sf}/{t}.parquet`)" for t in _names(sql, TABLES)]
    return spark.sql("WITH " + ",\n".join(base) + ",\n" + sql[5:])


def query(name: str, oracle: str | None = None):
    def register(fn):
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = with_fixtures(oracle)
        return fn
    return register

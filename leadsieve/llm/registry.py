"""Queries of this subpackage and their SQL for DuckDB."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql


def table(spark, sf: str, name: str):
    return spark.read.parquet(f"{sf}/{name}.parquet")

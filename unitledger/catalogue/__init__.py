"""Registered queries: each operator on whole tables, with equal SQL where SQL can say it."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from unitledger.session import configure

Query = Callable[["Tables"], DataFrame]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The given tables of one folder, read by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = configure(spark), folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None):
    """Register a function of `Tables` under its own name, with its SQL."""

    def register(function: Query) -> Query:
        name = function.__name__

        @functools.wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(Tables(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def load_all() -> None:
    from unitledger.catalogue import (  # noqa: F401
        incremental,
        joins,
        nested,
        quality,
        scalars,
        spatial,
        storage,
    )

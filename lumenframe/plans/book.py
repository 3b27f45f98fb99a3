"""A small catalogue that keeps a Spark query next to the SQL that must give the same rows."""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    ident: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


class Book:
    def __init__(self) -> None:
        self.entries: dict[str, Query] = {}

    def add(self, name: str, ident: str, sql: str | None = None):
        def keep(fn):
            if name in self.entries:
                raise ValueError(f"query {name} registered twice")
            self.entries[name] = Query(ident, fn, sql)
            return fn
        return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")

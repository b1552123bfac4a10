"""Registry of named queries over the supplied tables.

Each entry pairs a Spark builder ``fn(spark, sf_dir) -> DataFrame`` with an
equivalent DuckDB SQL text (or ``None`` when the operator has no SQL form,
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.sources.io import table_path

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One supplied table as a lazy Parquet scan."""
    return spark.read.parquet(table_path(sf_dir, name))

"""The registered queries, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

QueryFunction = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFunction] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[QueryFunction], QueryFunction]:
    """Register a function ``(spark, folder) -> DataFrame`` under its name."""

    def register(function: QueryFunction) -> QueryFunction:
        key = name or function.__name__
        QUERIES[key] = lambda spark, folder: portable(function(spark, folder))
        if sql is not None:
            ORACLES[key] = sql.strip()
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def portable(df: DataFrame) -> DataFrame:
    """Dates and decimals as text, as clients of different engines show them differently."""
    texts = (T.DateType, T.DecimalType)
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("string").alias(f.name)
            if isinstance(f.dataType, texts) else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )

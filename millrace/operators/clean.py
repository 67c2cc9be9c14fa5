"""The cleaner: blank rows, hidden characters, null keys, duplicate keys."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from millrace.functions.text import clean_text
from millrace.spec import TableSpec

log = logging.getLogger(__name__)


def _quoted(column: str) -> Column:
    return F.col(f"`{column}`")


def is_missing(df: DataFrame, column: str) -> Column:
    """True where a value is null, or a double that is not a number."""
    value = _quoted(column)
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def is_blank_row(df: DataFrame) -> Column:
    """True where every column is missing; never for a table without columns."""
    return reduce(lambda a, b: a & b, [is_missing(df, c) for c in df.columns], F.lit(bool(df.columns)))


def drop_blank_rows(df: DataFrame) -> DataFrame:
    """Drop rows in which every column is null; a blank text still counts as a value."""
    return df.filter(~is_blank_row(df))


def clean_all_columns(df: DataFrame) -> DataFrame:
    """Clean every text column and leave the others alone."""
    return df.select(
        *[
            clean_text(_quoted(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType) else _quoted(f.name)
            for f in df.schema
        ]
    )


def usable_key(df: DataFrame, key: Sequence[str]) -> list[str]:
    """The key columns, or none of them (with a warning) when the table lacks one."""
    missing = [c for c in key if c not in df.columns]
    if missing:
        log.warning("key columns %s are missing: rows keep their null and duplicate keys", missing)
        return []
    return list(key)


def drop_null_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any key column."""
    return df.filter(~reduce(lambda a, b: a | b, [is_missing(df, c) for c in key])) if key else df


def dedup(df: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Keep the first row of each key in the given order.

    Only the first row per key leaves each map task, as the filter on the row number is pushed
    below the shuffle; a key with very many copies is thus reduced before it meets one task.
    Give a total order: among rows equal in ``order_by`` any one is kept.
    """
    if not key:
        return df
    if not order_by:
        raise ValueError("keeping the first row of a key needs an order")
    first = Window.partitionBy(*[_quoted(c) for c in key]).orderBy(*[_quoted(c) for c in order_by])
    return df.withColumn("_row", F.row_number().over(first)).filter("_row = 1").drop("_row")


def clean_table(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The whole cleaner, as one lazy plan with a single shuffle on the key."""
    cleaned = clean_all_columns(drop_blank_rows(df))
    key = usable_key(cleaned, spec.key_columns)
    kept = dedup(drop_null_keys(cleaned, key), key, spec.order_by)
    return kept.withColumnsRenamed(spec.renames) if spec.renames else kept


def clean_report(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows removed by each step of :func:`clean_table`, from one aggregation.

    Rows are counted per key first, which also shrinks a hot key before the shuffle.
    """
    key = usable_key(df, spec.key_columns)
    cleaned = clean_all_columns(df.withColumn("_blank", is_blank_row(df)))
    no_key = reduce(lambda a, b: a | b, [_quoted(c).isNull() for c in key], F.lit(False))
    if not key:
        return cleaned.agg(
            F.count(F.lit(1)).alias("input_rows"),
            F.count_if("_blank").alias("blank_rows"),
            F.lit(0).cast("bigint").alias("null_key_rows"),
            F.lit(0).cast("bigint").alias("duplicate_rows"),
            F.count_if(~F.col("_blank")).alias("output_rows"),
        )
    step = F.when(F.col("_blank"), "blank").when(no_key, "null_key").otherwise("keyed")
    keys = [_quoted(c).alias(f"_key{i}") for i, c in enumerate(key)]
    counted = cleaned.groupBy(*keys, step.alias("step")).agg(F.count(F.lit(1)).alias("n"))

    def rows(name: str, value: Column) -> Column:
        hit = F.when(F.col("step") == name, value).otherwise(F.lit(0).cast("bigint"))
        return F.coalesce(F.sum(hit), F.lit(0).cast("bigint"))

    return counted.agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("input_rows"),
        rows("blank", F.col("n")).alias("blank_rows"),
        rows("null_key", F.col("n")).alias("null_key_rows"),
        rows("keyed", F.col("n") - 1).alias("duplicate_rows"),
        rows("keyed", F.lit(1).cast("bigint")).alias("output_rows"),
    )

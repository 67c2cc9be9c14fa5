"""The first rows of a table in some order, without sending many rows of every task to one."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions.calendar import micros

# A table is narrowed until it holds no more rows than this, or than those wanted.
ENOUGH_ROWS = 1_000_000
BUCKETS = 4096


def first_rows(
    df: DataFrame, order_by: Sequence[str], rows: int, descending: bool = False, narrow: bool = False
) -> DataFrame:
    """Exactly the first ``rows`` rows in the given order, nulls first (last when descending).

    Top-k keeps ``rows`` rows per task and merges them in one task. Where a caller wants many rows,
    ``narrow`` first drops what cannot be among them, which takes jobs of its own.
    """
    order = [F.desc(f"`{c}`") if descending else F.asc(f"`{c}`") for c in order_by]
    if narrow:
        df = _narrow(df, order_by[0], rows, descending)
    return df.orderBy(*order).limit(rows)


def _as_double(df: DataFrame, column: str) -> Column | None:
    """A double that rises with the column, null for what is no finite value."""
    kind, value = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, T.NumericType):
        number = value.cast("double")
        return F.when(~F.isnan(number), number)
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return micros(value).cast("double")
    return value.cast("double") if isinstance(kind, T.TimestampType) else None


def _is_float(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType))


def _narrow(df: DataFrame, column: str, rows: int, descending: bool) -> DataFrame:
    """Drop rows that cannot be among the first: those beyond the bucket in which the count of
    values reaches ``rows``. Each round counts values in equal buckets between the ends."""
    value = _as_double(df, column)
    if value is None:
        return df
    # What sorts before all of these values: nulls, or descending, doubles that are no number.
    early = F.col(f"`{column}`").isNull()
    if descending:
        value = -value
        early = F.isnan(f"`{column}`") if _is_float(df, column) else F.lit(False)
    while True:
        ends = df.agg(
            F.min(value).alias("low"), F.max(value).alias("high"), F.count(value).alias("values"),
            F.count_if(early).alias("early"),
        ).first()
        wanted = rows - ends.early
        if wanted <= 0:
            return df.filter(early)
        # Done when little is left, and given up where buckets cannot tell values apart.
        if ends.values <= max(wanted, ENOUGH_ROWS) or not ends.high > ends.low:
            return df
        width = (ends.high - ends.low) / BUCKETS
        if not math.isfinite(width) or width == 0:
            return df
        bucket = F.least(F.floor((value - F.lit(ends.low)) / F.lit(width)), F.lit(BUCKETS - 1))
        counts = df.filter(value.isNotNull()).groupBy(bucket.alias("bucket")).count().collect()
        reached = 0
        for last, count in sorted(tuple(r) for r in counts):
            reached += count
            if reached >= wanted:
                break
        if reached == ends.values:
            return df
        df = df.filter((bucket <= last) | early)

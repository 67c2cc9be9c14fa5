"""Column expressions and checks shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

# A word is a run of anything but space and the ASCII white space U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
GAPS = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def named(name: str) -> Column:
    """The column of exactly this name, dots and backquotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else, alike in every engine."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """The words of a text in order; an empty array for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAPS), lambda w: w != "")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def require(df: DataFrame, *columns: str) -> None:
    """Raise unless each of ``columns`` is in ``df`` exactly once."""
    for name in columns:
        if df.columns.count(name) != 1:
            raise ValueError(f"{name!r} must be there once; the columns are {df.columns}")


def small(df: DataFrame, limit: int) -> bool:
    """Whether a written table has at most ``limit`` rows; the bound under which it may be broadcast."""
    return df.limit(limit + 1).count() <= limit


def broadcast_if_small(df: DataFrame, limit: int) -> DataFrame:
    """``df`` marked for broadcast behind a check of its rows; beyond the limit a plain (shuffled) join."""
    return F.broadcast(df) if small(df, limit) else df


def row_hashes(*parts: Column) -> list[Column]:
    """128 bits of hash in two columns; equal for rows whose parts are equal, nulls included."""
    return [F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts)]


def slices(texts: pa.Array, rows: int, size: int) -> Iterator[tuple[int, int]]:
    """(start, number) of runs of at most ``rows`` texts and ``size`` bytes; a longer text is a run of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        upto = min(max(int(np.searchsorted(ends, before + size, "right")), at + 1), at + rows)
        yield at, min(upto, len(texts)) - at
        at = upto

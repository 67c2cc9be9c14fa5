"""Session settings for the jobs in this package."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import SparkSession

# Adaptive execution re-plans joins and splits skewed partitions at run time. UTC keeps the
# session zone out of results; timestamps stay TIMESTAMP_NTZ end to end.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.files.maxPartitionBytes": "134217728",
}

# The JVM leaves methods of over 8,000 bytes uncompiled. Plans with wide projections that come to more run operator by
# operator, whose methods Spark splits.
LARGEST_METHOD = "8000"
_lock = Lock()
_blocks: dict[tuple[int, str], list] = {}  # session and setting: how many blocks hold it, what it was before


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings (dots as ``__``) for the plans that run or are listed within the block.

    Blocks may be nested and run side by side in threads with the same values; what held before comes back when the
    last one ends.
    """
    held = {(id(spark), k.replace("__", ".")): v for k, v in values.items()}
    with _lock:
        for place, value in held.items():
            block = _blocks.setdefault(place, [0, spark.conf.get(place[1], None)])
            block[0] += 1
            spark.conf.set(place[1], value)
    try:
        yield
    finally:
        with _lock:
            for place in held:
                block = _blocks[place]
                block[0] -= 1
                if not block[0]:
                    _blocks.pop(place)
                    spark.conf.unset(place[1]) if block[1] is None else spark.conf.set(place[1], block[1])


def compiled(spark: SparkSession):
    """A block in which no plan runs on methods that the JVM leaves uncompiled."""
    return settings(spark, spark__sql__codegen__hugeMethodLimit=LARGEST_METHOD)


def few_listings(spark: SparkSession):
    """A block in which folders are listed by a few tasks a core, where Spark starts one task a folder."""
    tasks = str(max(4 * spark.sparkContext.defaultParallelism, 32))
    return settings(spark, spark__sql__sources__parallelPartitionDiscovery__parallelism=tasks)


def build_session(app: str = "millrace", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the package's settings; ``extra`` overrides them (dots as ``__``)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

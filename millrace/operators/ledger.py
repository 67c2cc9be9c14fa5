"""Batch loads that count once, whatever the driver dies of: a ledger of intents and commits.

A load writes its intent, then its rows into a partition of its own (named by the load), then its lines of
the history, and last its commit, one row. What no commit names does not count: readers take the rows and
history lines of committed loads (:func:`committed`), and the next run removes what an intent without a commit
has left (:func:`roll_back`). A load of the same files gets the same name until it is committed, and replaces
its own partition, so a repeated run can only replace, never add.

Loaders that run at the same time need names of their own: each rolls back its own loads only.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions.casts import declared_type
from millrace.operators.verify import digest_sum

TAG = "_load_id"
LEDGER_SCHEMA = "load_id string, table_name string, loader string, event string, at timestamp_ntz"
INTENT, COMMIT, ROLLBACK = "INTENT", "COMMIT", "ROLLBACK"


def create_ledger(spark: SparkSession, ledger: str) -> None:
    spark.createDataFrame([], LEDGER_SCHEMA).write.mode("ignore").saveAsTable(ledger)


def create_tagged_target(spark: SparkSession, table: str, fields: Sequence) -> None:
    """An empty table for the columns of ``fields``, partitioned by load."""
    columns = ", ".join(f"`{f.name}` {declared_type(f.type)}" for f in fields)
    spark.sql(f"CREATE TABLE {table} ({columns}, {TAG} STRING) USING parquet PARTITIONED BY ({TAG})")


def note(spark: SparkSession, ledger: str, load_id: str, table: str, loader: str, event: str) -> None:
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    spark.createDataFrame([(load_id, table, loader, event, now)], LEDGER_SCHEMA).coalesce(1).write.mode("append").saveAsTable(ledger)


def loads_of(spark: SparkSession, ledger: str, table: str) -> DataFrame:
    """(load_id, loader, intended, committed, ended): the state of each load into ``table``."""
    def seen(event: str) -> Column:
        return F.max(F.when(F.col("event") == event, F.col("at")))

    states = spark.table(ledger).filter(F.col("table_name") == table).groupBy("load_id", "loader").agg(
        seen(INTENT).alias("intended"), seen(COMMIT).alias("committed"), seen(ROLLBACK).alias("rolled_back")
    )
    # A name that was rolled back may be intended again: the later of both holds.
    ended = F.col("committed").isNotNull() | F.coalesce(F.col("rolled_back") >= F.col("intended"), F.lit(False))
    return states.select("load_id", "loader", "intended", "committed", ended.alias("ended"))


def committed(spark: SparkSession, table: str, ledger: str, tagged: str | None = None) -> DataFrame:
    """The rows of ``tagged`` (``table`` itself unless told) that committed loads into ``table`` have written."""
    done = loads_of(spark, ledger, table).filter("committed IS NOT NULL").select(F.col("load_id").alias(TAG))
    return spark.table(tagged or table).join(done, TAG, "left_semi").drop(TAG)


def load_name(spark: SparkSession, ledger: str, table: str, loader: str, files: DataFrame | None) -> str:
    """A name that the same files get again until they are committed; one of its own without files."""
    if files is None:
        return uuid.uuid4().hex
    entry = F.concat_ws("|", "path", F.col("size").cast("string"), F.col("modified").cast("string"))
    digest = files.agg(F.md5(F.concat_ws("|", F.lit(table), F.lit(loader), digest_sum(F.md5(entry)))).alias("d")).first().d
    done = loads_of(spark, ledger, table).filter(F.col("committed").isNotNull() & F.col("load_id").startswith(digest))
    return f"{digest}-{done.count()}"


def write_tagged(rows: DataFrame, table: str, load_id: str) -> None:
    """Replace the partition of one load in ``table``."""
    spark, view = rows.sparkSession, f"load_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{c}`" for c in spark.table(table).columns if c != TAG)
    rows.createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({TAG} = '{load_id}') SELECT {columns} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def drop_load(spark: SparkSession, table: str, load_id: str) -> None:
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({TAG} = '{load_id}')")


def roll_back(spark: SparkSession, table: str, ledger: str, loader: str) -> list[str]:
    """Remove the rows of this loader's loads that were intended and neither committed nor rolled back."""
    open_loads = loads_of(spark, ledger, table).filter((~F.col("ended")) & (F.col("loader") == loader))
    names = [r.load_id for r in open_loads.select("load_id").collect()]  # one at most in each run that failed
    for name in names:
        drop_load(spark, table, name)
        note(spark, ledger, name, table, loader, ROLLBACK)
    return names

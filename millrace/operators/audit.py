"""The audit table: one row per stage and table, and its rollups."""

from __future__ import annotations

import json
from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.sources.files import RAW_SUFFIX

AUDIT_SCHEMA = "timestamp timestamp_ntz, level string, stage string, data string"
RESULT_SCHEMA = (
    "table_name string, source string, status string, error string, rows_loaded bigint, total_columns bigint"
)


def brief_error(problem: Exception) -> str:
    """The class of an exception and the first line of what it says, which names Spark's error condition."""
    lines = str(problem).splitlines()
    return f"{type(problem).__name__}: {lines[0]}" if lines else type(problem).__name__


def audit_rows(spark: SparkSession, stage: str, results: Iterable[dict], level: str = "INFO") -> DataFrame:
    """Results of one stage as audit rows, their details as JSON."""
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    rows = [(now, level.upper(), stage, json.dumps(r, default=str)) for r in results]
    return spark.createDataFrame(rows, AUDIT_SCHEMA)


def append_audit(rows: DataFrame, table: str) -> None:
    rows.write.mode("append").saveAsTable(table)


def results_of(audit: DataFrame) -> DataFrame:
    """The load results held in the audit rows' details."""
    return audit.select("stage", F.from_json("data", RESULT_SCHEMA).alias("d")).select("stage", "d.*")


def audit_summary(results: DataFrame, *by: str) -> DataFrame:
    """Success, warnings and failures, rows and columns without the failed, share completed."""
    done = F.col("status").isin("success", "warning")
    loaded = F.sum(F.when(done, F.col("rows_loaded")).otherwise(F.lit(0).cast("bigint")))
    wide = F.sum(F.when(done, F.col("total_columns")).otherwise(F.lit(0).cast("bigint")))
    counts = results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_tables"),
        F.count_if(F.col("status") == "success").alias("successful"),
        F.count_if(F.col("status") == "warning").alias("warnings"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.coalesce(loaded, F.lit(0).cast("bigint")).alias("total_rows_loaded"),
        F.coalesce(wide, F.lit(0).cast("bigint")).alias("total_columns"),
    )
    share = (F.col("successful") + F.col("warnings")) / F.col("total_tables") * 100
    return counts.withColumn(
        "completion_percentage",
        F.when(F.col("total_tables") > 0, share).otherwise(F.lit(0.0)),
    )


def mapping_lookup(tables: DataFrame, mappings: DataFrame) -> DataFrame:
    """For each ``table_name`` the mapping that applies: the newest successful one by ``position``, as
    :func:`saved_mapping` takes it.

    ``verdict`` is ok, not_success (there are mappings, but none succeeded; ``position`` is that of the newest) or missing.
    """
    newest = mappings.groupBy("table_name").agg(
        F.max("position").alias("_newest"),
        F.max(F.when(F.col("status") == "success", F.col("position"))).alias("_success"),
    )
    verdict = F.when(F.col("_newest").isNull(), "missing").when(F.col("_success").isNull(), "not_success").otherwise("ok")
    return tables.join(newest, "table_name", "left").select(
        "table_name", F.coalesce("_success", "_newest").alias("position"), verdict.alias("verdict")
    )


def file_inventory(listing: DataFrame, raw_suffix: str = RAW_SUFFIX) -> DataFrame:
    """Raw and cleaned files of a listing with their bytes: a file is raw by the end of its name."""
    raw = F.endswith(F.lower("name"), F.lit(raw_suffix))
    kind = F.when(raw, "raw").otherwise("cleaned")
    return listing.groupBy(kind.alias("kind")).agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")
    )

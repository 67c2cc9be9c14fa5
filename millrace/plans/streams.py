"""Queries over the streaming loads, run to the end of what has arrived."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.plans.cleaning import clean_sql
from millrace.plans.registry import query, table
from millrace.sources.csv import MULTI_LINE, write_csv
from millrace.spec import TableSpec
from millrace.streaming.incremental import ByHeader, clean_new_files, file_stream, load_new_files_by_header
from millrace.workspace import fresh_folder


@query("""
SELECT 1::INTEGER AS run, count(*) AS row_count, sum(o_orderkey)::BIGINT AS key_sum, sum(o_custkey)::BIGINT AS customer_sum,
    count(DISTINCT o_orderpriority) AS priorities FROM orders WHERE o_orderdate < '1998-01-01'
UNION ALL SELECT 2, count(*), sum(o_orderkey)::BIGINT, sum(o_custkey)::BIGINT, count(DISTINCT o_orderpriority) FROM orders
    WHERE o_orderdate < '1998-01-01'
UNION ALL SELECT 3, count(*), sum(o_orderkey)::BIGINT, sum(o_custkey)::BIGINT, count(DISTINCT o_orderpriority) FROM orders
""")
def stream_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """The target after a first load, a load with nothing new, and one with new files, whose columns come in
    another order in each drop."""
    inbox, target, checkpoint, registry = (fresh_folder(spark, s) for s in ("inbox", "target", "progress", "registry"))
    orders = table(spark, folder, "orders")
    names = orders.columns
    reading = ByHeader(registry, tuple(names))
    after = []
    for run in (1, 2, 3):
        if run != 2:
            part = "o_orderdate < '1998-01-01'" if run == 1 else "o_orderdate >= '1998-01-01'"
            write_csv(orders.filter(part).select(*(names if run == 1 else reversed(names))), f"{inbox}/drop{run}")
        load_new_files_by_header(file_stream(spark, inbox), reading, target, checkpoint)
        loaded = spark.read.parquet(target).agg(
            F.lit(run).alias("run"),
            F.count(F.lit(1)).alias("row_count"),
            F.sum(F.col("o_orderkey").cast("bigint")).alias("key_sum"),
            F.sum(F.col("o_custkey").cast("bigint")).alias("customer_sum"),
            F.count_distinct("o_orderpriority").alias("priorities"),
        )
        # The row for this run has to be taken before the next run adds files.
        after.append(loaded.collect())
    return spark.createDataFrame([row for rows in after for row in rows], loaded.schema)


_DIRTY = (
    "CASE WHEN length(text) % 3 = 0 THEN ' ' || text || chr(9) WHEN length(text) % 11 = 1 THEN '   ' ELSE text END"
)


@query(f"""
WITH d AS (SELECT CASE WHEN lang = 'en' THEN 0 ELSE 1 END AS drop, doc_id, lang, source,
    {clean_sql(_DIRTY)} AS text FROM documents)
SELECT doc_id::VARCHAR AS doc_id, lang, source, text FROM d WHERE text IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY text ORDER BY drop, lpad(doc_id::VARCHAR, 12, '0')) = 1
""")
def stream_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Two drops of documents with their columns in two orders, each cleaned; texts known from the first drop
    are not added again."""
    names = ["doc_id", "lang", "source", "text", "sort_key"]
    inbox, target, checkpoint, registry = (fresh_folder(spark, s) for s in ("inbox", "clean", "progress", "registry"))
    reading = ByHeader(registry, tuple(names), MULTI_LINE)
    key = F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("sort_key")
    documents = table(spark, folder, "documents").select(
        "doc_id", "lang", "source", F.expr(_DIRTY).alias("text"), key
    )
    spec = TableSpec("documents", primary_key="text", order_by=("sort_key",))
    for drop, part in enumerate(("lang = 'en'", "lang <> 'en'")):
        write_csv(documents.filter(part).select(*(reversed(names) if drop else names)), f"{inbox}/drop{drop}")
        clean_new_files(file_stream(spark, inbox), spec, target, checkpoint, reading)
    return spark.read.parquet(target).select("doc_id", "lang", "source", "text")

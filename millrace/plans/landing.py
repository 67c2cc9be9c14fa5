"""The raw zone: test tables landed as files, with the defects real exports have.

Defects are SQL expressions both engines understand, so a query's SQL counterpart repeats them.
What is landed once in a session is read by all queries that need it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.plans.registry import table
from millrace.sources.csv import write_csv
from millrace.workspace import fresh_folder

_landed: dict[tuple[str, str, str], str] = {}

NBSP, EM_SPACE, ZERO_WIDTH = " ", " ", "​"

# A customer export: quoted text over two lines, null tokens, blanks.
CUSTOMER_NAME = (
    "CASE WHEN c_custkey % 11 = 0 THEN c_name || ', \"Inc\"' || chr(10) || ' branch' ELSE c_name END"
)
CUSTOMER_RAW = {
    "c_custkey": "CAST(c_custkey AS STRING)",
    "c_name": CUSTOMER_NAME,
    "c_nationkey": "CASE WHEN c_custkey % 5 = 0 THEN 'NULL' ELSE CAST(c_nationkey AS STRING) END",
    "c_acctbal": "CASE WHEN c_custkey % 13 = 0 THEN 'nan' ELSE CAST(c_acctbal AS STRING) END",
    "c_mktsegment": "CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 7 = 1 THEN 'NA'"
    " ELSE c_mktsegment END",
}

# A project export in files of a thousand keys: bad dates, bad amounts, missing states.
PROJECT_FILE = "CAST(floor(o_orderkey / 1000) AS BIGINT)"
PROJECT_DATE = (
    "CASE WHEN o_orderkey % 2503 = 7 THEN 'not a date'"
    " ELSE substring(CAST(o_orderdate AS STRING), 1, 10) END"
)
PROJECT_BUDGET = (
    "CASE WHEN o_orderkey % 4001 = 0 THEN 'n/a' ELSE CAST(o_totalprice AS STRING) END"
)
PROJECT_STATUS = (
    "CASE o_orderstatus WHEN 'P' THEN 'CANCELLED' WHEN 'O' THEN 'open'"
    " ELSE CASE WHEN o_custkey % 3 = 0 THEN 'NULL' ELSE 'done' END END"
)
PROJECT_COLUMNS = ["project_name", "project_id", "created_date", "budget", "status"]


def landed(spark: SparkSession, folder: str, label: str, write: Callable[[str], None]) -> str:
    """The path ``label`` of ``folder`` was landed at in this session, landing it if needed."""
    key = (spark.sparkContext.applicationId, folder, label)
    if key not in _landed:
        path = fresh_folder(spark, label)
        write(path)
        _landed[key] = path
    return _landed[key]


def customer_csv(spark: SparkSession, folder: str) -> str:
    def write(path: str) -> None:
        raw = table(spark, folder, "customer")
        write_csv(raw.select(*[F.expr(e).alias(c) for c, e in CUSTOMER_RAW.items()]), path)

    return landed(spark, folder, "customer-csv", write)


def project_rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.expr("'project ' || CAST(o_custkey AS STRING)").alias("project_name"),
        F.col("o_orderkey").cast("string").alias("project_id"),
        F.expr(PROJECT_DATE).alias("created_date"),
        F.expr(PROJECT_BUDGET).alias("budget"),
        F.expr(PROJECT_STATUS).alias("status"),
        F.expr(PROJECT_FILE).alias("batch"),
    )


def project_csv(spark: SparkSession, folder: str) -> str:
    """One folder ``batch=n`` per thousand keys; ``batch`` stands for the file."""
    return landed(
        spark, folder, "project-csv",
        lambda path: write_csv(
            project_rows(spark, folder).repartition("batch"), path, partition_by=("batch",)
        ),
    )

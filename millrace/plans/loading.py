"""Queries over table lifecycle and bulk loads."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators import audit, load, tables
from millrace.operators.load import Field
from millrace.plans.landing import (
    PROJECT_BUDGET, PROJECT_COLUMNS, PROJECT_DATE, PROJECT_FILE, PROJECT_STATUS, landed, project_csv,
)
from millrace.functions.text import null_if
from millrace.plans.registry import query, table
from millrace.sources.csv import BULK_LOAD, read_csv, write_csv
from millrace.plans.run import run_tables
from millrace.sources.files import partition_value
from millrace.spec import TableSpec
from millrace.workspace import fresh_database, fresh_folder

PROJECT_FIELDS = [
    Field("project_name", "VARCHAR(255)", "_1"),
    Field("project_id", "VARCHAR(50)", "_2"),
    Field("created_date", "DATE", "_3"),
    Field("budget", "FLOAT", "_4"),
    Field("status", "VARCHAR(100)", "_5", upper=True),
]
LENIENT_FIELDS = [
    Field(f.name, f.type, f.source, lenient=True, upper=f.upper) for f in PROJECT_FIELDS
]
_STATUS_SQL = f"CASE WHEN ({PROJECT_STATUS}) = 'NULL' THEN NULL ELSE upper({PROJECT_STATUS}) END"
_PROJECT_SQL = f"""
SELECT 'project ' || o_custkey AS project_name, o_orderkey::VARCHAR AS project_id,
    CASE WHEN o_orderkey % 2503 = 7 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS created_date,
    CASE WHEN o_orderkey % 4001 = 0 THEN NULL ELSE o_totalprice END AS budget,
    {_STATUS_SQL} AS status
FROM orders"""
_BAD = "(o_orderkey % 2503 = 7 OR o_orderkey % 4001 = 0)"


def _raw_projects(spark: SparkSession, folder: str) -> DataFrame:
    """Project files by position, ``batch`` standing for the file."""
    rows = read_csv(spark, project_csv(spark, folder), BULK_LOAD, names=PROJECT_COLUMNS)
    renamed = {c: f"_{i + 1}" for i, c in enumerate(PROJECT_COLUMNS)}
    return rows.withColumnsRenamed(renamed).withColumn("batch", F.col("batch").cast("bigint"))


def _empty_project_table(spark: SparkSession, database: str) -> str:
    name = f"{database}.projects"
    load.create_target(spark, name, PROJECT_FIELDS)
    return name


@query(_PROJECT_SQL)
def load_transform(spark: SparkSession, folder: str) -> DataFrame:
    """Projection by position with casts; bad dates and numbers become null."""
    return load.transform_on_load(_raw_projects(spark, folder), LENIENT_FIELDS)


@query(f"SELECT * FROM ({_PROJECT_SQL}) WHERE status <> 'CANCELLED'")
def load_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The same without cancelled projects; an unknown status does not pass either."""
    rows = _raw_projects(spark, folder)
    return load.transform_on_load(rows, LENIENT_FIELDS, F.col("status") != "CANCELLED")


@query(f"{_PROJECT_SQL} WHERE NOT {_BAD}")
def load_on_error_continue(spark: SparkSession, folder: str) -> DataFrame:
    """Good rows loaded, bad rows kept apart."""
    name = _empty_project_table(spark, fresh_database(spark, "load"))
    load.bulk_load(_raw_projects(spark, folder), PROJECT_FIELDS, name, "batch")
    return spark.table(name)


@query(f"""
SELECT {PROJECT_FILE} AS batch, count(*) AS rows_parsed, count(*) FILTER ({_BAD}) AS rows_rejected,
    count(*) FILTER (NOT {_BAD}) AS rows_loaded,
    sum((o_orderkey % 2503 = 7)::INTEGER + (o_orderkey % 4001 = 0)::INTEGER)::BIGINT AS error_count,
    CASE WHEN count(*) FILTER ({_BAD}) = 0 THEN 'LOADED' ELSE 'PARTIALLY_LOADED' END AS status,
    CASE WHEN count(*) FILTER (o_orderkey % 4001 = 0) > 0 THEN 'budget ''n/a'' not a FLOAT'
        WHEN count(*) FILTER (o_orderkey % 2503 = 7) > 0 THEN 'created_date ''not a date'' not a DATE'
        END AS first_error
FROM orders GROUP BY ALL
""")
def load_file_report(spark: SparkSession, folder: str) -> DataFrame:
    """What the load history says of every file of a load."""
    name = _empty_project_table(spark, fresh_database(spark, "load"))
    result = load.bulk_load(
        _raw_projects(spark, folder), PROJECT_FIELDS, name, "batch", loaded_at=datetime(2024, 1, 31)
    )
    return result.history.select(
        F.col("file_name").cast("bigint").alias("batch"), "rows_parsed", "rows_rejected", "rows_loaded",
        "error_count", "status", "first_error",
    )


@query("SELECT true AS aborted, 0::BIGINT AS rows_in_table, count(*) AS bad_rows FROM orders WHERE " + _BAD)
def load_abort(spark: SparkSession, folder: str) -> DataFrame:
    """A load that stops at the first bad row leaves the table empty."""
    name = _empty_project_table(spark, fresh_database(spark, "load"))
    rows = _raw_projects(spark, folder)
    aborted = False
    try:
        load.bulk_load(rows, PROJECT_FIELDS, name, "batch", on_error="abort")
    except load.LoadAborted:
        aborted = True
    bad = load.check_rows(rows, PROJECT_FIELDS).agg(F.count_if(F.size("_errors") > 0).alias("bad_rows"))
    return bad.select(
        F.lit(aborted).alias("aborted"),
        F.lit(spark.table(name).count()).cast("bigint").alias("rows_in_table"),
        "bad_rows",
    )


@query(f"""
{_PROJECT_SQL} WHERE {PROJECT_FILE} NOT IN (SELECT {PROJECT_FILE} FROM orders WHERE {_BAD})
""")
def load_skip_file(spark: SparkSession, folder: str) -> DataFrame:
    """Only files without a bad row are loaded."""
    name = _empty_project_table(spark, fresh_database(spark, "load"))
    load.bulk_load(_raw_projects(spark, folder), PROJECT_FIELDS, name, "batch", on_error="skip_file")
    return spark.table(name)


@query(f"""
SELECT {PROJECT_FILE} AS batch, o_orderkey::VARCHAR AS project_id, 'created_date' AS column_name,
    'not a date' AS value, 'not a DATE' AS reason FROM orders WHERE o_orderkey % 2503 = 7
UNION ALL SELECT {PROJECT_FILE}, o_orderkey::VARCHAR, 'budget', 'n/a', 'not a FLOAT'
FROM orders WHERE o_orderkey % 4001 = 0
""")
def load_validate(spark: SparkSession, folder: str) -> DataFrame:
    """All errors of a load that writes nothing."""
    checked = load.check_rows(_raw_projects(spark, folder), PROJECT_FIELDS, keep=["batch", "_2"])
    return load.rejects(checked, ["batch", "_2"]).withColumnRenamed("_2", "project_id")


_YEAR = "CAST(year(o_orderdate) AS BIGINT)"


def _drop_orders(spark: SparkSession, folder: str, path: str, early: bool) -> None:
    """Land the orders up to 1997, or those after, in folders by year."""
    orders = table(spark, folder, "orders").withColumn("year", F.expr(_YEAR))
    part = orders.filter("o_orderdate < '1998-01-01'" if early else "o_orderdate >= '1998-01-01'")
    rows = part.select(F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("string"), "year")
    write_csv(rows, f"{path}/{'first' if early else 'second'}", partition_by=("year",))


@query(f"""
SELECT CASE WHEN {_YEAR} < 1998 THEN 1 ELSE 2 END::INTEGER AS run, {_YEAR} AS year, count(*) AS rows_loaded,
    sum(o_orderkey)::BIGINT AS key_sum FROM orders GROUP BY ALL
""")
def incremental_files(spark: SparkSession, folder: str) -> DataFrame:
    """Four runs over a folder that grows once: each file is loaded in one run only."""
    inbox = fresh_folder(spark, "inbox")
    database = fresh_database(spark, "incremental")
    load.create_history(spark, f"{database}.history")
    spark.sql(
        f"CREATE TABLE {database}.rows (run BIGINT, year BIGINT, o_orderkey STRING, o_totalprice STRING) USING parquet"
    )
    fields = [Field("run", "NUMBER(9)"), Field("year", "NUMBER(9)"), Field("o_orderkey"), Field("o_totalprice")]
    for run in (0, 1, 2, 3):
        if run in (0, 2):
            _drop_orders(spark, folder, inbox, early=run == 0)

        def load_paths(paths: list[str], files: DataFrame) -> None:
            rows = spark.read.schema("o_orderkey string, o_totalprice string").option("header", "true").csv(paths)
            path = F.col("_metadata.file_path")
            number = F.lit("1" if run < 2 else "2")
            raw = rows.select(
                path.alias("path"), number.alias("run"), partition_value(path, "year").alias("year"), "o_orderkey", "o_totalprice"
            )
            load.bulk_load(raw, fields, f"{database}.rows", "path", history_table=f"{database}.history", files=files)

        load.load_new_files(spark, inbox, f"{database}.rows", f"{database}.history", load_paths)
    return spark.table(f"{database}.rows").groupBy(F.col("run").cast("int").alias("run"), "year").agg(
        F.count(F.lit(1)).alias("rows_loaded"), F.sum(F.col("o_orderkey").cast("bigint")).alias("key_sum")
    )


_CUSTOMER_TEXT = """
SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_nationkey::VARCHAR AS c_nationkey,
    c_acctbal::VARCHAR AS c_acctbal, c_mktsegment FROM customer"""


@query(_CUSTOMER_TEXT)
def load_text_table(spark: SparkSession, folder: str) -> DataFrame:
    """Create or replace a table with every column as text."""
    name = f"{fresh_database(spark, 'text')}.customer"
    tables.create_text_table(table(spark, folder, "customer"), name)
    return spark.table(name)


@query("""
SELECT true AS created_first, false AS created_again, 0::BIGINT AS rows, 'decimal(38,0),decimal(38,0),string,double,string,string'
    AS types, (SELECT count(*) FROM orders) AS source_rows
""")
def create_if_absent(spark: SparkSession, folder: str) -> DataFrame:
    """A table made from the types found in text, once."""
    name = f"{fresh_database(spark, 'absent')}.orders"
    text = table(spark, folder, "orders")
    text = text.select(*[F.col(c).cast("string").alias(c) for c in text.columns])
    text = text.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    first, again = tables.create_if_absent(text, name), tables.create_if_absent(text, name)
    types = ",".join(t for _, t in spark.table(name).dtypes)
    return text.agg(
        F.lit(first).alias("created_first"),
        F.lit(again).alias("created_again"),
        F.lit(spark.table(name).count()).cast("bigint").alias("rows"),
        F.lit(types).alias("types"),
        F.count(F.lit(1)).alias("source_rows"),
    )


@query("""
SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders
UNION ALL SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_totalprice > 250000
""")
def append_load(spark: SparkSession, folder: str) -> DataFrame:
    """An append whose columns come in another order."""
    name = f"{fresh_database(spark, 'append')}.orders"
    orders = table(spark, folder, "orders")
    orders.select("o_orderkey", "o_totalprice", "o_orderstatus").write.saveAsTable(name)
    large = orders.filter("o_totalprice > 250000")
    tables.append(large.select("o_orderstatus", "o_orderkey", "o_totalprice"), name)
    return spark.table(name)


@query("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_totalprice > 250000")
def overwrite_load(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of a table replaced, its columns kept."""
    name = f"{fresh_database(spark, 'overwrite')}.orders"
    orders = table(spark, folder, "orders")
    orders.select("o_orderkey", "o_totalprice", "o_orderstatus").write.saveAsTable(name)
    tables.overwrite(orders.filter("o_totalprice > 250000"), name)
    return spark.table(name)


@query("""
SELECT 'good' AS load, count(*) AS expected_rows, count(*) AS actual_rows, true AS verification_passed,
    sum(o_orderkey)::BIGINT AS key_sum FROM orders
UNION ALL SELECT 'short', count(*), count(*) FILTER (o_totalprice > 250000), false, sum(o_orderkey)::BIGINT FROM orders
""")
def recreate_typed(spark: SparkSession, folder: str) -> DataFrame:
    """A verified table replaces the old one; one that fails to verify does not."""
    name = f"{fresh_database(spark, 'recreate')}.orders"
    orders = table(spark, folder, "orders")
    tables.create_text_table(orders, name)
    text = spark.table(name)
    types = {"o_orderkey": "NUMBER(18)", "o_custkey": "NUMBER(18)", "o_totalprice": "FLOAT", "o_orderdate": "DATE"}
    from millrace.operators.infer import apply_types

    typed = apply_types(text, types).drop("_bad_cells", "_changed_cells")
    staged = f"{name}_typed"
    typed.write.saveAsTable(staged)
    reports = []
    for label, rows in (("good", spark.table(staged)), ("short", spark.table(staged).filter("o_totalprice > 250000"))):
        outcome = tables.recreate(rows, name, expected_rows=text.count() if label == "good" else spark.table(name).count())
        reports.append(
            spark.table(name).agg(
                F.lit(label).alias("load"),
                F.lit(outcome["expected_rows"]).cast("bigint").alias("expected_rows"),
                F.lit(outcome["actual_rows"]).cast("bigint").alias("actual_rows"),
                F.lit(outcome["verification_passed"]).alias("verification_passed"),
                F.sum("o_orderkey").alias("key_sum"),
            )
        )
    return reduce(DataFrame.unionByName, reports)


@query("""
SELECT 'orders' AS table_name, count(*) AS rows_before, 0::BIGINT AS rows_after, 'success' AS status FROM orders
UNION ALL SELECT 'customer', count(*), 0, 'success' FROM customer
UNION ALL SELECT 'missing', NULL, NULL, 'failed'
""")
def truncate_report(spark: SparkSession, folder: str) -> DataFrame:
    """Rows removed from each table; a missing table fails alone."""
    database = fresh_database(spark, "truncate")
    names = ["orders", "customer"]
    for name in names:
        table(spark, folder, name).write.saveAsTable(f"{database}.{name}")
    report = tables.truncate_report(spark, [f"{database}.{n}" for n in [*names, "missing"]])
    short = F.element_at(F.split("table_name", "[.]"), -1)
    return report.select(short.alias("table_name"), "rows_before", "rows_after", "status")


@query("""
SELECT o_orderkey, o_totalprice, CASE WHEN o_orderdate < '1998-01-01' THEN NULL ELSE o_orderpriority END
    AS o_orderpriority FROM orders
""")
def schema_drift(spark: SparkSession, folder: str) -> DataFrame:
    """A column that only later files have is added to the table on the way."""
    name = f"{fresh_database(spark, 'drift')}.orders"
    orders = table(spark, folder, "orders")
    early, late = orders.filter("o_orderdate < '1998-01-01'"), orders.filter("o_orderdate >= '1998-01-01'")
    early.select("o_orderkey", "o_totalprice").write.saveAsTable(name)
    tables.load_with_drift(late.select("o_orderpriority", "o_orderkey", "o_totalprice"), name)
    return spark.table(name)


_RESULT_STATUS = "CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'warning' ELSE 'success' END"


@query(f"""
SELECT strftime(ts, '%Y-%m-%d') AS stage, count(*) AS total_tables,
    count(*) FILTER ({_RESULT_STATUS} = 'success') AS successful,
    count(*) FILTER ({_RESULT_STATUS} = 'warning') AS warnings,
    count(*) FILTER ({_RESULT_STATUS} = 'failed') AS failed,
    sum(CASE WHEN {_RESULT_STATUS} <> 'failed' THEN user_id ELSE 0 END)::BIGINT AS total_rows_loaded,
    sum(CASE WHEN {_RESULT_STATUS} <> 'failed' THEN user_id % 7 ELSE 0 END)::BIGINT AS total_columns,
    count(*) FILTER ({_RESULT_STATUS} <> 'failed') / count(*) * 100 AS completion_percentage
FROM events GROUP BY ALL
""")
def audit_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Events as load results in an audit table, rolled up by stage."""
    def write(path: str) -> None:
        data = F.to_json(
            F.struct(
                F.col("event_id").cast("string").alias("table_name"),
                F.expr(_RESULT_STATUS).alias("status"),
                F.col("user_id").alias("rows_loaded"),
                (F.col("user_id") % 7).alias("total_columns"),
            )
        )
        table(spark, folder, "events").select(
            F.col("ts").alias("timestamp"), F.lit("INFO").alias("level"),
            F.to_date("ts").cast("string").alias("stage"), data.alias("data"),
        ).write.parquet(path)

    rows = spark.read.parquet(landed(spark, folder, "audit", write))
    return audit.audit_summary(audit.results_of(rows), "stage")


@query(f"""
SELECT t.c_name AS table_name, coalesce(max(event_id) FILTER ({_RESULT_STATUS} = 'success'), max(event_id)) AS position,
    CASE WHEN max(event_id) IS NULL THEN 'missing' WHEN count(*) FILTER ({_RESULT_STATUS} = 'success' AND event_id IS NOT NULL) > 0
        THEN 'ok' ELSE 'not_success' END AS verdict
FROM customer t LEFT JOIN events e ON t.c_name = 'Customer#' || lpad(e.user_id::VARCHAR, 9, '0')
GROUP BY t.c_name
""")
def mapping_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as tables, events as their mappings: the newest success applies."""
    names = table(spark, folder, "customer").select(F.col("c_name").alias("table_name")).distinct()
    mappings = table(spark, folder, "events").select(
        F.concat(F.lit("Customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("table_name"),
        F.col("event_id").alias("position"),
        F.expr(_RESULT_STATUS).alias("status"),
    )
    return audit.mapping_lookup(names, mappings)


@query("""
SELECT 'lines' AS table_name, 'success' AS status, count(*) AS rows_loaded,
    sum(l_linenumber)::BIGINT AS number_sum, 'bigint' AS key_type
FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
UNION ALL SELECT 'clients', 'warning', count(*), sum(c_nationkey)::BIGINT, 'bigint' FROM customer
UNION ALL SELECT 'nothing', 'failed', 0, NULL, NULL
""")
def full_run(spark: SparkSession, folder: str) -> DataFrame:
    """Three tables from raw files to verified tables: one complete, one larger than estimated,
    one without a file."""
    def write(path: str) -> None:
        lines = table(spark, folder, "lineitem")
        write_csv(
            lines.select(
                F.concat(F.lit(" "), "l_orderkey", F.lit(" ")).alias("Order ID"),
                F.col("l_linenumber").alias("Line Number"),
                *[c for c in lines.columns if c not in ("l_orderkey", "l_linenumber")],
            ),
            f"{path}/LINES.CSV",
        )
        customers = table(spark, folder, "customer")
        write_csv(customers.withColumnsRenamed({"c_custkey": "Client ID", "c_nationkey": "Nation Number"}),
                  f"{path}/clients.csv")

    inbox = landed(spark, folder, "inbox", write)
    database = fresh_database(spark, "run")
    order = (
        "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
        "l_partkey", "l_suppkey",
    )
    specs = [
        TableSpec("lines", "lines", "Order ID + Line Number", composite=True, order_by=order),
        TableSpec("clients", "clients", "Client ID", order_by=("c_name",), expected_rows=1),
        TableSpec("nothing", "nothing"),
    ]
    results = run_tables(spark, specs, inbox, database)
    keys = {"lines": ("Line_Number", "Order_ID"), "clients": ("Nation_Number", "Client_ID")}
    sums = reduce(
        DataFrame.unionByName,
        [
            spark.table(f"{database}.{name}").agg(
                F.lit(name).alias("table_name"),
                F.sum(number).cast("bigint").alias("number_sum"),
                F.max(F.typeof(key)).alias("key_type"),
            )
            for name, (number, key) in keys.items()
        ],
    )
    return results.join(sums, "table_name", "left").select(
        "table_name", "status", "rows_loaded", "number_sum", "key_type"
    )


_LIFE_SQL = f"""
WITH f AS (SELECT {PROJECT_FILE} AS batch, count(*) AS parsed, count(*) FILTER ({_BAD}) AS bad FROM orders GROUP BY ALL)
SELECT 'first load' AS step, count(*) AS files, sum(parsed - bad)::BIGINT AS rows_loaded,
    count(*) FILTER (bad > 0) AS partial, 0::BIGINT AS failed FROM f
UNION ALL SELECT 'nothing new', 0, 0, 0, 0
UNION ALL SELECT 'forced', count(*), sum(parsed - bad)::BIGINT, count(*) FILTER (bad > 0), 0 FROM f
UNION ALL SELECT 'skipped', count(*), sum(CASE WHEN bad = 0 THEN parsed ELSE 0 END)::BIGINT, 0,
    count(*) FILTER (bad > 0) FROM f"""


@query(_LIFE_SQL)
def load_lifecycle(spark: SparkSession, folder: str) -> DataFrame:
    """A load, a load with nothing new, a forced reload and one that fails for the files with bad rows,
    as the load history tells them."""
    database = fresh_database(spark, "life")
    name, history = _empty_project_table(spark, database), f"{database}.history"
    load.create_history(spark, history)
    inbox = project_csv(spark, folder)
    cells = ", ".join(f"{c} string" for c in PROJECT_COLUMNS)
    options = {**BULK_LOAD.reader_options(), "enforceSchema": "true"}

    def load_paths(on_error: str):
        def run(paths: list[str], files: DataFrame) -> None:
            rows = spark.read.schema(cells).options(**options).csv(paths)
            raw = rows.select(F.col("_metadata.file_path").alias("path"), *[
                null_if(F.col(c), BULK_LOAD.null_tokens).alias(f"_{i + 1}") for i, c in enumerate(PROJECT_COLUMNS)
            ])
            load.bulk_load(raw, PROJECT_FIELDS, name, "path", on_error, history_table=history, files=files)

        return run

    steps = [("first load", "continue", False), ("nothing new", "continue", False), ("forced", "continue", True), ("skipped", "skip_file", True)]
    told = []
    for step, on_error, force in steps:
        load.load_new_files(spark, inbox, name, history, load_paths(on_error), force=force)
        # What a step added to the history: its totals less those before it.
        totals = spark.table(history).agg(
            F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("rows_loaded"), F.lit(0)).alias("rows_loaded"),
            F.count_if(F.col("status") == "PARTIALLY_LOADED").alias("partial"),
            F.count_if(F.col("status") == "LOAD_FAILED").alias("failed"),
        ).first()
        before = told[-1][1] if told else (0, 0, 0, 0)
        told.append((step, tuple(totals), tuple(a - b for a, b in zip(totals, before, strict=True))))
    # The history agrees with what is in the table.
    assert spark.table(name).count() == told[-1][1][1]
    return spark.createDataFrame(
        [(step, *added) for step, _, added in told],
        "step string, files bigint, rows_loaded bigint, partial bigint, failed bigint",
    )


_HISTORY_SQL = """
SELECT 'file_' || event_id || '.csv' AS file_name, 'table_' || (user_id % 7) AS table_name,
    CASE event_type WHEN 'error' THEN 'LOAD_FAILED' WHEN 'signup' THEN 'PARTIALLY_LOADED' ELSE 'LOADED' END
        AS status,
    CASE event_type WHEN 'error' THEN 0 ELSE user_id END AS rows_loaded, user_id AS rows_parsed,
    CASE event_type WHEN 'error' THEN user_id ELSE 0 END AS rows_rejected,
    CASE event_type WHEN 'error' THEN user_id ELSE 0 END AS error_count,
    CASE event_type WHEN 'error' THEN 'bad value ' || props END AS first_error, ts AS last_load_time
FROM {0}"""
_AS_OF = datetime(2024, 1, 30, 23, 30)


def _history(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(_HISTORY_SQL.format("{events}"), events=table(spark, folder, "events"))


@query(f"""
SELECT * FROM ({_HISTORY_SQL.format('events')}) WHERE table_name = 'table_3'
AND last_load_time BETWEEN TIMESTAMP '2024-01-29 23:30:00' AND TIMESTAMP '2024-01-30 23:30:00'
""")
def load_history(spark: SparkSession, folder: str) -> DataFrame:
    """The last 24 hours of one table."""
    return load.load_history(_history(spark, folder), _AS_OF, "table_3")


@query(f"""
SELECT file_name, first_error, error_count, last_load_time FROM ({_HISTORY_SQL.format('events')})
WHERE status = 'LOAD_FAILED'
AND last_load_time BETWEEN TIMESTAMP '2024-01-30 22:30:00' AND TIMESTAMP '2024-01-30 23:30:00'
""")
def failed_loads(spark: SparkSession, folder: str) -> DataFrame:
    """Failures of the last hour with their first error."""
    return load.failed_loads(_history(spark, folder), _AS_OF)

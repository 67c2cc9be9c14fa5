"""Queries over reconciliation, inspection and merging."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.casts import stringify
from millrace.operators import merge, profile as inspect, tables, verify
from millrace.plans.cleaning import CUSTOMER_DIRTY, dirty_customer
from millrace.plans.landing import PROJECT_COLUMNS, landed, project_csv
from millrace.plans.loading import PROJECT_FIELDS, _BAD
from millrace.plans.registry import query, table
from millrace.operators.load import bulk_load, create_target
from millrace.sources.csv import BULK_LOAD, read_csv
from millrace.sources.files import list_files, partition_value
from millrace.workspace import fresh_database

TABLES = {
    "region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11,
    "events": 6, "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2, "labels": 3,
    "conversations": 4,
}


def _counts(spark: SparkSession, folder: str, names) -> DataFrame:
    return verify.table_counts({n: table(spark, folder, n) for n in names})


@query(" UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count, {c}::INTEGER AS column_count FROM {n}"
    for n, c in TABLES.items()
))
def verify_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and columns of every table."""
    return _counts(spark, folder, TABLES)


# What other tables lead one to expect: every key they refer to.
_REFERENCES = {
    "orders": ("lineitem", "l_orderkey"), "customer": ("orders", "o_custkey"),
    "part": ("lineitem", "l_partkey"), "supplier": ("lineitem", "l_suppkey"),
}


def _expected(spark: SparkSession, folder: str) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [
            table(spark, folder, source).agg(
                F.lit(name).alias("table_name"), F.count_distinct(key).alias("expected_rows")
            )
            for name, (source, key) in _REFERENCES.items()
        ],
    )


_EXPECTED_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(DISTINCT {k}) AS expected_rows, (SELECT count(*) FROM {n})"
    f" AS actual_rows FROM {s}"
    for n, (s, k) in _REFERENCES.items()
)


@query(f"""
SELECT *, CASE WHEN expected_rows = actual_rows THEN 'success' ELSE 'warning' END AS status
FROM ({_EXPECTED_SQL})
UNION ALL SELECT 'returns', count(*), NULL, 'failed' FROM lineitem WHERE l_returnflag = 'R'
""")
def verify_estimate(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of a table against the number of keys other tables refer to; one table was never loaded."""
    returns = table(spark, folder, "lineitem").filter("l_returnflag = 'R'").agg(
        F.lit("returns").alias("table_name"), F.count(F.lit(1)).alias("expected_rows")
    )
    expected = _expected(spark, folder).unionByName(returns)
    return verify.verify_estimate(_counts(spark, folder, _REFERENCES), expected)


@query(f"""
SELECT 'projects' AS table_name, count(*) AS expected_rows, count(*) FILTER (NOT {_BAD}) AS actual_rows,
    count(*) FILTER ({_BAD}) = 0 AS row_count_match, 5::INTEGER AS column_count,
    count(*) FILTER (NOT {_BAD}) / count(*) * 100 AS match_percentage,
    count(*) FILTER ({_BAD}) = 0 AS verification_passed
FROM orders
UNION ALL SELECT 'copy', count(*), count(*), true, 6, 100.0::DOUBLE, true FROM orders
""")
def verify_source(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of landed files against rows that arrived in the tables."""
    database = fresh_database(spark, "verify")
    create_target(spark, f"{database}.projects", PROJECT_FIELDS)
    raw = read_csv(spark, project_csv(spark, folder), BULK_LOAD, names=PROJECT_COLUMNS)
    renamed = raw.withColumnsRenamed({c: f"_{i + 1}" for i, c in enumerate(PROJECT_COLUMNS)})
    bulk_load(renamed, PROJECT_FIELDS, f"{database}.projects", "batch")
    table(spark, folder, "orders").write.saveAsTable(f"{database}.copy")
    counts = verify.table_counts({n: spark.table(f"{database}.{n}") for n in ("projects", "copy")})
    expected = verify.table_counts({"projects": raw, "copy": table(spark, folder, "orders")})
    return verify.verify_source(
        counts, expected.select("table_name", F.col("row_count").alias("expected_rows"))
    )


@query(f"""
WITH t AS (SELECT table_name, expected_rows, true AS table_exists, actual_rows > 0 AS has_data,
        expected_rows = actual_rows AS count_match FROM ({_EXPECTED_SQL})
    UNION ALL SELECT 'returns', count(*), false, false, false FROM lineitem WHERE l_returnflag = 'R')
SELECT *, (SELECT bool_and(table_exists AND count_match) FROM t) AS overall_success FROM t
""")
def verify_all(spark: SparkSession, folder: str) -> DataFrame:
    """Each expected table: there, filled, complete; one of them was never loaded."""
    database = fresh_database(spark, "verifyall")
    for name in _REFERENCES:
        table(spark, folder, name).write.saveAsTable(f"{database}.{name}")
    wanted = [*_REFERENCES, "returns"]
    found = verify.existing_tables(spark, [f"{database}.{n}" for n in wanted])
    counts = verify.table_counts({n.split(".")[1]: df for n, df in found.items()})
    returns = table(spark, folder, "lineitem").filter("l_returnflag = 'R'").agg(
        F.lit("returns").alias("table_name"), F.count(F.lit(1)).alias("expected_rows")
    )
    return verify.verify_all(counts, _expected(spark, folder).unionByName(returns))


@query("""
SELECT 'orders' AS table_name, count(*) AS row_count, 'success' AS status FROM orders
UNION ALL SELECT 'unknown_state', count(*), 'warning' FROM orders WHERE o_orderstatus = 'X'
UNION ALL SELECT 'missing', 0, 'error'
""")
def verify_nonempty(spark: SparkSession, folder: str) -> DataFrame:
    """A filled, an empty and a missing table."""
    database = fresh_database(spark, "nonempty")
    orders = table(spark, folder, "orders")
    orders.write.saveAsTable(f"{database}.orders")
    orders.filter("o_orderstatus = 'X'").write.saveAsTable(f"{database}.unknown_state")
    names = ["orders", "unknown_state", "missing"]
    found = verify.existing_tables(spark, [f"{database}.{n}" for n in names])
    counts = verify.table_counts({n.split(".")[1]: df for n, df in found.items()})
    wanted = spark.createDataFrame([(n,) for n in names], "table_name string")
    return verify.verify_nonempty(counts, wanted)


@query("""
SELECT source || '_' || lang || '.csv' AS name, count(l.doc_id) > 0 AS present
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id AND l.quality = 1 GROUP BY ALL
""")
def verify_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """One cleaned file is expected per source and language; only some have good documents."""
    name = F.concat_ws("", F.concat_ws("_", "source", "lang"), F.lit(".csv")).alias("name")
    documents = table(spark, folder, "documents")

    def write(path: str) -> None:
        good = table(spark, folder, "labels").filter("quality = 1").select("doc_id").distinct()
        kept = documents.join(good, "doc_id", "left_semi")
        kept.select("doc_id", name).write.partitionBy("name").option("header", "true").csv(path)

    listing = list_files(spark, landed(spark, folder, "outputs", write))
    written = listing.select(partition_value(F.col("path"), "name").alias("name"))
    return verify.verify_outputs(documents.select(name).distinct(), written)


_ALTERED = """
SELECT o_orderkey, o_custkey, o_orderstatus,
    CASE WHEN o_orderkey % 1009 = 5 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
    o_orderdate, o_orderpriority
FROM orders WHERE o_totalprice < 499000
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_totalprice < 1500"""
_COMPARED = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query(f"""
WITH l AS (SELECT {', '.join(_COMPARED)} FROM orders), r AS ({_ALTERED})
SELECT *, 'only_left' AS side, count(*) AS copies FROM (SELECT * FROM l EXCEPT ALL SELECT * FROM r) GROUP BY ALL
UNION ALL
SELECT *, 'only_right' AS side, count(*) AS copies FROM (SELECT * FROM r EXCEPT ALL SELECT * FROM l) GROUP BY ALL
""")
def table_diff(spark: SparkSession, folder: str) -> DataFrame:
    """A table against a copy with changed, missing and repeated rows."""
    orders = table(spark, folder, "orders")
    altered = spark.sql(_ALTERED.replace("FROM orders", "FROM {orders}"), orders=orders)
    return verify.table_diff(orders.select(*_COMPARED), altered)


@query("""
WITH o AS (SELECT 'orders' AS table_name, concat_ws('|', '=' || o_orderkey, '=' || o_custkey,
        '=' || o_orderstatus, '=' || o_totalprice, '=' || o_orderdate, '=' || o_orderpriority) AS row FROM orders
    UNION ALL SELECT 'documents', concat_ws('|', '=' || doc_id, '=' || text, '=' || lang, '=' || source,
        '=' || n_chars) FROM documents)
SELECT table_name, count(*) AS row_count, sum(('0x' || substr(md5(row), 1, 16))::UBIGINT)::VARCHAR || '-'
    || sum(('0x' || substr(md5(row), 17, 16))::UBIGINT)::VARCHAR AS checksum
FROM o GROUP BY ALL
""")
def table_checksum(spark: SparkSession, folder: str) -> DataFrame:
    """Checksums of two tables, the same in any row order."""
    names = ("orders", "documents")
    sums = [verify.table_checksum(stringify(table(spark, folder, n)), n) for n in names]
    return reduce(DataFrame.unionByName, sums)


@query("""
SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE l_orderkey END AS l_orderkey, l_linenumber,
    count(*) AS row_count, CASE WHEN l_linenumber = 7 THEN 'null_key' ELSE 'duplicate_key' END AS violation
FROM lineitem GROUP BY ALL HAVING count(*) > 1 OR l_linenumber = 7
""")
def pk_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Keys held by several line items, and keys made null."""
    key = F.expr("CASE WHEN l_linenumber = 7 THEN NULL ELSE l_orderkey END")
    lines = table(spark, folder, "lineitem").withColumn("l_orderkey", key)
    return verify.pk_violations(lines, ["l_orderkey", "l_linenumber"])


_DIRTY_VIEW = "SELECT " + ", ".join(f"{e} AS {c}" for c, e in CUSTOMER_DIRTY.items()) + " FROM customer"
_PROFILED = {
    "c_custkey": None, "c_name": "c_name = ''", "c_mktsegment": "c_mktsegment = ''", "c_acctbal": None,
}


@query(" UNION ALL ".join(
    f"SELECT 'customer' AS table_name, '{c}' AS column_name, count(*) AS row_count,"
    f" count(*) - count({c}) AS null_count, {f'count(*) FILTER ({e})' if e else '0::BIGINT'} AS empty_count"
    f" FROM (SELECT c_custkey, CASE WHEN c_name = '  ' THEN '' ELSE c_name END AS c_name,"
    f" CASE WHEN c_mktsegment = ' ' THEN '' ELSE c_mktsegment END AS c_mktsegment, c_acctbal FROM ({_DIRTY_VIEW}))"
    for c, e in _PROFILED.items()
))
def profile(spark: SparkSession, folder: str) -> DataFrame:
    """Nulls and empty texts of every column."""
    rows = dirty_customer(spark, folder)
    for column, blank in (("c_name", "  "), ("c_mktsegment", " ")):
        emptied = F.when(F.col(column) == blank, F.lit("")).otherwise(F.col(column))
        rows = rows.withColumn(column, emptied)
    return inspect.profile(rows, "customer")


_TYPES = {
    "orders": {"bigint": ["o_orderkey", "o_custkey"], "string": ["o_orderstatus", "o_orderpriority"],
               "double": ["o_totalprice"], "timestamp_ntz": ["o_orderdate"]},
    "documents": {"bigint": ["doc_id", "n_chars"], "string": ["text", "lang", "source"]},
}


@query(" UNION ALL ".join(
    f"SELECT '{kind}' AS dtype, '{t}' AS table_name, {len(columns)}::BIGINT AS columns,"
    f" {sum(map(len, kinds.values()))}::INTEGER AS table_columns, count(*) AS table_rows,"
    f" {' + '.join(f'count({c})' for c in columns)} AS filled_cells FROM {t}"
    for t, kinds in _TYPES.items() for kind, columns in kinds.items()
))
def dtype_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Columns and filled cells per type, with the shape of the table."""
    return reduce(
        DataFrame.unionByName, [inspect.dtype_summary(table(spark, folder, t), t) for t in _TYPES]
    )


_CATALOGUED = [
    ("doc_id", "bigint", 19, 0, None), ("text", "string", None, None, "text"),
    ("lang", "string", None, None, "lang"), ("source", "string", None, None, "source"),
    ("n_chars", "bigint", 19, 0, None),
]


def _or_null(value, kind: str) -> str:
    return f"{'NULL' if value is None else value}::{kind}"


@query(" UNION ALL ".join(
    f"SELECT 'documents' AS table_name, {i + 1}::INTEGER AS ordinal_position, '{name}' AS column_name,"
    f" '{kind}' AS data_type, 'YES' AS is_nullable, NULL::VARCHAR AS column_default,"
    f" NULL::INTEGER AS character_maximum_length, {_or_null(digits, 'INTEGER')} AS numeric_precision,"
    f" {_or_null(scale, 'INTEGER')} AS numeric_scale, count(*) - count({name}) AS null_cells,"
    f" {f'max(length({text}))' if text else 'NULL'}::INTEGER AS longest_value FROM documents"
    for i, (name, kind, digits, scale, text) in enumerate(_CATALOGUED)
))
def column_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """The column catalogue of a table, with what its rows show."""
    return inspect.column_catalog(table(spark, folder, "documents"), "documents")


@query("""
WITH sales AS (SELECT CASE WHEN o_orderkey % 97 <> 3 THEN o_orderkey END AS item_id, o_orderpriority AS name,
    o_totalprice AS amount FROM orders WHERE o_orderstatus <> 'P'),
delivery AS (SELECT CASE WHEN l_orderkey % 89 <> 2 THEN l_orderkey END AS item_id, true AS there, count(*) AS items, sum(l_quantity::BIGINT)::BIGINT AS amount
    FROM lineitem GROUP BY ALL)
SELECT coalesce(s.item_id, d.item_id) AS item_id, name, s.amount AS amount_sales, items,
    d.amount AS amount_delivery, CASE WHEN d.there IS NULL THEN 'left' WHEN s.name IS NULL THEN 'right'
    ELSE 'both' END AS origin
FROM sales s FULL JOIN delivery d ON s.item_id = d.item_id
""")
def merge_boards(spark: SparkSession, folder: str) -> DataFrame:
    """Settled orders as the sales board and shipments per order as the delivery board."""
    sales = table(spark, folder, "orders").filter("o_orderstatus <> 'P'").select(
        F.expr("CASE WHEN o_orderkey % 97 <> 3 THEN o_orderkey END").alias("item_id"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_totalprice").alias("amount"),
    )
    key = F.expr("CASE WHEN l_orderkey % 89 <> 2 THEN l_orderkey END").alias("item_id")
    delivery = table(spark, folder, "lineitem").groupBy(key).agg(
        F.count(F.lit(1)).alias("items"), F.sum(F.col("l_quantity").cast("bigint")).alias("amount")
    )
    return merge.merge_boards(sales, delivery, "item_id")

"""Queries over the cases that loads meet now and then: odd headers, values a cast alters, repeated runs."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators import audit, calendar as cal, infer, load, profile as inspect, verify
from millrace.plans.landing import landed
from millrace.plans.loading import _AS_OF, _HISTORY_SQL, _history
from millrace.plans.registry import query, table
from millrace.plans.run import run_tables
from millrace.sources import files, nested
from millrace.sources.csv import read_csv, read_csv_by_name, spread, write_csv
from millrace.spec import TableSpec
from millrace.streaming.incremental import clean_new_files, csv_stream
from millrace.workspace import fresh_database, fresh_folder


@query("""
SELECT 'orders' AS table_name, count(*) AS row_count, sum(o_orderkey)::BIGINT AS key_sum FROM orders
UNION ALL SELECT 'lineitem', count(*), sum(l_orderkey)::BIGINT FROM lineitem
UNION ALL SELECT 'none', NULL, NULL
UNION ALL SELECT 'missing', NULL, NULL
UNION ALL SELECT 'broken', NULL, NULL
""")
def extract_all(spark: SparkSession, folder: str) -> DataFrame:
    """Every table of a database, whole; an empty, a missing and an unreadable one are noted."""
    database = fresh_database(spark, "extract")
    orders = table(spark, folder, "orders")
    orders.write.saveAsTable(f"{database}.orders")
    table(spark, folder, "lineitem").write.saveAsTable(f"{database}.lineitem")
    orders.filter("o_orderstatus = 'X'").write.saveAsTable(f"{database}.none")
    spark.sql(f"CREATE VIEW {database}.broken AS SELECT * FROM {database}.none")
    spark.sql(f"DROP TABLE {database}.none")
    orders.filter("o_orderstatus = 'X'").select("o_orderkey").withColumnRenamed("o_orderkey", "other").write.saveAsTable(
        f"{database}.none"
    )
    found = nested.extract_tables(spark, database, {"missing": ["id"]})
    keys = {"orders": "o_orderkey", "lineitem": "l_orderkey"}
    parts = [
        rows.agg(
            F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("row_count"), F.sum(keys[n]).cast("bigint").alias("key_sum")
        )
        for n, rows in found.tables.items()
    ]
    noted = spark.createDataFrame([(n, None, None) for n in found.problems], "table_name string, row_count bigint, key_sum bigint")
    return reduce(DataFrame.unionByName, [*parts, noted])


@query("""
SELECT o_orderkey::VARCHAR AS o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice::VARCHAR END AS o_totalprice,
    o_orderpriority, CASE WHEN o_orderstatus = 'F' THEN o_custkey::VARCHAR END AS o_custkey,
    CASE WHEN o_orderstatus = 'P' THEN 'a' || o_custkey WHEN o_orderstatus = 'O' THEN 'b' || o_custkey END AS "Memo",
    CASE WHEN o_orderstatus = 'P' THEN 'c' || o_custkey WHEN o_orderstatus = 'O' THEN 'd' || o_custkey END AS "Memo.1"
FROM orders
""")
def csv_mixed_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Files with their columns in another order, with fewer columns, and with a repeated name in two places,
    each read by its own header."""
    layouts = {
        "F": ["o_orderkey", "o_totalprice", "o_orderpriority", "o_custkey"],
        "O": ["Memo", "o_orderpriority", "o_orderkey", "o_totalprice", "Memo"],
        "P": ["Memo", "Memo", "o_orderpriority", "o_orderkey"],
    }
    memos = {"P": ("a", "c"), "O": ("b", "d")}

    def write(path: str) -> None:
        for status, columns in layouts.items():
            rows = table(spark, folder, "orders").filter(F.col("o_orderstatus") == status)
            prefixes = iter(memos.get(status, ()))
            cells = [
                F.concat(F.lit(next(prefixes)), F.col("o_custkey").cast("string")) if c == "Memo" else F.col(c).cast("string") for c in columns
            ]
            # Lines of text, since a frame with a repeated name cannot be written; a file is one task's.
            lines = rows.select(F.concat_ws(",", *cells).alias("line"), (F.col("o_orderkey") % 7).alias("file"))
            headed = lines.select("file").distinct().select(F.lit(",".join(columns)).alias("line"), "file", F.lit(0).alias("place"))
            files = lines.withColumn("place", F.lit(1)).unionByName(headed).repartition("file").sortWithinPartitions("file", "place")
            files.select("line", "file").write.partitionBy("file").text(f"{path}/{status}")

    return read_csv_by_name(spark, landed(spark, folder, "mixed-headers", write))


@query("""
SELECT count(*) AS rows, sum(bad)::BIGINT AS bad_cells, sum(changed)::BIGINT AS changed_cells,
    sum(whole)::BIGINT AS whole_sum, count(short) AS short_values, min(day)::VARCHAR AS first_day
FROM (SELECT CASE WHEN o_orderkey >= 1000 THEN 1 ELSE 0 END AS bad,
    (CASE WHEN round(o_totalprice) <> o_totalprice THEN 1 ELSE 0 END)
        + (CASE WHEN o_custkey < 100000 THEN 1 ELSE 0 END)
        + (CASE WHEN o_orderkey % 24 <> 0 THEN 1 ELSE 0 END)
        + (CASE WHEN o_orderkey % 2 = 1 AND o_orderkey % 10 <> 0 THEN 1 ELSE 0 END)
        + (CASE WHEN o_custkey < 100000 THEN 1 ELSE 0 END) AS changed,
    round(o_totalprice::DECIMAL(18, 4))::BIGINT AS whole, CASE WHEN o_orderkey < 1000 THEN o_orderkey END AS short,
    o_orderdate::DATE AS day FROM orders)
""")
def changed_values(spark: SparkSession, folder: str) -> DataFrame:
    """What casts lose (numbers too long for their type) and alter: fractions, leading zeros, times of day, and
    digits beyond a double's precision."""
    hour = "lpad(CAST(o_orderkey % 24 AS STRING), 2, '0')"
    text = table(spark, folder, "orders").select(
        F.col("o_totalprice").cast("string").alias("whole"),
        F.lpad(F.col("o_custkey").cast("string"), 6, "0").alias("zip"),
        F.col("o_orderkey").cast("string").alias("short"),
        F.expr(f"substring(CAST(o_orderdate AS STRING), 1, 10) || ' ' || {hour} || ':00:00'").alias("day"),
        # From 2^53 on every other whole number is no double.
        F.expr("CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderkey + 9007199254740992 AS STRING) END").alias("number"),
        F.lpad(F.col("o_custkey").cast("string"), 6, "0").alias("code"),
    )
    types = {"whole": "NUMBER(10)", "zip": "NUMBER(10)", "short": "NUMBER(3)", "day": "DATE", "number": "FLOAT", "code": "FLOAT"}
    return infer.apply_types(text, types).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("_bad_cells").alias("bad_cells"), F.sum("_changed_cells").alias("changed_cells"),
        F.sum("whole").alias("whole_sum"), F.count("short").alias("short_values"), F.min("day").cast("string").alias("first_day"),
    )


@query("""
SELECT 'short' AS mode, count(*) AS parsed, count(*) FILTER (o_orderkey >= 1000) AS rejected,
    count(*) FILTER (o_orderkey < 1000) AS loaded, 'not a NUMBER(3)' AS reason FROM orders
""")
def load_long_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """A number with more digits than its column has is a reject."""
    name = f"{fresh_database(spark, 'long')}.short"
    spark.sql(f"CREATE TABLE {name} (short BIGINT) USING parquet")
    raw = table(spark, folder, "orders").select(F.lit("f").alias("file"), F.col("o_orderkey").cast("string").alias("short"))
    result = load.bulk_load(raw, [load.Field("short", "NUMBER(3)")], name, "file")
    reason = result.rejects.agg(F.max("reason").alias("reason"))
    return result.history.select(
        F.lit("short").alias("mode"), F.col("rows_parsed").alias("parsed"), F.col("rows_rejected").alias("rejected"),
        F.lit(spark.table(name).count()).cast("bigint").alias("loaded"), F.lit(reason.first()[0]).alias("reason"),
    )


@query("""
SELECT 'clients' AS table_name, 'warning' AS status, count(*) FILTER (c_custkey < 10000) || ' cells changed' AS error,
    count(*) AS rows_loaded, 6::BIGINT AS total_columns, round(sum(c_acctbal), 2) AS balance, count(DISTINCT "memo1")::BIGINT AS memos
FROM (SELECT *, 'second ' || c_nationkey AS memo1 FROM customer)
""")
def run_with_warnings(spark: SparkSession, folder: str) -> DataFrame:
    """A whole run over files with a repeated header, fractions in a column that sounds like an id, and
    leading zeros: the fractions stay, and the zeros that a cast drops are told."""
    def write(path: str) -> None:
        rows = table(spark, folder, "customer").select(
            F.col("c_custkey").cast("string").alias("Client ID"), F.col("c_acctbal").cast("string").alias("Amount Paid"),
            F.lpad(F.col("c_custkey").cast("string"), 5, "0").alias("Zip Code"), F.col("c_name").alias("Client.Label"),
            F.concat(F.lit("first "), "c_mktsegment").alias("m0"), F.concat(F.lit("second "), "c_nationkey").alias("m1"),
        )
        header = "Client ID,Amount Paid,Zip Code,Client.Label,Memo,Memo"
        # Every task writes a file; the lower 33 bits of the id number the rows of a task, and the first brings the header.
        first = (F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0).alias("first")
        lines = spread(rows).select(F.concat_ws(",", *[F.col(f"`{c}`") for c in rows.columns]).alias("line"), first)
        headed = F.when(F.col("first"), F.array(F.lit(header), F.col("line"))).otherwise(F.array("line"))
        lines.select(F.explode(headed).alias("line")).write.options(
            sep="\u0001", quote="\u0000", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
        ).csv(f"{path}/clients.csv")

    inbox = landed(spark, folder, "repeated-header", write)
    database = fresh_database(spark, "warn")
    outcome = run_tables(spark, [TableSpec("clients", "clients", "Client ID", order_by=("Zip Code",))], inbox, database)
    sums = spark.table(f"{database}.clients").agg(F.sum("Amount_Paid").alias("balance"), F.count_distinct("Memo_1").alias("memos"))
    first = sums.first()
    return outcome.select(
        "table_name", "status", "error", "rows_loaded", "total_columns",
        F.round(F.lit(first.balance), 2).alias("balance"), F.lit(first.memos).cast("bigint").alias("memos"),
    )


@query("""
SELECT lang, count(*) AS texts FROM (
    SELECT lang, text FROM documents WHERE text IS NOT NULL AND trim(text, e' \\t\\n\\r') <> ''
    QUALIFY row_number() OVER (PARTITION BY text ORDER BY lang <> 'en', doc_id) = 1) GROUP BY ALL
""")
def stream_two_checkpoints(spark: SparkSession, folder: str) -> DataFrame:
    """Two streams into one target: the second adds what the first has not, and overwrites nothing."""
    inbox, target = fresh_folder(spark, "inboxes"), fresh_folder(spark, "shared-target")
    hidden = F.regexp_replace("text", "[\\x00-\\x1F]", " ")
    documents = table(spark, folder, "documents").select(
        F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("sort_key"), "lang", F.md5("text").alias("text"),
        (F.trim(hidden) != "").alias("filled"),
    ).filter("filled").drop("filled")
    spec = TableSpec("documents", primary_key="text", order_by=("sort_key",))
    for name, part in (("first", "lang = 'en'"), ("second", "lang <> 'en'")):
        write_csv(documents.filter(part), f"{inbox}/{name}")
        stream = csv_stream(spark, f"{inbox}/{name}", documents.columns)
        clean_new_files(stream, spec, target, fresh_folder(spark, f"progress-{name}"))
    return spark.read.parquet(target).groupBy("lang").agg(F.count(F.lit(1)).alias("texts"))


@query("""
WITH l AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders),
r AS (SELECT CASE WHEN o_orderkey % 1009 = 7 THEN NULL ELSE o_orderkey END AS o_orderkey, o_custkey, o_orderstatus,
    CASE WHEN o_orderkey % 1009 = 5 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders),
d AS (SELECT count(*) FILTER (side = 'l') AS a, count(*) FILTER (side = 'r') AS b FROM (
    SELECT 'l' AS side, * FROM (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM l EXCEPT ALL SELECT * FROM r)
    UNION ALL SELECT 'r', * FROM (SELECT * FROM r EXCEPT ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM l)))
SELECT 'missing_columns' AS "check", 1::BIGINT AS differences, 'o_orderdate' AS detail, false AS passed
UNION ALL SELECT 'additional_columns', 1, 'extra', false
UNION ALL SELECT 'retyped_columns', 1, 'o_orderpriority', false
UNION ALL SELECT 'rows_only_left', a, NULL, a = 0 FROM d
UNION ALL SELECT 'rows_only_right', b, NULL, b = 0 FROM d
UNION ALL SELECT 'key_violations', count(*), NULL, count(*) = 0 FROM (SELECT o_orderkey FROM r GROUP BY 1
    HAVING count(*) > 1 OR o_orderkey IS NULL)
""")
def table_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """A table against a copy with other columns, values and keys, in one report."""
    orders = table(spark, folder, "orders")
    copy = orders.selectExpr(
        "CASE WHEN o_orderkey % 1009 = 7 THEN NULL ELSE o_orderkey END AS o_orderkey", "o_custkey", "o_orderstatus",
        "CASE WHEN o_orderkey % 1009 = 5 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice",
        "length(o_orderpriority) AS o_orderpriority", "1 AS extra",
    )
    return verify.compare_tables(orders, copy, ["o_orderkey"])


@query("""
SELECT 'Customer_ID' AS clean_name, 'NUMBER(10)' AS inferred_type, 'bigint' AS applied, 0::BIGINT AS lost,
    count(*) AS row_count, 'ok' AS verdict FROM customer
UNION ALL SELECT 'Balance', 'VARCHAR(50)', 'string', 0, count(*), 'ok' FROM customer
""")
def saved_mapping(spark: SparkSession, folder: str) -> DataFrame:
    """Types that one run saves, looked up and applied to the next delivery without looking at its data."""
    def write(path: str) -> None:
        rows = table(spark, folder, "customer").select(
            F.col("c_custkey").cast("string").alias("Customer ID"), F.concat(F.lit("USD "), "c_acctbal").alias("Balance")
        )
        write_csv(rows, f"{path}/accounts.csv")

    inbox = landed(spark, folder, "accounts", write)
    database = fresh_database(spark, "mapping")
    mappings = f"{database}.column_mapping"
    run_tables(spark, [TableSpec("accounts", "accounts", "Customer ID", order_by=("Balance",))], inbox, database, mapping_table=mappings)
    types, names = infer.saved_mapping(spark.table(mappings), "accounts")
    again = infer.apply_types(read_csv(spark, f"{inbox}/accounts.csv"), types, names)
    lost = again.agg(F.sum("_bad_cells").cast("bigint").alias("lost"), F.count(F.lit(1)).alias("row_count"))
    wanted = spark.createDataFrame([("accounts",)], "table_name string")
    verdict = audit.mapping_lookup(wanted, spark.table(mappings)).select("verdict")
    kinds = spark.createDataFrame([(names[c], types[c], dict(again.dtypes)[names[c]]) for c in types], "clean_name string, inferred_type string, applied string")
    one = lost.first()
    return kinds.select(
        "*", F.lit(one.lost).cast("bigint").alias("lost"), F.lit(one.row_count).cast("bigint").alias("row_count"), F.lit(verdict.first()[0]).alias("verdict")
    )


_FILE_KEYS = 500_000  # orders whose rows may be in one file


@query("""
SELECT o_orderstatus AS part, count(*) AS lines, count(*) AS last_row, 1::BIGINT AS keys, true AS size_known,
    true AS dated, true AS scanned FROM orders GROUP BY ALL
""")
def file_provenance(spark: SparkSession, folder: str) -> DataFrame:
    """Of every file: lines, the last row's number, size, time of change, scan time, and a content key that
    a copy of the file shares and the same lines in another order do not. Summed up by part, whose rows lie in
    files of at most ``_FILE_KEYS`` keys, so that the task that puts a file in order holds no more."""
    def write(path: str) -> None:
        rows = table(spark, folder, "orders").select(
            F.concat_ws(",", "o_orderkey", "o_totalprice").alias("line"), F.col("o_orderstatus").alias("part"),
            F.floor(F.col("o_orderkey") / _FILE_KEYS).alias("chunk"), "o_orderkey",
        )
        copies = rows.withColumn("copy", F.explode(F.array(*map(F.lit, "abc"))))
        # Each file is written by one task, different files by different ones; the last copy is in reverse order.
        place = F.when(F.col("copy") == "c", -F.col("o_orderkey")).otherwise(F.col("o_orderkey"))
        file = ("copy", "part", "chunk")
        spread_out = copies.repartition(*file).sortWithinPartitions(*file, place)
        spread_out.select("line", *file).write.mode("append").partitionBy(*file).text(path)

    path = landed(spark, folder, "provenance", write)
    file = ["copy", "part", "chunk"]
    place = [files.partition_value(F.col("file_path"), k).alias(k) for k in file]
    keys = files.content_keys(spark, path, "*.txt").select(*place, "file_size", "file_modified", "lines", "content_key")
    numbered = files.with_row_numbers(spark.read.text(path).select("value", *files.provenance()))
    last = numbered.groupBy("file_path").agg(F.max("file_row_number").alias("last_row"), F.max("scan_started").alias("scanned"))
    rows = keys.join(last.select(*place, "last_row", "scanned"), file)
    by_file = rows.groupBy("part", "chunk").agg(
        F.max("lines").alias("lines"), F.max("last_row").alias("last_row"),
        F.count_distinct(F.when(F.col("copy") != "c", F.col("content_key"))).alias("keys"),
        F.bool_and(F.col("file_size") > 0).alias("size_known"), F.bool_and(F.col("file_modified").isNotNull()).alias("dated"),
        F.bool_and(F.col("scanned").isNotNull()).alias("scanned"),
    )
    ordered = by_file.groupBy("part").agg(
        F.sum("lines").alias("lines"), F.sum("last_row").alias("last_row"), F.max("keys").alias("keys"),
        *[F.bool_and(c).alias(c) for c in ("size_known", "dated", "scanned")],
    )
    return ordered


@query("""
SELECT 'name' AS column_name, 2::INTEGER AS ordinal_position, count(*) - count(c_name) AS null_cells, 3::INTEGER AS listed FROM customer
UNION ALL SELECT 'NAME', 2, count(*) - count(c_name), 1 FROM customer
""")
def find_columns(spark: SparkSession, folder: str) -> DataFrame:
    """A table described under its name in another case, one of its columns found in any case, and the
    last columns of its catalogue."""
    database = fresh_database(spark, "catalogue")
    rows = table(spark, folder, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), "c_mktsegment", "c_acctbal")
    rows.write.saveAsTable(f"{database}.clients")
    catalogue = inspect.describe_table(spark, f"{database}.CLIENTS")
    last = inspect.column_catalog(rows, "clients", last=3).count()
    wanted = [("name", last), ("NAME", inspect.find_column(catalogue, "NAME").count())]
    return reduce(
        DataFrame.unionByName,
        [
            inspect.find_column(catalogue, n).select(F.lit(n).alias("column_name"), "ordinal_position", "null_cells", F.lit(k).alias("listed"))
            for n, k in wanted
        ],
    )


@query("SELECT count(*) AS days, count(*) AS created, true AS same FROM (SELECT DISTINCT o_orderdate::DATE FROM orders)")
def audited_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """The calendar with times of creation and change, for the days that orders have."""
    span = cal.span_of(table(spark, folder, "orders"), "o_orderdate") or (date(2024, 1, 1), date(2024, 12, 31))
    dim = cal.date_dim(spark, *span, audit=True)
    days = table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("full_date")).distinct()
    return days.join(dim, "full_date").agg(
        F.count(F.lit(1)).alias("days"), F.count("created_timestamp").alias("created"),
        F.bool_and(F.col("created_timestamp") == F.col("updated_timestamp")).alias("same"),
    )


@query("SELECT 'o_orderkey' AS column_name, least(count(*), 500) AS rows, true AS fits FROM orders")
def sampled_types(spark: SparkSession, folder: str) -> DataFrame:
    """Types from a sample of rows, where a caller asks for one: as many rows as were asked for."""
    text = table(spark, folder, "orders").select(F.col("o_orderkey").cast("string").alias("o_orderkey"))
    found = infer.column_statistics(text, "orders", sample=500)
    return found.select("column_name", "rows", (F.col("numbers") == F.col("rows")).alias("fits"))


@query(f"""
SELECT file_name, last_load_time FROM ({_HISTORY_SQL.format('events')})
WHERE last_load_time BETWEEN TIMESTAMP '2024-01-29 23:30:00' AND TIMESTAMP '2024-01-30 23:30:00'
ORDER BY last_load_time DESC, file_name
""")
def ordered_history(spark: SparkSession, folder: str) -> DataFrame:
    """The loads of a day, newest first."""
    found = load.load_history(_history(spark, folder), _AS_OF)
    return found.select("file_name", "last_load_time").orderBy(F.desc("last_load_time"), "file_name")


@query("""
SELECT CASE WHEN o_orderstatus = 'F' THEN 'raw' ELSE 'cleaned' END AS kind, count(DISTINCT o_orderstatus || year(o_orderdate)) AS files,
    true AS has_bytes FROM orders GROUP BY ALL
""")
def file_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Raw and cleaned files; the folder ``file=name`` stands for a file."""
    name = "'orders_' || o_orderstatus || year(o_orderdate) || CASE WHEN o_orderstatus = 'F' THEN '_raw.csv' ELSE '.csv' END"

    def write(path: str) -> None:
        rows = table(spark, folder, "orders").select("o_orderkey", F.expr(name).alias("file"))
        write_csv(rows.repartition("file"), path, partition_by=("file",))

    listing = files.list_files(spark, landed(spark, folder, "inventory", write))
    one = listing.withColumn("name", files.partition_value(F.col("path"), "file")).groupBy("name").agg(F.sum("size").alias("size"))
    return audit.file_inventory(one).select("kind", "files", (F.col("bytes") > 0).alias("has_bytes"))


_EXACT = "o_orderkey % 10 <> 0"


@query(f"""
WITH o AS (SELECT *, o_totalprice::DECIMAL(18, 2) AS price FROM orders)
SELECT 'exact' AS run, 'success' AS status, NULL::VARCHAR AS error, sum(CASE WHEN {_EXACT} THEN o_orderkey + 9007199254740992 END)::VARCHAR AS number_sum,
    min(lpad(o_custkey::VARCHAR, 6, '0')) AS first_zip, sum((price + 12345678901234567)::DECIMAL(38, 2))::VARCHAR AS price_sum,
    'decimal(19,2),bigint' AS types FROM o
UNION ALL SELECT 'plain', 'warning', (count(*) FILTER ({_EXACT} AND o_orderkey % 2 = 1) + count(*) FILTER (o_custkey < 100000)
    + count(*) FILTER (price <> floor(price) OR price % 2 = 0)) || ' cells changed', NULL, NULL, NULL, 'double,double' FROM o
""")
def run_exact(spark: SparkSession, folder: str) -> DataFrame:
    """A whole run over numbers that doubles round and codes with zeros in front: kept to the digit, or told."""
    def write(path: str) -> None:
        rows = table(spark, folder, "orders").select(
            F.col("o_orderkey").cast("string").alias("Order Ref"),
            F.expr(f"CASE WHEN {_EXACT} THEN CAST(o_orderkey + 9007199254740992 AS STRING) END").alias("Ledger Number"),
            F.lpad(F.col("o_custkey").cast("string"), 6, "0").alias("Zip Code"),
            (F.col("o_totalprice").cast("decimal(18,2)") + F.lit("12345678901234567.00").cast("decimal(19,2)")).cast("string").alias("Total Price"),
        )
        write_csv(rows, f"{path}/numbers.csv")

    inbox, told = landed(spark, folder, "numbers", write), []
    for run in ("exact", "plain"):
        database = fresh_database(spark, run)
        spec = TableSpec("numbers", "numbers", "Order Ref", order_by=("Zip Code",))
        outcome = run_tables(spark, [spec], inbox, database, exact=run == "exact").first()
        found = spark.table(f"{database}.numbers")
        kinds = ",".join(dict(found.dtypes)[c] for c in ("Total_Price", "Ledger_Number"))
        sums = found.agg(
            F.sum(F.col("Ledger_Number").cast("decimal(38,0)")).cast("string").alias("number_sum"), F.min("Zip_Code").cast("string").alias("first_zip"),
            F.sum("Total_Price").cast("string").alias("price_sum"),
        ).first()
        told.append((run, outcome.status, outcome.error, *(sums if run == "exact" else (None, None, None)), kinds))
    return spark.createDataFrame(told, "run string, status string, error string, number_sum string, first_zip string, price_sum string, types string")


@query("""
SELECT 'first' AS delivery, count(DISTINCT year(o_orderdate)) AS files_read, 'NUMBER(7)' AS key_type, 'FLOAT' AS price_type, true AS as_one_pass
    FROM orders WHERE o_orderdate < '1998-01-01'
UNION ALL SELECT 'second', count(DISTINCT year(o_orderdate)), 'VARCHAR(50)', 'FLOAT', true FROM orders WHERE o_orderdate >= '1998-01-01'
UNION ALL SELECT 'third', 0, 'VARCHAR(50)', 'FLOAT', true
""")
def incremental_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """Types after each delivery of files, of which only the new ones are read, against one pass over all of them."""
    inbox = fresh_folder(spark, "deliveries")
    database = fresh_database(spark, "statistics")
    orders = table(spark, folder, "orders")
    told = []
    for delivery, part in (("first", "o_orderdate < '1998-01-01'"), ("second", "o_orderdate >= '1998-01-01'"), ("third", None)):
        if part:
            key = F.col("o_orderkey") % 1000 + 100_000
            rows = orders.filter(part).select(
                (key.cast("string") if delivery == "first" else F.concat(F.lit("K"), key)).alias("order_number"),
                F.col("o_totalprice").cast("string").alias("total_price"), F.expr("year(o_orderdate)").alias("year"),
            )
            write_csv(rows.repartition("year"), f"{inbox}/{delivery}", partition_by=("year",))
        read_paths: list[str] = []

        def read(paths: list[str]) -> DataFrame:
            read_paths.extend(paths)
            rows = spark.read.schema("order_number string, total_price string").option("header", "true").csv(paths)
            return rows.select("order_number", "total_price", F.regexp_replace("_metadata.file_path", "^file:/+", "file:/").alias("path"))

        listing = files.list_files(spark, inbox)
        found = infer.statistics_with_new_files(spark, "orders", f"{database}.kept", listing, read, "path")
        types = infer.mapping_of(infer.infer_by_name_and_data(found))
        paths = [r.path for r in listing.select("path").collect()]
        read_before = len(read_paths)
        whole = infer.column_statistics(read(paths).drop("path"), "orders")
        same = sorted(map(tuple, found.collect())) == sorted(map(tuple, whole.collect()))
        told.append((delivery, read_before, types["order_number"], types["total_price"], same))
    return spark.createDataFrame(told, "delivery string, files_read bigint, key_type string, price_type string, as_one_pass boolean")

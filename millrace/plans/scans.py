"""Queries over sources: delimited files, listings, nested records, web events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.plans.landing import (
    CUSTOMER_NAME, CUSTOMER_RAW, customer_csv, landed,
)
from millrace.plans.registry import query, table
from millrace.operators.infer import read_typed
from millrace.sources import files, nested
from millrace.sources.csv import BULK_LOAD, MULTI_LINE, read_csv, spread, write_csv
from millrace.sources.web_report import REPORT_HEADERS, web_report
from millrace.workspace import fresh_database, fresh_folder

CUSTOMER_COLUMNS = list(CUSTOMER_RAW)
_CUSTOMER_CELLS = f"""
    {CUSTOMER_NAME} AS c_name,
    CASE WHEN c_custkey % 7 IN (0, 1) THEN NULL ELSE c_mktsegment END AS c_mktsegment"""


@query(f"""
SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_nationkey END::DOUBLE AS c_nationkey,
    CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal, {_CUSTOMER_CELLS}
FROM customer
""")
def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Reader defaults: null tokens, quoted line breaks, types found in the data."""
    return read_typed(read_csv(spark, customer_csv(spark, folder), MULTI_LINE))


@query(f"""
SELECT c_custkey::VARCHAR AS c_custkey,
    CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_nationkey END::VARCHAR AS c_nationkey,
    CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_acctbal END::VARCHAR AS c_acctbal, {_CUSTOMER_CELLS}
FROM customer
""")
def csv_scan_text(spark: SparkSession, folder: str) -> DataFrame:
    """Every column as text, ``nan`` among the null tokens."""
    return read_csv(spark, customer_csv(spark, folder), MULTI_LINE, names=CUSTOMER_COLUMNS)


# Lines as other programs write them: padded and short or long, some with the token NULL.
_BULK_CELLS = [
    "CAST(o_orderkey AS STRING)",
    "CASE WHEN o_orderkey % 3 = 0 THEN 'NULL' WHEN o_orderkey % 3 = 1 THEN ''"
    " ELSE CAST(o_custkey AS STRING) END",
    "'  ' || o_orderpriority || ' '",
    "'\"  ' || o_orderstatus || ', quoted \"'",
]


@query("""
SELECT o_orderkey::VARCHAR AS id,
    CASE WHEN o_orderkey % 3 = 2 THEN o_custkey::VARCHAR END AS customer,
    o_orderpriority AS priority,
    CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE '  ' || o_orderstatus || ', quoted ' END AS state
FROM orders
""")
def csv_format(spark: SparkSession, folder: str) -> DataFrame:
    """The bulk-load format: trimmed, three null tokens, any number of fields in a row."""
    def write(path: str) -> None:
        full = " || ',' || ".join(_BULK_CELLS)
        short = " || ',' || ".join(_BULK_CELLS[:3])
        line = F.expr(
            f"CASE WHEN o_orderkey % 17 = 0 THEN {short}"
            f" WHEN o_orderkey % 19 = 0 THEN {full} || ',surplus' ELSE {full} END"
        )
        # One raw column, written without quoting, gives lines of any shape below a header.
        lines = table(spark, folder, "orders").select(line.alias("id,customer,priority,state"))
        lines.write.option("header", "true").option("sep", "\u0001").option("quote", "\u0000").option(
            "ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)

    return read_csv(spark, landed(spark, folder, "bulk-csv", write), BULK_LOAD)


@query("""
SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey, o_orderstatus,
    o_totalprice::VARCHAR AS o_totalprice, o_orderdate::VARCHAR AS o_orderdate, o_orderpriority
FROM orders
""")
def csv_gzip(spark: SparkSession, folder: str) -> DataFrame:
    """Compressed files, spread over the cluster after reading as they cannot be split."""
    orders = table(spark, folder, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("string"))
    path = landed(spark, folder, "orders-gzip", lambda p: write_csv(orders, p, compression="gzip"))
    return spread(read_csv(spark, path, BULK_LOAD, names=orders.columns, glob="*.csv.gz"))


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate::VARCHAR AS o_orderdate,
    CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders
""")
def json_array_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Arrays of objects, null fields left out, one row per object."""
    def write(path: str) -> None:
        record = F.struct(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("string").alias("o_orderdate"),
            F.expr("CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_orderpriority END").alias("o_orderpriority"),
        )
        # Order keys are unique, so an array holds at most a hundred records.
        pages = table(spark, folder, "orders").groupBy(F.floor(F.col("o_orderkey") / 100)).agg(
            F.collect_list(record).alias("records")
        )
        pages.select(F.to_json("records")).write.text(path)

    return nested.read_json_array(
        spark, landed(spark, folder, "orders-json", write),
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate string,"
        " o_orderpriority string",
    )


_EXPORT_FILE = (
    "CASE o_orderstatus"
    " WHEN 'F' THEN 'orders_' || substring(CAST(o_orderdate AS STRING), 1, 7) || '-01.csv'"
    " WHEN 'O' THEN 'orders_' || substring(CAST(o_orderdate AS STRING), 1, 4) || '.csv'"
    " ELSE 'orders_' || substring(CAST(o_orderdate AS STRING), 1, 4) || '.json' END"
)


def _export_files(spark: SparkSession, folder: str) -> str:
    """Exports whose names tell date and kind; the folder ``file=name`` stands for a file."""
    def write(path: str) -> None:
        rows = table(spark, folder, "orders").select(
            "o_orderkey", "o_totalprice", F.expr(_EXPORT_FILE).alias("file")
        )
        write_csv(rows.repartition("file", F.floor(F.col("o_orderkey") / 100_000)), path, partition_by=("file",))

    return landed(spark, folder, "orders-exports", write)


@query(f"SELECT DISTINCT {_EXPORT_FILE} AS file FROM orders WHERE o_orderstatus <> 'P'")
def file_listing(spark: SparkSession, folder: str) -> DataFrame:
    """Names of the CSV exports in a folder, found without reading them."""
    listing = files.list_files(spark, _export_files(spark, folder))
    name = files.partition_value(F.col("path"), "file")
    return listing.select(name.alias("file")).distinct().filter(files.matches(F.col("file"), files.ANY_CSV))


_PATTERNS = {"any_csv": files.ANY_CSV, "dated_csv": files.DATED_CSV, "csv_or_json": files.CSV_OR_JSON}


@query("\nUNION ALL\n".join(
    f"SELECT '{label}' AS pattern, {_EXPORT_FILE} AS file, count(*) AS row_count,"
    f" sum(o_orderkey)::BIGINT AS key_sum FROM orders"
    f" WHERE regexp_full_match({_EXPORT_FILE}, '{pattern}') GROUP BY ALL"
    for label, pattern in _PATTERNS.items()
))
def pattern_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the files whose names match a pattern; the other files are pruned, not read."""
    rows = read_csv(spark, _export_files(spark, folder), names=["o_orderkey", "o_totalprice"])
    chosen = [
        rows.filter(files.matches(F.col("file"), pattern)).groupBy("file").agg(
            F.lit(label).alias("pattern"),
            F.count(F.lit(1)).alias("row_count"),
            F.sum(F.col("o_orderkey").cast("bigint")).alias("key_sum"),
        )
        for label, pattern in _PATTERNS.items()
    ]
    return reduce(DataFrame.unionByName, chosen)


@query(f"""
SELECT {_EXPORT_FILE} AS file, count(*) AS row_count, count(*) AS numbered, count(*) AS distinct_numbers
FROM orders GROUP BY ALL
""")
def file_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Row numbers run from 1 to the number of rows in every file."""
    rows = spark.read.schema("o_orderkey string, o_totalprice string").option("header", "true").csv(
        _export_files(spark, folder)
    )
    numbered = files.with_row_numbers(rows.select("file", *files.provenance()))
    per_file = numbered.groupBy("file", "file_path").agg(
        F.count(F.lit(1)).alias("rows"),
        F.max("file_row_number").alias("last"),
        F.sum("file_row_number").alias("total"),
    )
    # Numbers 1..n add up to n(n+1)/2; count a file's rows only if they do.
    complete = F.col("total") * 2 == F.col("rows") * (F.col("rows") + 1)
    return per_file.groupBy("file").agg(
        F.sum("rows").alias("row_count"),
        F.sum("last").alias("numbered"),
        F.sum(F.when(complete, F.col("rows")).otherwise(F.lit(0).cast("bigint"))).alias("distinct_numbers"),
    )


_LISTED_NAME = (
    "CASE c_mktsegment WHEN 'BUILDING' THEN c_name WHEN 'MACHINERY' THEN c_name || '.csv'"
    " WHEN 'FURNITURE' THEN upper(c_name) || '.CSV' WHEN 'HOUSEHOLD' THEN lower(c_name) END"
)


@query(f"""
WITH listing AS (
    SELECT c_custkey AS ordinal, {_LISTED_NAME} AS name FROM customer WHERE {_LISTED_NAME} IS NOT NULL),
requests AS (SELECT DISTINCT 'Customer#' || lpad(o_custkey::VARCHAR, 9, '0') AS request FROM orders),
ranked AS (
    SELECT request, name, ordinal, CASE WHEN name = request THEN 1 WHEN name = request || '.csv' THEN 2
        ELSE 3 END AS match_rank
    FROM requests LEFT JOIN listing
        ON lower(name) IN (lower(request), lower(request) || '.csv'))
SELECT request, name AS file, CASE WHEN name IS NOT NULL THEN match_rank END::INTEGER AS match_rank
FROM ranked
QUALIFY row_number() OVER (PARTITION BY request ORDER BY match_rank, ordinal) = 1
""")
def resolve_files(spark: SparkSession, folder: str) -> DataFrame:
    """Customers asked for by orders against a listing with their names in several spellings."""
    listing = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("ordinal"), F.expr(_LISTED_NAME).alias("name")
    ).filter("name IS NOT NULL")
    requests = table(spark, folder, "orders").select(
        F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("request")
    )
    return files.resolve_files(requests, listing)


@query("""
WITH o AS (SELECT * FROM orders ORDER BY o_orderkey LIMIT 10000),
l AS (SELECT * FROM lineitem ORDER BY l_orderkey LIMIT 10000),
c AS (SELECT * FROM customer ORDER BY c_custkey LIMIT 10000)
SELECT 'orders' AS table_name, count(*) AS row_count, sum(o_orderkey)::BIGINT AS key_sum FROM o
UNION ALL SELECT 'lineitem', count(*), sum(l_orderkey)::BIGINT FROM l
UNION ALL SELECT 'customer', count(*), sum(c_custkey)::BIGINT FROM c
""")
def extract_capped(spark: SparkSession, folder: str) -> DataFrame:
    """At most 10,000 rows of each catalog table; empty and missing tables are passed over."""
    database = fresh_database(spark, "extract")
    keys = {"orders": "o_orderkey", "lineitem": "l_orderkey", "customer": "c_custkey"}
    for name in keys:
        table(spark, folder, name).write.saveAsTable(f"{database}.{name}")
    table(spark, folder, "orders").filter("o_orderstatus = 'X'").write.saveAsTable(f"{database}.none")
    wanted = {n: [k] for n, k in keys.items()}
    found = nested.extract_tables(spark, database, {**wanted, "none": ["o_orderkey"], "missing": ["id"]}, cap=10_000)
    sums = []
    for short, rows in found.tables.items():
        path = fresh_folder(spark, f"extract-{short}")
        write_csv(rows.select(keys[short]), path)
        back = read_csv(spark, path, names=[keys[short]])
        sums.append(back.agg(
            F.lit(short).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.sum(F.col(keys[short]).cast("bigint")).alias("key_sum"),
        ))
    return reduce(DataFrame.unionByName, sums)


def _board_files(spark: SparkSession, folder: str) -> str:
    """Conversations as boards and turns as items, in pages of at most a hundred items."""
    def cell(title: str, text: str, when: str = "true") -> str:
        return (
            f"CASE WHEN {when} THEN named_struct('id', '{title}', 'text', {text}, 'value', '\"raw\"',"
            f" 'column', named_struct('title', '{title}')) END"
        )

    cells = [
        cell("Speaker Role", "role"),
        cell("Message", "text"),
        cell("Turn No", "CAST(turn AS STRING)"),
        cell("Message", "CASE WHEN turn % 3 = 0 THEN CAST(NULL AS STRING) ELSE text || ' (edited)' END", "turn % 2 = 1"),
        cell("Item Name", "'system prompt'", "role = 'system'"),
    ]

    def write(path: str) -> None:
        item = F.struct(
            F.expr("CAST(conv_id AS STRING) || '-' || CAST(turn AS STRING)").alias("id"),
            F.col("role").alias("name"),
            F.array_compact(F.array(*[F.expr(c) for c in cells])).alias("column_values"),
        )
        rows = table(spark, folder, "conversations")
        # Turns are unique in a conversation, so a page holds at most a hundred of them.
        pages = rows.groupBy("conv_id", F.floor(F.col("turn") / 100).alias("page")).agg(
            F.collect_list(item).alias("items")
        )
        board = F.struct(
            F.col("conv_id").cast("string").alias("id"),
            F.concat(F.lit("board "), F.col("conv_id").cast("string")).alias("name"),
            F.struct(F.col("page").cast("string").alias("cursor"), "items").alias("items_page"),
        )
        pages.select(F.struct(F.array(board).alias("boards")).alias("data")).write.option(
            "ignoreNullFields", "false"
        ).json(path)

    return landed(spark, folder, "boards", write)


@query("""
SELECT conv_id::VARCHAR AS board_id, conv_id || '-' || turn AS item_id,
    CASE WHEN role = 'system' THEN 'system prompt' ELSE role END AS item_name,
    CASE WHEN turn % 2 = 0 THEN text WHEN turn % 3 = 0 THEN NULL ELSE text || ' (edited)' END AS message,
    role AS speaker_role, turn::VARCHAR AS turn_no
FROM conversations
""")
def board_flatten(spark: SparkSession, folder: str) -> DataFrame:
    """One wide row per item; the last of equal titles wins, also when its text is null."""
    return nested.flatten_board(nested.read_board_pages(spark, _board_files(spark, folder)))


@query("""
SELECT conv_id::VARCHAR AS board_id, count(*) AS items, sum(3 + (turn % 2)
    + CASE WHEN role = 'system' THEN 1 ELSE 0 END)::BIGINT AS column_values
FROM conversations GROUP BY ALL
""")
def board_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Items and values per board over all of its pages."""
    items = nested.read_board_pages(spark, _board_files(spark, folder))
    return items.groupBy("board_id").agg(
        F.count(F.lit(1)).alias("items"),
        F.sum(F.size("column_values").cast("bigint")).alias("column_values"),
    )


_METRICS = [
    "event_id", "user_id", "value", "length(props)", "length(event_type)",
    "event_id % 7", "user_id % 5", "event_id % 11", "user_id + event_id", "event_id * 2",
]


def _report_rows(spark: SparkSession, folder: str) -> DataFrame:
    def write(path: str) -> None:
        events = table(spark, folder, "events")
        dims = ["substring(CAST(ts AS STRING), 1, 10)", "event_type", "'/' || event_type"]
        nested.write_json(
            events.select(
                F.array(*[F.expr(d) for d in dims]).alias("dimension_values"),
                F.array(*[F.expr(f"CAST({m} AS STRING)") for m in _METRICS]).alias("metric_values"),
            ),
            path,
        )

    path = landed(spark, folder, "report-rows", write)
    return nested.read_json_array(spark, path, nested.REPORT_ROW)


def _report_sql(names: list[str]) -> str:
    cells = ["strftime(ts, '%Y-%m-%d')", "event_type", "'/' || event_type"]
    cells += [f"({m})::VARCHAR" for m in _METRICS]
    columns = ", ".join(f'{c} AS "{n}"' for c, n in zip(cells, names, strict=True))
    return f"SELECT {columns} FROM events"


@query(_report_sql(list(REPORT_HEADERS)))
def report_flatten(spark: SparkSession, folder: str) -> DataFrame:
    """Positional report rows as named text columns."""
    return nested.flatten_report(_report_rows(spark, folder), 3, 10)


@query(_report_sql(list(REPORT_HEADERS.values())))
def rename_report(spark: SparkSession, folder: str) -> DataFrame:
    """The same under the report's own headers."""
    return nested.flatten_report(_report_rows(spark, folder), 3, 10).withColumnsRenamed(REPORT_HEADERS)


@query("""
WITH e AS (
    SELECT epoch_us(ts) AS us, user_id, strftime(ts, '%Y-%m-%d') AS date, event_type AS "pageTitle",
        '/' || event_type || '/' || json_extract_string(props, '$.k') AS "pagePath",
        event_type = 'view' AS is_view, event_type = 'purchase' AS is_conversion, event_id
    FROM events
    WHERE ts >= DATE '2024-01-31' - INTERVAL 365 DAY AND ts < DATE '2024-02-01'),
gaps AS (SELECT *, lag(us) OVER w AS before, lead(us) OVER w AS after,
        min(us) OVER (PARTITION BY user_id) AS first_us FROM e
    WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)),
s AS (SELECT *, sum(CASE WHEN before IS NULL OR us - before >= 1800000000 THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY us, event_id) AS sid,
        CASE WHEN after - us < 1800000000 THEN after - us ELSE 0 END AS engagement FROM gaps),
sessions AS (SELECT user_id, sid, max(us) - min(us) AS length_us,
        max(us) - min(us) > 10000000 OR count(*) FILTER (is_conversion) > 0
            OR count(*) FILTER (is_view) >= 2 AS engaged
    FROM s GROUP BY ALL),
touched AS (SELECT DISTINCT date, "pageTitle", "pagePath", user_id, sid FROM s),
per_session AS (SELECT date, "pageTitle", "pagePath", count(*) AS sessions,
        sum(length_us)::BIGINT AS length_us, count(*) FILTER (engaged) AS engaged
    FROM touched JOIN sessions USING (user_id, sid) GROUP BY ALL),
per_event AS (SELECT date, "pageTitle", "pagePath", count(DISTINCT user_id) AS "totalUsers",
        count(DISTINCT CASE WHEN us = first_us THEN user_id END) AS "newUsers",
        count(*) FILTER (is_conversion) AS conversions, sum(engagement)::BIGINT AS engagement_us,
        count(*) AS "eventCount", count(*) FILTER (is_view) AS "screenPageViews"
    FROM s GROUP BY ALL)
SELECT date, "pageTitle", "pagePath", "totalUsers", sessions, "newUsers",
    length_us / sessions / 1000000 AS "averageSessionDuration",
    1 - engaged / sessions AS "bounceRate", engaged / sessions AS "engagementRate",
    conversions, engagement_us / 1000000 AS "userEngagementDuration",
    "eventCount", "screenPageViews"
FROM per_event JOIN per_session USING (date, "pageTitle", "pagePath")
""", name="web_report")
def web_report_query(spark: SparkSession, folder: str) -> DataFrame:
    """The report over the 365 days up to a fixed day: 30-minute sessions, pages from event types."""
    events = table(spark, folder, "events").filter(nested.rolling_window("ts", "2024-01-31"))
    page = F.concat_ws("/", F.lit(""), "event_type", F.get_json_object("props", "$.k"))
    return web_report(
        events.select(
            "ts", "user_id",
            F.col("event_type").alias("pageTitle"),
            page.alias("pagePath"),
            (F.col("event_type") == "view").alias("is_view"),
            (F.col("event_type") == "purchase").alias("is_conversion"),
        )
    )


_KNOWN_SHEETS = {"src0": "service.csv", "src1": "projects.csv"}
_ROUTE_SQL = (
    "CASE source " + " ".join(f"WHEN '{s}' THEN '{t}'" for s, t in _KNOWN_SHEETS.items())
    + " ELSE 'workbook_' || replace(lower(source), ' ', '_') || '.csv' END"
)


@query(f"""
SELECT {_ROUTE_SQL} AS target, count(*) AS row_count, sum(length(text))::BIGINT AS characters
FROM documents GROUP BY ALL
""")
def route_entities(spark: SparkSession, folder: str) -> DataFrame:
    """Each sheet's rows written to the sheet's own target and read back from there."""
    def write(path: str) -> None:
        routed = nested.route_entities(table(spark, folder, "documents"), "source", _KNOWN_SHEETS)
        write_csv(routed.select("doc_id", "text", "target"), path, partition_by=("target",))

    path = landed(spark, folder, "routed", write)
    rows = read_csv(spark, path, MULTI_LINE, names=["doc_id", "text"])
    return rows.groupBy("target").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.length("text").cast("bigint")).alias("characters"),
    )


@query("""
SELECT * FROM orders
WHERE o_orderdate >= DATE '1998-12-31' - INTERVAL 365 DAY AND o_orderdate < DATE '1999-01-01'
""")
def date_window(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the 365 days up to a fixed day; the bounds reach the file scan."""
    return table(spark, folder, "orders").filter(nested.rolling_window("o_orderdate", "1998-12-31"))


@query("SELECT doc_id::VARCHAR AS doc_id, text, lang, source, n_chars::VARCHAR AS n_chars FROM documents")
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts with quotes and line breaks, written as CSV and read back."""
    documents = table(spark, folder, "documents")
    path = landed(spark, folder, "documents-csv", lambda p: write_csv(documents, p))
    return read_csv(spark, path, MULTI_LINE, names=documents.columns)


@query("""
WITH t AS (SELECT CASE WHEN doc_id % 4 = 0 THEN NULL ELSE lang END AS lang, source, text, doc_id
    FROM documents),
long AS (
    SELECT 'lang' AS column_name, lang AS value, doc_id FROM t
    UNION ALL SELECT 'source', source, doc_id FROM t
    UNION ALL SELECT 'text', text, doc_id FROM t
    UNION ALL SELECT 'doc_id', doc_id::VARCHAR, doc_id FROM t)
SELECT column_name, (row_number() OVER w - 1)::INTEGER AS position, value
FROM long WHERE value IS NOT NULL
WINDOW w AS (PARTITION BY column_name ORDER BY doc_id)
QUALIFY row_number() OVER w <= 3
""")
def sample_values(spark: SparkSession, folder: str) -> DataFrame:
    """The first three values of every column, nulls passed over."""
    from millrace.operators.profile import sample_values as samples

    lang = F.expr("CASE WHEN doc_id % 4 = 0 THEN NULL ELSE lang END")
    docs = table(spark, folder, "documents").select("doc_id", lang.alias("lang"), "source", "text")
    return samples(docs, ["doc_id"])


@query("""
(SELECT o_orderkey, o_custkey, 'head' AS part FROM orders ORDER BY o_orderkey LIMIT 5)
UNION ALL
(SELECT o_orderkey, o_custkey, 'tail' AS part FROM orders ORDER BY o_orderkey DESC LIMIT 5)
""")
def head_and_tail(spark: SparkSession, folder: str) -> DataFrame:
    """The first and last five rows by key."""
    from millrace.operators.profile import head_and_tail as ends

    return ends(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"])

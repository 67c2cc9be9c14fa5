"""Queries over broken input and broken runs: malformed lines, loads that fail half way, headers that change."""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators import ledger as ledgers, load, profile as inspect, tables, verify
from millrace.plans.landing import landed
from millrace.plans.registry import query, table
from millrace.plans.run import run_tables
from millrace.session import compiled
from millrace.sources.csv import BULK_LOAD, RECORD, read_csv_checked, write_csv
from millrace.sources.files import partition_value
from millrace.spec import TableSpec
from millrace.workspace import fresh_database

_FIELDS = [load.Field("o_orderkey", "NUMBER(18)"), load.Field("o_clerk"), load.Field("o_totalprice", "FLOAT")]
_NAMES = [f.name for f in _FIELDS]
# Every so many orders have a value that is not closed, text after a closing quote, or a bad number. Quotes within a
# value, delimiters in quotes, a line that is short and one with surplus values are all fine.
_BROKEN = "(o_orderkey % 1009 = 3 OR o_orderkey % 1013 = 4)"
_BAD_NUMBER = "o_orderkey % 1019 = 5"
_CLERK = """CASE WHEN o_orderkey % 1009 = 3 THEN '"open ' || o_custkey WHEN o_orderkey % 1013 = 4 THEN '"shut"' || o_custkey
    WHEN o_orderkey % 7 = 1 THEN '"a ""quoted"", clerk"' WHEN o_orderkey % 7 = 2 THEN '5" pipe' ELSE 'clerk ' || o_custkey END"""
_PRICE = f"CASE WHEN {_BAD_NUMBER} THEN 'n/a' ELSE CAST(o_totalprice AS STRING) END"
_LINE = f"""CASE WHEN o_orderkey % 7 = 5 THEN CAST(o_orderkey AS STRING) || ',short'
    ELSE CAST(o_orderkey AS STRING) || ',' || ({_CLERK}) || ',' || ({_PRICE}) || CASE WHEN o_orderkey % 7 = 6 THEN ',more' ELSE '' END END"""
_YEARS = "CAST(year(o_orderdate) AS BIGINT)"


def broken_files(spark: SparkSession, folder: str) -> str:
    """Orders as lines of text, a header first, in a folder for each year."""
    def write(path: str) -> None:
        lines = table(spark, folder, "orders").select(F.expr(_LINE).alias("line"), F.expr(_YEARS).alias("year"))
        # Each file is one task's, so its first line is the header.
        rows = lines.withColumn("place", F.lit(1)).unionByName(
            lines.select("year").distinct().select(F.lit(",".join(_NAMES)).alias("line"), "year", F.lit(0).alias("place"))
        )
        files = rows.repartition("year").sortWithinPartitions("year", "place")
        files.select("line", "year").write.partitionBy("year").text(path)

    return landed(spark, folder, "broken-quotes", write)


_ROWS_SQL = f"""
SELECT o_orderkey, {_YEARS} AS year, o_orderkey % 7 <> 5 AND {_BROKEN} AS broken,
    o_orderkey % 7 <> 5 AND NOT {_BROKEN} AND {_BAD_NUMBER} AS bad FROM orders"""


@query(f"""
WITH r AS ({_ROWS_SQL}), f AS (SELECT year, bool_or(broken OR bad) AS faulty FROM r GROUP BY year)
SELECT 'continue' AS mode, count(*) FILTER (NOT broken AND NOT bad) AS loaded, count(*) FILTER (broken) AS malformed,
    count(*) FILTER (bad) AS bad_values, false AS aborted FROM r
UNION ALL SELECT 'abort', 0, count(*) FILTER (broken), count(*) FILTER (bad), count(*) FILTER (broken OR bad) > 0 FROM r
UNION ALL SELECT 'skip_file', count(*) FILTER (NOT faulty), count(*) FILTER (broken), count(*) FILTER (bad), false FROM r JOIN f USING (year)
UNION ALL SELECT 'validate', 0, count(*) FILTER (broken), count(*) FILTER (bad), false FROM r
""")
def load_malformed(spark: SparkSession, folder: str) -> DataFrame:
    """Files with broken quotes under the four error modes: what is loaded, and what each reject is."""
    database = fresh_database(spark, "malformed")
    raw = read_csv_checked(spark, broken_files(spark, folder), _NAMES, BULK_LOAD)
    wrong = load.rejects(load.check_rows(raw, _FIELDS, ["file_path"]), ["file_path"])
    with compiled(spark):
        faults = wrong.agg(
            F.count_if(F.col("reason") == load.MALFORMED).alias("malformed"),
            F.count_if(F.col("reason") != load.MALFORMED).alias("bad_values"),
        ).first()
    reports = []
    for mode in ("continue", "abort", "skip_file", "validate"):
        name, aborted = f"{database}.{mode}", False
        load.create_target(spark, name, _FIELDS)
        try:
            load.bulk_load(raw, _FIELDS, name, "file_path", mode)
        except load.LoadAborted:
            aborted = True
        reports.append((mode, spark.table(name).count(), faults.malformed, faults.bad_values, aborted))
    return spark.createDataFrame(reports, "mode string, loaded bigint, malformed bigint, bad_values bigint, aborted boolean")


@query(f"""
SELECT o_orderkey, {_YEARS} AS year, {_LINE} AS record FROM orders WHERE o_orderkey % 7 <> 5 AND {_BROKEN}
""")
def malformed_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every malformed line as it stands in its file."""
    raw = read_csv_checked(spark, broken_files(spark, folder), _NAMES, BULK_LOAD).filter(F.col(RECORD).isNotNull())
    return raw.select(
        F.substring_index(RECORD, ",", 1).cast("bigint").alias("o_orderkey"),
        partition_value(F.col("file_path"), "year").cast("bigint").alias("year"), F.col(RECORD).alias("record"),
    )


@query(f"""
WITH r AS ({_ROWS_SQL}), g AS (SELECT count(*) AS good, sum(o_orderkey)::BIGINT AS key_sum FROM r WHERE NOT broken AND NOT bad)
SELECT 'failed' AS step, 0::BIGINT AS rows, 0::BIGINT AS key_sum, 0::BIGINT AS files, 1::BIGINT AS open_loads FROM g
UNION ALL SELECT 'repeated', good, key_sum, (SELECT count(DISTINCT year) FROM r), 0 FROM g
UNION ALL SELECT 'nothing new', good, key_sum, (SELECT count(DISTINCT year) FROM r), 0 FROM g
""")
def load_exactly_once(spark: SparkSession, folder: str) -> DataFrame:
    """A load that breaks between its rows and its history, its repetition, and a run with nothing new."""
    database = fresh_database(spark, "once")
    target, history, ledger = f"{database}.orders", f"{database}.history", f"{database}.ledger"
    ledgers.create_ledger(spark, ledger)
    ledgers.create_tagged_target(spark, target, _FIELDS)
    load.create_history(spark, history, tagged=True)
    spark.sql(f"CREATE TABLE {database}.broken (x BIGINT) USING parquet")  # no history can be written there
    inbox = broken_files(spark, folder)

    def run(noted_in: str) -> None:
        def load_paths(paths: list[str], files: DataFrame) -> None:
            raw = read_csv_checked(spark, paths, _NAMES, BULK_LOAD)
            # Listings and readers write a path's scheme differently.
            path = F.regexp_replace("file_path", "^file:/+", "file:/")
            load.bulk_load(raw.withColumn("file_path", path), _FIELDS, target, "file_path", history_table=noted_in, files=files, ledger=ledger)

        load.load_new_files(spark, inbox, target, history, load_paths, pattern=".*[.]txt", ledger=ledger)

    told = []
    for step, noted_in in (("failed", f"{database}.broken"), ("repeated", history), ("nothing new", history)):
        try:
            run(noted_in)
        except AnalysisException:
            assert step == "failed" and spark.table(target).count() > 0  # the rows are there, but do not count
        rows = ledgers.committed(spark, target, ledger).agg(F.count(F.lit(1)), F.coalesce(F.sum("o_orderkey"), F.lit(0))).first()
        open_loads = ledgers.loads_of(spark, ledger, target).filter("NOT ended").count()
        told.append((step, *rows, ledgers.committed(spark, target, ledger, history).count(), open_loads))
    return spark.createDataFrame(told, "step string, rows bigint, key_sum bigint, files bigint, open_loads bigint")


_SIZE = """CASE WHEN max(length({0})) <= 50 THEN 50 WHEN max(length({0})) <= 100 THEN 100 WHEN max(length({0})) <= 255 THEN 255
    WHEN max(length({0})) <= 500 THEN 500 ELSE 1000 END::INTEGER"""


@query(f"""
SELECT 'Segment' AS column_name, {_SIZE.format('c_mktsegment')} AS character_maximum_length, true AS overlong_append_fails FROM customer
UNION ALL SELECT 'Client_Name', 100, true FROM customer HAVING count(*) > 0
UNION ALL SELECT 'Phone', 20, true FROM customer HAVING count(*) > 0
""")
def declared_lengths(spark: SparkSession, folder: str) -> DataFrame:
    """Lengths of text columns that a run finds, declared in its table: the catalogue has them, and a longer
    value cannot be appended."""
    def write(path: str) -> None:
        rows = table(spark, folder, "customer").select(
            F.col("c_custkey").cast("string").alias("Client Ref"), F.col("c_name").alias("Client Name"),
            F.col("c_mktsegment").alias("Segment"), F.lpad(F.col("c_custkey").cast("string"), 12, "+").alias("Phone"),
        )
        write_csv(rows, f"{path}/clients.csv")

    database = fresh_database(spark, "lengths")
    run_tables(spark, [TableSpec("clients", "clients", "Client Ref", order_by=("Client Name",))], landed(spark, folder, "lengths", write), database)
    name = f"{database}.clients"
    catalogue = inspect.describe_table(spark, name).filter(F.col("column_name").isin("Segment", "Client_Name", "Phone"))
    fails = {}
    for column in ("Segment", "Client_Name", "Phone"):
        longer = spark.table(name).limit(1).withColumn(column, F.repeat(F.lit("x"), 1001))
        try:
            tables.append(longer, name)
            fails[column] = False
        except (PySparkException, Py4JJavaError) as problem:
            fails[column] = "EXCEED_LIMIT_LENGTH" in str(problem)
    outcome = spark.createDataFrame(list(fails.items()), "column_name string, overlong_append_fails boolean")
    return catalogue.join(outcome, "column_name").select("column_name", "character_maximum_length", "overlong_append_fails")


@query("""
SELECT 'equal' AS pair, 0::BIGINT AS only_left, 0::BIGINT AS only_right, 0::BIGINT AS differing_buckets
UNION ALL SELECT 'kept checksums', count(*) FILTER (l_orderkey % 2999 = 1), count(*) FILTER (l_orderkey % 2999 = 1), -1 FROM lineitem
UNION ALL SELECT 'most rows', count(*) FILTER (l_orderkey % 10 <> 0), 0, -1 FROM lineitem
""")
def bucket_diff(spark: SparkSession, folder: str) -> DataFrame:
    """Line items against a copy, against one that differs in few rows, by checksums kept with the load, and
    against one that lacks most rows."""
    name = f"{fresh_database(spark, 'buckets')}.lineitem"
    lines = table(spark, folder, "lineitem")
    verify.bucket_checksums(lines).write.saveAsTable(f"{name}_sums")
    kept = spark.table(f"{name}_sums")
    # A price beyond all others, so that no changed row equals another one.
    changed = lines.withColumn("l_extendedprice", F.expr("CASE WHEN l_orderkey % 2999 = 1 THEN -1 - l_extendedprice ELSE l_extendedprice END"))
    told = []
    for pair, other, sums in (("equal", lines, None), ("kept checksums", changed, kept), ("most rows", lines.filter("l_orderkey % 10 = 0"), None)):
        buckets = len(verify.differing_buckets(kept, verify.bucket_checksums(other)))
        diff = verify.table_diff(lines, other, left_sums=sums).groupBy().agg(
            *[F.coalesce(F.sum(F.when(F.col("side") == s, F.col("copies"))), F.lit(0)).alias(s) for s in ("only_left", "only_right")]
        ).first()
        told.append((pair, *diff, 0 if buckets == 0 else -1))
    return spark.createDataFrame(told, "pair string, only_left bigint, only_right bigint, differing_buckets bigint")


@query("""
SELECT count(*) AS items, count(o) AS with_orders, count(*) FILTER (c_mktsegment = 'BUILDING') AS building,
    sum(o)::BIGINT AS orders, 'Item,STATUS_sales,Amount,status_delivery,amount_1,origin' AS columns
FROM (SELECT c_custkey, c_mktsegment, count(o_orderkey) AS o FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL)
""")
def merge_mixed_case(spark: SparkSession, folder: str) -> DataFrame:
    """Two boards whose columns differ by case only: nothing is ambiguous afterwards."""
    from millrace.operators.merge import merge_boards

    customers, orders = table(spark, folder, "customer"), table(spark, folder, "orders")
    counts = orders.groupBy(F.col("o_custkey").alias("item")).agg(F.count(F.lit(1)).alias("status"))
    right = customers.select(F.col("c_custkey").alias("item")).join(counts, "item", "left").select(
        "item", F.coalesce("status", F.lit(0)).alias("status"), F.lit(1).alias("amount_1")
    )
    left = customers.select(F.col("c_custkey").alias("Item"), F.col("c_mktsegment").alias("STATUS"), F.lit(2).alias("Amount"))
    merged = merge_boards(left, right, "Item")
    return merged.agg(
        F.count("Item").alias("items"), F.count("status_delivery").alias("with_orders"),
        F.count_if(F.col("STATUS_sales") == "BUILDING").alias("building"), F.sum("status_delivery").alias("orders"),
        F.lit(",".join(merged.columns)).alias("columns"),
    )

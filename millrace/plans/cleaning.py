"""Queries over the cleaner, column names and deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.casts import stringify
from millrace.functions.names import (
    NamePolicy, clean_name_column, has_special_characters, unique_names_in_catalogue,
)
from millrace.functions.text import clean_text
from millrace.operators import clean
from millrace.plans.landing import EM_SPACE, NBSP, ZERO_WIDTH
from millrace.plans.registry import query, table
from millrace.spec import TableSpec

# The white space that is stripped, written down once more for the SQL side.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Documents with white space and hidden characters at their edges and within.
DIRTY_TEXT = (
    "CASE doc_id % 8 WHEN 0 THEN chr(9) || ' ' || text || chr(10) || ' '"
    f" WHEN 1 THEN '{NBSP}{EM_SPACE}' || text || '{EM_SPACE}' WHEN 2 THEN '{ZERO_WIDTH}' || text"
    " WHEN 3 THEN chr(1) || ' ' || text || chr(31) WHEN 4 THEN '  ' || chr(9)"
    " WHEN 5 THEN chr(2) || ' ' || chr(3) ELSE text END"
)


def clean_sql(text: str) -> str:
    """The cleaning rule in SQL."""
    visible = f"regexp_replace(trim({text}, '{WHITE_SPACE}'), '[\\x00-\\x1F]', '', 'g')"
    return f"CASE WHEN trim({visible}, '{WHITE_SPACE}') <> '' THEN {visible} END"


@query(f"SELECT doc_id, {clean_sql(DIRTY_TEXT)} AS text FROM documents")
def clean_strings(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents, stripped and freed of hidden characters."""
    return table(spark, folder, "documents").select(
        "doc_id", clean_text(F.expr(DIRTY_TEXT)).alias("text")
    )


_BLANK = "CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE"
CUSTOMER_DIRTY = {
    "c_custkey": f"{_BLANK} CASE WHEN c_custkey % 9 = 1 THEN NULL ELSE c_custkey END END",
    "c_name": f"{_BLANK} CASE WHEN c_custkey % 9 = 1 THEN '  ' ELSE chr(9) || c_name || ' ' END END",
    "c_mktsegment": f"{_BLANK} CASE WHEN c_custkey % 4 = 0 THEN ' ' ELSE c_mktsegment END END",
    "c_acctbal": f"{_BLANK} CASE WHEN c_custkey % 9 = 1 THEN NULL ELSE c_acctbal END END",
}
_DIRTY_SQL = "SELECT " + ", ".join(f"{e} AS {c}" for c, e in CUSTOMER_DIRTY.items()) + " FROM customer"
_NOT_BLANK = " OR ".join(f"{c} IS NOT NULL" for c in CUSTOMER_DIRTY)


def dirty_customer(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        *[F.expr(e).alias(c) for c, e in CUSTOMER_DIRTY.items()]
    )


@query(f"""
SELECT c_custkey, {clean_sql('c_name')} AS c_name, {clean_sql('c_mktsegment')} AS c_mktsegment, c_acctbal
FROM ({_DIRTY_SQL})
""")
def clean_all_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Every text column of a table; numbers stay."""
    return clean.clean_all_columns(dirty_customer(spark, folder))


@query(f"SELECT * FROM ({_DIRTY_SQL}) WHERE {_NOT_BLANK}")
def drop_blank_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of nulls go; rows of blank texts stay at this step."""
    return clean.drop_blank_rows(dirty_customer(spark, folder))


@query(f"SELECT * FROM ({_DIRTY_SQL}) WHERE c_custkey IS NOT NULL AND c_acctbal IS NOT NULL")
def drop_null_keys(spark: SparkSession, folder: str) -> DataFrame:
    return clean.drop_null_keys(dirty_customer(spark, folder), ["c_custkey", "c_acctbal"])


@query("""
SELECT * FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1
""")
def dedup_single(spark: SparkSession, folder: str) -> DataFrame:
    """The first document of each text."""
    return clean.dedup(table(spark, folder, "documents"), ["text"], ["doc_id"])


_LINE_ORDER = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]


@query(f"""
SELECT * FROM lineitem QUALIFY row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(_LINE_ORDER)}) = 1
""")
def dedup_composite(spark: SparkSession, folder: str) -> DataFrame:
    """The first line item of each order and line number."""
    spec = TableSpec(
        "lineitem", primary_key="l_orderkey + l_linenumber", composite=True, order_by=tuple(_LINE_ORDER)
    )
    lines = table(spark, folder, "lineitem")
    return clean.dedup(lines, clean.usable_key(lines, spec.key_columns), spec.order_by)


# Documents with blank rows and dirty texts; the text is the key, the smallest id wins.
_DOCS_RAW = {
    "doc_id": "CASE WHEN doc_id % 10 = 9 THEN NULL ELSE doc_id END",
    "text": f"CASE WHEN doc_id % 10 = 9 THEN NULL ELSE {DIRTY_TEXT} END",
    "lang": "CASE WHEN doc_id % 10 = 9 THEN NULL ELSE ' ' || lang END",
}
_DOCS_SQL = (
    "SELECT " + ", ".join(f"{e} AS {c}" for c, e in _DOCS_RAW.items()) + " FROM documents"
)
_DOCS_CLEAN = f"""SELECT doc_id, {clean_sql('text')} AS text, {clean_sql('lang')} AS lang
    FROM ({_DOCS_SQL}) WHERE doc_id IS NOT NULL OR text IS NOT NULL OR lang IS NOT NULL"""
_DOCS_SPEC = TableSpec(
    "documents", primary_key="text", order_by=("doc_id",), renames={"lang": "language"}
)


def _raw_documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        *[F.expr(e).alias(c) for c, e in _DOCS_RAW.items()]
    )


@query(f"""
SELECT doc_id, text, lang AS language FROM ({_DOCS_CLEAN}) WHERE text IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1
""")
def clean_table(spark: SparkSession, folder: str) -> DataFrame:
    """The whole cleaner: blank rows, texts, null keys, duplicates, headers."""
    return clean.clean_table(_raw_documents(spark, folder), _DOCS_SPEC)


@query(f"""
SELECT (SELECT count(*) FROM documents) AS input_rows,
    (SELECT count(*) FROM documents) - (SELECT count(*) FROM ({_DOCS_CLEAN})) AS blank_rows,
    (SELECT count(*) FROM ({_DOCS_CLEAN}) WHERE text IS NULL) AS null_key_rows,
    (SELECT count(text) - count(DISTINCT text) FROM ({_DOCS_CLEAN})) AS duplicate_rows,
    (SELECT count(DISTINCT text) FROM ({_DOCS_CLEAN})) AS output_rows
""")
def clean_report(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that each step of the cleaner removes."""
    return clean.clean_report(_raw_documents(spark, folder), _DOCS_SPEC)


# A catalogue of hostile column names: one table per brand, parts as its columns.
_PART_NAME = (
    "CASE p_size % 6 WHEN 0 THEN p_name WHEN 1 THEN ' ' || upper(p_name) || ' '"
    " WHEN 2 THEN replace(p_name, ' ', '--') || ' (' || p_type || ')' WHEN 3 THEN '2nd ' || p_name"
    " WHEN 4 THEN '__' || p_name || '.%' ELSE '%% ' END"
)
_STRICT = "trim(regexp_replace({0}, '[^A-Za-z0-9]+', '_', 'g'), '_')"
_STRICT_SQL = (
    f"CASE WHEN {_STRICT} = '' THEN 'UNNAMED_COLUMN'"
    f" WHEN regexp_matches({_STRICT}, '^[0-9]') THEN 'COL_' || {_STRICT} ELSE {_STRICT} END"
).format(_PART_NAME)


def _catalogue(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_brand").alias("table_name"),
        F.col("p_partkey").alias("ordinal"),
        F.expr(_PART_NAME).alias("original_name"),
    )


@query(f"""
SELECT p_brand AS table_name, p_partkey AS ordinal, {_PART_NAME} AS original_name,
    {_STRICT_SQL} AS clean_name FROM part
""")
def sanitize_names(spark: SparkSession, folder: str) -> DataFrame:
    """Names as ASCII identifiers."""
    name = clean_name_column(F.col("original_name"))
    return _catalogue(spark, folder).withColumn("clean_name", name)


@query(f"""
SELECT p_partkey AS ordinal, {_PART_NAME} AS original_name,
    replace(replace(trim({_PART_NAME}, ' '), ' ', '_'), '-', '_') AS clean_name FROM part
""")
def sanitize_names_light(spark: SparkSession, folder: str) -> DataFrame:
    """Names with only blanks and dashes changed."""
    name = clean_name_column(F.col("original_name"), NamePolicy.LIGHT)
    return _catalogue(spark, folder).withColumn("clean_name", name).drop("table_name")


_WORD = "regexp_replace(original_name, '[ :.-]', '_', 'g')"


@query(f"""
SELECT original_name, CASE WHEN regexp_matches({_WORD}, '^\\pL[\\pL\\pN_]*$') THEN {_WORD}
    ELSE '_' || regexp_replace({_WORD}, '[^\\pL\\pN_]', '_', 'g') END AS clean_name
FROM (SELECT url AS original_name FROM pages UNION ALL SELECT c_name FROM customer
    UNION ALL SELECT p_name FROM part)
""")
def sanitize_names_prefixed(spark: SparkSession, folder: str) -> DataFrame:
    """Names with ``_`` in front unless they are a word already."""
    names = (
        table(spark, folder, "pages").select(F.col("url").alias("original_name"))
        .union(table(spark, folder, "customer").select("c_name"))
        .union(table(spark, folder, "part").select("p_name"))
    )
    name = clean_name_column(F.col("original_name"), NamePolicy.PREFIXED)
    return names.withColumn("clean_name", name)


@query(f"""
SELECT p_brand AS table_name, p_partkey AS ordinal, {_PART_NAME} AS original_name FROM part
WHERE regexp_matches({_PART_NAME}, '["'' \\-.()\\[\\]]')
""")
def special_names(spark: SparkSession, folder: str) -> DataFrame:
    """Names that need quoting."""
    return _catalogue(spark, folder).filter(has_special_characters(F.col("original_name")))


@query(f"""
WITH c AS (SELECT p_brand AS table_name, p_partkey AS ordinal, {_PART_NAME} AS original_name,
    {_STRICT_SQL} AS clean_name FROM part)
SELECT table_name, ordinal, original_name, CASE WHEN row_number() OVER (
    PARTITION BY table_name, lower(clean_name) ORDER BY ordinal) = 1 THEN clean_name
    ELSE clean_name || '_' || ordinal END AS clean_name
FROM c
""")
def column_mapping(spark: SparkSession, folder: str) -> DataFrame:
    """Original to clean name, unique within each table."""
    named = sanitize_names(spark, folder)
    return unique_names_in_catalogue(named, "table_name", "ordinal", "clean_name")


@query("""
SELECT l_orderkey::VARCHAR AS l_orderkey, l_partkey::VARCHAR AS l_partkey,
    l_suppkey::VARCHAR AS l_suppkey, l_linenumber::VARCHAR AS l_linenumber,
    l_quantity::VARCHAR AS l_quantity, l_extendedprice::VARCHAR AS l_extendedprice,
    l_discount::VARCHAR AS l_discount, l_tax::VARCHAR AS l_tax,
    CASE l_returnflag WHEN 'R' THEN NULL ELSE l_returnflag END AS l_returnflag, l_linestatus,
    l_shipdate::VARCHAR AS l_shipdate
FROM lineitem
""")
def stringify_all(spark: SparkSession, folder: str) -> DataFrame:
    """Every column as text; returns are marked ``nan`` and come out null."""
    lines = table(spark, folder, "lineitem")
    flag = F.expr("CASE l_returnflag WHEN 'R' THEN 'nan' ELSE l_returnflag END")
    return stringify(lines.withColumn("l_returnflag", flag))

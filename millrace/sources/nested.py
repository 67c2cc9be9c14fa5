"""Nested records: JSON arrays, board pages and positional report rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.operators.audit import brief_error
from millrace.operators.top import first_rows

BOARD_PAGE = (
    "data struct<boards: array<struct<id: string, name: string, items_page: struct<cursor: string,"
    " items: array<struct<id: string, name: string, column_values: array<struct<id: string,"
    " text: string, value: string, column: struct<title: string>>>>>>>>>"
)
REPORT_ROW = "dimension_values array<string>, metric_values array<string>"
BASE_COLUMNS = ("board_id", "item_id", "item_name")


def read_json_array(
    spark: SparkSession, path: str, schema: str, multi_line: bool = False
) -> DataFrame:
    """One row per object, from lines that hold an object or an array of objects.

    Broken JSON and bytes that are not UTF-8 fail the read instead of passing as nulls or
    replacement characters. With ``multi_line`` each file is one object or array over many lines,
    read by one task; its bytes are checked in a pass of their own.
    """
    lines = spark.read.text(path)
    if multi_line:
        if not lines.filter(~F.is_valid_utf8("value")).isEmpty():
            raise ValueError(f"{path} holds bytes that are not UTF-8")
        return spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", "true").json(path)
    records = F.from_json(F.validate_utf8("value"), f"array<struct<{schema}>>", {"mode": "FAILFAST"})
    return lines.filter(F.trim("value") != "").select(F.inline(records))


def write_json(df: DataFrame, path: str) -> None:
    """One object per line, null fields left out."""
    df.write.mode("overwrite").option("ignoreNullFields", "true").json(path)


def read_board_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per item of all landed pages: base columns and ``column_values``."""
    pages = spark.read.schema(BOARD_PAGE).option("mode", "FAILFAST").json(path)
    boards = pages.select(F.explode("data.boards").alias("b"))
    items = boards.select(F.col("b.id").alias("board_id"), F.explode("b.items_page.items").alias("i"))
    return items.select(
        "board_id",
        F.col("i.id").alias("item_id"),
        F.col("i.name").alias("item_name"),
        F.col("i.column_values").alias("column_values"),
    )


def title_to_name(title: Column) -> Column:
    """Lower case, blanks as ``_``; a missing title is the empty name."""
    return F.replace(F.lower(F.coalesce(title, F.lit(""))), F.lit(" "), F.lit("_"))


def board_titles(items: DataFrame) -> list[str]:
    """The distinct column names of a board, sorted. They become columns of one table.

    For boards with more titles than a table can have columns, :func:`board_cells` has them as rows.
    """
    titles = items.select(F.explode("column_values.column.title").alias("t"))
    rows = titles.select(title_to_name(F.col("t")).alias("t")).distinct().collect()
    return sorted(r.t for r in rows)


def board_cells(items: DataFrame) -> DataFrame:
    """The long form of a board: one row per item, title and text, the last of equal titles."""
    cells = items.select(*BASE_COLUMNS, F.posexplode("column_values").alias("place", "c"))
    named = cells.select(
        *BASE_COLUMNS, title_to_name(F.col("c.column.title")).alias("title"), "place", F.col("c.text").alias("text")
    )
    last = F.max(F.struct("place", "text"))["text"]
    return named.groupBy(*BASE_COLUMNS, "title").agg(last.alias("text"))


def flatten_board(items: DataFrame, titles: Sequence[str] | None = None) -> DataFrame:
    """One wide row per item: base columns, then one text column per title.

    Of equal titles the last wins, and a title equal to a base column overwrites it. Only ``text``
    counts, also where it is null. An item holds its own values, so no shuffle is needed.
    """
    titles = board_titles(items) if titles is None else titles
    # Last value first, so that the first position of a title is that of its last value.
    named = items.select(
        *BASE_COLUMNS,
        F.reverse(F.transform("column_values.column.title", title_to_name)).alias("_names"),
        F.reverse("column_values.text").alias("_texts"),
    )
    columns = []
    for name in (*BASE_COLUMNS, *[t for t in titles if t not in BASE_COLUMNS]):
        position = F.array_position("_names", name).cast("int")
        text = F.get("_texts", position - 1)
        if name in BASE_COLUMNS:
            text = F.when(position > 0, text).otherwise(F.col(name)) if name in titles else F.col(name)
        columns.append(text.alias(name))
    return named.select(*columns)


def flatten_report(rows: DataFrame, dimensions: int, metrics: int) -> DataFrame:
    """``dimension_1..n`` and ``metric_1..m`` from the positions of the two value lists."""
    dims = [F.get("dimension_values", F.lit(i)).alias(f"dimension_{i + 1}") for i in range(dimensions)]
    nums = [F.get("metric_values", F.lit(i)).alias(f"metric_{i + 1}") for i in range(metrics)]
    return rows.select(*dims, *nums)


def route_entities(
    df: DataFrame, sheet: str, known: dict[str, str], prefix: str = "workbook_"
) -> DataFrame:
    """Add ``target``: the file a sheet goes to, by name or as ``{prefix}{sheet in lower case}.csv``."""
    name = F.col(sheet)
    target = F.concat(F.lit(prefix), F.replace(F.lower(name), F.lit(" "), F.lit("_")), F.lit(".csv"))
    for known_sheet, file in known.items():
        target = F.when(name == known_sheet, F.lit(file)).otherwise(target)
    return df.withColumn("target", target)


def rolling_window(column: str, as_of: str, days: int = 365) -> Column:
    """True from ``days`` before ``as_of`` to the end of ``as_of``.

    Compares the bare column with constants, so the filter reaches the file scan.
    """
    day = F.lit(as_of).cast("date")
    start = F.date_sub(day, days).cast("timestamp_ntz")
    end = F.date_add(day, 1).cast("timestamp_ntz")
    return (F.col(column) >= start) & (F.col(column) < end)


@dataclass(frozen=True)
class Extract:
    """``tables`` that could be read and hold rows, and ``problems``: what kept each other one out."""

    tables: dict[str, DataFrame]
    problems: dict[str, str]


def extract_tables(
    spark: SparkSession, database: str, orders: dict[str, Sequence[str]] | None = None, cap: int | None = None
) -> Extract:
    """Every table of a catalog database, whole, or its first ``cap`` rows where a cap is named.

    ``orders`` names tables and the order of their rows; tables that are not in it come as they are.
    Empty, unreadable and missing tables are noted, and the others still come through.
    """
    orders = orders or {}
    found = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
    tables, problems = {}, {n: "no such table" for n in orders if n.lower() not in {f.lower() for f in found}}
    for name in sorted(found):
        try:
            rows = spark.table(f"{database}.`{name}`")
            if rows.isEmpty():
                problems[name] = "no rows"
                continue
            order = orders.get(name, ())
            if cap is not None:
                rows = first_rows(rows, order, cap, narrow=True) if order else rows.limit(cap)
            tables[name] = rows
        except Exception as problem:  # one unreadable table must not stop the others
            problems[name] = brief_error(problem)
    return Extract(tables, problems)

"""Inspection: shape, types, nulls, samples and the column catalogue."""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from millrace.functions.casts import text_of
from millrace.functions.names import has_special_characters
from millrace.operators.top import first_rows


def _one_row_per_column(totals: DataFrame, rows: list[Column]) -> DataFrame:
    return totals.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _is_text(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.StringType)


def profile(df: DataFrame, table: str) -> DataFrame:
    """Rows, nulls and empty texts of every column, counted in one pass."""
    counts = [F.count(F.lit(1)).alias("n")]
    for i, field in enumerate(df.schema):
        column = F.col(f"`{field.name}`")
        counts.append(F.count_if(column.isNull()).alias(f"nulls{i}"))
        if _is_text(field):
            counts.append(F.count_if(column == "").alias(f"empty{i}"))
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(field.name).alias("column_name"),
            F.col("n").alias("row_count"),
            F.col(f"nulls{i}").alias("null_count"),
            (F.col(f"empty{i}") if _is_text(field) else F.lit(0).cast("bigint")).alias("empty_count"),
        )
        for i, field in enumerate(df.schema)
    ]
    return _one_row_per_column(df.agg(*counts), rows)


def dtype_summary(df: DataFrame, table: str) -> DataFrame:
    """Columns per type with the table's shape and the filled cells of these columns."""
    filled = [F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)]
    rows = [
        F.struct(
            F.lit(field.dataType.simpleString()).alias("dtype"),
            F.col("n").alias("row_count"),
            F.col(f"c{i}").alias("filled"),
        )
        for i, field in enumerate(df.schema)
    ]
    cells = _one_row_per_column(df.agg(F.count(F.lit(1)).alias("n"), *filled), rows)
    return cells.groupBy("dtype").agg(
        F.lit(table).alias("table_name"),
        F.count(F.lit(1)).alias("columns"),
        F.lit(len(df.columns)).alias("table_columns"),
        F.max("row_count").alias("table_rows"),
        F.sum("filled").alias("filled_cells"),
    )


def sample_values(df: DataFrame, order_by: Sequence[str], rows: int = 3) -> DataFrame:
    """The first ``rows`` non-null values of each column in the given order.

    One scan: rows unfold into cells, and the filter on the bare row number is pushed below the shuffle (one
    on an expression of it would not be), so a task hands on ``rows`` cells of each column.
    """
    cells = df.select(
        *[F.col(f"`{c}`").alias(f"_o{i}") for i, c in enumerate(order_by)],
        F.posexplode(F.array(*[text_of(df, c) for c in df.columns])).alias("ordinal", "value"),
    ).filter(F.col("value").isNotNull())
    order = [f"_o{i}" for i in range(len(order_by))]
    first = Window.partitionBy("ordinal").orderBy(*order, "value")
    top = cells.withColumn("_number", F.row_number().over(first)).filter(F.col("_number") <= rows)
    name = F.get(F.array(*[F.lit(c) for c in df.columns]), F.col("ordinal"))
    return top.select(name.alias("column_name"), (F.col("_number") - 1).alias("position"), "value")


def head_and_tail(df: DataFrame, order_by: Sequence[str], rows: int = 5) -> DataFrame:
    """The first and the last ``rows`` rows in the given order, marked ``head`` and ``tail``."""
    head = first_rows(df, order_by, rows).withColumn("part", F.lit("head"))
    tail = first_rows(df, order_by, rows, descending=True).withColumn("part", F.lit("tail"))
    return head.unionByName(tail)


def _catalogue_entry(field: T.StructField) -> dict:
    kind = field.dataType
    fixed = {T.LongType: 19, T.IntegerType: 10, T.ShortType: 5, T.ByteType: 3}
    digits = kind.precision if isinstance(kind, T.DecimalType) else fixed.get(type(kind))
    scale = kind.scale if isinstance(kind, T.DecimalType) else (0 if digits else None)
    declared = field.metadata.get("__CHAR_VARCHAR_TYPE_STRING", "")
    size = declared[declared.find("(") + 1 : -1] if "(" in declared else None
    return {
        "data_type": kind.simpleString(),
        "is_nullable": "YES" if field.nullable else "NO",
        "column_default": field.metadata.get("CURRENT_DEFAULT"),
        "character_maximum_length": int(size) if size else None,
        "numeric_precision": digits,
        "numeric_scale": scale,
    }


def column_catalog(df: DataFrame, table: str, last: int | None = None) -> DataFrame:
    """Name, type, nullability, default, length, precision, scale and ordinal of each column.

    The declared facts come from the schema. ``null_cells`` and ``longest_value`` are measured on
    the rows, as declared lengths are mostly absent. ``last`` keeps the last columns only.
    """
    fields = list(df.schema)
    measured = []
    for i, field in enumerate(fields):
        column = F.col(f"`{field.name}`")
        measured.append(F.count_if(column.isNull()).alias(f"nulls{i}"))
        if _is_text(field):
            measured.append(F.max(F.length(column)).alias(f"longest{i}"))
    types = {
        "data_type": "string", "is_nullable": "string", "column_default": "string",
        "character_maximum_length": "int", "numeric_precision": "int", "numeric_scale": "int",
    }
    rows = []
    for i, field in enumerate(fields):
        entry = _catalogue_entry(field)
        longest = F.col(f"longest{i}") if _is_text(field) else F.lit(None).cast("int")
        rows.append(
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(i + 1).alias("ordinal_position"),
                F.lit(field.name).alias("column_name"),
                *[F.lit(entry[k]).cast(t).alias(k) for k, t in types.items()],
                F.col(f"nulls{i}").alias("null_cells"),
                longest.alias("longest_value"),
            )
        )
    return _one_row_per_column(df.agg(*measured), rows[-last:] if last else rows)


def find_column(catalogue: DataFrame, name: str) -> DataFrame:
    """The catalogue entry of a column, in any case."""
    return catalogue.filter(F.lower("column_name") == name.lower())


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    """The column catalogue of a catalog table whose name may be given in any case."""
    database, _, table = name.rpartition(".")
    database = database or spark.catalog.currentDatabase()
    for known in spark.catalog.listTables(database):
        if known.name.lower() == table.lower():
            return column_catalog(spark.table(f"{database}.{known.name}"), known.name)
    raise ValueError(f"no table {table} in {database}")


def special_names(catalogue: DataFrame, name: str = "column_name") -> DataFrame:
    """Catalogue entries whose names need quoting."""
    return catalogue.filter(has_special_characters(F.col(name)))

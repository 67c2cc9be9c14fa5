"""Catalog tables: create, append, replace, recreate, truncate, and follow schema drift."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.casts import declared_type, stringify
from millrace.functions.names import NamePolicy, clean_columns
from millrace.operators.audit import brief_error
from millrace.operators.infer import apply_types, column_statistics, infer_by_data, mapping_of


def create_text_table(df: DataFrame, table: str, policy: NamePolicy = NamePolicy.STRICT) -> None:
    """Create or replace ``table`` with clean names and every column as text."""
    clean_columns(stringify(df), policy).write.mode("overwrite").saveAsTable(table)


def create_if_absent(df: DataFrame, table: str) -> bool:
    """Create an empty ``table`` with the types found in text columns; True if it was created."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        return False
    found = mapping_of(infer_by_data(column_statistics(df, table)))
    typed = clean_columns(apply_types(df, found).drop("_bad_cells", "_changed_cells"), NamePolicy.LIGHT)
    spark.createDataFrame([], typed.schema).write.saveAsTable(table)
    return True


def append(df: DataFrame, table: str) -> None:
    """Append to an existing table, matching columns by name."""
    if not df.sparkSession.catalog.tableExists(table):
        raise ValueError(f"table {table} does not exist")
    df.write.mode("append").saveAsTable(table)


def overwrite(df: DataFrame, table: str) -> None:
    """Replace the rows of an existing table and keep its columns."""
    target = df.sparkSession.table(table).columns
    df.select(*[F.col(f"`{c}`") for c in target]).write.insertInto(table, overwrite=True)


def recreate(
    df: DataFrame, table: str, expected_rows: int | None = None,
    verify: Callable[[DataFrame], bool] | None = None, types: dict[str, str] | None = None,
) -> dict:
    """Build the new table beside the old one, verify it, and only then swap.

    ``types`` (column to warehouse type) declares the columns, so that the catalogue shows the lengths of texts
    and a longer value fails its write, now and in later appends.

    A load that fails or does not verify leaves the old table as it was. The old table is renamed aside
    and dropped last, so one of both is there at any moment; what a lost driver left aside is put back.
    """
    spark = df.sparkSession
    fresh, aside = f"{table}_new", f"{table}_old"
    if spark.catalog.tableExists(aside):
        if spark.catalog.tableExists(table):
            spark.sql(f"DROP TABLE {aside}")
        else:
            spark.sql(f"ALTER TABLE {aside} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {fresh}")
    if types:
        columns = ", ".join(f"`{c}` {declared_type(types[c])}" for c in df.columns)
        spark.sql(f"CREATE TABLE {fresh} ({columns}) USING parquet")
        df.write.insertInto(fresh)
    else:
        df.write.saveAsTable(fresh)
    loaded = spark.table(fresh)
    rows = loaded.count()
    passed = (expected_rows is None or rows == expected_rows) and (verify is None or verify(loaded))
    if passed:
        if spark.catalog.tableExists(table):
            spark.sql(f"ALTER TABLE {table} RENAME TO {aside}")
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
        spark.sql(f"DROP TABLE IF EXISTS {aside}")
    else:
        spark.sql(f"DROP TABLE {fresh}")
    return {
        "table_name": table,
        "expected_rows": rows if expected_rows is None else expected_rows,
        "actual_rows": rows,
        "verification_passed": passed,
    }


def truncate_report(spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    """Empty each table: rows before and after, and ``failed`` where rows remain or it broke."""
    results = []
    for table in tables:
        try:
            before = spark.table(table).count()
            spark.sql(f"TRUNCATE TABLE {table}")
            after = spark.table(table).count()
            error = None if after == 0 else f"table still has {after} rows after truncation"
            results.append((table, before, after, "failed" if error else "success", error))
        except Exception as problem:  # one broken table must not stop the others
            results.append((table, None, None, "failed", brief_error(problem)))
    return spark.createDataFrame(
        results,
        "table_name string, rows_before bigint, rows_after bigint, status string, error string",
    )


def load_with_drift(df: DataFrame, table: str) -> list[str]:
    """Add the columns ``table`` lacks, then append; columns missing in ``df`` become null."""
    spark = df.sparkSession
    known = spark.table(table).schema
    have = {f.name.lower() for f in known}
    added = [f for f in df.schema if f.name.lower() not in have]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    given = {f.name.lower(): f.name for f in df.schema}
    target = spark.table(table).schema
    columns = [
        (F.col(f"`{given[f.name.lower()]}`") if f.name.lower() in given else F.lit(None))
        .cast(f.dataType).alias(f.name)
        for f in target
    ]
    append(df.select(*columns), table)
    return [f.name for f in added]

"""Bulk loads: cast on load, error modes, rejected rows and load history."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import nullcontext
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions.casts import cast_to, declared_type
from millrace.operators import ledger as ledgers
from millrace.operators.tables import append
from millrace.session import compiled, few_listings
from millrace.sources.csv import RECORD
from millrace.sources.files import ANY_CSV, list_files, matches
from millrace.workspace import scratch_tables

HISTORY_SCHEMA = (
    "file_name string, table_name string, status string, rows_loaded bigint, rows_parsed bigint,"
    " rows_rejected bigint, error_count bigint, first_error string, last_load_time timestamp_ntz,"
    " size bigint, modified timestamp_ntz"
)
MALFORMED = "malformed record"
# A list of this many file names is small enough to send to every executor.
BROADCAST_FILES = 100_000


class LoadAborted(RuntimeError):
    """Raised in abort mode before anything is written."""


@dataclass(frozen=True)
class Field:
    """One target column of a load.

    ``source`` is the raw column, ``lenient`` turns bad values into null instead of an error, and
    ``upper`` changes text to upper case.
    """

    name: str
    type: str = "VARCHAR"
    source: str | None = None
    lenient: bool = False
    upper: bool = False

    @property
    def raw(self) -> Column:
        return F.col(f"`{self.source or self.name}`")

    def value(self) -> Column:
        value = cast_to(self.raw, self.type)
        return F.upper(value) if self.upper else value

    def problem(self) -> Column | None:
        """Why a raw value cannot be loaded, or null; None where no value can fail."""
        kind, _, size = self.type.upper().partition("(")
        if self.lenient or (kind == "VARCHAR" and not size):
            return None
        if kind == "VARCHAR":
            bad = F.length(self.raw) > int(size.rstrip(")"))
            reason = f"longer than {size.rstrip(')')} characters"
        else:
            bad = self.raw.isNotNull() & cast_to(self.raw, self.type).isNull()
            reason = f"not a {self.type}"
        return F.when(
            bad,
            F.struct(
                F.lit(self.name).alias("column_name"),
                self.raw.alias("value"),
                F.lit(reason).alias("reason"),
            ),
        )


def by_position(df: DataFrame) -> DataFrame:
    """Name the columns of a file ``_1``, ``_2``, … for a projection by position."""
    return df.toDF(*[f"_{i + 1}" for i in range(len(df.columns))])


def transform_on_load(raw: DataFrame, fields: Sequence[Field], where: Column | None = None) -> DataFrame:
    """Project, cast and filter while reading. Bad values become null; :func:`check_rows` finds
    them."""
    typed = raw.select(*[f.value().alias(f.name) for f in fields])
    return typed if where is None else typed.filter(where)


def check_rows(raw: DataFrame, fields: Sequence[Field], keep: Sequence[str] = ()) -> DataFrame:
    """Typed columns, the columns to ``keep`` and ``_errors``, the list of what is wrong.

    Where ``raw`` has the column ``_record`` (see :func:`read_csv_checked`), a line that could not be read is one
    error with the whole line, whatever the fields make of it.
    """
    problems = [p for p in (f.problem() for f in fields) if p is not None]
    errors = (
        F.array_compact(F.array(*problems))
        if problems
        else F.expr("CAST(array() AS array<struct<column_name:string,value:string,reason:string>>)")
    )
    if RECORD in raw.columns:
        line = F.struct(F.lit("record").alias("column_name"), F.col(RECORD).alias("value"), F.lit(MALFORMED).alias("reason"))
        errors = F.when(F.col(RECORD).isNotNull(), F.array(line)).otherwise(errors)
    values = [f.value().alias(f.name) for f in fields]
    return raw.select(*[F.col(f"`{c}`") for c in keep], *values, errors.alias("_errors"))


def good_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("_errors") == 0).drop("_errors")


def rejects(checked: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row per bad value: where it stood, the column, the value and the reason."""
    bad = checked.filter(F.size("_errors") > 0)
    return bad.select(*keep, F.explode("_errors").alias("e")).select(*keep, "e.*")


def file_report(checked: DataFrame, file_column: str) -> DataFrame:
    """Rows parsed and rejected, values in error and the first error of each file, from one pass.

    Rows are first counted by file and first error, which hashing does within the map tasks; all good rows of
    a file are one group there. Only these groups are put in order for the smallest error.
    """
    file = F.col(file_column).alias("file_name")
    groups = checked.groupBy(file, F.get("_errors", F.lit(0)).alias("_error")).agg(
        F.count(F.lit(1)).alias("_rows"), F.sum(F.size("_errors")).alias("_wrong")
    )
    nothing = F.lit(0).cast("bigint")
    counts = groups.groupBy("file_name").agg(
        F.sum("_rows").alias("rows_parsed"),
        F.sum(F.when(F.col("_error").isNotNull(), F.col("_rows")).otherwise(nothing)).alias("rows_rejected"),
        F.sum("_wrong").alias("error_count"),
        F.min("_error").alias("e"),
    )
    message = F.concat_ws(" ", "e.column_name", F.concat(F.lit("'"), "e.value", F.lit("'")), "e.reason")
    first = F.when(F.col("e").isNotNull(), message).alias("first_error")
    return counts.select("file_name", "rows_parsed", "rows_rejected", "error_count", first)


def rows_of_clean_files(checked: DataFrame, file_column: str, report: DataFrame) -> DataFrame:
    """The rows of files without any bad row, as ``report`` (see :func:`file_report`) has them.

    The list of bad files is broadcast only while it is short; beyond that the adaptive join
    splits the rows of a large file. Rows without a file are one file.
    """
    bad = report.filter("rows_rejected > 0").select(F.col("file_name").alias("_file"))
    small = bad.limit(BROADCAST_FILES + 1).count() <= BROADCAST_FILES
    kept = checked.join(
        F.broadcast(bad) if small else bad, F.col(file_column).eqNullSafe(F.col("_file")), "left_anti"
    )
    return kept.drop("_errors")


@dataclass(frozen=True)
class LoadResult:
    """``rejects`` and ``history`` are read from the source when they are used."""

    rejects: DataFrame
    history: DataFrame


def bulk_load(
    raw: DataFrame,
    fields: Sequence[Field],
    table: str,
    file_column: str,
    on_error: str = "continue",
    keep: Sequence[str] = (),
    loaded_at: datetime | None = None,
    history_table: str | None = None,
    files: DataFrame | None = None,
    ledger: str | None = None,
    loader: str = "batch",
) -> LoadResult:
    """Load ``raw`` into an existing table and report on each file.

    ``continue`` loads the good rows, ``abort`` raises before writing when any row is bad,
    ``skip_file`` leaves out files with a bad row, ``validate`` writes nothing. Every row that is loaded
    is written once, straight from the source; the report is one more pass over the source that only
    counts, which ``abort`` and ``skip_file`` make first. It is appended
    to ``history_table`` where one is named, also for an aborted load. ``files`` (path, size, modified) brings in files without rows, and what a file looked like.

    With a ``ledger`` the load counts once: rows and history lines carry the load's name and count from its
    commit on, and what an earlier failed run of this ``loader`` has left is removed first. The table must
    be one of :func:`ledger.create_tagged_target`, the history one of :func:`create_history` with ``tagged``.
    """
    if on_error not in ("continue", "abort", "skip_file", "validate"):
        raise ValueError(f"unknown error mode {on_error}")
    kept = list(dict.fromkeys([file_column, *keep]))
    checked = check_rows(raw, fields, kept)
    names = [F.col(f"`{f.name}`") for f in fields]
    report, spark = file_report(checked, file_column), raw.sparkSession
    looks_first = on_error in ("abort", "skip_file")
    with compiled(spark), scratch_tables(spark) if looks_first else nullcontext() as keep_until_done:
        # These modes look at all files before they write, and need not look again.
        seen = keep_until_done(report) if keep_until_done else report
        aborted, load_id = None, None
        if on_error == "abort":
            bad = seen.filter("rows_rejected > 0").agg(
                F.sum("rows_rejected").alias("rows"), F.min("first_error").alias("error")
            ).first()
            aborted = LoadAborted(f"{bad.rows} bad rows, first: {bad.error}") if bad.rows else None
        if ledger:
            ledgers.roll_back(spark, table, ledger, loader)
            load_id = ledgers.load_name(spark, ledger, table, loader, files)
            ledgers.note(spark, ledger, load_id, table, loader, ledgers.INTENT)

        def write(rows: DataFrame) -> None:
            rows = rows.select(*names)
            if load_id:
                ledgers.write_tagged(rows, table, load_id)
            else:
                append(rows, table)

        if on_error == "continue" or on_error == "abort" and not aborted:
            write(good_rows(checked))
        elif on_error == "skip_file":
            write(rows_of_clean_files(checked, file_column, seen))
        told = table, on_error, on_error == "validate" or aborted is not None, loaded_at, files
        history = load_report(seen, *told)
        if history_table:
            noted = history.withColumn(ledgers.TAG, F.lit(load_id)) if load_id else history
            noted.write.mode("append").saveAsTable(history_table)
        if load_id:
            ledgers.note(spark, ledger, load_id, table, loader, ledgers.COMMIT)
    if aborted:
        raise aborted
    return LoadResult(rejects(checked, kept), load_report(report, *told))


def load_report(
    report: DataFrame, table: str, on_error: str, nothing: bool, loaded_at: datetime | None, files: DataFrame | None
) -> DataFrame:
    """What the load history says of every file of ``report``; ``nothing`` says that no row was written."""
    report = report.withColumn("file_name", F.col("file_name").cast("string"))
    if files is not None:
        facts = files.select(F.col("path").alias("file_name"), "size", "modified")
        report = facts.join(report, "file_name", "left").fillna(0, ["rows_parsed", "rows_rejected", "error_count"])
    else:
        report = report.withColumn("size", F.lit(None).cast("bigint"))
        report = report.withColumn("modified", F.lit(None).cast("timestamp_ntz"))
    good = F.col("rows_parsed") - F.col("rows_rejected")
    whole_file = F.when(F.col("rows_rejected") == 0, good).otherwise(F.lit(0).cast("bigint"))
    loaded = F.lit(0).cast("bigint") if nothing else whole_file if on_error == "skip_file" else good
    status = (
        F.when(F.lit(nothing and on_error != "validate"), "LOAD_FAILED")
        .when(F.col("rows_loaded") == F.col("rows_parsed"), "LOADED")
        .when(F.lit(on_error == "validate"), "VALIDATED")
        .when(F.col("rows_loaded") == 0, "LOAD_FAILED")
        .otherwise("PARTIALLY_LOADED")
    )
    moment = F.lit(loaded_at.isoformat(" ")) if loaded_at else F.current_timestamp()
    return (
        report.withColumn("rows_loaded", loaded)
        .withColumn("status", status)
        .withColumn("table_name", F.lit(table))
        .withColumn("last_load_time", moment.cast("timestamp_ntz"))
        .select("file_name", "table_name", "status", "rows_loaded", "rows_parsed", "rows_rejected",
                "error_count", "first_error", "last_load_time", "size", "modified")
    )


def create_target(spark: SparkSession, table: str, fields: Sequence[Field]) -> None:
    """An empty table with the columns that a load of ``fields`` fills."""
    columns = ", ".join(f"`{f.name}` {declared_type(f.type)}" for f in fields)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet")


def create_history(spark: SparkSession, history_table: str, tagged: bool = False) -> None:
    """An empty load history; ``tagged`` where its lines name their load, for loads with a ledger."""
    schema = f"{HISTORY_SCHEMA}, {ledgers.TAG} string" if tagged else HISTORY_SCHEMA
    spark.createDataFrame([], schema).write.mode("ignore").saveAsTable(history_table)


def new_files(listing: DataFrame, history: DataFrame, table: str) -> DataFrame:
    """Files of a listing that no load has brought into ``table``, by path, size and time of change."""
    done = history.filter(F.col("status").isin("LOADED", "PARTIALLY_LOADED") & (F.col("table_name") == table))
    loaded = done.select(F.col("file_name").alias("path"), "size", "modified")
    return listing.join(loaded, ["path", "size", "modified"], "left_anti")


def load_new_files(
    spark: SparkSession,
    folder: str,
    table: str,
    history_table: str,
    load: Callable[[list[str], DataFrame], None],
    force: bool = False,
    pattern: str = ANY_CSV,
    batch: int = 5_000,
    ledger: str | None = None,
) -> int:
    """Call ``load`` for the files that ``history_table`` does not have as loaded, in batches.

    ``load`` gets the paths of a batch, which a reader needs, and their table (path, size, modified); it
    passes the latter to :func:`bulk_load` with the history table, which notes them. The folder is
    listed once. With ``force`` all files are loaded again. Without a ledger a batch is noted after it is loaded,
    and a driver lost in between loads it twice; with a ``ledger``, which ``load`` passes on too, only committed
    loads count, and none twice. Returns the number of files.
    """
    listing = list_files(spark, folder, "*").filter(matches(F.col("path"), pattern))
    history = ledgers.committed(spark, table, ledger, history_table) if ledger else spark.table(history_table)
    wanted = listing if force else new_files(listing, history, table)
    with few_listings(spark), scratch_tables(spark) as keep:  # readers list their paths as tasks too
        files = keep(wanted.select("path", "size", "modified"))
        total = files.count()
        batches = max(-(-total // batch), 1)
        files = files.withColumn("_batch", F.pmod(F.xxhash64("path"), F.lit(batches)))
        for number in range(batches if total else 0):
            part = files.filter(F.col("_batch") == number).drop("_batch")
            paths = [r.path for r in part.select("path").collect()]  # some ``batch`` of them
            if paths:
                load(paths, part)
    return total


def load_history(history: DataFrame, as_of: datetime, table: str | None = None, hours: int = 24) -> DataFrame:
    """Loads of the last ``hours`` before ``as_of``, of one table or all, newest first."""
    end = F.lit(as_of.isoformat(" ")).cast("timestamp_ntz")
    start = end - F.expr(f"INTERVAL {hours} HOURS")
    recent = history.filter((F.col("last_load_time") >= start) & (F.col("last_load_time") <= end))
    if table is not None:
        recent = recent.filter(F.col("table_name") == table)
    return recent.orderBy(F.desc("last_load_time"))


def failed_loads(history: DataFrame, as_of: datetime, hours: int = 1) -> DataFrame:
    """Failed loads of the last ``hours`` with their first error, newest first."""
    return (
        load_history(history, as_of, hours=hours)
        .filter(F.col("status") == "LOAD_FAILED")
        .select("file_name", "first_error", "error_count", "last_load_time")
    )

"""The whole way of raw files to verified tables: resolve, read, clean, type, load, verify."""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from millrace.functions.names import clean_name, unique_names
from millrace.operators import infer, tables
from millrace.operators.audit import RESULT_SCHEMA, append_audit, audit_rows, brief_error
from millrace.operators.clean import clean_table
from millrace.sources.csv import MULTI_LINE, READER_DEFAULTS, CsvFormat, read_csv, spread
from millrace.session import compiled
from millrace.sources.files import list_files, resolve_files
from millrace.spec import TableName, TableSpec
from millrace.workspace import scratch_tables


def inbox_entries(spark: SparkSession, inbox: str) -> DataFrame:
    """(name, ordinal) of what lies directly in ``inbox``: files, or folders of part files.

    Listings are in order of names, and may write the scheme of ``inbox`` in another way (``file:/`` for ``file:///``).
    """
    place = re.sub("^[A-Za-z][A-Za-z0-9+.-]*:/+", "", inbox).strip("/")
    below = F.substring_index("path", f"/{place}/", -1)
    names = list_files(spark, inbox).select(F.split(below, "/")[0].alias("name")).distinct()
    return names.withColumn("ordinal", F.col("name"))


def target_of(spark: SparkSession, spec: TableSpec, database: str) -> str:
    """The catalog table of a spec: in ``database``, or where a three-part name says."""
    if "." not in spec.name:
        return f"{database}.{spec.name}"
    name = TableName.parse(spec.name)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.catalog_database}")
    return name.catalog_name


def load_table(
    spark: SparkSession, spec: TableSpec, path: str, database: str, fmt: CsvFormat | None = None,
    mapping_table: str | None = None, exact: bool = False, stages: list[tuple[str, dict]] | None = None,
) -> dict:
    """Clean one landed table, find its types, replace the warehouse table, and report.

    The cleaned rows are written once; statistics and the typed rows read that copy, which goes at the end. ``bad_cells`` and ``changed_cells`` count what the casts lost or altered; either makes
    the outcome a warning; ``exact`` chooses types that alter no number. The types go to ``mapping_table`` where one is named.
    What each stage that was reached has done is appended to ``stages``.
    """
    def note(stage: str, rows: int, problem: str | None = None, **details) -> None:
        if stages is not None:
            status = "warning" if problem else "success"
            stages.append((stage, {
                "table_name": spec.name, "source": spec.source, "status": status, "error": problem, "rows_loaded": rows,
                "total_columns": len(columns), **details,
            }))

    fmt = fmt or (MULTI_LINE if spec.multi_line else READER_DEFAULTS)
    raw = read_csv(spark, path, fmt)
    raw = spread(raw) if fmt.multi_line else raw
    source = Observation()
    raw = raw.observe(source, F.count(F.lit(1)).alias("rows"))
    with scratch_tables(spark) as keep:
        # Positions stand in for the columns' names, which a catalog table may not be able to hold.
        cleaned = clean_table(raw, spec)
        columns = cleaned.columns
        staged = keep(cleaned.toDF(*[f"_{i}" for i in range(len(columns))])).toDF(*columns)
        rows = staged.count()
        note("clean", rows, rows_read=source.get["rows"])
        inferred = infer.infer_by_name_and_data(infer.column_statistics(staged, spec.name), widest=True, exact=exact)
        found = infer.mapping_of(inferred)
        names = dict(zip(found, unique_names([clean_name(c) for c in found]), strict=True))
        note("infer", rows, types=found)
        # The cells are counted as the rows go to the new table.
        told = Observation()
        typed = infer.apply_types(staged, found, names).observe(
            told, F.coalesce(F.sum("_bad_cells"), F.lit(0)).alias("bad"), F.coalesce(F.sum("_changed_cells"), F.lit(0)).alias("changed"),
        )
        outcome = tables.recreate(
            typed.drop("_bad_cells", "_changed_cells"), target_of(spark, spec, database), rows,
            types={names[c]: kind for c, kind in found.items()},
        )
        # An empty plan may be cut short, and then tells nothing.
        cells = told.get if rows else {"bad": 0, "changed": 0}
        bad, changed = cells["bad"], cells["changed"]
        if mapping_table:
            infer.save_mapping(inferred, names, spec.name, mapping_table)
    expected = spec.expected_rows
    complete = outcome["verification_passed"] and expected in (None, outcome["actual_rows"])
    problems = [f"{n} cells {what}" for n, what in ((bad, "lost"), (changed, "changed")) if n]
    wanted = rows if expected is None else expected
    note("verify", outcome["actual_rows"], None if complete else f"{outcome['actual_rows']} rows, not {wanted}", rows_expected=wanted)
    return {
        "status": "success" if complete and not problems else "warning",
        "error": "; ".join(problems) or None,
        "rows_loaded": outcome["actual_rows"],
        "total_columns": len(columns),
    }


def run_tables(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    inbox: str,
    database: str,
    workers: int = 4,
    audit_table: str | None = None,
    mapping_table: str | None = None,
    exact: bool = False,
) -> DataFrame:
    """Load every table of ``specs`` from ``inbox``; one result row each.

    Tables run side by side on one session, and a failure stays with its table. The results are
    appended to ``audit_table``, the types found to ``mapping_table``, where these are named. The audit has a row a
    table for the load and for each stage around it (clean, infer, verify) that was reached; the stage that failed
    says so. With ``exact`` no number loses a digit or a leading zero to its type.
    """
    requests = spark.createDataFrame([(s.source,) for s in specs], "request string")
    found = {
        r.request: r.file for r in resolve_files(requests, inbox_entries(spark, inbox)).collect()
    }

    def one(spec: TableSpec) -> tuple[tuple, list[tuple[str, dict]]]:
        file, stages = found[spec.source], []
        if file is None:
            report = {"status": "failed", "error": f"no file for {spec.source}", "rows_loaded": 0, "total_columns": 0}
        else:
            try:
                report = load_table(spark, spec, f"{inbox}/{file}", database, mapping_table=mapping_table, exact=exact, stages=stages)
            except Exception as problem:  # the other tables go on
                report = {"status": "failed", "error": brief_error(problem), "rows_loaded": 0, "total_columns": 0}
                reached = [stage for stage, _ in stages]
                failed = next((stage for stage in ("clean", "infer") if stage not in reached), None)
                if failed:  # else it was the load, which has a row anyhow
                    stages.append((failed, {"table_name": spec.name, "source": spec.source, **report}))
        row = spec.name, spec.source, report["status"], report["error"], report["rows_loaded"], report["total_columns"]
        return row, stages

    with compiled(spark), ThreadPoolExecutor(workers) as pool:
        done = list(pool.map(one, specs))
    outcome = spark.createDataFrame([row for row, _ in done], RESULT_SCHEMA)
    if audit_table:
        noted = [entry for _, stages in done for entry in stages]
        noted += [("load", r.asDict()) for r in outcome.collect()]
        rows = [audit_rows(spark, s, [d for stage, d in noted if stage == s]) for s in ("clean", "infer", "load", "verify")]
        append_audit(reduce(DataFrame.unionByName, rows), audit_table)
    return outcome

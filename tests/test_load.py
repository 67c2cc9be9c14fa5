"""Bulk loads: error modes, reports, history, and the table operators."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from millrace.operators import audit, load, tables
from millrace.operators.load import Field
from millrace.workspace import fresh_database

FIELDS = [
    Field("id", "NUMBER(10)", "_1"),
    Field("day", "DATE", "_2"),
    Field("name", "VARCHAR(3)", "_3", upper=True),
    Field("hours", "FLOAT", "_4", lenient=True),
]
ROWS = [
    ("f1", "1", "2024-01-01", "abc", "1.5"),
    ("f1", "2", "2024-01-02", None, "x"),
    ("f2", "x", "soon", "abcd", "2"),
    ("f2", "3", "2024-01-03", "ab", None),
    ("f3", "x", None, "a", "1"),
]


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(ROWS, "file string, _1 string, _2 string, _3 string, _4 string")


@pytest.fixture
def target(spark):
    name = f"{fresh_database(spark, 'test')}.t"
    spark.sql(f"CREATE TABLE {name} (id BIGINT, day DATE, name STRING, hours DOUBLE) USING parquet")
    return name


def ids(spark, table):
    return sorted(r.id for r in spark.table(table).collect())


def history(result):
    rows = result.history.orderBy("file_name").collect()
    return [(r.file_name, r.status, r.rows_loaded, r.rows_parsed, r.rows_rejected, r.error_count, r.first_error) for r in rows]


def test_continue(spark, raw, target):
    result = load.bulk_load(raw, FIELDS, target, "file", loaded_at=datetime(2024, 1, 1))
    assert ids(spark, target) == [1, 2, 3]
    assert [r.name for r in spark.table(target).orderBy("id").collect()] == ["ABC", None, "AB"]
    assert history(result) == [
        ("f1", "LOADED", 2, 2, 0, 0, None),
        ("f2", "PARTIALLY_LOADED", 1, 2, 1, 3, "id 'x' not a NUMBER(10)"),
        ("f3", "LOAD_FAILED", 0, 1, 1, 1, "id 'x' not a NUMBER(10)"),
    ]
    found = sorted((r.file, r.column_name, r.value, r.reason) for r in result.rejects.collect())
    assert found == [
        ("f2", "day", "soon", "not a DATE"),
        ("f2", "id", "x", "not a NUMBER(10)"),
        ("f2", "name", "abcd", "longer than 3 characters"),
        ("f3", "id", "x", "not a NUMBER(10)"),
    ]


def test_good_and_rejected_rows_make_the_whole(raw):
    checked = load.check_rows(raw, FIELDS, ["file"])
    bad = checked.filter(F.size("_errors") > 0).count()
    assert load.good_rows(checked).count() + bad == len(ROWS)


def test_abort_writes_nothing(spark, raw, target):
    with pytest.raises(load.LoadAborted, match="2 bad rows"):
        load.bulk_load(raw, FIELDS, target, "file", on_error="abort")
    assert ids(spark, target) == []
    load.bulk_load(raw.filter("file = 'f1'"), FIELDS, target, "file", on_error="abort")
    assert ids(spark, target) == [1, 2]


@pytest.mark.parametrize("limit", [100_000, 0])
def test_skip_file(spark, raw, target, monkeypatch, limit):
    monkeypatch.setattr(load, "BROADCAST_FILES", limit)
    result = load.bulk_load(raw, FIELDS, target, "file", on_error="skip_file")
    assert ids(spark, target) == [1, 2]
    assert [h[1:3] for h in history(result)] == [("LOADED", 2), ("LOAD_FAILED", 0), ("LOAD_FAILED", 0)]


def test_validate(spark, raw, target):
    result = load.bulk_load(raw, FIELDS, target, "file", on_error="validate")
    assert ids(spark, target) == [] and result.rejects.count() == 4
    with pytest.raises(ValueError):
        load.bulk_load(raw, FIELDS, target, "file", on_error="ignore")


def test_only_lenient_fields(raw):
    checked = load.check_rows(raw, [Field("hours", "FLOAT", "_4", lenient=True)])
    assert load.good_rows(checked).count() == len(ROWS)


def test_positions_and_filter(spark):
    raw = load.by_position(spark.createDataFrame([("p", "CANCELLED"), ("q", None), ("r", "open")], "a string, b string"))
    fields = [Field("project", source="_1"), Field("status", source="_2", upper=True)]
    kept = load.transform_on_load(raw, fields, F.col("status") != "CANCELLED")
    assert [tuple(r) for r in kept.collect()] == [("r", "OPEN")]


def test_load_new_files(spark, folder):
    from pathlib import Path

    database = fresh_database(spark, "test")
    table, history = f"{database}.t", f"{database}.history"
    spark.sql(f"CREATE TABLE {table} (x BIGINT) USING parquet")
    load.create_history(spark, history)
    seen, parts = [], []

    def run(on_error="continue", **options):
        seen.clear()
        parts.clear()

        def one(paths, found):
            seen.extend(p[-5:] for p in paths)
            parts.append(len(paths))
            raw = spark.read.schema("x string").option("header", "true").csv(paths).select(F.col("_metadata.file_path").alias("path"), "x")
            load.bulk_load(raw, [Field("x", "NUMBER(3)")], table, "path", on_error, history_table=history, files=found)

        count = load.load_new_files(spark, folder, table, history, one, **options)
        return count, sorted(seen)

    for name in ("a.csv", "b.csv", "c.txt"):
        Path(folder, name).write_text("x\n1\n")
    assert run() == (2, ["a.csv", "b.csv"])
    assert run() == (0, [])
    Path(folder, "b.csv").write_text("x\n1\n2\n")
    Path(folder, "d.csv").write_text("x\n")
    assert run() == (2, ["b.csv", "d.csv"])
    none = [r for r in spark.table(history).collect() if r.file_name.endswith("d.csv")]
    assert [(r.status, r.rows_parsed, r.size) for r in none] == [("LOADED", 0, 2)]  # a file without rows has an entry
    assert run(force=True) == (3, ["a.csv", "b.csv", "d.csv"])
    assert run(pattern=".*[.]txt") == (1, ["c.txt"])
    Path(folder, "e.csv").write_text("x\nbad\n1234\n")
    assert run() == (1, ["e.csv"]) and run() == (1, ["e.csv"])  # what failed is tried again
    with pytest.raises(load.LoadAborted):
        run("abort")
    failed = load.failed_loads(spark.table(history), datetime.now(timezone.utc).replace(tzinfo=None) + timedelta(minutes=1))
    assert {(r.error_count, r.first_error) for r in failed.collect()} == {(2, "x '1234' not a NUMBER(3)")}
    for i in range(20):
        Path(folder, f"m{i}.csv").write_text("x\n1\n")
    assert run(batch=5)[0] == 21 and len(parts) > 2
    assert spark.table(history).filter("status = 'LOADED'").count() == 8 + 20


def test_loads_leave_nothing_behind(spark, raw, target):
    from pathlib import Path

    from millrace.workspace import shared_root

    place = Path(shared_root(spark)) / "millrace"
    before = set(place.iterdir()) if place.exists() else set()
    for mode in ("continue", "skip_file", "validate"):
        load.bulk_load(raw, FIELDS, target, "file", on_error=mode)
    assert (set(place.iterdir()) if place.exists() else set()) == before


def test_history_window(spark):
    now = datetime(2024, 1, 2, 12)
    rows = [("a", "t", "LOADED", now - timedelta(hours=25)), ("b", "t", "LOADED", now - timedelta(hours=24)),
            ("c", "u", "LOAD_FAILED", now - timedelta(minutes=5)), ("d", "t", "LOAD_FAILED", now + timedelta(seconds=1))]
    full = [(f, t, s, 0, 1, 1, 1, "bad", m, 1, now) for f, t, s, m in rows]
    table = spark.createDataFrame(full, load.HISTORY_SCHEMA)
    assert [r.file_name for r in load.load_history(table, now).collect()] == ["c", "b"]
    assert [r.file_name for r in load.load_history(table, now, "t").collect()] == ["b"]
    assert [r.file_name for r in load.failed_loads(table, now).collect()] == ["c"]


def test_append_needs_a_table_and_goes_by_name(spark):
    database = fresh_database(spark, "test")
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    with pytest.raises(ValueError):
        tables.append(df, f"{database}.none")
    df.write.saveAsTable(f"{database}.t")
    tables.append(df.select("name", "id"), f"{database}.t")
    assert [tuple(r) for r in spark.table(f"{database}.t").collect()] == [(1, "a")] * 2
    tables.overwrite(spark.createDataFrame([("b", 2)], "name string, id int"), f"{database}.t")
    assert [tuple(r) for r in spark.table(f"{database}.t").collect()] == [(2, "b")]


def test_failed_recreate_keeps_the_old_table(spark):
    name = f"{fresh_database(spark, 'test')}.t"
    spark.range(3).write.saveAsTable(name)
    failed = tables.recreate(spark.range(5), name, expected_rows=6)
    assert not failed["verification_passed"] and spark.table(name).count() == 3
    assert not tables.recreate(spark.range(5), name, verify=lambda df: False)["verification_passed"]
    assert tables.recreate(spark.range(5), name, 5)["verification_passed"] and spark.table(name).count() == 5
    assert not spark.catalog.tableExists(f"{name}_new") and not spark.catalog.tableExists(f"{name}_old")
    # A driver lost in the middle of the swap leaves the old table aside; the next run puts it back.
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}_old")
    assert not tables.recreate(spark.range(2), name, expected_rows=9)["verification_passed"]
    assert spark.table(name).count() == 5


def test_drift(spark):
    name = f"{fresh_database(spark, 'test')}.t"
    spark.createDataFrame([(1, "a")], "id int, name string").write.saveAsTable(name)
    added = tables.load_with_drift(spark.createDataFrame([(2.5, 2)], "price double, ID int"), name)
    assert added == ["price"]
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [(1, "a", None), (2, None, 2.5)]
    assert tables.load_with_drift(spark.createDataFrame([(3,)], "id int"), name) == []


def test_create_if_absent(spark):
    name = f"{fresh_database(spark, 'test')}.t"
    df = spark.createDataFrame([("1", "2.5", "true", "x")], "`a b` string, `c-d` string, e string, f string")
    assert tables.create_if_absent(df, name) and not tables.create_if_absent(df, name)
    assert spark.table(name).dtypes == [("a_b", "decimal(38,0)"), ("c_d", "double"), ("e", "boolean"), ("f", "string")]


def test_audit(spark):
    name = f"{fresh_database(spark, 'test')}.audit"
    results = [{"table_name": t, "status": s, "rows_loaded": n, "total_columns": 2} for t, s, n in
               [("a", "success", 5), ("b", "warning", 3), ("c", "failed", 7), ("d", "failed", None)]]
    audit.append_audit(audit.audit_rows(spark, "load", results), name)
    audit.append_audit(audit.audit_rows(spark, "clean", results[:1]), name)
    found = audit.results_of(spark.table(name))
    summary = {r.stage: tuple(r)[1:] for r in audit.audit_summary(found, "stage").collect()}
    assert summary == {"load": (4, 1, 1, 2, 8, 4, 50.0), "clean": (1, 1, 0, 0, 5, 2, 100.0)}
    assert tuple(audit.audit_summary(found.limit(0)).first()) == (0, 0, 0, 0, 0, 0, 0.0)


def test_lengths_are_declared(spark):
    database = fresh_database(spark, "test")
    df = spark.createDataFrame([("abc", 1)], "name string, n long")
    assert tables.recreate(df, f"{database}.t", 1, types={"name": "VARCHAR(5)", "n": "NUMBER(10)"})["verification_passed"]
    field = spark.table(f"{database}.t").schema["name"]
    assert field.metadata["__CHAR_VARCHAR_TYPE_STRING"] == "varchar(5)"
    tables.append(df, f"{database}.t")
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        tables.append(df.withColumn("name", F.lit("longer than five")), f"{database}.t")
    assert spark.table(f"{database}.t").count() == 2
    load.create_target(spark, f"{database}.u", [Field("a", "VARCHAR(3)"), Field("b", "NUMBER(12,2)"), Field("c")])
    assert spark.table(f"{database}.u").dtypes == [("a", "string"), ("b", "decimal(12,2)"), ("c", "string")]

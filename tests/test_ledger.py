"""Loads that fail half way and are run again; lines that cannot be read."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.operators import ledger as ledgers, load
from millrace.operators.load import Field
from millrace.sources.csv import BULK_LOAD, LINE, READER_DEFAULTS, RECORD, CsvFormat, is_well_formed, read_csv_checked
from millrace.workspace import fresh_database

FIELDS = [Field("x", "NUMBER(3)"), Field("y")]


class Lost(RuntimeError):
    """Stands for a driver that dies."""


@pytest.fixture
def place(spark):
    database = fresh_database(spark, "ledger")
    names = [f"{database}.{n}" for n in ("t", "history", "ledger")]
    ledgers.create_tagged_target(spark, names[0], FIELDS)
    load.create_history(spark, names[1], tagged=True)
    ledgers.create_ledger(spark, names[2])
    return names


def run(spark, folder, place, loader="batch", force=False, batch=5_000):
    table, history, ledger = place

    def one(paths, files):
        raw = read_csv_checked(spark, paths, ["x", "y"]).withColumn("file_path", F.regexp_replace("file_path", "^file:/+", "file:/"))
        load.bulk_load(raw, FIELDS, table, "file_path", history_table=history, files=files, ledger=ledger, loader=loader)

    return load.load_new_files(spark, folder, table, history, one, ledger=ledger, force=force, batch=batch)


def rows(spark, place):
    return sorted(r.x for r in ledgers.committed(spark, place[0], place[2]).collect())


def files(spark, place):
    return sorted((Path(r.file_name).name, r.rows_loaded) for r in ledgers.committed(spark, place[0], place[2], place[1]).collect())


@pytest.mark.parametrize("moment", ["intent", "rows", "history", "commit"])
def test_a_load_that_fails_counts_once_when_it_is_repeated(spark, folder, place, monkeypatch, moment):
    for i in range(3):
        Path(folder, f"{i}.csv").write_text(f"x,y\n{i},a\n{10 + i},b\n")
    note, write, report = ledgers.note, ledgers.write_tagged, load.load_report

    def lost_note(*arguments):
        if arguments[-1] == ledgers.COMMIT and moment == "commit":
            raise Lost
        note(*arguments)
        if arguments[-1] == ledgers.INTENT and moment == "intent":
            raise Lost

    def lost_write(*arguments):
        write(*arguments)
        if moment == "rows":
            raise Lost

    def lost_report(*arguments):
        if moment == "history":
            raise Lost
        return report(*arguments)

    with monkeypatch.context() as patch:
        patch.setattr(ledgers, "note", lost_note)
        patch.setattr(ledgers, "write_tagged", lost_write)
        patch.setattr(load, "load_report", lost_report)
        for _ in range(2):  # and once more in the same way
            with pytest.raises(Lost):
                run(spark, folder, place)
    assert rows(spark, place) == [] and files(spark, place) == []
    Path(folder, "new.csv").write_text("x,y\n99,z\n")  # so the repeated batch is another one
    assert run(spark, folder, place) == 4
    assert rows(spark, place) == [0, 1, 2, 10, 11, 12, 99]
    assert spark.table(place[0]).count() == 7  # nothing of the failed runs is left either
    assert files(spark, place) == [("0.csv", 2), ("1.csv", 2), ("2.csv", 2), ("new.csv", 1)]
    assert run(spark, folder, place) == 0
    assert not ledgers.loads_of(spark, place[2], place[0]).filter("NOT ended").count()


def test_batches_and_forced_loads(spark, folder, place):
    for i in range(6):
        Path(folder, f"{i}.csv").write_text(f"x,y\n{i},a\n")
    assert run(spark, folder, place, batch=2) == 6 and rows(spark, place) == list(range(6))
    assert run(spark, folder, place, force=True) == 6 and rows(spark, place) == sorted([*range(6)] * 2)


def test_a_repeated_load_replaces_its_own_rows_only(spark, folder, place, monkeypatch):
    Path(folder, "a.csv").write_text("x,y\n1,a\n")
    note = ledgers.note

    def lost(*arguments):
        if arguments[-1] == ledgers.COMMIT:
            raise Lost
        note(*arguments)

    with monkeypatch.context() as patch:
        patch.setattr(ledgers, "note", lost)
        with pytest.raises(Lost):
            run(spark, folder, place, loader="one")
        # Without a chance to roll back first, the same load still writes over its own partition.
        patch.setattr(ledgers, "roll_back", lambda *a: [])
        with pytest.raises(Lost):
            run(spark, folder, place, loader="one")
    assert spark.table(place[0]).count() == 1
    # Another loader leaves what this one has begun alone.
    assert ledgers.roll_back(spark, place[0], place[2], "two") == [] and spark.table(place[0]).count() == 1
    assert len(ledgers.roll_back(spark, place[0], place[2], "one")) == 1 and spark.table(place[0]).count() == 0
    assert run(spark, folder, place, loader="one") == 1 and rows(spark, place) == [1]


LINES = [  # line, well formed as it is, well formed with blanks trimmed
    ('5,"6', False, False), ('"a"b,1', False, False), ('"a","b"', True, True), ('"a ""q"" b",c', True, True), ('5" pipe,x', True, True),
    ('a,"b,c",d', True, True), ('a,""', True, True), ('a,"""', False, False), ("plain,line", True, True), ('a, "b"', True, True),
    ('a, "b', True, False), ('"a" ,b', False, True), (",,", True, True), ('"', False, False), ('a,"b"x,"c', False, False),
]


@pytest.mark.parametrize("trim", [False, True])
def test_quotes(spark, trim):
    given = spark.createDataFrame([(line,) for line, *_ in LINES], "line string")
    got = [r[0] for r in given.select(is_well_formed(F.col("line"), CsvFormat(trim=trim))).collect()]
    assert got == [x[2 if trim else 1] for x in LINES]
    tabs = CsvFormat(delimiter="\t", quote="'")
    given = spark.createDataFrame([("a\t'b\tc'",), ("a\t'b",)], "line string")
    assert [r[0] for r in given.select(is_well_formed(F.col("line"), tabs)).collect()] == [True, False]


def test_checked_read(spark, folder):
    Path(folder, "a.csv").write_text('x,y\n1,a\n\n5,"6\n2\n3,"c, ""d""",surplus\n4, NULL \n"7"8,z\n')
    Path(folder, "b.csv").write_text("x,y\n")
    got = sorted(
        (Path(r.file_path).name, r[LINE], r[RECORD], r.x, r.y) for r in read_csv_checked(spark, folder, ["x", "y"], BULK_LOAD).collect()
    )
    assert got == [
        ("a.csv", 2, None, "1", "a"), ("a.csv", 4, '5,"6', None, None), ("a.csv", 5, None, "2", None),
        ("a.csv", 6, None, "3", 'c, "d"'), ("a.csv", 7, None, "4", None), ("a.csv", 8, '"7"8,z', None, None),
    ]
    with pytest.raises(ValueError):
        read_csv_checked(spark, folder, ["x"], CsvFormat(multi_line=True))
    plain = read_csv_checked(spark, folder, ["x", "y"], READER_DEFAULTS).filter(F.col("x") == "3").collect()
    assert [(r.x, r.y) for r in plain] == [("3", 'c, "d"')]


def test_malformed_lines_are_rejects(spark, folder):
    Path(folder, "a.csv").write_text('x,y\n1,a\n5,"6\nbad,b\n')
    Path(folder, "b.csv").write_text("x,y\n2,c\n")
    raw = read_csv_checked(spark, folder, ["x", "y"])
    checked = load.check_rows(raw, FIELDS, ["file_path", LINE])
    found = sorted((r[LINE], r.column_name, r.value, r.reason) for r in load.rejects(checked, ["file_path", LINE]).collect())
    assert found == [(3, "record", '5,"6', "malformed record"), (4, "x", "bad", "not a NUMBER(3)")]
    name = f"{fresh_database(spark, 'malformed')}.t"
    load.create_target(spark, name, FIELDS)
    with pytest.raises(load.LoadAborted):
        load.bulk_load(raw, FIELDS, name, "file_path", "abort")
    result = load.bulk_load(raw, FIELDS, name, "file_path", "skip_file")
    assert [r.x for r in spark.table(name).collect()] == [2]
    assert sorted((r.rows_parsed, r.rows_rejected, r.status) for r in result.history.collect()) == [(1, 0, "LOADED"), (3, 2, "LOAD_FAILED")]

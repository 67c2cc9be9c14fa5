"""Delimited text with everything that goes wrong in it."""

import gzip
from pathlib import Path

import pytest

from millrace.operators.infer import read_typed
from millrace.sources.csv import BULK_LOAD, MULTI_LINE, READER_DEFAULTS, csv_header, read_csv, read_csv_by_name, spread, write_csv


def land(folder, text, name="a.csv"):
    path = Path(folder) / "in"
    path.mkdir(exist_ok=True)
    (path / name).write_bytes(text.encode())
    return str(path)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_defects(spark, folder):
    path = land(
        folder,
        'i,b,i,"x,y",,q\n1,2,3,4,5,6\n\n7,8\n"a ""q"" b"," sp ",NULL,"line\nbreak",5,6\n1,2,3,4,5,6,7,8\n,,,,,\nnan,NA,None,n/a,x,\n',
    )
    df = read_csv(spark, path, MULTI_LINE)
    assert df.columns == ["i", "b", "i.1", "x,y", "Unnamed: 4", "q"]
    assert rows(df) == [
        ("1", "2", "3", "4", "5", "6"),
        ("7", "8", None, None, None, None),
        ('a "q" b', " sp ", None, "line\nbreak", "5", "6"),
        ("1", "2", "3", "4", "5", "6"),
        (None,) * 6,
        (None, None, None, None, "x", None),
    ]


def test_bulk_format_trims_only_what_is_not_quoted(spark, folder):
    path = land(folder, 'a,b,c\n  x  ," y ",null\nNA,,NULL\n')
    assert rows(read_csv(spark, path, BULK_LOAD)) == [("x", " y ", None), ("NA", None, None)]


def test_header_only_and_empty(spark, folder):
    path = land(folder, "a,b\n")
    df = read_csv(spark, path)
    assert df.columns == ["a", "b"] and df.count() == 0
    assert csv_header(spark, land(folder + "/", "", "a.csv")) == []


def test_gzip(spark, folder):
    path = Path(folder) / "gz"
    path.mkdir()
    with gzip.open(path / "a.csv.gz", "wt") as file:
        file.write("a,b\n" + "".join(f"{i},x\n" for i in range(1000)))
    df = spread(read_csv(spark, str(path), BULK_LOAD))
    assert df.count() == 1000 and df.rdd.getNumPartitions() > 1


def test_types_of_a_reader(spark, folder):
    path = land(folder, "a,b,c,d,e\n1,1,True,x,1.5\n2,,False,,2\n")
    df = read_typed(read_csv(spark, path))
    assert df.dtypes == [("a", "bigint"), ("b", "double"), ("c", "boolean"), ("d", "string"), ("e", "double")]
    assert rows(df) == [(1, 1.0, True, "x", 1.5), (2, None, False, None, 2.0)]


@pytest.mark.parametrize("value", ['a"b', "a,b", "a\nb", " lead", "trail ", "back\\slash", 'x"', '\\"', "é,ü"])
def test_roundtrip(spark, folder, value):
    df = spark.createDataFrame([("1", value, None)], "id string, text string, none string")
    write_csv(df, f"{folder}/out")
    assert rows(read_csv(spark, f"{folder}/out", MULTI_LINE)) == [("1", value, None)]


def test_overwrite_and_partitions(spark, folder):
    df = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, p string")
    for _ in range(2):
        write_csv(df, f"{folder}/out", partition_by=("p",))
    assert sorted(rows(read_csv(spark, f"{folder}/out", READER_DEFAULTS, names=["id"]))) == [("1", "a"), ("2", "b")]


def test_headers_that_differ(spark, folder):
    path = land(folder, "a,b\n1,2\n")
    land(folder, 'b,"c d",a\n3,4,5\n', "b.csv")
    land(folder, "b,b,\n6,7,NA\n", "c.csv")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, path).collect()  # by position they would be mixed up
    df = read_csv_by_name(spark, path)
    found = {tuple(sorted((k, v) for k, v in r.asDict().items() if v is not None)) for r in df.collect()}
    assert found == {(("a", "1"), ("b", "2")), (("a", "5"), ("b", "3"), ("c d", "4")), (("b", "6"), ("b.1", "7"))}
    assert set(df.columns) == {"a", "b", "c d", "b.1", "Unnamed: 2"}


def test_a_large_file_takes_several_tasks(spark, folder):
    path = land(folder, "a,b\n" + "".join(f"{i},x\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    try:
        assert read_csv(spark, path).rdd.getNumPartitions() > 3 and read_csv(spark, path).count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "134217728")


def test_repeated_headers_in_different_orders(spark, folder):
    Path(folder, "a.csv").write_text("A,Memo,Memo\n1,x,y\n")
    Path(folder, "b.csv").write_text("A,Memo,Memo\n2,z,\n")
    got = sorted(tuple(r) for r in read_csv(spark, folder).collect())
    assert got == [("1", "x", "y"), ("2", "z", None)]
    Path(folder, "c.csv").write_text("Memo,Memo,A\nx3,y3,3\n")
    with pytest.raises(ValueError, match="different headers"):
        read_csv(spark, folder)
    got = sorted(tuple(r[c] for c in ("A", "Memo", "Memo.1")) for r in read_csv_by_name(spark, folder).collect())
    assert got == [("1", "x", "y"), ("2", "z", None), ("3", "x3", "y3")]

"""Listings, name resolution, row numbers and content keys."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.sources import files

LISTING = ["A.csv", "a.csv", "B", "b.CSV", "c.CSV", "D.csv", "d", "e.txt"]


def python_resolve(name, listing):
    if name in listing:
        return name
    if name + ".csv" in listing:
        return name + ".csv"
    return next((f for f in listing if f.lower() in (name.lower(), name.lower() + ".csv")), None)


def test_resolve(spark):
    requests = ["a.csv", "A", "a", "B", "b", "C", "D", "d", "E", "e.TXT", "none"]
    listing = spark.createDataFrame([(n, i) for i, n in enumerate(LISTING)], "name string, ordinal int")
    asked = spark.createDataFrame([(r,) for r in requests + requests], "request string")
    found = {r.request: r.file for r in files.resolve_files(asked, listing).collect()}
    assert found == {r: python_resolve(r, LISTING) for r in requests}


@pytest.mark.parametrize("pattern", [files.ANY_CSV, files.DATED_CSV, files.CSV_OR_JSON])
def test_patterns(spark, pattern):
    names = ["a.csv", "a-2024-01-31.csv", "x/a.json", "a.csv.gz", "2024-1-1.csv", "a.csvx", "b.JSON"]
    rows = spark.createDataFrame([(n,) for n in names], "n string")
    found = {r.n for r in rows.filter(files.matches(F.col("n"), pattern)).collect()}
    assert found == {n for n in names if re.fullmatch(pattern, n)}


def test_listing_reads_no_content(spark, folder):
    for name in ("a.csv", "b_raw.csv", "c.txt", "sub/d.csv"):
        path = Path(folder) / name
        path.parent.mkdir(exist_ok=True)
        path.write_text("x" * 10)
    listing = files.list_files(spark, folder)
    assert sorted((r.name, r["size"]) for r in listing.collect()) == [("a.csv", 10), ("b_raw.csv", 10), ("d.csv", 10)]
    assert [r.name for r in files.list_files(spark, folder, f"*{files.RAW_SUFFIX}").collect()] == ["b_raw.csv"]
    assert "content" not in listing._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_row_numbers_in_split_files(spark, folder):
    for name, rows in (("a", 5000), ("b", 3), ("c", 1200)):
        (Path(folder) / f"{name}.csv").write_text("id\n" + "".join(f"{i + 1}\n" for i in range(rows)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        rows = spark.read.schema("id int").option("header", "true").csv(folder)
        assert rows.rdd.getNumPartitions() > 4
        numbered = files.with_row_numbers(rows.select("id", *files.provenance()))
        found = numbered.select("id", "file_row_number", "file_name").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "134217728")
    assert len(found) == 6203
    assert all(r.id == r.file_row_number for r in found)


def test_content_keys(spark, folder):
    for name, text in (("a", "x\ny\n"), ("b", "y\nx\n"), ("c", "x\nz\n"), ("d", "x\ny\n")):
        (Path(folder) / f"{name}.csv").write_text(text)
    keys = {r.file_path[-5]: (r.lines, r.content_key) for r in files.content_keys(spark, folder).collect()}
    assert keys["a"] == keys["d"] and keys["a"][0] == 2
    assert len({keys[k] for k in "abc"}) == 3  # the order of lines counts


def test_provenance_in_files_of_bounded_keys(spark, monkeypatch):
    from millrace.plans import edges, landing
    from tests.conftest import SMALL

    monkeypatch.setattr(edges, "_FILE_KEYS", 400)  # 1,500 orders: four files of each part and copy
    monkeypatch.setattr(landing, "_landed", {})
    found = {r.part: tuple(r)[1:] for r in edges.file_provenance(spark, SMALL).collect()}
    counts = {r.o_orderstatus: r["count"] for r in spark.read.parquet(f"{SMALL}/orders.parquet").groupBy("o_orderstatus").count().collect()}
    assert found == {part: (n, n, 1, True, True, True) for part, n in counts.items()}
    landed = spark.read.text(next(iter(landing._landed.values())))
    chunks = {(r.copy, r.part, r.chunk) for r in landed.select("copy", "part", "chunk").distinct().collect()}
    assert len(chunks) == len(landed.inputFiles()) == 3 * 3 * 4

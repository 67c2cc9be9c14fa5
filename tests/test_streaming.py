"""Streams: new files once, cleaned batches without repeats, restarts."""

from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException

from millrace.spec import TableSpec
from millrace.streaming.incremental import (
    ByHeader, clean_new_files, csv_stream, file_stream, load_new_files, load_new_files_by_header,
)
from millrace.streaming.key_index import IndexOwned, KeyIndex, key_hashes

SPEC = TableSpec("t", primary_key="k", order_by=("seq",))


def land(folder, name, rows):
    inbox = Path(folder) / "inbox"
    inbox.mkdir(exist_ok=True)
    (inbox / name).write_text("seq,k\n" + "".join(f"{s},{k}\n" for s, k in rows))


def target_rows(spark, folder):
    return sorted((r.seq, r.k) for r in spark.read.parquet(f"{folder}/target").select("seq", "k").collect())


def test_each_file_is_loaded_once(spark, folder):
    def run():
        load_new_files(csv_stream(spark, f"{folder}/inbox", ["seq", "k"]), f"{folder}/target", f"{folder}/progress")

    land(folder, "a.csv", [(1, "a"), (2, "NULL")])
    run()
    assert target_rows(spark, folder) == [("1", "a"), ("2", None)]
    run()
    assert target_rows(spark, folder) == [("1", "a"), ("2", None)]
    land(folder, "b.csv", [(3, "c")])
    run()
    assert target_rows(spark, folder) == [("1", "a"), ("2", None), ("3", "c")]


def clean(spark, folder):
    clean_new_files(csv_stream(spark, f"{folder}/inbox", ["seq", "k"]), SPEC, f"{folder}/target", f"{folder}/progress")


def test_clean_batches(spark, folder):
    land(folder, "a.csv", [(2, " a"), (1, "a "), (3, "b"), (4, "")])
    clean(spark, folder)
    assert target_rows(spark, folder) == [("1", "a"), ("3", "b")]
    land(folder, "b.csv", [(5, "a"), (6, "c"), (7, "c"), (8, "NULL")])
    clean(spark, folder)
    assert target_rows(spark, folder) == [("1", "a"), ("3", "b"), ("6", "c")]
    clean(spark, folder)
    assert target_rows(spark, folder) == [("1", "a"), ("3", "b"), ("6", "c")]


def test_a_repeated_batch_adds_nothing(spark, folder):
    land(folder, "a.csv", [(1, "a")])
    clean(spark, folder)
    land(folder, "b.csv", [(2, "b")])
    clean(spark, folder)
    # As after a driver lost between writing the batch and noting it: the commit is missing.
    commit = Path(folder) / "progress" / "commits"
    for file in (commit / "1", commit / ".1.crc"):
        file.unlink()
    clean(spark, folder)
    assert target_rows(spark, folder) == [("1", "a"), ("2", "b")]


def test_batches_of_few_files(spark, folder):
    for i in range(4):
        land(folder, f"{i}.csv", [(i, "same"), (10 + i, f"k{i}")])
    stream = csv_stream(spark, f"{folder}/inbox", ["seq", "k"], files_per_batch=1)
    clean_new_files(stream, SPEC, f"{folder}/target", f"{folder}/progress")
    rows = target_rows(spark, folder)
    assert len(rows) == 5 and sum(k == "same" for _, k in rows) == 1


def test_two_checkpoints_share_a_target(spark, folder):
    land(folder, "a.csv", [(1, "a"), (2, "b")])
    clean(spark, folder)
    other = Path(folder) / "other"
    other.mkdir()
    (other / "x.csv").write_text("seq,k\n7,b\n8,c\n")
    clean_new_files(csv_stream(spark, str(other), ["seq", "k"]), SPEC, f"{folder}/target", f"{folder}/progress2")
    assert target_rows(spark, folder) == [("1", "a"), ("2", "b"), ("8", "c")]


def drop(folder, name, text):
    inbox = Path(folder) / "inbox"
    inbox.mkdir(exist_ok=True)
    (inbox / name).write_text(text)


def by_header(spark, folder, **options):
    reading = ByHeader(f"{folder}/registry", ("A", "B"), **options)
    load_new_files_by_header(file_stream(spark, f"{folder}/inbox"), reading, f"{folder}/target", f"{folder}/progress")
    return reading


def test_columns_in_another_order(spark, folder):
    drop(folder, "a.csv", "A,B\n1,x\n")
    by_header(spark, folder)
    drop(folder, "b.csv", "B,A\ny,2\n")
    reading = by_header(spark, folder)
    rows = spark.read.parquet(f"{folder}/target").select("A", "B").collect()
    assert sorted(map(tuple, rows)) == [("1", "x"), ("2", "y")]
    assert sorted((Path(r.path).name, r.names) for r in reading.known(spark).collect()) == [("a.csv", ["A", "B"]), ("b.csv", ["B", "A"])]
    # A stream of rows cannot follow, so it fails.
    with pytest.raises(StreamingQueryException):
        load_new_files(csv_stream(spark, f"{folder}/inbox", ["A", "B"]), f"{folder}/other", f"{folder}/progress2")


def test_unknown_layouts_fail_or_add_columns(spark, folder):
    drop(folder, "a.csv", "B,A\nx,1\n")
    by_header(spark, folder)
    drop(folder, "b.csv", "A,C\n2,new\n")
    with pytest.raises(StreamingQueryException, match="has the columns"):
        by_header(spark, folder)
    by_header(spark, folder, new_columns="add")
    rows = spark.read.option("mergeSchema", "true").parquet(f"{folder}/target").select("A", "B", "C").collect()
    assert sorted(map(tuple, rows)) == [("1", "x", None), ("2", None, "new")]


def test_repeated_names_in_a_stream(spark, folder):
    drop(folder, "a.csv", "A,B,B\n1,x,y\n")
    drop(folder, "b.csv", "B,B,A\nx2,y2,2\n")
    reading = ByHeader(f"{folder}/registry", ("A", "B", "B.1"))
    load_new_files_by_header(file_stream(spark, f"{folder}/inbox"), reading, f"{folder}/target", f"{folder}/progress")
    rows = spark.read.parquet(f"{folder}/target").select("A", "B", "`B.1`").collect()
    assert sorted(map(tuple, rows)) == [("1", "x", "y"), ("2", "x2", "y2")]


def test_clean_batches_by_header(spark, folder):
    reading = ByHeader(f"{folder}/registry", ("seq", "k"))
    for name, text in (("a.csv", "seq,k\n2, a\n1,a\n"), ("b.csv", "k,seq\na,5\nc,6\n")):
        drop(folder, name, text)
        clean_new_files(file_stream(spark, f"{folder}/inbox"), SPEC, f"{folder}/target", f"{folder}/progress", reading)
    assert target_rows(spark, folder) == [("1", "a"), ("6", "c")]


def hashed(spark, values):
    return spark.createDataFrame([(v,) for v in values], "k string").withColumns(key_hashes(["k"]))


def unseen(index, spark, values, load="x", batch_id=99):
    return sorted(r.k for r in index.unseen(hashed(spark, values), load, batch_id).collect())


def test_files_read_do_not_grow_with_batches(spark, folder):
    index = KeyIndex(f"{folder}/index", buckets=4, fan=3)
    index.create(spark)
    assert unseen(index, spark, ["a", "b"]) == ["a", "b"]
    for batch in range(14):
        index.add(hashed(spark, [f"{batch}-{i}" for i in range(50)]), "load", batch)
        # New keys lead to no file, known ones to those that hold them.
        fresh = hashed(spark, [f"new {batch}-{i}" for i in range(20)])
        assert index.places(fresh) == [] and index.held(fresh, "x", 0) is None
        assert len(index.held(hashed(spark, ["0-1", f"{batch}-7"]), "x", 0).inputFiles()) <= 2
    # Three levels of fewer than three runs, and the newest batch.
    assert len(index.runs(spark)) <= 7
    assert unseen(index, spark, [f"{b}-{i}" for b in range(14) for i in (0, 49)] + ["c"]) == ["c"]
    # A batch that runs again does not meet its own keys, however often it has.
    assert unseen(index, spark, ["13-1", "12-1"], "load", 13) == ["13-1"]
    index.add(hashed(spark, ["13-1"]), "load", 13)
    assert unseen(index, spark, ["13-1", "13-2"]) == ["13-2"]


def test_filters_pass_few_other_keys(spark, folder):
    index = KeyIndex(f"{folder}/index", buckets=2)
    index.create(spark)
    numbers = spark.range(20_000).selectExpr("cast(id as string) k").withColumns(key_hashes(["k"]))
    index.add(numbers, "load", 0)
    assert spark.read.parquet(f"{folder}/index/filters").agg({"parts": "max"}).first()[0] == 8
    filters, others = KeyIndex(f"{folder}/index", buckets=2), []
    for i in range(40):
        others += filters.places(hashed(spark, [f"other {i}"]))
    assert len(others) <= 2
    assert index.unseen(numbers, "x", 0).count() == 0


def test_hashes_of_the_earlier_layout_are_taken_over(spark, folder):
    hashed(spark, ["a"]).select("h1", "h2").write.parquet(f"{folder}/target_keys/load=none/batch_id=0")
    land(folder, "a.csv", [(1, "a"), (2, "b")])
    clean(spark, folder)
    assert target_rows(spark, folder) == [("2", "b")]


def test_streams_side_by_side_add_a_key_once(spark, folder):
    inboxes = []
    for s in range(2):
        box = Path(folder) / f"in{s}"
        box.mkdir()
        for f in range(4):
            (box / f"{f}.csv").write_text("seq,k\n" + "".join(f"{s}{f}{i},{f * 5 + i}\n" for i in range(10)))
        inboxes.append(str(box))

    def run(s):
        stream = csv_stream(spark, inboxes[s], ["seq", "k"], files_per_batch=1)
        index = KeyIndex(f"{folder}/target_index", buckets=2, fan=3)
        clean_new_files(stream, SPEC, f"{folder}/target", f"{folder}/progress{s}", index=index)

    KeyIndex(f"{folder}/target_index").create(spark)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(run, range(2)))
    assert sorted(int(k) for _, k in target_rows(spark, folder)) == list(range(25))
    assert KeyIndex(f"{folder}/target_index").owner(spark) is None


def test_a_lost_stream_keeps_the_index(spark, folder):
    index = KeyIndex(f"{folder}/index", wait_seconds=0.5)
    index.create(spark)
    with pytest.raises(ZeroDivisionError):
        with index.owned(spark, "one"):
            raise ZeroDivisionError
    with pytest.raises(IndexOwned, match="'one' holds"):
        index.claim(spark, "two")
    with index.owned(spark, "one"):
        assert index.owner(spark) == "one"
    with index.owned(spark, "two"):
        assert index.owner(spark) == "two"

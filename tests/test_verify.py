"""Reconciliation and inspection on small tables."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.functions.casts import stringify
from millrace.operators import merge, profile, verify
from millrace.workspace import fresh_database


def test_diff_is_a_multiset_difference(spark):
    left = [(1, "a"), (1, "a"), (2, "b"), (3, None), (4, "x")]
    right = [(1, "a"), (2, "c"), (3, None), (4, "x"), (4, "x")]
    a, b = (spark.createDataFrame(r, "id int, v string") for r in (left, right))
    found = {(r.id, r.v, r.side): r.copies for r in verify.table_diff(a, b).collect()}
    only_left, only_right = Counter(left) - Counter(right), Counter(right) - Counter(left)
    expected = {(*k, "only_left"): n for k, n in only_left.items()}
    expected |= {(*k, "only_right"): n for k, n in only_right.items()}
    assert found == expected
    assert verify.table_diff(a, a).count() == 0


def test_schema_diff(spark):
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = spark.createDataFrame([(1, 2.0)], "ID bigint, w double")
    assert verify.schema_diff(a, b) == [("id", "int", "bigint"), ("v", "string", None), ("w", None, "double")]


@pytest.mark.parametrize("checksum", [lambda df: verify.table_checksum(stringify(df), "t"), verify.fast_checksum])
def test_checksum_ignores_order_only(spark, checksum):
    rows = [(i, f"v{i % 3}") for i in range(50)]
    base = checksum(spark.createDataFrame(rows, "id int, v string")).first()
    assert checksum(spark.createDataFrame(rows[::-1], "id int, v string").repartition(7)).first() == base
    changed = [*rows[:-1], (49, "other")]
    assert checksum(spark.createDataFrame(changed, "id int, v string")).first() != base
    # A null is not an empty text, and a border between columns counts.
    sums = {checksum(spark.createDataFrame([r], "a string, b string")).first().checksum
            for r in [(None, "x"), ("", "x"), ("x", None), ("x", "")]}
    assert len(sums) == 4


def test_pk_violations(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (2, None), (2, None)], "id int, k string")
    found = {(r.id, r.k): (r.row_count, r.violation) for r in verify.pk_violations(df, ["id", "k"]).collect()}
    assert found == {(1, "a"): (2, "duplicate_key"), (None, "c"): (1, "null_key"), (2, None): (2, "null_key")}


def test_counts_against_expectations(spark):
    tables = {"a": spark.range(3), "b": spark.range(0), "c": spark.range(2)}
    counts = verify.table_counts(tables)
    expected = spark.createDataFrame([("a", 3), ("b", 0), ("c", 4), ("d", 1)], "table_name string, expected_rows bigint")
    estimate = {r.table_name: r.status for r in verify.verify_estimate(counts, expected).collect()}
    assert estimate == {"a": "success", "b": "success", "c": "warning", "d": "failed"}
    source = {r.table_name: (r.actual_rows, r.match_percentage, r.verification_passed) for r in verify.verify_source(counts, expected).collect()}
    assert source == {"a": (3, 100.0, True), "b": (0, 0.0, True), "c": (2, 50.0, False), "d": (0, 0.0, False)}
    every = {r.table_name: (r.table_exists, r.has_data, r.count_match, r.overall_success) for r in verify.verify_all(counts, expected).collect()}
    assert every == {"a": (True, True, True, False), "b": (True, False, True, False),
                     "c": (True, True, False, False), "d": (False, False, False, False)}
    good = verify.verify_all(counts, expected.filter("table_name IN ('a', 'b')"))
    assert {r.overall_success for r in good.collect()} == {True}
    empty = {r.table_name: r.status for r in verify.verify_nonempty(counts, expected.select("table_name")).collect()}
    assert empty == {"a": "success", "b": "warning", "c": "success", "d": "error"}


def test_outputs(spark):
    expected = spark.createDataFrame([("a.csv",), ("b.csv",)], "name string")
    listing = spark.createDataFrame([("a.csv",), ("a.csv",), ("c.csv",)], "name string")
    found = sorted(tuple(r) for r in verify.verify_outputs(expected, listing).collect())
    assert found == [("a.csv", True), ("b.csv", False)]


def test_profile_and_types(spark):
    df = spark.createDataFrame([(1, ""), (None, None), (3, "x")], "a int, `b c` string")
    found = [tuple(r)[1:] for r in profile.profile(df, "t").collect()]
    assert found == [("a", 3, 1, 0), ("b c", 3, 1, 1)]
    types = {r.dtype: (r.columns, r.table_columns, r.table_rows, r.filled_cells) for r in profile.dtype_summary(df, "t").collect()}
    assert types == {"int": (1, 2, 3, 2), "string": (1, 2, 3, 2)}


def test_catalogue(spark):
    name = f"{fresh_database(spark, 'test')}.t"
    spark.sql(f"CREATE TABLE {name} (id BIGINT, price DECIMAL(10,2), v VARCHAR(20), s STRING) USING parquet")
    df = spark.table(name)
    rows = profile.column_catalog(df, "t").collect()
    assert [(r.ordinal_position, r.column_name, r.data_type, r.numeric_precision, r.numeric_scale, r.character_maximum_length)
            for r in rows] == [
        (1, "id", "bigint", 19, 0, None), (2, "price", "decimal(10,2)", 10, 2, None),
        (3, "v", "string", None, None, 20), (4, "s", "string", None, None, None),
    ]
    assert profile.describe_table(spark, name.replace(".t", ".T")).count() == 4
    with pytest.raises(ValueError):
        profile.describe_table(spark, name + "x")
    assert [r.column_name for r in profile.column_catalog(df, "t", last=2).collect()] == ["v", "s"]
    assert profile.find_column(profile.column_catalog(df, "t"), "PRICE").count() == 1


def test_samples(spark):
    df = spark.range(100).selectExpr("id", "CASE WHEN id < 40 THEN NULL ELSE 100 - id END AS v").repartition(6)
    found = profile.sample_values(df, ["id"]).orderBy("column_name", "position").collect()
    assert [(r.column_name, r.value) for r in found] == [
        ("id", "0"), ("id", "1"), ("id", "2"), ("v", "60"), ("v", "59"), ("v", "58"),
    ]
    ends = profile.head_and_tail(df.select("id"), ["id"], 2).collect()
    assert sorted(r.id for r in ends if r.part == "tail") == [98, 99]


def test_merge(spark):
    left = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (None, "n", 0)], "k int, name string, v int")
    right = spark.createDataFrame([(2, 7, "x"), (3, 8, "y")], "k int, v int, extra string")
    merged = merge.merge_boards(left, right, "k")
    assert merged.columns == ["k", "name", "v_sales", "v_delivery", "extra", "origin"]
    assert sorted((tuple(r) for r in merged.collect()), key=str) == sorted([
        (1, "a", 5, None, None, "left"), (2, "b", 6, 7, "x", "both"), (None, "n", 0, None, None, "left"),
        (3, None, None, 8, "y", "right"),
    ], key=str)


def test_names_with_dots(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "`k.1` int, `Memo.1` string")
    b = spark.createDataFrame([(1, "x"), (1, "y")], "`k.1` int, `Memo.1` string")
    assert {(r[0], r.side) for r in verify.table_diff(a, b).collect()} == {(2, "only_left"), (1, "only_right")}
    assert verify.pk_violations(b, ["k.1"]).first().violation == "duplicate_key"
    checks = {r.check: (r.differences, r.passed) for r in verify.compare_tables(a, b, ["k.1"]).collect()}
    assert checks["rows_only_left"] == (1, False) and checks["key_violations"] == (1, False)
    assert all(r.passed for r in verify.compare_tables(a, a, ["k.1"]).collect())


def test_merge_of_items_without_a_key(spark):
    a = spark.createDataFrame([(1, "x"), (None, "y")], "id int, n string")
    b = spark.createDataFrame([(1, 5), (None, 6)], "id int, m int")
    assert sorted((r.n or "", r.origin) for r in merge.merge_boards(a, b, "id").collect()) == [("", "right"), ("x", "both"), ("y", "left")]


@pytest.mark.parametrize("buckets", [1, 8, 4096])
def test_diff_by_buckets(spark, buckets):
    a = spark.createDataFrame([(i, f"v{i}") for i in range(50)] + [(1, "v1"), (None, None)], "id int, v string")
    b = spark.createDataFrame([(i, f"v{i}") for i in range(2, 50)] + [(1, "v1"), (7, "v7"), (99, None)], "id int, v string")
    want = {(0, "v0", "only_left"): 1, (1, "v1", "only_left"): 1, (None, None, "only_left"): 1, (7, "v7", "only_right"): 1, (99, None, "only_right"): 1}
    diff = verify.table_diff(a, b, buckets=buckets)
    assert diff.columns == ["id", "v", "side", "copies"]
    assert {(r.id, r.v, r.side): r.copies for r in diff.collect()} == want
    kept = verify.bucket_checksums(a, buckets)
    assert {(r.id, r.v, r.side): r.copies for r in verify.table_diff(a, b, left_sums=kept, buckets=buckets).collect()} == want
    # Equal tables, in another order: nothing differs, and the second look reads no row.
    same = verify.table_diff(a, a.orderBy("v"), buckets=buckets)
    assert same.count() == 0 and verify.differing_buckets(kept, verify.bucket_checksums(a.orderBy("v"), buckets)) == []


def test_boards_whose_names_differ_by_case(spark):
    left = spark.createDataFrame([(1, "a", "x")], "K int, Status string, `status_delivery` string")
    right = spark.createDataFrame([(1, "b", 5), (2, "c", 6)], "k int, status string, origin int")
    merged = merge.merge_boards(left, right, "k")
    names = [c.lower() for c in merged.columns]
    assert names[:3] == ["k", "status_sales", "status_delivery"] and names[-1] == "origin" and len(set(names)) == 6
    assert sorted(tuple(r) for r in merged.collect()) == [(1, "a", "x", "b", 5, "both"), (2, None, None, "c", 6, "right")]


def test_samples_are_cut_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id", "CAST(id % 7 AS STRING) AS v")
    found = profile.sample_values(df, ["id"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan  # a task hands on three cells of each column, not all
    rows = {(r.column_name, r.position, r.value) for r in found.collect()}
    assert rows == {(c, i, str(i)) for c in ("id", "v") for i in range(3)}

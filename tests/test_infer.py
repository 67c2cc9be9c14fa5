"""Type inference on hand-made columns, one per rule."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from millrace.functions import casts
from millrace.operators import infer

COLUMNS = {
    # name: (values, by name and data, generous, max text, by data)
    "order_date": (["20240101", "20240102"], "VARCHAR(50)", "VARCHAR(100)", "VARCHAR(16777216)", "NUMBER"),
    "start_date": (["2024-01-01", None], "DATE", "VARCHAR(100)", "VARCHAR(16777216)", "VARCHAR"),
    "us_date": (["01/31/2024", "2/1/2024"], "DATE", "VARCHAR(100)", "VARCHAR(16777216)", "VARCHAR"),
    "paid": (["no", "yes"], "VARCHAR(50)", "VARCHAR(255)", "VARCHAR(16777216)", "VARCHAR"),
    "loss_total": (["-5", "-7"], "NUMBER(1)", "NUMBER(15)", "NUMBER(15)", "NUMBER"),
    "count": (["99", "100"], "NUMBER(4)", "NUMBER(15)", "NUMBER(15)", "NUMBER"),
    "some_count": (["99", None], "FLOAT", "FLOAT", "FLOAT", "FLOAT"),
    "price": (["9.5", "1"], "FLOAT", "FLOAT", "FLOAT", "FLOAT"),
    "bad_price": (["9.5", "x"], "VARCHAR(50)", "VARCHAR(255)", "VARCHAR(16777216)", "VARCHAR"),
    "is_x": (["yes", "No"], "BOOLEAN", "VARCHAR(255)", "VARCHAR(16777216)", "VARCHAR"),
    "has_y": (["true", "False"], "BOOLEAN", "VARCHAR(255)", "VARCHAR(16777216)", "BOOLEAN"),
    "state_flag": (["1", None], "VARCHAR(50)", "VARCHAR(255)", "VARCHAR(16777216)", "FLOAT"),
    "status": (["open", "done"], "VARCHAR(50)", "VARCHAR(255)", "VARCHAR(16777216)", "VARCHAR"),
    "email": (["a@b.co", "x.y@z.org"], "VARCHAR(255)", "VARCHAR(255)", "VARCHAR(16777216)", "VARCHAR"),
    "bad_email": (["a@b.co", "nobody"], "VARCHAR(50)", "VARCHAR(255)", "VARCHAR(16777216)", "VARCHAR"),
    "phone": (["1", "2"], "VARCHAR(20)", "VARCHAR(50)", "VARCHAR(16777216)", "NUMBER"),
    "hotel": (["Ritz", None], "VARCHAR(20)", "VARCHAR(50)", "VARCHAR(16777216)", "VARCHAR"),
    "link": (["http://x", "y"], "VARCHAR(500)", "VARCHAR(1000)", "VARCHAR(16777216)", "VARCHAR"),
    "name": (["a", "b"], "VARCHAR(100)", "VARCHAR(255)", "VARCHAR(16777216)", "VARCHAR"),
    "notes": (["a", "b"], "VARCHAR(1000)", "VARCHAR(2000)", "VARCHAR(16777216)", "VARCHAR"),
    "comments": (["a", "b"], "VARCHAR(50)", "VARCHAR(2000)", "VARCHAR(16777216)", "VARCHAR"),
    "code": (["007", "12"], "NUMBER(10)", "VARCHAR(255)", "VARCHAR(16777216)", "NUMBER"),
    "zip_code": (["A7", "12"], "VARCHAR(50)", "VARCHAR(255)", "VARCHAR(16777216)", "VARCHAR"),
    "long_id": (["123456789012", "1"], "NUMBER(38)", "NUMBER(15)", "NUMBER(15)", "NUMBER"),
    "nothing": ([None, None], "VARCHAR(255)", "VARCHAR(255)", "VARCHAR(16777216)", "FLOAT"),
    "t50": (["x" * 50, "y"], "VARCHAR(50)", "VARCHAR(255)", "VARCHAR(16777216)", "VARCHAR"),
    "t51": (["x" * 51, "y"], "VARCHAR(100)", "VARCHAR(255)", "VARCHAR(16777216)", "VARCHAR"),
    "t101": (["x" * 101, "y"], "VARCHAR(255)", "VARCHAR(1000)", "VARCHAR(16777216)", "VARCHAR"),
    "t256": (["x" * 256, "y"], "VARCHAR(500)", "VARCHAR(1000)", "VARCHAR(16777216)", "VARCHAR"),
    "t501": (["x" * 501, "y"], "VARCHAR(1000)", "VARCHAR(2000)", "VARCHAR(16777216)", "VARCHAR"),
    "huge": (["9" * 25, "1"], "VARCHAR(50)", "VARCHAR(255)", "VARCHAR(16777216)", "VARCHAR"),
}


@pytest.fixture(scope="module")
def statistics(spark):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in COLUMNS])
    rows = list(zip(*[v[0] for v in COLUMNS.values()], strict=True))
    return infer.column_statistics(spark.createDataFrame(rows, schema), "t").cache()


@pytest.mark.parametrize(
    "position,rules",
    [(1, infer.infer_by_name_and_data), (2, infer.infer_generous), (3, infer.infer_max_text), (4, infer.infer_by_data)],
)
def test_rules(statistics, position, rules):
    found = infer.mapping_of(rules(statistics))
    assert found == {c: v[position] for c, v in COLUMNS.items()}


@pytest.mark.parametrize(
    "value,kind",
    [("9", 1), ("10", 2), ("99", 2), ("999", 4), ("1000", 5), ("99999", 6), ("999999", 7), ("1000000", 10)],
)
def test_digits(spark, value, kind):
    df = spark.createDataFrame([(value,)], "total string")
    assert infer.mapping_of(infer.infer_by_name_and_data(infer.column_statistics(df, "t"))) == {"total": f"NUMBER({kind})"}


def test_whole_word_and_widest(spark):
    df = spark.createDataFrame([("1", "-5000"), ("2", "3")], "paid string, total string")
    found = infer.column_statistics(df, "t")
    assert infer.mapping_of(infer.infer_by_name_and_data(found)) == {"paid": "NUMBER(10)", "total": "NUMBER(1)"}
    strict = infer.infer_by_name_and_data(found, whole_word=True, widest=True)
    assert infer.mapping_of(strict) == {"paid": "VARCHAR(50)", "total": "NUMBER(5)"}


def test_typed_columns_count_as_text(spark):
    df = spark.createDataFrame([(1, 2.5, True)], "total int, price double, is_on boolean")
    assert infer.mapping_of(infer.infer_by_name_and_data(infer.column_statistics(df, "t"))) == {
        "total": "NUMBER(1)", "price": "FLOAT", "is_on": "BOOLEAN",
    }


def test_sample_is_repeatable(spark):
    df = spark.range(1000).selectExpr("cast(id as string) as total")
    first = infer.sample_rows(df, 10).collect()
    assert len(first) == 10 and first == infer.sample_rows(df.repartition(7), 10).collect()


def test_empty_table(spark):
    df = spark.createDataFrame([], "total string")
    assert infer.column_statistics(df, "t").count() == 1
    assert infer.mapping_of(infer.infer_by_name_and_data(infer.column_statistics(df, "t"))) == {"total": "VARCHAR(255)"}


def test_apply_types_counts_lost_cells(spark):
    df = spark.createDataFrame([("1", "2024-01-01"), ("x", "soon"), (None, None)], "a string, b string")
    typed = infer.apply_types(df, {"a": "NUMBER(10)", "b": "DATE"}, {"a": "A"})
    assert typed.dtypes == [("A", "bigint"), ("b", "date"), ("_bad_cells", "int"), ("_changed_cells", "int")]
    assert [r._bad_cells for r in typed.collect()] == [0, 2, 0]


NUMBERS = [  # text, changed as a double, digits before and after the point
    ("9007199254740992", False, 16, 0), ("9007199254740993", True, 16, 0), ("0.1", False, 0, 1), ("00501", True, 3, 0), ("0501.5", True, 3, 1),
    ("1.10", False, 1, 1), ("123456789012345.6", False, 15, 1), ("1234567890123456.7", True, 16, 1), ("123456789012345.67", False, 15, 2), ("12345678901234567.89", True, 17, 2),
    ("1e400", True, None, None), ("1e3", False, None, None), ("-0.000000000000000000001", False, 0, 21), ("9" * 30, True, 30, 0),
    ("1" + "0" * 30, False, 31, 0), ("0.12345678901234567890123", True, 0, 23), ("0", False, 0, 0), ("+7.", False, 1, 0),
]


def test_digits(spark):
    given = spark.createDataFrame([(n,) for n, *_ in NUMBERS], "n string")
    n = F.col("n")
    got = given.select("n", casts.changed_by_double(n).alias("c"), casts.whole_digits(n).alias("w"), casts.fraction_digits(n).alias("f")).collect()
    assert [tuple(r) for r in got] == NUMBERS


@pytest.mark.parametrize("values,plain,exact,spark_kind", [
    (["9007199254740993", None], "FLOAT", "NUMBER(16)", "bigint"),
    (["00501", "02134.5"], "FLOAT", "VARCHAR(50)", "string"),
    (["123456789012345678901.25", "1.5"], "FLOAT", "NUMBER(23,2)", "decimal(23,2)"),
    (["1.5", "2"], "FLOAT", "FLOAT", "double"),
    (["1234567890123456789012", None], "FLOAT", "NUMBER(22)", "decimal(38,0)"),
    (["1e300", "123456789012345678.5"], "FLOAT", "VARCHAR(50)", "string"),
    (["9" * 30 + "." + "1" * 30, "1"], "FLOAT", "VARCHAR(100)", "string"),
])
def test_no_digit_is_lost(spark, values, plain, exact, spark_kind):
    df = spark.createDataFrame([(v,) for v in values], "total_number string")
    statistics = infer.column_statistics(df, "t")
    assert infer.mapping_of(infer.infer_by_name_and_data(statistics)) == {"total_number": plain}
    types = infer.mapping_of(infer.infer_by_name_and_data(statistics, exact=True))
    assert types == {"total_number": exact} and casts.spark_type(exact).split("(")[0] in (spark_kind.split("(")[0], "varchar")
    kept = infer.apply_types(df, types)
    assert kept.agg(F.sum("_bad_cells"), F.sum("_changed_cells")).first() == (0, 0)
    lossy = infer.apply_types(df, {"total_number": "FLOAT"}).agg(F.sum("_changed_cells")).first()[0]
    assert (lossy > 0) == (exact != "FLOAT")
    if exact != "FLOAT":
        same = Decimal if exact.startswith("NUMBER") else str
        assert [r[0] and same(r[0]) for r in kept.select("total_number").collect()] == [v and same(v) for v in values]


def test_scale_and_leading_zeros_count_as_changes(spark):
    df = spark.createDataFrame([("1.25", "007.5", "12345.678"), ("1.2", "7.5", "0.1")], "a string, b string, c string")
    typed = infer.apply_types(df, {"a": "NUMBER(5,1)", "b": "NUMBER(5,1)", "c": "NUMBER(5,2)"})
    assert [(str(r.a), str(r.b), r.c and str(r.c), r._bad_cells, r._changed_cells) for r in typed.collect()] == [
        ("1.3", "7.5", None, 1, 2), ("1.2", "7.5", "0.10", 0, 0),
    ]


def test_statistics_of_files_add_up(spark):
    rows = [("f1", "1", "2024-01-01", None), ("f1", "20", None, "x"), ("f2", "00300.25", "2024-01-02 10:00", "yes"), ("f3", None, None, None)]
    df = spark.createDataFrame(rows, "file string, a string, b string, c string")
    kept = infer.file_statistics(df, "t", "file")
    assert kept.select("file_name").distinct().count() == 3
    assert sorted(map(tuple, infer.merge_statistics(kept).collect())) == sorted(map(tuple, infer.column_statistics(df.drop("file"), "t").collect()))
    # A file without a column, and one with the column in another case.
    other = spark.createDataFrame([("f0", "9", "z")], "file string, A string, d string")
    merged = {r.column_name: (r.ordinal, r.rows, r.filled) for r in infer.merge_statistics(kept.unionByName(infer.file_statistics(other, "t", "file"))).collect()}
    assert merged == {"A": (0, 5, 4), "d": (1, 5, 1), "b": (2, 5, 2), "c": (3, 5, 2)}

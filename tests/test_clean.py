"""The cleaner against a plain Python version of its rules."""

import random

import pytest

from millrace.operators import clean
from millrace.spec import TableName, TableSpec
from tests.test_text import python_clean

SCHEMA = "seq int, a string, b string, n int"


def python_cleaner(rows, key):
    """rows of (seq, a, b, n); key positions. Returns kept rows and removal counts."""
    kept = [r for r in rows if any(v is not None for v in r)]
    blank = len(rows) - len(kept)
    kept = [(s, python_clean(a), python_clean(b), n) for s, a, b, n in kept]
    keyed = [r for r in kept if all(r[i] is not None for i in key)]
    first = {}
    for row in sorted(keyed, key=lambda r: r[0]):
        first.setdefault(tuple(row[i] for i in key), row)
    return sorted(first.values()), (len(rows), blank, len(kept) - len(keyed), len(keyed) - len(first), len(first))


def sample(seed, size=300):
    rng = random.Random(seed)
    texts = ["x", " x", "x\t", "X", "y\x01", "y", "  ", "\x02", None, ""]
    rows = []
    for i in range(size):
        if rng.random() < 0.1:
            rows.append((None, None, None, None))
        else:
            rows.append((i, rng.choice(texts), rng.choice(texts), rng.choice([1, 2, None])))
    return rows


@pytest.mark.parametrize("key,positions,composite", [("a", [1], False), ("a + b", [1, 2], True), ("b+n", [2, 3], True)])
def test_against_python(spark, key, positions, composite):
    rows = sample(len(key))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    spec = TableSpec("t", primary_key=key, composite=composite, order_by=("seq",))
    kept, counts = python_cleaner(rows, positions)
    assert sorted(tuple(r) for r in clean.clean_table(df, spec).collect()) == kept
    assert tuple(clean.clean_report(df, spec).first()) == counts


def test_blank_texts_survive_the_blank_row_step(spark):
    df = spark.createDataFrame([(None, None), (" ", None), ("x", None)], "a string, b string")
    assert clean.drop_blank_rows(df).count() == 2
    spec = TableSpec("t", primary_key="a", order_by=("a",))
    assert [tuple(r) for r in clean.clean_table(df, spec).collect()] == [("x", None)]


def test_case_matters_in_keys(spark):
    df = spark.createDataFrame([(1, "a"), (2, "A"), (3, " a")], "seq int, k string")
    kept = clean.clean_table(df, TableSpec("t", primary_key="k", order_by=("seq",)))
    assert sorted(r.seq for r in kept.collect()) == [1, 2]


@pytest.mark.parametrize("key,composite", [("missing", False), ("a + missing", True)])
def test_missing_key_column_skips_both_steps(spark, key, composite, caplog):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "seq int, a string")
    spec = TableSpec("t", primary_key=key, composite=composite, order_by=("seq",))
    assert clean.clean_table(df, spec).count() == 3
    assert "missing" in caplog.text
    assert tuple(clean.clean_report(df, spec).first()) == (3, 0, 0, 0, 3)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    spec = TableSpec("t", primary_key="a", order_by=("seq",))
    assert clean.clean_table(df, spec).count() == 0
    assert tuple(clean.clean_report(df, spec).first()) == (0, 0, 0, 0, 0)


def test_dedup_needs_an_order(spark):
    with pytest.raises(ValueError):
        clean.dedup(spark.range(3), ["id"], [])


def test_renames(spark):
    df = spark.createDataFrame([("x",)], "dimension_1 string")
    assert clean.clean_table(df, TableSpec("t", renames={"dimension_1": "date"})).columns == ["date"]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(3000).selectExpr("id AS seq", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS k")
    kept = clean.dedup(df, ["k"], ["seq"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert kept.count() == 2001
    assert kept.filter("k = 'hot'").first().seq == 0


def test_names_and_keys():
    name = TableName.parse("sales.public.projects")
    assert name.catalog_name == "sales_public.projects"
    assert TableName.parse("projects", "sales").catalog_name == "sales_public.projects"
    assert TableName.parse("x.y.projects", "sales.raw").catalog_name == "sales_raw.projects"
    assert TableName.parse("projects").catalog_database == "default_public"
    assert TableSpec("t", primary_key="A + B", composite=True).key_columns == ["A", "B"]
    assert TableSpec("t", primary_key="A + B").key_columns == ["A + B"]

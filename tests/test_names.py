"""Column names: golden cases, and the catalogue against the plain version."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.functions.names import (
    NamePolicy, clean_columns, clean_name, clean_name_column, has_special_characters, header_names,
    unique_names, unique_names_in_catalogue,
)

NAMES = [
    "2nd col", "__a--b__", "%%", "", "  ", " Plain Name ", "é à", "a.b:c-d e", "x", "_x", "9", "a(b)[c]",
    "Größe", "日本", "a b", "A__B", "٣", "tail_",
]


@pytest.mark.parametrize(
    "name,strict,light,prefixed",
    [
        ("2nd col", "COL_2nd_col", "2nd_col", "_2nd_col"),
        ("__a--b__", "a_b", "__a__b__", "___a__b__"),
        ("%%", "UNNAMED_COLUMN", "%%", "___"),
        ("", "UNNAMED_COLUMN", "", "_"),
        (" Plain Name ", "Plain_Name", "Plain_Name", "Plain_Name"),
        ("a.b:c-d e", "a_b_c_d_e", "a.b:c_d_e", "a_b_c_d_e"),
        ("a(b)", "a_b", "a(b)", "_a_b_"),
        ("Größe", "Gr_e", "Größe", "Größe"),
    ],
)
def test_golden(name, strict, light, prefixed):
    assert clean_name(name) == strict
    assert clean_name(name, NamePolicy.LIGHT) == light
    assert clean_name(name, NamePolicy.PREFIXED) == prefixed


@pytest.mark.parametrize("policy", list(NamePolicy))
def test_column_version_agrees(spark, policy):
    rows = spark.createDataFrame([(n,) for n in NAMES], "n string")
    for row in rows.select("n", clean_name_column(F.col("n"), policy).alias("c")).collect():
        assert row.c == clean_name(row.n, policy)


def test_unique_names():
    assert unique_names(["a", "A", "a!", "a"]) == ["a", "A_1", "a!", "a_3"]
    assert unique_names(["a", "A"], case_sensitive=True) == ["a", "A"]
    # A suffixed name may meet a name that is there already, or one that comes later.
    assert unique_names(["x", "x_2", "x"]) == ["x", "x_2", "x_2_2"]
    assert unique_names(["x", "x", "x_1"]) == ["x", "x_1", "x_1_2"]


def test_catalogue_agrees_with_plain_version(spark):
    rng = random.Random(7)
    tables = {f"t{t}": [rng.choice(["x", "X", "x_1", "x_2", "y", "x_1_2", "y_4"]) for _ in range(9)] for t in range(40)}
    rows = [(t, i, n) for t, names in tables.items() for i, n in enumerate(names)]
    catalogue = spark.createDataFrame(rows, "t string, i int, n string")
    found = {}
    for row in unique_names_in_catalogue(catalogue, "t", "i", "n").collect():
        found.setdefault(row.t, {})[row.i] = row.n
    for t, names in tables.items():
        expected = unique_names(names)
        assert [found[t][i] for i in range(len(names))] == expected
        assert len({n.lower() for n in expected}) == len(expected)


def test_clean_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`a b` int, `A-B` int, `%` int")
    assert clean_columns(df).columns == ["a_b", "A_B_1", "UNNAMED_COLUMN"]


def test_header_names():
    assert header_names(["i", "b", "i", None, "", "i"]) == ["i", "b", "i.1", "Unnamed: 3", "Unnamed: 4", "i.2"]
    assert header_names(["i", "i.1", "i"]) == ["i", "i.1", "i.2"]


def test_special_characters(spark):
    rows = spark.createDataFrame([(n,) for n in ["a b", "a-b", "a.b", "(a", "a]", "'a", '"a', "a_b", "a%"]], "n string")
    flags = {r.n: r.f for r in rows.select("n", has_special_characters(F.col("n")).alias("f")).collect()}
    assert [n for n, f in flags.items() if not f] == ["a_b", "a%"]

"""Cleaning and casting of single values, against the rules in plain Python."""

import math

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from millrace.functions import casts
from millrace.functions.text import WHITE_SPACE, clean_text, null_if, strip

TEXTS = [
    None, "", "  ", "\t x \n", " a ", "\u001cb", "​kept​", "\x01 ab", "\x02 \x03",
    "in\nner\x00", " plain ", "tab\tinside", "ß\x1f", "end\n", "end\r", "end\u0085", "end\u2028", "a\u2028b", "a", "é", "a é", "x\x7f", "　wide　", "a" * 5000 + " ",
]


def python_clean(text):
    if text is None:
        return None
    text = text.strip(WHITE_SPACE)
    text = "".join(c for c in text if ord(c) >= 32)
    return text if text.strip(WHITE_SPACE) else None


def apply(spark, values, expression, kind="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    result = rows.select("i", expression(F.col("v")).alias("r")).collect()
    return [r.r for r in sorted(result, key=lambda r: r.i)]


def test_white_space_is_pythons_but_for_zero_width():
    assert len(WHITE_SPACE) == 29
    assert all(c.isspace() for c in WHITE_SPACE)
    assert {chr(c) for c in range(1, 0x3100) if not chr(c).strip()} == set(WHITE_SPACE)


def test_clean_text_edge_cases(spark):
    assert apply(spark, TEXTS, clean_text) == [python_clean(t) for t in TEXTS]
    assert apply(spark, ["\x01 ab"], clean_text) == [" ab"]


def test_strip_every_code_point(spark):
    texts = [chr(c) + "a b" + chr(c) for c in range(1, 0x3100)]
    assert apply(spark, texts, strip) == [t.strip() for t in texts]


@settings(max_examples=5, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.characters(codec="utf-8"), max_size=20), min_size=100, max_size=200))
def test_clean_text_property(spark, texts):
    cleaned = apply(spark, texts, clean_text)
    assert cleaned == [python_clean(t) for t in texts]
    # Once no hidden character is left, a second pass only strips.
    again = apply(spark, cleaned, clean_text)
    assert again == [None if t is None else t.strip(WHITE_SPACE) for t in cleaned]


def test_null_tokens(spark):
    assert apply(spark, ["NULL", "x", "", None], lambda c: null_if(c, ("NULL", ""))) == [None, "x", None, None]


@pytest.mark.parametrize(
    "text,number",
    [("12.5", 12.5), ("+3", 3.0), ("-.5", -0.5), ("1e3", 1000.0), ("NaN", None), ("1,5", None),
     ("", None), ("12 ", None), ("0x1F", None), ("1.", 1.0), ("Infinity", None)],
)
def test_numbers(spark, text, number):
    assert apply(spark, [text], casts.try_double) == [number]


def test_try_number_rounds_half_up(spark):
    values = ["12.5", "-12.5", "12.49", "abc", "9" * 40]
    assert [None if v is None else int(v) for v in apply(spark, values, casts.try_number)] == [13, -13, 12, None, None]


def test_dates(spark):
    values = ["2024-02-29", "2023-02-29", "2024-01-02 03:04:05", "1998", "12/31/1999", "13/01/1999", "2024-1-2", "soon"]
    found = apply(spark, values, casts.try_date)
    assert [None if d is None else d.isoformat() for d in found] == [
        "2024-02-29", None, "2024-01-02", None, "1999-12-31", None, None, None,
    ]


def test_flags(spark):
    values = ["Yes", "n", "TRUE", "0", "1", "maybe", None]
    assert apply(spark, values, casts.try_flag) == [True, False, True, False, True, None, None]


def test_double_text(spark):
    values = [0.0, 1.0, 12345678.9, 1e7, 9.999e15, 0.00015, 0.001, -12345678.25, math.nan, None]
    texts = apply(spark, values, casts.double_text, "double")
    assert texts == [None if v is None or math.isnan(v) else repr(v) for v in values]


def test_stringify(spark):
    df = spark.createDataFrame([("nan", 1.0, True, 3), ("NaN", math.nan, None, None)], "a string, b double, c boolean, d int")
    assert [tuple(r) for r in casts.stringify(df).collect()] == [
        (None, "1.0", "true", "3"), ("NaN", None, None, None),
    ]


@pytest.mark.parametrize(
    "kind,text,value",
    [("NUMBER(10)", "42", 42), ("NUMBER", "42", 42), ("FLOAT", "4.5", 4.5), ("BOOLEAN", "y", True),
     ("VARCHAR(5)", "any length", "any length"), ("NUMBER(38)", "1" * 30, int("1" * 30))],
)
def test_cast_to(spark, kind, text, value):
    assert apply(spark, [text], lambda c: casts.cast_to(c, kind)) == [value]
    frame = spark.createDataFrame([(text,)], "v string").select(casts.cast_to(F.col("v"), kind).alias("r"))
    assert frame.dtypes[0][1] == casts.spark_type(kind)

"""First rows against a sort, narrowed and direct."""

import random
from datetime import date, datetime, timedelta

import pytest

from millrace.operators import top

RNG = random.Random(3)
KEYS = {
    "bigint": [RNG.choice([None, 0, 1, -(10**15), 10**15, *range(200)]) for _ in range(600)],
    "double": [RNG.choice([None, float("nan"), 0.5, -3.25, 1e9, RNG.random()]) for _ in range(600)],
    "date": [date(2024, 1, 1) + timedelta(RNG.randrange(500)) for _ in range(600)],
    "timestamp_ntz": [datetime(2024, 1, 1) + timedelta(seconds=RNG.randrange(9**7)) for _ in range(600)],
    "string": [RNG.choice("abcdefgh") for _ in range(600)],
    "int": [7] * 600,
}


@pytest.mark.parametrize("kind", KEYS)
@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("rows", [3, 150, 599, 1000])
def test_against_sort(spark, monkeypatch, kind, descending, rows):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(KEYS[kind])], f"k {kind}, i int").repartition(4)
    expected = {r.i for r in top.first_rows(df, ["k", "i"], rows, descending).collect()}
    monkeypatch.setattr(top, "ENOUGH_ROWS", 0)
    monkeypatch.setattr(top, "BUCKETS", 8)
    found = {r.i for r in top.first_rows(df, ["k", "i"], rows, descending, narrow=True).collect()}
    assert found == expected and len(found) == min(rows, 600)


def test_infinite_values_are_left_to_the_sort(spark, monkeypatch):
    monkeypatch.setattr(top, "ENOUGH_ROWS", 0)
    df = spark.createDataFrame([(v,) for v in (float("inf"), 1.0, float("-inf"), 0.0)], "k double")
    assert [r.k for r in top.first_rows(df, ["k"], 2, narrow=True).collect()] == [float("-inf"), 0.0]


def test_little_is_left_after_narrowing(spark, monkeypatch):
    monkeypatch.setattr(top, "ENOUGH_ROWS", 100)
    df = spark.range(100_000).selectExpr("(id * 7919) % 100000 AS k")
    assert top._narrow(df, "k", 10, False).count() < 200

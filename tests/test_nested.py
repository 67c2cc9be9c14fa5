"""Nested records: boards, report rows, arrays, sheets, windows and capped extracts."""

import json
from datetime import datetime
from pathlib import Path

import pytest

from millrace.sources import nested
from millrace.workspace import fresh_database


def page(board, cursor, items):
    return json.dumps({"data": {"boards": [{"id": board, "name": "n", "items_page": {"cursor": cursor, "items": items}}]}})


def item(number, *cells):
    values = [{"id": "c", "value": "raw", "column": {"title": t}, **({"text": x} if x != "-" else {})} for t, x in cells]
    return {"id": str(number), "name": f"item {number}", "column_values": values}


@pytest.fixture
def board(spark, folder):
    lines = [
        page("b1", "next", [item(1, ("Due Date", "monday"), ("Owner", None)), item(2, ("Due Date", "x"), ("due date", "last"))]),
        page("b1", None, [item(3, ("Item ID", "override"), ("Owner", "-"))]),
        page("b2", None, [item(4), item(5, (None, "untitled"))]),
    ]
    (Path(folder) / "pages.json").write_text("\n".join(lines))
    return nested.read_board_pages(spark, folder)


def test_pages_are_read_in_full(board):
    assert sorted((r.board_id, r.item_name) for r in board.collect()) == [
        ("b1", "item 1"), ("b1", "item 2"), ("b1", "item 3"), ("b2", "item 4"), ("b2", "item 5"),
    ]


def test_flatten(board):
    flat = nested.flatten_board(board)
    assert flat.columns == ["board_id", "item_id", "item_name", "", "due_date", "owner"]
    found = {r.item_name: tuple(r)[1:2] + tuple(r)[3:] for r in flat.collect()}
    assert found == {
        "item 1": ("1", None, "monday", None),
        "item 2": ("2", None, "last", None),
        "item 3": ("override", None, None, None),
        "item 4": ("4", None, None, None),
        "item 5": ("5", "untitled", None, None),
    }
    assert "Exchange" not in flat._jdf.queryExecution().executedPlan().toString()


def test_long_form_agrees_with_the_wide_one(board):
    titles = nested.board_titles(board)
    wide = {(r.item_id, t): r[t] for r in nested.flatten_board(board).collect() for t in titles if t not in nested.BASE_COLUMNS}
    long = {(r.item_id, r.title): r.text for r in nested.board_cells(board).collect() if r.title not in nested.BASE_COLUMNS}
    long = {k: v for k, v in long.items() if k[0] != "3"}  # that item's id is overwritten by a title
    wide = {k: v for k, v in wide.items() if k[0] != "override"}
    assert long == {k: v for k, v in wide.items() if k in long} and {k for k, v in wide.items() if v is not None} <= set(long)


def test_report(spark):
    rows = spark.createDataFrame([(["a", "b"], ["1"])], nested.REPORT_ROW)
    assert nested.flatten_report(rows, 3, 2).first().asDict() == {
        "dimension_1": "a", "dimension_2": "b", "dimension_3": None, "metric_1": "1", "metric_2": None,
    }


def test_json_arrays(spark, folder):
    (Path(folder) / "a.json").write_text('[{"a":1,"b":"x"},{"a":2}]\n{"a":3,"b":null}\n[]\n')
    rows = nested.read_json_array(spark, folder, "a int, b string").collect()
    assert sorted(tuple(r) for r in rows) == [(1, "x"), (2, None), (3, None)]


def test_broken_json_fails(spark, folder):
    (Path(folder) / "a.json").write_text('{"a":1}\n{"a":\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        nested.read_json_array(spark, folder, "a int").collect()


@pytest.mark.parametrize("multi_line", [False, True])
def test_bytes_that_are_not_utf8_fail(spark, folder, multi_line):
    (Path(folder) / "a.json").write_bytes(b'[{"a":1,"b":"\xff\xfe"}]')
    with pytest.raises(Exception, match="(?i)utf-?8"):
        nested.read_json_array(spark, folder, "a int, b string", multi_line).collect()


def test_an_array_over_many_lines(spark, folder):
    (Path(folder) / "a.json").write_text('[\n {"a": 1,\n  "b": "é"},\n\n {"a": 2}\n]\n')
    rows = nested.read_json_array(spark, folder, "a int, b string", multi_line=True).collect()
    assert sorted(tuple(r) for r in rows) == [(1, "é"), (2, None)]


def test_null_fields_are_not_written(spark, folder):
    nested.write_json(spark.createDataFrame([(1, None)], "a int, b string"), f"{folder}/out")
    written = "".join(p.read_text() for p in Path(folder, "out").glob("*.json"))
    assert written == '{"a":1}\n'


def test_routes(spark):
    rows = spark.createDataFrame([("Service",), ("Any Other Sheet",)], "sheet string")
    routed = nested.route_entities(rows, "sheet", {"Service": "service_raw.csv"}, prefix="book_")
    assert [r.target for r in routed.collect()] == ["service_raw.csv", "book_any_other_sheet.csv"]


def test_rolling_window(spark):
    moments = [datetime(2023, 1, 31), datetime(2023, 1, 30, 23, 59), datetime(2024, 1, 31, 23, 59), datetime(2024, 2, 1), None]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(moments)], "i int, m timestamp_ntz")
    assert [r.i for r in df.filter(nested.rolling_window("m", "2024-01-31")).collect()] == [0, 2]


def test_capped_extract(spark):
    database = fresh_database(spark, "test")
    spark.range(50).write.saveAsTable(f"{database}.full")
    spark.range(0).write.saveAsTable(f"{database}.empty")
    orders = {t: ["id"] for t in ("full", "empty", "none")}
    found = nested.extract_tables(spark, database, orders, cap=10)
    assert list(found.tables) == ["full"] and found.problems == {"empty": "no rows", "none": "no such table"}
    assert [r.id for r in found.tables["full"].collect()] == list(range(10))
    assert nested.extract_tables(spark, database).tables["full"].count() == 50  # no cap unless one is named

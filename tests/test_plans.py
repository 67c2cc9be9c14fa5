"""Plans and folders: what reaches the scan, what is broadcast, where files go."""

import json

import pytest

import check
from millrace import workspace
from millrace.operators import calendar as cal
from millrace.operators.audit import audit_summary, results_of
from millrace.plans import all_oracles, all_queries
from millrace.spec import TableSpec
from millrace.plans.run import run_tables
from tests.conftest import SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    queries = all_queries()
    window = plan(queries["date_window"](spark, SMALL))
    assert "GreaterThanOrEqual(o_orderdate" in window and "LessThan(o_orderdate" in window
    report = plan(queries["monthly_performance"](spark, SMALL))
    assert "ReadSchema: struct<l_shipdate:timestamp_ntz>" in report
    history = plan(queries["load_history"](spark, SMALL))
    assert "GreaterThanOrEqual(ts" in history


def test_calendar_is_broadcast_only_while_small(spark, monkeypatch):
    from datetime import date

    facts = spark.range(10).selectExpr("DATE '2024-01-05' AS d")
    dim = cal.date_dim(spark, date(2024, 1, 1), date(2024, 12, 31))
    assert "ResolvedHint" in cal.date_join(facts, "d", dim)._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr(cal, "BROADCAST_DAYS", 100)
    dim = cal.date_dim(spark, date(2024, 1, 1), date(2024, 12, 31))
    assert "ResolvedHint" not in cal.date_join(facts, "d", dim)._jdf.queryExecution().analyzed().toString()


def test_no_python_in_any_plan(spark):
    for name in ("clean_table", "infer_types", "board_flatten", "web_report", "table_checksum"):
        text = plan(all_queries()[name](spark, SMALL))
        assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_folders_are_shared_and_fresh(spark, monkeypatch):
    named = spark.conf.get("spark.checkpoint.dir", None)
    root = workspace.shared_root(spark)
    if named:
        assert root == named.rstrip("/")
    assert workspace.fresh_folder(spark, "x") != workspace.fresh_folder(spark, "x")
    assert workspace.fresh_folder(spark, "x").startswith(root)


def test_a_cluster_must_name_its_folder():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://host:7077"

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        workspace.shared_root(Session())


def test_cut_lineage(spark):
    df = spark.range(10).selectExpr("id", "id % 2 AS k")
    cut = workspace.cut_lineage(df)
    assert sorted(cut.collect()) == sorted(df.collect()) and "Range" not in plan(cut)


def test_a_broken_table_does_not_stop_the_run(spark, folder):
    from pathlib import Path

    Path(folder, "good.csv").write_text("id,name\n1, a \n1,b\n,c\n")
    Path(folder, "bad.csv").write_text("")
    database = workspace.fresh_database(spark, "test")
    specs = [TableSpec("good", "GOOD", "id", order_by=("name",)), TableSpec("bad", "bad"), TableSpec("none", "none"), TableSpec("loose", "GOOD", "id")]
    found = {r.table_name: (r.status, r.rows_loaded) for r in run_tables(spark, specs, folder, database, audit_table=f"{database}.audit").collect()}
    assert found["good"] == ("success", 1) and found["bad"][0] == "failed" and found["none"][0] == "failed"
    assert [tuple(r) for r in spark.table(f"{database}.good").collect()] == [(1, "a")]
    noted = spark.table(f"{database}.audit")
    summary = {r.stage: r for r in audit_summary(results_of(noted), "stage").collect()}
    load = summary["load"]
    assert (load.total_tables, load.successful, load.failed, load.total_rows_loaded) == (4, 1, 3, 1)
    assert {s: (r.successful, r.failed) for s, r in summary.items()} == {
        "clean": (1, 1), "infer": (1, 0), "load": (1, 3), "verify": (1, 0),
    }
    details = {(r.stage, json.loads(r.data)["table_name"]): json.loads(r.data) for r in noted.collect()}
    assert details["clean", "good"]["rows_read"] == 3 and details["clean", "good"]["rows_loaded"] == 1
    assert set(details["infer", "good"]["types"]) == {"id", "name"} and details["verify", "good"]["rows_expected"] == 1
    assert details["clean", "loose"]["error"] == details["load", "loose"]["error"] == "ValueError: keeping the first row of a key needs an order"


def test_a_wrong_number_of_rows_is_in_the_audit(spark, folder):
    from pathlib import Path

    Path(folder, "t.csv").write_text("id,name\n1,a\n2,b\n")
    database = workspace.fresh_database(spark, "test")
    spec = TableSpec("t", "t", "id", order_by=("name",), expected_rows=3)
    assert run_tables(spark, [spec], folder, database, audit_table=f"{database}.audit").first().status == "warning"
    verified = results_of(spark.table(f"{database}.audit")).filter("stage = 'verify'").first()
    assert (verified.status, verified.error, verified.rows_loaded) == ("warning", "2 rows, not 3", 2)


def test_temporary_copies(spark):
    with pytest.raises(ZeroDivisionError):
        with workspace.temporary_copies(spark):
            failed = workspace.cut_lineage(spark.range(3))
            raise ZeroDivisionError
    with workspace.temporary_copies(spark) as keep_outer:
        with workspace.temporary_copies(spark) as keep:
            inner = workspace.cut_lineage(spark.range(3))
            result = keep(inner.selectExpr("id + 1 AS id"), "result")
        assert result.count() == 3
        last = keep_outer(result, "last")
    assert sorted(r.id for r in last.collect()) == [1, 2, 3]
    for df in (failed, inner, result):
        with pytest.raises(Exception, match="(?i)not exist|not found|FileNotFound"):
            df.collect()


@pytest.mark.parametrize("name", ["file_provenance", "run_with_warnings"])
def test_landing_spreads_over_tasks(spark, name, monkeypatch):
    from millrace.plans import landing

    monkeypatch.setattr(landing, "_landed", {})  # land anew
    kind = type(spark.range(1))
    for method in ("repartition", "coalesce"):
        def spread_only(df, *args, whole=getattr(kind, method)):
            assert args[0] != 1, "a whole table goes through one task"
            return whole(df, *args)

        monkeypatch.setattr(kind, method, spread_only)
    assert check.compare(all_queries()[name](spark, SMALL), check.connect(SMALL), all_oracles()[name], False) == ""

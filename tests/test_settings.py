"""Settings that hold for a block, and what runs within one."""

from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from millrace import workspace
from millrace.functions.casts import LEADING_ZERO, cast_to, changed_by_cast, changed_by_double, is_number, try_number
from millrace.operators import load
from millrace.plans import run
from millrace.plans.run import inbox_entries
from millrace.session import compiled, few_listings, settings
from millrace.sources.csv import read_csv_checked
from millrace.sources.files import list_files
from millrace.spec import TableSpec

METHOD = "spark.sql.codegen.hugeMethodLimit"
LISTINGS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def test_settings_come_back(spark):
    before = spark.conf.get(METHOD)
    with pytest.raises(ZeroDivisionError), compiled(spark), compiled(spark):
        assert spark.conf.get(METHOD) == "8000" != before
        1 / 0
    assert spark.conf.get(METHOD) == before
    with settings(spark, **{"millrace.unknown": "1"}):
        assert spark.conf.get("millrace.unknown") == "1"
    assert spark.conf.get("millrace.unknown", None) is None


def test_settings_hold_until_the_last_thread_is_done(spark):
    before, both = spark.conf.get(METHOD), Barrier(2)

    def one(first: bool) -> str:
        with compiled(spark):
            both.wait()
            if first:
                return ""
            both.wait()
            return spark.conf.get(METHOD)

    with ThreadPoolExecutor(2) as pool:
        early, late = pool.submit(one, True), pool.submit(one, False)
        early.result()
        both.wait()
        assert late.result() == "8000"
    assert spark.conf.get(METHOD) == before


def test_folders_are_listed_by_a_few_tasks(spark, tmp_path):
    for i in range(200):
        (tmp_path / f"n={i}").mkdir()
        (tmp_path / f"n={i}" / "a.csv").write_text("x\n1\n")
    before = spark.conf.get(LISTINGS)
    context = spark.sparkContext
    context.setJobGroup("listing", "listing")
    assert list_files(spark, str(tmp_path)).count() == 200
    context.setLocalProperty("spark.jobGroup.id", None)
    told = context.statusTracker()
    stages = [s for j in told.getJobIdsForGroup("listing") for s in told.getJobInfo(j).stageIds]
    tasks = [told.getStageInfo(s).numTasks for s in stages if told.getStageInfo(s)]
    assert max(tasks) <= max(4 * context.defaultParallelism, 32)
    assert spark.conf.get(LISTINGS) == before
    with few_listings(spark):
        assert int(spark.conf.get(LISTINGS)) < 200


def test_a_load_parses_each_line_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,v\n1,2\n2,"x\n3,n/a\n4\n')
    fields = [load.Field("k", "NUMBER(9)"), load.Field("v", "FLOAT")]
    checked = load.check_rows(read_csv_checked(spark, str(tmp_path), ["k", "v"]), fields)
    good = load.good_rows(checked)
    assert good._jdf.queryExecution().optimizedPlan().toString().count("from_csv(") == 1
    assert sorted(map(tuple, good.collect()), key=str) == [(1, 2.0), (4, None)]
    assert sorted(r.value for r in load.rejects(checked, []).collect()) == ['2,"x', "n/a"]


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_an_inbox_with_a_scheme(spark, tmp_path, scheme):
    (tmp_path / "a.csv").mkdir()
    (tmp_path / "a.csv" / "part-0.csv").write_text("x\n1\n")
    (tmp_path / "b.csv").write_text("x\n1\n")
    assert sorted(r.name for r in inbox_entries(spark, f"{scheme}{tmp_path}").collect()) == ["a.csv", "b.csv"]


def test_a_table_is_copied_once_on_its_way(spark, tmp_path, monkeypatch):
    copies = []

    @contextmanager
    def counted(session):
        with workspace.scratch_tables(session) as keep:
            yield lambda df: copies.append(df) or keep(df)

    monkeypatch.setattr(run, "scratch_tables", counted)
    (tmp_path / "t.csv").write_text("Order ID,Total Price\n1,1234567890123456789\n2,007\n3,1.5\n")
    told = run.load_table(spark, TableSpec("t", "t", "Order ID", order_by=("Total Price",)), f"{tmp_path}/t.csv", workspace.fresh_database(spark))
    assert len(copies) == 1
    assert (told["status"], told["error"], told["rows_loaded"]) == ("warning", "2 cells changed", 3)


def test_whole_numbers_and_their_changes(spark):
    texts = ["7", "007", "-7", "+7", "12", "123", "1.5", "1.0", "1e2", "9" * 18, "9" * 19, "9" * 40, "x", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    for kind, size in (("NUMBER(2)", 2), ("NUMBER(18)", 18)):
        whole = try_number(t, size).cast("bigint")
        lost = whole.isNotNull() & (t.rlike(LEADING_ZERO) | F.coalesce(try_number(t, 38, 10) != whole.cast("decimal(38,10)"), F.lit(False)))
        found = df.select("t", cast_to(t, kind).alias("v"), whole.alias("w"), changed_by_cast(t, kind).alias("c"), lost.alias("d")).collect()
        assert all(r.v == r.w and r.c == r.d for r in found), found
    told = dict(df.select("t", changed_by_cast(t, "FLOAT")).where(is_number(t)).collect())
    assert {k for k, v in told.items() if v} == {"007", "9" * 18, "9" * 19, "9" * 40}
    odd = spark.createDataFrame([("1e400",), ("-1e400",), ("123456789.12345",)], "t string")
    assert [r[0] for r in odd.select(changed_by_double(t)).collect()] == [True, True, False]

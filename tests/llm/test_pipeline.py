import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
import check
import corpus_pipeline
from millrace.llm import quality_mil, queries
from millrace.workspace import cut_lineage
from tests.conftest import SMALL
from tests.llm.helpers import shingles
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_jaccard_join import brute as classes
from tests.llm.test_line_dedup import brute as without_lines


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(cut_lineage(stage(spark, out[-1], SMALL), name))
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "bpe",
    ]
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes
        assert df.where(F.col("n_chars") != F.length("text")).count() == 0


def test_classifier_decides(spark, stages):
    labels = queries.table(spark, SMALL, "labels").where(queries.fold("doc_id", 3) != 1)
    model = quality_mil.train(stages[0].select("doc_id", "text"), labels)
    given = sorted(texts(stages[0]).items())
    scores = model.score([t or "" for _, t in given])
    assert set(texts(stages[1])) == {i for (i, _), s in zip(given, scores) if s >= 0.5}


def test_lines_go(stages):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in stages[1].collect()]
    want = {i: t for (i, t), (_, old, _) in zip(without_lines(rows, 10, 3), rows) if t == old or (t or "").split()}
    assert texts(stages[2]) == want


def test_one_of_each_group_stays(stages):
    given = list(texts(stages[2]).items())
    assert set(texts(stages[3])) == {c for c, _, _ in classes(given).values()}


def test_no_test_item_stays(spark, stages):
    items = [(r["item_id"], r["text"]) for r in queries.table(spark, SMALL, "benchmark").collect()]
    held = {d for d, _ in contaminated(list(texts(stages[3]).items()), items)}
    assert set(texts(stages[4])) == set(texts(stages[3])) - held
    assert all(shingles(t) for t in texts(stages[4]).values() if t)


def test_all_encoded(stages):
    assert stages[5].count() == stages[4].count()
    assert stages[5].where("NOT round_trip OR n_tokens != size(token_ids)").count() == 0


def test_run_gives_the_last_stage(spark, stages):
    assert registered.queries()["pipeline"](spark, SMALL).exceptAll(stages[5]).count() == 0


def test_every_operator_has_its_query():
    names = sorted((q for q in registered.queries() if q.startswith("op")), key=lambda q: int(q[2:].split("_")[0]))
    assert [int(q[2:].split("_")[0]) for q in names] == list(range(1, 11))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    assert check.compare(queries.QUERIES[name](spark, SMALL), check.connect(SMALL), queries.ORACLES[name]) == ""

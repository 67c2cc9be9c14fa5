import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import quality_mil, queries
from tests.llm.helpers import ODD_TEXTS, documents

MIDDLE = "/root/testdata/sf0.01"


def test_gradient():
    draw = np.random.default_rng(0)
    model = quality_mil.Model()
    x, counts = draw.standard_normal((9, quality_mil.WIDTH)).astype(np.float32), np.array([2, 1, 6])
    label = np.array([1.0, 0.0, 1.0])

    def loss():
        p = model.forward(x.astype(np.float64), counts)["score"]
        return -np.mean(label * np.log(p) + (1 - label) * np.log(1 - p))

    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    exact = model.gradient(x.astype(np.float64), counts, label)
    for name, weight in model.weights.items():
        at = tuple(draw.integers(0, n) for n in weight.shape)
        old = weight[at]
        weight[at] = old + 1e-5
        up = loss()
        weight[at] = old - 1e-5
        down = loss()
        weight[at] = old
        assert exact[name][at] == pytest.approx((up - down) / 2e-5, abs=1e-5)


def test_attention_is_a_share_of_each_bag():
    model = quality_mil.Model()
    x, counts = quality_mil.encode(["some words here " * 100, "", "x"])
    share = model.forward(x, counts)["share"]
    starts = np.cumsum(counts) - counts
    assert np.add.reduceat(share, starts) == pytest.approx(np.ones(3), abs=1e-5)


def test_few_passages_of_a_long_text_are_learned_from():
    long = np.arange(1000, dtype=np.float32)[:, None]
    kept = quality_mil.spaced(long)[:, 0]
    assert len(kept) == quality_mil.BAG_PASSAGES and kept[0] == 0 and kept[-1] == 999
    assert set(np.diff(kept).astype(int)) <= {15, 16}
    assert len(quality_mil.spaced(long[:64])) == 64 and (quality_mil.spaced(long[:65], 65) == long[:65]).all()


def test_odd_rows_and_labels(spark):
    rows = documents(spark, [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(0, "twice"), (None, "no id")])
    given = rows.withColumn("quality_score", F.lit("x")).withColumn("_label", F.lit(0))
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 1), (3, 0), (None, 1), (4, None)], "doc_id long, quality int")
    out = quality_mil.score_quality(given, labels)
    got = out.collect()
    assert out.columns == [*rows.columns, "_label", "quality_score"] and len(got) == len(ODD_TEXTS) + 2
    assert all(0 <= r["quality_score"] <= 1 for r in got)
    assert len({r["quality_score"] for r in got if not (r["text"] or "").split() and r["text"] != "\x1c\x1d"}) == 1
    none = quality_mil.score_quality(rows, labels.limit(0)).collect()
    assert {r["quality_score"] for r in none} == {0.5}
    assert quality_mil.score_quality(rows.limit(0), labels).count() == 0


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    rows = [r for r in queries.op9_quality_mil(spark, MIDDLE).collect()]
    assert len(rows) == 1000
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) > 0.95


def test_encoding_takes_memory_by_the_window():
    texts = ["some words " * 200_000] * 3 + ["w" * 4_000_000]
    tracemalloc.start()
    x, counts = quality_mil.encode(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert counts.tolist() == [4000] * 3 + [1]
    assert np.array_equal(x, np.concatenate([quality_mil.encode([t])[0] for t in texts]))
    assert peak < 100e6

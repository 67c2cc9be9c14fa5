import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import queries, repetition
from tests.conftest import SMALL
from tests.llm.helpers import ODD_TEXTS, WORD, documents


def windows_twice(w, size):
    seen = Counter(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    return {i + k for i in range(len(w) - size + 1) if seen[tuple(w[i : i + size])] > 1 for k in range(size)}


def longest(w):
    best = 0
    for size in range(1, len(w)):
        if len({tuple(w[i : i + size]) for i in range(len(w) - size + 1)}) == len(w) - size + 1:
            break
        best = size
    return best


def brute(text, least=repetition.MIN_REPEAT):
    text = text or ""
    w = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    most = longest(w)
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(windows_twice(w, 3)),
        "covered_words": len(windows_twice(w, least)), "longest_repeat": most if most >= least else 0,
    }


@pytest.mark.parametrize("least", [2, 4, 8])
def test_repeats_against_brute_force(least):
    draw = random.Random(least)
    for _ in range(400):
        w = [draw.choice("abc") for _ in range(draw.randrange(60))]
        if draw.random() < 0.5:
            w = w + w[: draw.randrange(len(w) + 1)]
        ids = repetition.word_ids([x.encode() for x in w])
        mask, most = repetition.repeats(ids, least)
        want = longest(w)
        assert (set(np.flatnonzero(mask).tolist()), most if most >= least else 0) == (windows_twice(w, least), want if want >= least else 0)


def test_odd_rows(spark):
    rows = list(enumerate(ODD_TEXTS)) + [(0, "a b\n" * 40), (0, "a b\n" * 40), (None, "x # y")]
    given = documents(spark, rows).withColumn("measures", F.lit(1)).withColumn("kept", F.lit("x"))
    out = repetition.judge_repetition(given)
    got = out.collect()
    assert out.columns == [*given.columns, "repetition"] and len(got) == len(rows)
    for r in got:
        m = r["repetition"].asDict()
        want = brute(r["text"]) if len(r["text"] or "") < 9000 else {}
        assert {k: m[k] for k in want} == want
        assert m["covered_words"] == sum(s["end"] - s["start"] for s in m["spans"])
        assert m["base_failed"] == (m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"])
        assert not (m["base_failed"] and m["kept"])
    assert repetition.judge_repetition(given.limit(0)).count() == 0
    with pytest.raises(ValueError):
        repetition.judge_repetition(given, verdict="TEXT")


def test_query_against_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = queries.op10_repetition(spark, SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        if len(texts[r["doc_id"]] or "") < 12_000:
            want = brute(texts[r["doc_id"]])
            assert {k: r[k] for k in want} == want
        fine = not r["base_failed"] and r["covered_words"] <= 0.25 * r["n_words"] and r["longest_repeat"] <= 100
        assert r["kept"] == fine


def test_the_method_rejects_what_the_base_rules_keep(spark):
    own = lambda seed, n: " ".join(f"w{seed}x{i}" for i in range(n))
    passage, long_passage = own("p", 40), own("q", 120)
    rows = [
        (1, own(1, 200)),  # nothing repeats
        (2, f"{passage} {own(2, 300)} {passage}"),  # 80 of 380 words
        (3, f"{passage} {own(3, 200)} {passage}"),  # 80 of 280 words
        (4, f"{long_passage} {own(4, 2000)} {long_passage}"),  # few words of many, but 120 in a row
        (5, f"{passage} {passage}"),  # the base rules see this one
    ]
    out = {r["doc_id"]: r["repetition"] for r in repetition.judge_repetition(documents(spark, rows)).collect()}
    assert [(out[i]["base_failed"], out[i]["kept"]) for i in range(1, 6)] == [
        (False, True), (False, True), (False, False), (False, False), (True, False),
    ]

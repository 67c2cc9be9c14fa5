"""Extra columns named like anything the operators use inside change no result and pass through."""

import re
from pathlib import Path

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from millrace.llm import (
    align, bpe, chat_format, decontaminate, jaccard_join, line_dedup, pii, prefix_trie, quality_mil, queries,
    repetition, suffix_dedup, url_filter,
)
from tests.llm.helpers import documents, prose

MODULES = (align, bpe, chat_format, decontaminate, jaccard_join, line_dedup, pii, prefix_trie, quality_mil, repetition, suffix_dedup, url_filter)
INSIDE = sorted({n for m in MODULES for n in re.findall(r'"(_\w+)"', Path(m.__file__).read_text())} | {"held", "a.b"})
SHARED = "this line stands on many sites"
ROWS = [
    (i, f"{prose(i, 30)}\n{SHARED}\nmail a{i}@b.org or call +1 (017) 555-77{i}0 now", f"s{i}") for i in range(10, 22)
] + [(30, prose(10, 30) + f"\n{SHARED}\nmail a10@b.org or call +1 (017) 555-77100 now", "s1"), (31, prose(99, 40), "s2"), (32, None, None), (None, "", "s3")]

PIECES = public_tokenizers.path("piece_bpe_32k.model")
OPERATORS = {
    "bpe": lambda d, crowd: bpe.encode_and_decode(d, queries.vocabulary()),
    "line_dedup": lambda d, crowd: line_dedup.remove_boilerplate(d, min_sites=5),
    "decontaminate": lambda d, crowd: decontaminate.decontaminate(
        d, crowd(d.sparkSession.createDataFrame([(1, prose(99, 40))], "item_id long, text string"))
    ),
    "jaccard_join": lambda d, crowd: jaccard_join.drop_similar(d),
    "pii": lambda d, crowd: pii.find_personal_data(d),
    "quality_mil": lambda d, crowd: quality_mil.score_quality(
        d, crowd(d.sparkSession.createDataFrame([(i, i % 2) for i in range(10, 22)], "doc_id long, quality int"))
    ),
    "repetition": lambda d, crowd: repetition.judge_repetition(d),
    "suffix_dedup": lambda d, crowd: suffix_dedup.remove_repeats(d),
    "align": lambda d, crowd: align.align_tokens(d, queries.vocabulary(), PIECES),
    "url_filter": lambda d, crowd: url_filter.judge_urls(d.withColumn("url", F.concat(F.lit("http://"), "source", F.lit(".org/x")))),
}


def crowded(df):
    return df.select("*", *[F.lit(n).alias(n) for n in INSIDE])


def test_names_were_found():
    assert {"_d1", "_lost", "_lines", "_key", "_held", "_first", "_again", "_spans"} <= set(INSIDE)


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_names(spark, name):
    given, operator = documents(spark, ROWS), OPERATORS[name]
    plain = operator(given, lambda df: df)
    full = operator(crowded(given), crowded)
    assert set(full.columns) == set(plain.columns) | set(INSIDE)
    rows = full.collect()
    assert all(r[n] == n for r in rows for n in INSIDE)
    assert sorted(repr([r[c] for c in plain.columns]) for r in rows) == sorted(repr(list(r)) for r in plain.collect())

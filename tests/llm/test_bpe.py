import hashlib
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import bpe, queries
from millrace.llm.common import slices
from tests.conftest import SMALL
from tests.llm.helpers import ODD_TEXTS, documents


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.vocabulary())


@pytest.fixture(scope="module")
def codec():
    with open(queries.vocabulary(), encoding="utf-8") as file:
        return bpe.Codec(file.read())


def test_same_ids_and_text_as_the_library(codec, library):
    draw = random.Random(3)
    letters = [chr(c) for c in range(0x560)] + list(" \n\t'srveABx12  ") * 60
    texts = ["".join(draw.choices(letters, k=draw.randrange(60))) for _ in range(3000)]
    texts += [t for t in ODD_TEXTS if t is not None]
    texts += ["a <|endoftext|> b<|endoftext|><|endoftext|>", "a" * 20000, "it's I'LL they'll", chr(0x10FFFF)]
    for text, theirs in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        ids = codec.encode(text)
        assert ids == theirs.ids
        assert codec.decode(ids) == library.decode(theirs.ids, skip_special_tokens=False)


def test_stale_entries_are_skipped(codec):
    # Overlapping candidates: merging one makes its neighbours' entries stale.
    for word in ("aaaaaaa", "ababababab", "thethethe", "  the"):
        assert codec.decode(codec.merge([codec.byte_ids[b] for b in word.encode()])) == word


def test_frame_with_odd_rows(spark):
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(0, "again"), (0, "again"), (None, "no id")]
    given = documents(spark, rows).withColumn("encoded", F.lit("mine")).withColumn("a.b", F.lit(1))
    out = bpe.encode_and_decode(given, queries.vocabulary())
    assert out.columns == given.columns + ["token_ids", "decoded_text"]
    got = out.collect()
    assert len(got) == len(rows)
    assert all(r["decoded_text"] == (r["text"] or "") and r["encoded"] == "mine" for r in got)
    assert [r["token_ids"] for r in got if not r["text"]] == [[], []]
    with pytest.raises(ValueError):
        bpe.encode_and_decode(given.withColumn("Token_ids", F.lit(1)), queries.vocabulary())
    assert bpe.encode_and_decode(given.limit(0), queries.vocabulary()).count() == 0


def test_columns_one_way(spark):
    shared = bpe.SharedVocabulary(spark, queries.vocabulary())
    rows = spark.createDataFrame([("hello there",), (None,), ("",)], "text string")
    out = rows.withColumn("ids", bpe.encode_column(shared, F.col("text")))
    back = out.withColumn("back", bpe.decode_column(shared, F.col("ids"))).collect()
    assert [r["back"] for r in back] == ["hello there", None, ""]


def test_query_against_the_library(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = queries.op1_bpe(spark, SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_batches_are_taken_in_slices_of_bounded_bytes():
    texts = pa.array([None, "", "a" * 10, "b" * 50, "c" * 10, "d" * 10, None, *"efghijkl"])
    found = list(slices(texts, rows=4, size=25))
    assert [at for at, _ in found] == [sum(n for _, n in found[:k]) for k in range(len(found))]
    assert sum(n for _, n in found) == len(texts)
    assert all(n <= 4 and (n == 1 or sum(len(t or "") for t in texts.slice(at, n).to_pylist()) <= 25) for at, n in found)
    assert list(slices(pa.array([], pa.string()), 4, 25)) == []

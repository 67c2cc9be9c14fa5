import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import queries, suffix_dedup
from tests.conftest import SMALL
from tests.llm.helpers import ODD_TEXTS, documents, prose


def brute(rows, least):
    """(removed spans, kept bytes) of each (id, text) by comparing all windows."""
    key = lambda i: suffix_dedup.NO_ID if i is None else i
    first = {}
    for i, text in rows:
        data = (text or "").encode()
        for p in range(len(data) - least + 1):
            w = data[p : p + least]
            first[w] = min(first.get(w, key(i)), key(i))
    out = []
    for i, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - least + 1):
            if first[data[p : p + least]] < key(i):
                gone[p : p + least] = b"\1" * least
        edges = [p for p in range(len(data) + 1) if (gone[p] if p < len(data) else 0) != (gone[p - 1] if p else 0)]
        out.append((list(zip(edges[::2], edges[1::2])), bytes(b for b, g in zip(data, gone) if not g)))
    return out


def result(df):
    """(id, text, spans, kept) of each row."""
    return sorted(
        ((r["doc_id"], r["text"], [(s["start"], s["end"]) for s in r["removed_spans"]], bytes(r["kept_bytes"])) for r in df.collect()),
        key=repr,
    )


def compared(spark, rows, least=50):
    got = result(suffix_dedup.remove_repeats(documents(spark, rows), least=least))
    want = sorted(((i, t, *found) for (i, t), found in zip(rows, brute(rows, least))), key=repr)
    assert got == want
    return got


@pytest.mark.parametrize("letters", ["ab", "abcdefgh", "".join(map(chr, range(32, 900)))])
def test_groups_of_equal_windows(letters):
    draw = random.Random(len(letters))
    for least in (4, 5, 9, 50):
        strings = {"".join(draw.choice(letters) for _ in range(draw.randrange(least, 3 * least))).encode() for _ in range(30)}
        strings |= {s[: -draw.randrange(1, 3)] + b"~" * least for s in list(strings)[:10]}
        strings = [s for s in strings if len(s) >= least]
        string, place, group = suffix_dedup.groups(strings, least)
        windows = [strings[s][p : p + least] for s, p in zip(string, place)]
        assert sorted(zip(string, place)) == [(i, p) for i, s in enumerate(strings) for p in range(len(s) - least + 1)]
        assert len(set(zip(windows, group))) == len(set(windows)) == len(set(group))


def test_boundaries_are_found_by_increasing_prefix():
    data = np.frombuffer(b"abracadabra\0abracadxbra\0", np.uint8).copy()
    order = suffix_dedup.rotations(data, 6)
    known = suffix_dedup.known_boundaries(data[order - 1], 6)
    rows = [bytes(np.roll(data, -k)) for k in order]
    for k in range(1, len(rows)):
        if 0 not in rows[k][:6] and 0 not in rows[k - 1][:6]:
            assert known[k] == (rows[k][:6] != rows[k - 1][:6])


@pytest.mark.parametrize("least", [6, 20, 50])
def test_against_brute_force(spark, monkeypatch, least):
    draw = random.Random(least)
    parts = [prose(k, 40, 10**6) for k in range(12)] + ["ab" * 60, "é日\U0001f600" * 20, "x" * 200]
    rows = [(draw.randrange(40), " ".join(draw.choices(parts, k=draw.randrange(4)))[draw.randrange(30) :]) for _ in range(60)]
    rows += [(-5, parts[0]), (None, parts[1]), (None, parts[1]), (7, None), (8, "")]
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 4000)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 4000)
    got = compared(spark, rows, least)
    assert any(spans for _, _, spans, _ in got)


def test_slices_and_blocks_lose_nothing(spark):
    """Small slices, blocks and hot limits in the functions that run in tasks."""
    draw, least = random.Random(2), 20
    parts = [prose(k, 30, 10**6).encode() for k in range(6)]
    texts = [b" ".join(draw.choices(parts, k=draw.randrange(1, 6))) + str(i).encode() * 3 for i in range(80)]
    want = brute([(i, t.decode()) for i, t in enumerate(texts)], least)
    for name, values in {"SLICE": (64, 1 << 20), "BLOCK": (300, 1 << 20), "ROWS": (1, 7), "HOT": (2, 8, 4096)}.items():
        for value in values:
            with pytest.MonkeyPatch.context() as patch:
                patch.setattr(suffix_dedup, name, value)
                if name != "BLOCK":
                    patch.setattr(suffix_dedup, "BLOCK", 2000)
                assert in_one_process(texts, least) == [w[0] for w in want], (name, value)


def in_one_process(texts, least, chunks=7):
    dealt = [[] for _ in range(chunks)]
    for i, t in enumerate(texts):
        dealt[i % chunks].append((i % chunks, i, i, t))
    tables = [
        pa.Table.from_pylist([dict(zip(("chunk", "row", "doc", "bytes"), r)) for r in rows], pa.schema(
            [("chunk", pa.int64()), ("row", pa.int64()), ("doc", pa.int64()), ("bytes", pa.binary())]
        )) for rows in dealt
    ]
    keys = pa.concat_tables([suffix_dedup.keys_of_chunk(least, 3)(t) for t in tables])
    replies = pa.concat_tables([suffix_dedup.candidates_of_bucket(keys.filter(pa.compute.equal(keys["bucket"], b))) for b in range(3)])
    strings = pa.concat_tables([
        suffix_dedup.strings_of_chunk(least, 3)(t, replies.filter(pa.compute.equal(replies["chunk"], c))) for c, t in enumerate(tables)
    ]).sort_by([("key", "ascending"), ("smallest", "ascending")])
    found = pa.Table.from_batches(suffix_dedup.spans_of_partition(least)(iter(strings.to_batches(max_chunksize=50))), suffix_dedup.RESULT)
    out = {}
    for c, t in enumerate(tables):
        cut = suffix_dedup.cut_of_chunk(t, found.filter(pa.compute.equal(found["chunk"], c)))
        for (_, i, _, _), spans in zip(dealt[c], cut["removed"].to_pylist()):
            out[i] = [(s["start"], s["end"]) for s in spans]
    return [out[i] for i in range(len(texts))]


def test_hot_keys(spark, monkeypatch):
    """One line in all texts, with another text after it each time."""
    monkeypatch.setattr(suffix_dedup, "HOT", 5)
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 1000)
    line = "the very same line of boilerplate stands in all of these texts, all rights reserved."
    compared(spark, [(i, f"{prose(i, 9)} {line} {prose(i + 100, 9)}") for i in range(40)])


def test_odd_rows(spark):
    rows = [(i % 9, t) for i, t in enumerate(ODD_TEXTS)] + [(3, "y" * 70), (4, "y" * 70), (4, "y" * 70), (None, "y" * 70)]
    got = compared(spark, rows)
    assert (4, "y" * 70, [(0, 70)], b"") in got and (3, "y" * 70, [], b"y" * 70) in got
    given = documents(spark, rows).withColumn("bytes", F.lit(1)).withColumn("chunk", F.lit("x")).withColumn("c0", F.lit(2.5)).withColumn("codes", F.array(F.lit(1)))
    out = suffix_dedup.remove_repeats(given)
    assert out.columns == [*given.columns, "removed_spans", "kept_bytes"] and result(out) == got
    assert out.select("bytes", "chunk", "c0").distinct().collect() == [(1, "x", 2.5)]
    assert suffix_dedup.remove_repeats(given.limit(0)).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(given, kept="TEXT")
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(given, doc_id="source")


def test_query_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want = {i: found for (i, _), found in zip(rows, brute(rows, 50))}
    got = queries.op11_suffix_dedup(spark, SMALL).collect()
    assert len(got) == len(rows)
    for r in got:
        spans, kept = want[r["doc_id"]]
        assert (r["n_spans"], r["n_removed"]) == (len(spans), sum(b - a for a, b in spans))
        assert r["n_bytes"] == r["n_removed"] + len(kept) and r["kept_sha256"] == hashlib.sha256(kept).hexdigest()
    assert sum(r["n_removed"] for r in got) > 0

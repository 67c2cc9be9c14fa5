import pytest
from pyspark.sql import functions as F

from millrace.llm import decontaminate
from tests.llm.helpers import documents, prose, shingles


@pytest.fixture(scope="module")
def tables(spark):
    items = [(i, prose(1000 + i, n)) for i, n in enumerate([1, 3, 5, 6, 9, 12, 20, 40, 70, 200])]
    items += [(50, None), (51, ""), (52, "  "), (None, prose(1, 30)), (7, items[7][1]), (60, items[7][1])]
    docs = []
    for k in range(60):
        body = prose(k, 300).split()
        item = (items[k % 10][1]).split()
        lost = k % 4  # some words of the item are changed
        for w in range(lost):
            item[(w * 7) % len(item)] = f"other{k}"
        docs.append((k, " ".join(body[:150] + item + body[150:])))
    docs += [(100, prose(5, 20000) + " " + items[8][1].upper()), (101, None), (102, ""), (None, items[8][1]), (0, docs[0][1]), (103, items[4][1])]
    return docs, items


def brute(docs, items):
    sets, wanted = {}, {}
    for i, t in docs:
        if i is not None:
            sets[i] = sets.get(i, set()) | shingles(t)
    for i, t in items:
        if i is not None:
            wanted[i] = wanted.get(i, set()) | shingles(t)
    return {
        (d, i): (len(w), len(s & w)) for d, s in sets.items() for i, w in wanted.items() if w and len(s & w) / len(w) >= 0.8
    }


def test_pairs_against_brute_force(spark, tables):
    docs, items = tables
    given = documents(spark, docs).withColumn("item_id", F.lit(3)).withColumn("shingle", F.lit("x"))
    tests = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminations(given, tests).collect()
    assert {(r["doc_id"], r["item_id"]): (r["item_shingles"], r["shared"]) for r in got} == brute(docs, items)
    assert len(got) == len(brute(docs, items)) > 20
    rest = decontaminate.decontaminate(given, tests)
    held = {d for d, _ in brute(docs, items)}
    assert rest.columns == given.columns
    assert sorted(rest.select("doc_id").collect(), key=repr) == sorted([(d,) for d, _ in docs if d not in held], key=repr)


def test_shuffled_join_gives_the_same(spark, tables, monkeypatch):
    docs, items = tables
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    got = decontaminate.contaminations(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == set(brute(docs, items))


def test_empty_tables(spark, tables):
    docs = documents(spark, tables[0])
    items = spark.createDataFrame(tables[1], "item_id long, text string")
    assert decontaminate.contaminations(docs.limit(0), items).count() == 0
    assert decontaminate.decontaminate(docs, items.limit(0)).count() == len(tables[0])

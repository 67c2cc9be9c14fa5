import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import jaccard_join
from millrace.llm.graph import components, with_least
from millrace.workspace import cut_lineage
from tests.llm.helpers import documents, prose, shingles


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows):
    sets = {i: frozenset(shingles(t)) for i, t in rows if i is not None}
    first = {}
    for i in sorted(sets):
        first.setdefault(sets[i], i)
    reps = {i: s for s, i in first.items()}
    links = [
        (a, b) for a in reps for b in reps
        if a < b and reps[a] and reps[b] and len(reps[a] & reps[b]) >= 0.8 * len(reps[a] | reps[b])
    ]
    root = roots(reps, links)
    degree = {i: sum(i in p for p in links) for i in reps}
    return {i: (root[first[s]], first[s], degree[first[s]]) for i, s in sets.items()}


@pytest.fixture(scope="module")
def rows():
    draw, out = random.Random(9), []
    for group in range(12):
        base = prose(group, draw.choice([4, 30, 120, 400])).split()
        for _ in range(draw.choice([1, 2, 6, 25])):
            text = list(base)
            for _ in range(draw.randrange(4)):
                text[draw.randrange(len(text))] = f"new{draw.randrange(10**6)}"
            out.append((len(out), " ".join(text)))
    out += [(900, None), (901, ""), (902, " \n"), (903, out[0][1]), (904, out[5][1].upper()), (3, out[3][1]), (905, prose(77, 9000))]
    return out


@pytest.mark.parametrize("block", [1024, 3])
def test_against_brute_force(spark, rows, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)  # small blocks cut the groups into many tasks
    given = documents(spark, rows).withColumn("class_id", F.lit("x")).withColumn("_node", F.lit(0))
    got = jaccard_join.similar_documents(given).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    assert {r["doc_id"]: (r["class_id"], r["copy_of"], r["n_links"]) for r in got} == want
    assert sum(w[2] for w in want.values()) > 100


def test_links_count_once_where_blocks_are_empty(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 300)  # 16 blocks for 12 near copies: some hold two, some none
    base = prose(5, 400).split()
    near = [(k, " ".join([*base[:-1], f"new{k}"])) for k in range(12)]
    got = jaccard_join.similar_documents(documents(spark, near)).collect()
    assert {r["doc_id"]: (r["class_id"], r["copy_of"], r["n_links"]) for r in got} == brute(near)


def test_one_of_each_class_stays(spark, rows):
    given = documents(spark, rows + [(None, "no id here at all")])
    kept = jaccard_join.drop_similar(given)
    assert kept.columns == given.columns
    want = {w[0] for w in brute(rows).values()}
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([*want, None], key=repr)
    assert jaccard_join.similar_documents(given.limit(0)).count() == 0


def test_pruning_keeps_what_may_reach_the_threshold():
    draw = np.random.default_rng(1)
    least = jaccard_join.least_matches(0.8, jaccard_join.TOLERANCE)
    steps = draw.random((100_000, len(least), jaccard_join.STEP)) < 0.8
    matches = steps.sum(2).cumsum(1)
    assert (matches >= np.array(least)).all()  # pairs at the threshold itself
    far = (draw.random((1000, len(least), jaccard_join.STEP)) < 0.4).sum(2).cumsum(1)
    assert (far < np.array(least)).any(1).mean() > 0.999


def test_long_sets_in_pieces():
    hashes = np.unique(np.random.default_rng(2).integers(0, 2**63, 20_000).astype(np.uint64))
    whole = jaccard_join.signatures([hashes[:3], hashes])[1]
    a, b = jaccard_join.permutations()
    assert (whole == (a * (hashes >> np.uint64(32)).astype(np.uint32) + b).min(1)).all()


def test_both_ways_to_verify_agree():
    draw = np.random.default_rng(3)
    sets = [np.unique(draw.integers(0, 300, 200).astype(np.uint64)) for _ in range(40)]
    i, j = np.triu_indices(40, 1)
    many = jaccard_join.verified(sets, i, j, 0.3)
    few = np.concatenate([jaccard_join.verified(sets, i[k : k + 50], j[k : k + 50], 0.3) for k in range(0, len(i), 50)])
    assert (many == few).all() and 0 < many.sum() < len(many)


def test_components(spark):
    draw = random.Random(4)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 100), (200, 201), (None, 3), (201, 200)]
    edges += [(300 + draw.randrange(50), 300 + draw.randrange(50)) for _ in range(30)] + [(500, 500 + k) for k in range(1, 40)]
    draw.shuffle(edges)
    real = [(a, b) for a, b in edges if a is not None and a != b]
    given = spark.createDataFrame(edges, "a long, b long")
    want = roots({n for e in real for n in e}, real)
    for hub in (100_000, 10, 1):  # no hubs, some, hubs only
        assert {r["node"]: r["component"] for r in components(given, hub=hub).collect()} == want


def test_rows_of_a_hub_do_not_meet_in_one_task(spark):
    star = spark.range(1, 40_000).selectExpr("0L AS u", "id AS v").unionByName(spark.range(40_001, 40_100).selectExpr("id AS u", "id + 500 AS v"))
    star = cut_lineage(star.repartition(8))
    least = cut_lineage(star.groupBy("u").agg(F.count("*").alias("n"), F.min("v").alias("m")))
    sizes = with_least(star, least, 1000).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 40_098 and max(r["count"] for r in sizes) < 15_000

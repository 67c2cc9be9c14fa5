import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import check
from millrace.llm import prefix_trie, queries
from tests.conftest import SMALL

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(conversations):
    """Node rows of {conversation: [(role, text), ...]}."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in sorted(conversations.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)

    def below(path):
        return [path] + [x for child in children[path] for x in below(child)]

    out = []
    for path, ids in members.items():
        tree = below(path)
        out.append((
            ids[0], len(path), members[path[:-1]][0] if path else None, len(ids), len(children[path]),
            sum(not children[x] for x in tree), sum((len(members[x]) - 1) * len(x[-1][1]) for x in tree if x),
            hashlib.sha256(",".join(map(str, ends[path])).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def table(spark, conversations):
    rows = [(c, n, *t) for c, turns in conversations.items() for n, t in enumerate(turns)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def drawn(seed, n, deepest=6, texts=3):
    draw = random.Random(seed)
    return {
        c: [(draw.choice(["user", "assistant"]), "t" * draw.randrange(texts)) for _ in range(draw.randrange(1, deepest))]
        for c in draw.sample(range(-50, 10 * n), n)
    }


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    given = drawn(seed, [3, 60, 400][seed])
    assert rows_of(prefix_trie.conversation_trie(prefix_trie.sequences(table(spark, given)))) == brute(given)


def test_shards_and_spills_lose_nothing():
    """Any cut into shards, with a queue that holds two messages."""
    given = drawn(7, 150)
    paths = defaultdict(list)
    for c, turns in given.items():
        paths[tuple(turns)].append(c)
    sorted_paths = [
        ([{"digest": hashlib.sha256(repr(t).encode()).digest()[:16], "length": len(t[1])} for t in turns], min(ids), len(ids),
         hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest())
        for turns, ids in paths.items()
    ]
    sorted_paths.sort(key=lambda p: [t["digest"] for t in p[0]])
    for n_shards in (1, 2, 7, len(sorted_paths)):
        for limit in (2, 10**6):
            found = []
            for k in range(n_shards):
                a, b = (len(sorted_paths) * x // n_shards for x in (k, k + 1))
                nodes = [dict(zip(prefix_trie.NODES.names, n)) for n in prefix_trie.nodes_of_shard(sorted_paths[a:b])]
                nodes.sort(key=lambda n: (-n["depth"], n["place"]))
                found += prefix_trie.forward(nodes, limit)
            names = prefix_trie.RESULT.names
            rows = [dict(zip(names, r)) for r in found]
            merged = {}
            for r in (r for r in rows if r["id"] is not None):
                m = merged.setdefault(r["id"], {
                    "depth": r["depth"], "place": r["id"], "up": r["up_id"], "id": r["id"], "up_id": r["up_id"], "length": r["length"],
                    "conv_id": None, "n_convs": 0, "n_children": 0, "n_leaves": 0, "saved_tokens": 0, "ends_sha256": None, "open": False,
                })
                m["conv_id"] = min((x for x in (m["conv_id"], r["conv_id"]) if x is not None), default=None)
                m["ends_sha256"] = m["ends_sha256"] or r["ends_sha256"]
                for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                    m[c] += r[c]
            top = sorted(merged.values(), key=lambda n: (-n["depth"], n["place"]))
            joined = [dict(zip(names, r)) for r in prefix_trie.forward(top, limit, with_ids=True)]
            conv = {r["id"]: r["conv_id"] for r in joined}
            closed = [r | ({"parent_conv_id": conv[r["up_id"]]} if r["up_id"] is not None else {}) for r in rows if r["id"] is None]
            assert sorted((tuple(r[c] for c in COLUMNS) for r in closed + joined), key=repr) == brute(given)


def test_spilling_queue():
    draw, queue, given = random.Random(1), prefix_trie.SpillingQueue(3), []
    for k in range(200):
        given.append((draw.randrange(9), draw.randrange(5), k))
        queue.push(*given[-1])
    for key in range(9):
        assert list(queue.pop(key)) == [v for _, _, v in sorted(g for g in given if g[0] == key)]
    assert not queue.held and not queue.runs


def test_odd_rows(spark):
    rows = [
        (1, None, "user", "first"), (1, 0, None, None), (1, 0, None, None), (2, 5, "b", "y"), (2, 5, "a", "z"), (3, 1, "", ""),
        (None, 1, "user", "no one"), (4, -1, "user", "x" * 5000), (5, 1, "1:", "23"), (6, 1, "1:2", "3"),
    ]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("place", F.lit(1))
    given = given.withColumn("conversation", F.lit("x")).withColumn("digest", F.lit(1))
    want = {
        1: [("user", "first"), ("", ""), ("", "")], 2: [("a", "z"), ("b", "y")], 3: [("", "")], 4: [("user", "x" * 5000)],
        5: [("1:", "23")], 6: [("1:2", "3")],
    }
    paths = prefix_trie.sequences(given)
    assert rows_of(prefix_trie.conversation_trie(paths)) == brute(want)
    assert prefix_trie.conversation_trie(paths.limit(0)).count() == 0
    turnless = paths.limit(1).select(F.lit(9).cast("long").alias("conversation"), F.slice("turns", 1, 0).alias("turns"))
    assert rows_of(prefix_trie.conversation_trie(turnless)) == brute({9: []})
    assert rows_of(prefix_trie.conversation_trie(paths.unionByName(turnless))) == brute(want | {9: []})


def test_query_against_sql(spark, tmp_path):
    connection = check.connect(SMALL)
    assert check.compare(queries.op12_prefix_trie(spark, SMALL), connection, queries.ORACLES["op12_prefix_trie"]) == ""
    # Absent and short first conversations of a hundred, turnless results, nulls.
    rows = [(c, t, "user" if t else None, f"text {c % 3} {t}" if t < 4 else None) for c in (0, 1, 2, 103, 104, 105, 200, 201, 202, 203, 250, 307) for t in range(c % 4 + 1)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    connection.sql(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert check.compare(queries.op12_prefix_trie(spark, str(tmp_path)), connection, queries.ORACLES["op12_prefix_trie"]) == ""

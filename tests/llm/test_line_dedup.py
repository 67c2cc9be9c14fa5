import random
from collections import defaultdict

from pyspark.sql import functions as F

from millrace.llm import line_dedup
from tests.llm.helpers import documents, prose


def brute(rows, min_sites, min_words):
    sites, first = defaultdict(set), {}
    place = lambda r: (r[0] is not None, r[0] or 0)
    for r in sorted(rows, key=place):
        for pos, line in enumerate((r[1] or "").split("\n")):
            key = line.strip("\t\n\x0b\x0c\r ")
            if len(key.split()) >= min_words:
                if r[2] is not None:
                    sites[key].add(r[2])
                first.setdefault(key, (r[0], r[1], pos))
    out = []
    for r in rows:
        kept = [
            line for pos, line in enumerate((r[1] or "").split("\n"))
            if len(sites.get(line.strip("\t\n\x0b\x0c\r "), ())) < min_sites or first[line.strip("\t\n\x0b\x0c\r ")] == (r[0], r[1], pos)
        ]
        out.append((r[0], None if r[1] is None else "\n".join(kept)))
    return out


def test_against_brute_force(spark):
    rows = []
    for i in range(120):
        lines = [f"only in text {i}", "Ti."]
        for k in range(3, 25):
            if i < 2 * k:
                lines.append(f"  line for {k} sites ")
        rows.append((i, "\n".join(lines), f"site{(i // 2) % 30}"))
    rows += [(None, "line for 24 sites\nx", None), (500, None, "a"), (501, "", "b"), (502, "line for 24 sites", "c"), (502, "line for 24 sites", "c")]
    rows += [(503, "\n" * 50, "d"), (504, "line for 24 sites\nline for 24 sites", "e")]
    given = documents(spark, rows).withColumn("n_removed", F.lit("x")).withColumn("_line", F.lit(1))
    out = line_dedup.remove_boilerplate(given)
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)
    assert got == sorted(brute(rows, 10, 3), key=repr)
    assert line_dedup.remove_boilerplate(given.limit(0)).count() == 0


def test_near_threshold_lines_are_counted_exactly(spark):
    rows = [(i, "nine sites have this" if i < 9 else "other words stand here", f"s{i}") for i in range(12)]
    rows += [(20 + i, "ten sites have this", f"t{i}") for i in range(10)]
    out = {r["doc_id"]: r["n_removed"] for r in line_dedup.remove_boilerplate(documents(spark, rows)).collect()}
    assert [out[i] for i in range(12)] == [0] * 12
    assert [out[20 + i] for i in range(10)] == [0] + [1] * 9


def test_long_passages_need_fewer_sites(spark):
    draw, rows = random.Random(6), []
    for p in range(30):  # copies of long passages; the hot site holds a third of all rows
        for _ in range(draw.choice([4, 8, 20])):
            site = "hot" if draw.random() < 1 / 3 else f"s{draw.randrange(19)}"
            rows.append((len(rows), f"own text {len(rows)} here\n{prose(p, 60, 10**6)}", site))
    for k, n in ((9, 10), (10, 9), (30, 10), (30, 7), (30, 6), (60, 2)):  # sites a line of k words stands on: n
        rows += [(len(rows) + i, f"edge {k} {n} {prose(k * 100 + n, k - 3)}", f"s{i}") for i in range(n)]
    sites = defaultdict(set)
    for _, t, s in rows:
        sites[t.split("\n")[-1]].add(s)
    need = lambda line: max(3, min(10, 10 - (len(line.split()) - 10) * 7 // 40))
    want, seen = {}, set()
    for i, t, _ in rows:
        line = t.split("\n")[-1]
        want[i] = int(line in seen and len(sites[line]) >= need(line))
        seen.add(line)
    got = line_dedup.remove_boilerplate(documents(spark, rows), by_length=True)
    assert {r["doc_id"]: r["n_removed"] for r in got.collect()} == want
    fixed = line_dedup.remove_boilerplate(documents(spark, rows))
    assert fixed.agg(F.sum("n_removed")).first()[0] < sum(want.values())


def test_short_lines_need_more_sites(spark):
    rows = [(i, f"own text {i}\n\n{'Les.' if i < 20 else 'Nur.'}\n{'And ornd.' if i else ''}", f"s{i}") for i in range(39)]
    got = {r["doc_id"]: r["text"].split("\n") for r in line_dedup.remove_boilerplate(documents(spark, rows), by_length=True).collect()}
    # 'Les.' stands on 20 sites, 'Nur.' on 19, 'And ornd.' on 38; empty lines stay.
    assert got[0] == ["own text 0", "", "Les.", ""] and got[1] == ["own text 1", "", "And ornd."]
    assert all(got[i] == [f"own text {i}", ""] for i in range(2, 20))
    assert all(got[i] == [f"own text {i}", "", "Nur."] for i in range(20, 39))


def test_pipeline_uses_the_falling_threshold(spark):
    import corpus_pipeline

    rows = [(i, f"own text {i}\n{prose(1, 60)}", f"s{i}") for i in range(3)]
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_lines(spark, documents(spark, rows), "").collect()}
    assert [len(left[i].split("\n")) for i in range(3)] == [2, 1, 1]


def test_texts_are_not_split_again_for_the_result(spark):
    lines = [f"one two three number {i}" for i in range(3)]
    df = documents(spark, [(i, "\n".join(lines), f"site {i}") for i in range(12)])
    result = line_dedup.remove_boilerplate(df)
    assert "posexplode" not in result._jdf.queryExecution().optimizedPlan().toString()
    assert [r.n_removed for r in result.orderBy("doc_id").collect()] == [0] + [3] * 11

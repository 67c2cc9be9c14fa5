import re
import hashlib

from pyspark.sql import functions as F

from millrace.llm import pii, queries
from tests.conftest import SMALL
from tests.llm.helpers import ODD_TEXTS, documents

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    twice = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in twice) % 10 == 0


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, p in BASE.items() for m in re.finditer(p, text or "") if passes(k, m[0])]


TEXTS = ODD_TEXTS + [
    "mail a.b+c@x-y.co.uk, é@b.c x@y.z%w@q.r @a.b a@@b.c a@b c@d.e.@f.g", "1.2.3.4.5.6.7.8 256.1.1.1 0255.0.0.1 1.2.3 999.1.1.1.1",
    "4111 1111-1111 1111, 4111111111111112 41111111111111111111 1 2 3 5", "+1 (017) 555-7713 +49--- +4 +44 20 7946 0958. +1234567890123456 ++15551234567",
    "😀 4111111111111111 ü a@b.c", "9" * 3000 + " " + "a" * 30000 + "@", "1 " * 5000, "1." * 4000, "a." * 4000 + "@" + "b." * 4000 + "c", "+1" + " " * 5000 + "x",
    "4111111111111111 4111111111111111", "٣.٣.٣.٣ 1.1.1.1",
]


def base_of(row):
    return [(s["kind"], s["start"], s["end"]) for s in row["found"] if s["kind"] != "id"]


def test_base_spans_against_brute_force(spark):
    rows = list(enumerate(TEXTS)) + [(None, TEXTS[-2]), (0, "a@b.c"), (0, "a@b.c")]
    given = documents(spark, rows).withColumn("found", F.lit(1)).withColumn("_text", F.lit("a@b.c")).withColumn("start", F.lit(0))
    got = pii.find_personal_data(given, spans="found").collect()
    assert len(got) == len(rows)
    assert all(base_of(r) == brute(r["text"]) for r in got)
    assert pii.find_personal_data(given.limit(0), spans="found").count() == 0


def test_context_finds_unseen_identifiers(spark):
    seeds = [f"please pay by card number 4{k:02d}{'0' * 11}" for k in range(40)]
    seeds = [t + next(c for c in "0123456789" if luhn(re.sub("[^0-9]", "", t) + c)) + " before friday" for t in seeds]
    other = ["please pay by card number AB-4411-9902 before friday", "the year was 20240131 long", "number 123456"]
    rows = documents(spark, list(enumerate(seeds + other)))
    got = {r["doc_id"]: [(r["text"][s["start"] : s["end"]], s["kind"]) for s in r["found"] if s["kind"] == "id"]
           for r in pii.find_personal_data(rows, spans="found").collect()}
    assert got[40] == [("AB-4411-9902", "id")]
    # One pattern is enough once its other instances are trusted; the year has no such pattern.
    assert got[42] == [("123456", "id")]
    assert all(not v for k, v in got.items() if k not in (40, 42))


def ids(spark, texts):
    rows = documents(spark, list(enumerate(texts)))
    return {r["doc_id"]: [r["text"][s["start"] : s["end"]] for s in r["found"] if s["kind"] == "id"]
            for r in pii.find_personal_data(rows, spans="found").collect()}


def test_patterns_stand_beside_whole_seeds(spark):
    seeds = [f"do call +1 (017) 555-{7700 + k} today" for k in range(40)]
    seeds += [f"my host 10.0.{k}.1, answers" for k in range(40)]
    unseen = ["do call 55-12 today", "do call (017)  55 1234. today", "my host 10.0.777.1, answers", "has 55 apples", "7 55-13 8"]
    got = ids(spark, seeds + unseen)
    assert [got[80 + k] for k in range(5)] == [["55-12"], ["(017)  55 1234"], ["10.0.777.1"], [], []]
    assert not any(got[k] for k in range(80))


def test_found_instances_support_new_patterns(spark):
    texts = [f"then ring +1 017 555 {1000 + k} please" for k in range(200)]
    texts += [f"then ring X-{k} and fax X-{k} urgently" for k in range(20)] + ["so fax Y-77 urgently", "so take Y-78 urgently"]
    got = ids(spark, texts)
    assert got[220] == ["Y-77"] and got[221] == [] and got[200] == ["X-0", "X-0"]


def test_credentials(spark):
    texts = [f'my words token = "{k:08x}{"ab" * 12}" more' for k in range(30)]
    texts += [
        "password: 'hunter22' x", 'API_KEY="sk-1234567890" and secret = "only letters here" secret="onlyletters"', 'token = "short1"',
        'id token = "ü1234567" é', "my token = 0123456789abcdef0123 bare", 'a token of love, "quoted 1234567"', 'words = "0123abcd0123abcd0123" here',
    ]
    got = ids(spark, texts)
    assert all(got[k] == [f"{k:08x}{'ab' * 12}"] for k in range(30))
    # The quotes are not part of it; what the seeds' words stand beside is found though it is short or has no quotes.
    assert [got[30 + k] for k in range(4)] == [["hunter22"], ["sk-1234567890"], ["short1"], ["ü1234567"]]
    assert got[34] == ["0123456789abcdef0123"] and got[35] == []


def test_planted_tokens_of_the_given_table(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    planted = {r["doc_id"]: re.findall(r'token = "([0-9a-f]{40})"', r["text"]) for r in rows.collect()}
    found = {r["doc_id"]: r for r in pii.find_personal_data(rows).collect()}
    for i, secrets in planted.items():
        ids_of = [found[i]["text"][s["start"] : s["end"]] for s in found[i]["spans"] if s["kind"] == "id"]
        assert ids_of == secrets  # all of them, and nothing else


def test_query_against_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = queries.op8_pii(spark, SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        spans = brute(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in BASE] == [sum(s[0] == k for s in spans) for k in BASE]
        shown = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r["base_sha256"] == hashlib.sha256(shown.encode()).hexdigest() and r["spans"].startswith(shown)

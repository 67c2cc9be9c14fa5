import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.llm import align, queries
from tests.conftest import SMALL
from tests.llm.helpers import ODD_TEXTS, documents, prose

FIELDS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def files():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    vocabulary, model = files()
    a = Tokenizer.from_file(vocabulary)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=model)


def letters():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def tokens(libraries, text):
    """(id, bytes) of both encodings; none where they do not join to the text."""
    if not text:
        return [], []
    a, b = libraries
    back = letters()
    left = [(i, bytes(back[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (left, right) if b"".join(x for _, x in left) == whole == b"".join(x for _, x in right) else ([], [])


def ends(ids):
    at, out = 0, []
    for _, x in ids:
        at += len(x)
        out.append(at)
    return out


def brute(libraries, texts):
    grouped = []
    for text in texts:
        left, right = tokens(libraries, text)
        common = sorted(set(ends(left)) & set(ends(right)))
        groups, before = [], 0
        for end in common:
            groups.append((
                [i for (i, _), e in zip(left, ends(left)) if before < e <= end],
                [i for (i, _), e in zip(right, ends(right)) if before < e <= end],
            ))
            before = end
        grouped.append((len(left), len(right), groups))
    held = Counter()
    for _, _, groups in grouped:
        held.update({(x, y) for a, b in groups for x in a for y in b})
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for n_a, n_b, groups in grouped:
        links = [(x, y) for a, b in groups for x in a for y in b]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((
            n_a, n_b, len(groups), len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return out


TEXTS = [t for t in ODD_TEXTS if len(t or "") < 6000] + [
    "Ein Satz, über Straßen und Flüsse.", "l'été déjà vu: ça va", "<|endoftext|> and <s> </s> <0x41>", "a ▁ b", "▁", "١٢٣ ٠", "ﬁ ½ ²",
    "tabs\t\tand   spaces  \n\n  end ", "한국어 텍스트", "é ​‍", "1234567890 3.14 0x1f", prose(3, 300), prose(4, 300), prose(3, 300),
]


def rows_of(df):
    return [tuple(r[f] for f in FIELDS) for r in df.collect()]


def test_against_brute_force(spark, libraries, monkeypatch):
    given = documents(spark, list(enumerate(TEXTS))).repartition(5)
    out = align.align_tokens(given, *files()).select("doc_id", "alignment.*")
    got = {r["doc_id"]: r for r in out.collect()}
    want = brute(libraries, TEXTS)
    assert len(got) == len(TEXTS)
    for i, expected in enumerate(want):
        assert tuple(got[i][f] for f in FIELDS) == expected, TEXTS[i]
        assert sum(x["links"] for x in got[i]["links"]) == expected[3]
    assert want[TEXTS.index("a ▁ b")] == (0, 0, 0, 0, 0, 0, "")


def test_wide_groups_and_slices(libraries, monkeypatch):
    monkeypatch.setattr(align, "WIDE", 1)
    vocabulary, model = files()
    known = align.Tokenizers(open(vocabulary, encoding="utf-8").read(), open(model, "rb").read())
    texts = [t or "" for t in TEXTS]
    found, want = align.Aligned(known, texts), brute(libraries, texts)
    assert found.n_links.tolist() == [w[3] for w in want] and found.digests == [w[6] for w in want]
    links = Counter()
    for r in found.pairs.to_pylist():
        links[r["document"]] += r["links_sum"]
    assert [links[i] for i in range(len(texts))] == [w[3] for w in want]
    assert list(align.cuts(align.np.array([5, 1, 1, 9, 1]), 6)) == [(0, 2), (2, 2), (4, 1)]


def test_both_libraries_encode_alike(libraries):
    vocabulary, model = files()
    known = align.Tokenizers(open(vocabulary, encoding="utf-8").read(), open(model, "rb").read())
    assert known.fast is not None
    texts = [" " + "".join(map(chr, range(k, k + 40))) for k in range(1, 0x600, 13)] + [f"a{chr(c)} {chr(c)}b {chr(c)}{chr(c)}1" for c in range(1, 0x558)]
    texts += ["x" * 20_000, " " * 3000 + "\n" * 30, "<|endoftext|>", "it's we'LL I'd 'tis"]
    assert known.encode_a(texts) == [libraries[0].encode(t, add_special_tokens=False).ids for t in texts]
    known.fast = None
    assert known.encode_a(texts[:9]) == [libraries[0].encode(t, add_special_tokens=False).ids for t in texts[:9]]


def test_odd_rows(spark):
    rows = [(1, "same text"), (1, "same text"), (None, "same text"), (2, None), (3, "")]
    given = documents(spark, rows).withColumn("code", F.lit(1)).withColumn("chunk", F.lit("x")).withColumn("codes", F.array(F.lit(1)))
    out = align.align_tokens(given, *files())
    assert out.columns == [c for c in given.columns if c != "text"] + ["alignment"]
    got = {(r["doc_id"], r["chunk"], r["codes"][0]): r["alignment"] for r in out.collect()}
    assert got[1, "x", 1]["count_sum"] == 3 * got[1, "x", 1]["n_links"] == 3 * got[1, "x", 1]["n_best"] > 0
    assert out.count() == 5 and got[2, "x", 1]["groups_sha256"] == "" and got[3, "x", 1]["links"] == []
    assert align.align_tokens(given.limit(0), *files()).count() == 0
    with pytest.raises(ValueError):
        align.align_tokens(given, *files(), alignment="LANG")


def test_query_against_brute_force(spark, libraries):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    small = [r["text"] for r in rows]
    want = dict(zip((r["doc_id"] for r in rows), brute(libraries, small)))
    got = queries.op13_align(spark, SMALL).collect()
    assert {r["doc_id"]: tuple(r[f] for f in FIELDS) for r in got} == want

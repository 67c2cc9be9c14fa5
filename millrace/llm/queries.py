"""The registered queries of the training-data operators and the SQL of those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import (
    align, bpe, chat_format, decontaminate, jaccard_join, line_dedup, lm_score, pii, prefix_trie, quality_mil, repetition,
    suffix_dedup, url_filter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql.strip()
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary() -> str:
    """Path of the vocabulary: the environment's MILLRACE_VOCABULARY, else the installed public one."""
    if path := os.environ.get("MILLRACE_VOCABULARY"):
        return path
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def sha256(text):
    return F.sha2(F.encode(text, "UTF-8"), 256)


@query()
def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every whole text encoded and decoded."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.encode_and_decode(documents, vocabulary()).select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        sha256(F.array_join("token_ids", ",")).alias("ids_sha256"),
        sha256(F.col("decoded_text")).alias("decoded_sha256"),
    )


# Escaping adds one character to each control string.
@query(r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
), sized AS (
  SELECT *,
    length(regexp_replace(text, '(<\||<</?|</?|\[/?)(\\*)(im_start\|>|im_end\|>|s>|SYS>>|INST\])', '\1\2\\\3', 'g')) AS escaped
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(24 + length(role) + escaped) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
""")
def op5_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations formatted, and what the parser reads back from them."""
    odd = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame(
        [(-7, 0, "user", odd), (-7, 1, "assistant", odd)], "conv_id long, turn long, role string, text string"
    )
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    formatted = chat_format.format_conversations(given)
    masked = F.transform("loss_spans", lambda s: chat_format.unescape(
        F.substring("formatted", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
    ))
    # What does not come back as it was has no loss text, which no row of the SQL equals.
    loss = F.when(F.col("round_trip"), F.array_join(masked, ""))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return formatted.select(
        "conv_id", "n_turns", sha256(whole).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), sha256(loss).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


URL_RULES = [
    ("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"),
]


@query()
def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's url judged by the rules, else by the model."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "block_score")


# Lines that stand on as many sites as they need, first occurrences aside; lines of one or two words have needs of their own.
LINE_SQL = r"""
WITH given AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents
), lines AS (
  SELECT d.doc_id, d.source, u.pos, trim(g.parts[u.pos], e'\t\n\x0b\x0c\r ') AS line
  FROM given g JOIN documents d USING (doc_id), unnest(range(1, len(g.parts) + 1)) AS u(pos)
), counted AS (
  SELECT *, len(regexp_split_to_array(line, '[\x20\x09-\x0D]+')) AS words FROM lines WHERE line <> ''
), boilerplate AS (
  SELECT line FROM counted GROUP BY line HAVING count(DISTINCT source) >= {needed}
), lost AS (
  SELECT doc_id, pos FROM (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) AS nth
    FROM counted JOIN boilerplate USING (line)
  ) WHERE nth > 1
)
SELECT l.doc_id, count(o.pos) AS n_removed,
  sha256(coalesce(string_agg(g.parts[l.pos], chr(10) ORDER BY l.pos) FILTER (o.pos IS NULL), '')) AS text_sha256
FROM lines l JOIN given g USING (doc_id) LEFT JOIN lost o ON o.doc_id = l.doc_id AND o.pos = l.pos
GROUP BY l.doc_id
"""


@query(LINE_SQL.replace("{needed}", "10 AND any_value(words) >= 3"))
def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the lines that stand on ten or more sites, first occurrences aside."""
    documents = table(spark, folder, "documents").select("doc_id", "source", "text")
    return line_dedup.remove_boilerplate(documents).select(
        "doc_id", "n_removed", sha256(F.coalesce("text", F.lit(""))).alias("text_sha256")
    )


@query(LINE_SQL.replace(
    "{needed}",
    "CASE WHEN any_value(words) < 3 THEN 20 ELSE greatest(3, least(10, 10 - floor((any_value(words) - 10) * 7 / 40))) END",
))
def op2_line_dedup_by_length(spark: SparkSession, folder: str) -> DataFrame:
    """The same with a number of sites that falls with a line's length, as the pipeline has it."""
    documents = table(spark, folder, "documents").select("doc_id", "source", "text")
    return line_dedup.remove_boilerplate(documents, by_length=True).select(
        "doc_id", "n_removed", sha256(F.coalesce("text", F.lit(""))).alias("text_sha256")
    )


@query(r"""
WITH words AS (
  SELECT 'd' AS kind, doc_id AS id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL
  SELECT 'i', item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark
), split AS (
  SELECT kind, id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM words
), shingles AS (
  SELECT DISTINCT kind, id, array_to_string(w[s.i : s.i + 4], ' ') AS shingle
  FROM split, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS s(i) WHERE len(w) > 0
), sized AS (
  SELECT id, count(*) AS item_shingles FROM shingles WHERE kind = 'i' GROUP BY id
)
SELECT * FROM (
  SELECT d.id AS doc_id, i.id AS item_id, z.item_shingles, count(*) AS shared, count(*) / z.item_shingles AS containment
  FROM shingles i JOIN shingles d USING (shingle) JOIN sized z ON z.id = i.id
  WHERE i.kind = 'i' AND d.kind = 'd'
  GROUP BY d.id, i.id, z.item_shingles
) WHERE containment >= 0.8
""")
def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """All pairs of a document and a test item it holds."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.contaminations(documents, table(spark, folder, "benchmark"))


@query(r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[s.i : s.i + 4], ' ') AS shingle
  FROM split, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS s(i) WHERE len(w) > 0
), sets AS (
  SELECT doc_id, count(shingle) AS n, coalesce(md5(string_agg(shingle, chr(10) ORDER BY shingle)), '') AS digest
  FROM documents LEFT JOIN shingles USING (doc_id) GROUP BY doc_id
), classed AS (
  SELECT *, min(doc_id) OVER (PARTITION BY digest) AS copy_of FROM sets
), rep AS (
  SELECT doc_id, n, shingle FROM classed JOIN shingles USING (doc_id) WHERE doc_id = copy_of
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM rep a JOIN rep b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*)) - 1e-9
), reached(x, y) AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x
), lowest AS (
  SELECT x, min(y) AS y FROM reached GROUP BY x
), counted AS (
  SELECT x, count(*) AS n_links FROM links GROUP BY x
)
SELECT c.doc_id, least(coalesce(m.y, c.copy_of), c.copy_of) AS class_id, c.copy_of, coalesce(k.n_links, 0) AS n_links
FROM classed c LEFT JOIN lowest m ON m.x = c.copy_of LEFT JOIN counted k ON k.x = c.copy_of
""")
def op6_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Each document with its class of near copies and its number of links."""
    return jaccard_join.similar_documents(table(spark, folder, "documents").select("doc_id", "text"))


def fold(doc_id: str, parts: int):
    """The fold of a document: crc32 of its id as text, modulo ``parts``."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts


@query()
def op9_quality_mil(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's quality score, learned from the labels of two folds of three."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").where(fold("doc_id", 3) != 1)
    scored = quality_mil.score_quality(documents, labels)
    return scored.select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.5).cast("int").alias("predicted"),
    )


@query()
def op10_repetition(spark: SparkSession, folder: str) -> DataFrame:
    """The quality rules' measures and verdict for every document."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return repetition.judge_repetition(documents).select(
        "doc_id",
        *[f"repetition.{c}" for c in (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
            "covered_words", "longest_repeat",
        )],
    )


@query()
def op3_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's log10 probability, learned from nine folds of ten."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    scored = lm_score.score_documents(documents, fold("doc_id", 10) != 0)
    return scored.select(
        "doc_id", (fold("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query()
def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's personal data: counts of the base kinds and all spans."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    # The text goes no further than the scan: what the result needs is the id and the spans.
    found = pii.find_personal_data(documents, spans="found")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("found", lambda s: s["kind"] != pii.ADDED_KIND)
    return found.select(
        "doc_id",
        *[number(k) for k in pii.KINDS],
        sha256(joined(base)).alias("base_sha256"), joined(F.col("found")).alias("spans"),
    )


@query()
def op11_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What each document keeps without the 50-byte strings that start in earlier documents."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    removed = F.col("removed_spans")
    return suffix_dedup.remove_repeats(documents).select(
        "doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        F.aggregate(removed, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed"),
        F.size(removed).cast("long").alias("n_spans"), F.sha2(F.col("kept_bytes"), 256).alias("kept_sha256"),
    )


@query()
def op13_align(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's tokens under two vocabularies, aligned by bytes and counted over the corpus."""
    import public_tokenizers

    documents = table(spark, folder, "documents").select("doc_id", "text")
    aligned = align.align_tokens(documents, vocabulary(), public_tokenizers.path("piece_bpe_32k.model"))
    fields = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return aligned.select("doc_id", *[f"alignment.{f}" for f in fields])


# h, the turns taken from the first conversation of a hundred, needs CRC-32: its table by eight shifts, then one step a digit.
@query(r"""
WITH RECURSIVE shifts(i, k, v) AS (
  SELECT i, 0, i FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM shifts WHERE k < 8
), crc AS (
  SELECT list(v ORDER BY i) AS steps FROM shifts WHERE k = 8
), own AS (
  SELECT conv_id AS c, list(len(role) || ':' || role || text ORDER BY turn NULLS FIRST, role, text) AS turns,
    list(len(text) ORDER BY turn NULLS FIRST, role, text) AS sizes
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations)
  WHERE conv_id IS NOT NULL GROUP BY conv_id
), headed AS (
  SELECT o.*, coalesce(b.turns, []) AS base, coalesce(b.sizes, []) AS base_sizes,
    xor(list_reduce(
      list_prepend(4294967295, list_transform(string_split(CAST(o.c AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
      lambda a, b: xor(a >> 8, steps[(xor(a, b) & 255) + 1])
    ), 4294967295) % 6 AS h
  FROM own o CROSS JOIN crc LEFT JOIN own b ON b.c = o.c - o.c % 100
), rebuilt AS (
  SELECT c, base[1:h] || turns[h + 1:] AS turns, base_sizes[1:h] || sizes[h + 1:] AS sizes FROM headed
), nodes AS (
  SELECT d.d, turns[1:d.d] AS path, min(c) AS conv_id, count(*) AS n_convs, any_value(CASE WHEN d.d > 0 THEN sizes[d.d] ELSE 0 END) AS size,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(turns) = d.d), '')) AS ends_sha256
  FROM rebuilt, unnest(range(0, len(turns) + 1)) AS d(d) GROUP BY d.d, turns[1:d.d]
), children AS (
  SELECT path[1:d - 1] AS path, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY path[1:d - 1], d - 1
), counted AS (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN children k ON k.d = n.d AND k.path = n.path
), totals AS (
  SELECT u.u AS d, path[1:u.u] AS path, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * size) AS saved
  FROM counted, unnest(range(0, d + 1)) AS u(u) GROUP BY u.u, path[1:u.u]
)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, CAST(t.n_leaves AS BIGINT) AS n_leaves,
  CAST(t.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM counted n JOIN totals t ON t.d = n.d AND t.path = n.path
LEFT JOIN nodes p ON p.d = n.d - 1 AND p.path = n.path[1:n.d - 1]
""")
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The trie of all conversations, each rebuilt on the first turns of the first one of its hundred."""
    own = prefix_trie.sequences(table(spark, folder, "conversations").select("conv_id", "turn", "role", "text"))
    bases = own.where(F.col("conversation") % 100 == 0).select(
        F.col("conversation").alias("base"), F.slice("turns", 1, 5).alias("head")
    )
    c = F.col("conversation")
    h = (F.crc32(c.cast("string").cast("binary")) % 6).cast("int")
    nothing = F.slice("turns", 1, 0)
    rebuilt = own.withColumn("base", c - c % 100).join(bases, "base", "left").select(
        c, F.concat(F.slice(F.coalesce("head", nothing), F.lit(1), h), F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))).alias("turns")
    )
    return prefix_trie.conversation_trie(rebuilt)

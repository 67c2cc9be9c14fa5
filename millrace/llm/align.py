"""Alignment of two tokenizers by byte offsets, with corpus-wide counts of linked ids.

Tokenizer A is a byte-level BPE vocabulary, B a sentencepiece model. Both encode the same bytes (a space and the
text); where a token of A and one of B end at the same byte, a group of linked tokens ends.

Per slice of a task's texts everything is columns: the token lists are flattened, each token has its document's
index, running sums of the token lengths give its end within the document, and an Acero hash join on
(document, end) finds the common ends. Links are expanded within groups and counted per document and id pair by
``Table.group_by``; a second one counts the documents of a chunk of texts that hold a pair. Those partial
counts, one row a pair and chunk, are merged by Spark; the merged counts go back to the chunks that asked, and
each chunk adds them up for its documents. So a pair that stands in every document is shuffled once per chunk.

The texts are encoded once: what the chunks need later is written to the shared folder. Vocabularies are
broadcast; their size is that of the files.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from millrace.llm.bpe import SAME_CLASSES, byte_letters
from millrace.llm.common import named, require
from millrace.workspace import fresh_folder

SLICE = 1 << 20  # characters of text encoded at a time
CHUNK = 8 << 20  # characters of text whose partial counts are one chunk's
WIDE = 1 << 12  # links of a group beyond which equal ids are counted first
# The pre-tokenizer's pattern of byte-level vocabularies; a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
GAP = "▁"  # a space in the pieces of B


class Tokenizers:
    """Both tokenizers, with the bytes of each token."""

    def __init__(self, vocabulary: str, model: bytes):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(vocabulary)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        spec = json.loads(vocabulary)["model"]
        back = {letter: b for b, letter in enumerate(byte_letters())}
        tokens = {i: bytes(map(back.__getitem__, s)) for s, i in spec["vocab"].items() if all(x in back for x in s)}
        self.bytes_a = pa.array([tokens.get(i, b"") for i in range(max(spec["vocab"].values()) + 1)], pa.binary())
        merged = [spec["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["merges"]]
        # If ids grow with the merges, an id is its rank, and the faster library gives the same tokens for
        # texts on whose letters all versions of Unicode agree.
        self.fast, self.late = None, re.compile(f"[^\\x00-{chr(SAME_CLASSES - 1)}]")
        if all(a < b for a, b in zip(merged, merged[1:])):
            ranks = {tokens[i]: i for i in [*map(spec["vocab"].__getitem__, back), *merged]}
            self.fast = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.n_b = self.pieces.vocab_size()
        self.bytes_b = pa.array([self.piece_bytes(i) for i in range(self.n_b)], pa.binary())
        written = [str(i) for i in range(max(len(self.bytes_a), self.n_b))]
        # What a token adds to a document's list of groups: a comma follows within a group, else | or ;.
        self.written = pa.array([w + end for end in (",", "|", ";") for w in written], pa.binary())
        self.n_written = len(written)

    def piece_bytes(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace(GAP, " ").encode()

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        if self.fast is None:
            return [e.ids for e in self.library.encode_batch(texts, add_special_tokens=False)]
        return [
            self.library.encode(t, add_special_tokens=False).ids if self.late.search(t) else self.fast.encode_ordinary(t)
            for t in texts
        ]

    def encode_b(self, texts: list[str]) -> list[list[int]]:
        return self.pieces.encode(texts, num_threads=1)


def token_lists(ids: list[list[int]]) -> pa.ListArray:
    offsets = np.zeros(len(ids) + 1, np.int32)
    np.cumsum([len(i) for i in ids], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.fromiter(chain.from_iterable(ids), np.int32, offsets[-1])))


def data_of(values: pa.Array) -> memoryview:
    """The bytes of a binary array, one value after the other."""
    return memoryview(values.buffers()[2] or b"").cast("B")


def prefix_sums(values) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=out[1:])
    return out


def same_bytes(tokens: pa.ListArray, table: pa.Array, texts: list[bytes]) -> np.ndarray:
    """For which documents the tokens' bytes, joined, are the text."""
    taken = pc.take(table, tokens.values)
    ends = prefix_sums(pc.binary_length(taken).to_numpy())[tokens.offsets.to_numpy()]
    joined = data_of(taken)
    if joined == b"".join(texts) and np.array_equal(np.diff(ends), [len(t) for t in texts]):
        return np.ones(len(texts), bool)
    return np.array([joined[a:b] == t for a, b, t in zip(ends[:-1].tolist(), ends[1:].tolist(), texts)], bool)


def ends_of(tokens: pa.ListArray, table: pa.Array, name: str) -> pa.Table:
    """One row a token: its document, its end in bytes within it, and its place among all tokens."""
    flat, document = pc.list_flatten(tokens), pc.list_parent_indices(tokens)
    running = pc.cumulative_sum(pc.cast(pc.binary_length(pc.take(table, flat)), pa.int64()))
    before = pc.take(pa.concat_arrays([pa.array([0], pa.int64()), running]), tokens.offsets.slice(0, len(tokens)))
    end = pc.subtract(running, pc.take(before, document))
    return pa.table({"document": document, "end": end, name: pa.array(np.arange(len(flat)))})


class Aligned:
    """The alignment of a slice of texts: counts per document, and ``pairs`` (document, code, links)."""

    def __init__(self, known: Tokenizers, texts: list[str]):
        spaced = [" " + t if t else "" for t in texts]
        ids_a, ids_b = known.encode_a(spaced), known.encode_b(texts)
        a, b, wanted = token_lists(ids_a), token_lists(ids_b), [t.encode() for t in spaced]
        same = same_bytes(a, known.bytes_a, wanted) & same_bytes(b, known.bytes_b, wanted)
        if not same.all():  # what does not come back as it was has no tokens
            a = token_lists([i if s else [] for i, s in zip(ids_a, same)])
            b = token_lists([i if s else [] for i, s in zip(ids_b, same)])
        common = ends_of(a, known.bytes_a, "a").join(
            ends_of(b, known.bytes_b, "b"), keys=["document", "end"], join_type="inner", use_threads=False
        )
        last_a, last_b, document = (common[c].to_numpy() for c in ("a", "b", "document"))
        order = np.argsort(last_a)
        last_a, last_b, self.document = last_a[order], last_b[order], document[order]
        # Groups follow each other, and the end of a document is the end of a group.
        size_a, size_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        a_ids, b_ids = a.values.to_numpy().astype(np.int64), b.values.to_numpy().astype(np.int64)
        n = len(texts)
        self.n_a, self.n_b = np.diff(a.offsets.to_numpy()), np.diff(b.offsets.to_numpy())
        self.n_groups = np.bincount(self.document, minlength=n)
        self.n_links = np.diff(prefix_sums(size_a * size_b)[prefix_sums(self.n_groups)])
        self.digests = self.digest(known, a_ids, b_ids, last_a, last_b, size_a, size_b)
        self.pairs = self.links(known.n_b, a_ids, b_ids, size_a, size_b)

    def digest(self, known, a_ids, b_ids, last_a, last_b, size_a, size_b) -> list[str]:
        """SHA-256 of each document's groups in writing; nothing for a document without tokens."""
        n = known.n_written
        text_a, text_b = a_ids.copy(), b_ids.copy()
        text_a[last_a] += n
        text_b[last_b] += 2 * n
        mixed = np.empty(len(a_ids) + len(b_ids), np.int64)
        mixed[np.arange(len(a_ids)) + np.repeat(np.cumsum(size_b) - size_b, size_a)] = text_a
        mixed[np.arange(len(b_ids)) + np.repeat(np.cumsum(size_a), size_b)] = text_b
        taken = pc.take(known.written, pa.array(mixed))
        ends = prefix_sums(pc.binary_length(taken).to_numpy())[prefix_sums(self.n_a.astype(np.int64) + self.n_b)].tolist()
        data = data_of(taken)
        return [hashlib.sha256(data[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(ends, ends[1:])]

    def links(self, n_b, a_ids, b_ids, size_a, size_b) -> pa.Table:
        """All links, counted per document and id pair (code: A's id times B's size plus B's id)."""
        wide = size_a * size_b > WIDE
        first_a, first_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
        group = np.repeat(np.arange(len(size_a)), np.where(wide, 0, size_a))  # of each A token in narrow groups
        token = np.flatnonzero(~np.repeat(wide, size_a))
        times = size_b[group]
        link = np.repeat(np.arange(len(token)), times)
        other = np.arange(len(link)) - np.repeat(np.cumsum(times) - times, times) + first_b[group][link]
        codes, documents = [a_ids[token][link] * n_b + b_ids[other]], [self.document[group][link]]
        numbers = [np.ones(len(link), np.int64)]
        for g in np.flatnonzero(wide).tolist():
            (x, n_x), (y, n_y) = (
                np.unique(ids[f[g] : f[g] + s[g]], return_counts=True)
                for ids, f, s in ((a_ids, first_a, size_a), (b_ids, first_b, size_b))
            )
            codes.append((x[:, None] * n_b + y).ravel())
            numbers.append((n_x[:, None] * n_y).ravel())
            documents.append(np.full(len(codes[-1]), self.document[g]))
        every = pa.table({"document": np.concatenate(documents), "code": np.concatenate(codes), "links": np.concatenate(numbers)})
        return every.group_by(["document", "code"], use_threads=False).aggregate([("links", "sum")])


def cuts(lengths: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """(start, rows) of slices of about ``limit`` characters, one row at least."""
    start, size = 0, 0
    for i, n in enumerate(lengths.tolist()):
        size += n
        if size >= limit:
            yield start, i + 1 - start
            start, size = i + 1, 0
    if start < len(lengths):
        yield start, len(lengths) - start


_held: dict[int, Tokenizers] = {}


class Shared:
    """Both files, sent to each executor once and read once per Python worker."""

    def __init__(self, spark, vocabulary: str, model: str):
        files = Path(vocabulary).read_text(encoding="utf-8"), Path(model).read_bytes()
        self.n_b = Tokenizers(*files).n_b  # fails early on files that cannot be used
        self.files, self.key = spark.sparkContext.broadcast(files), hash(files)

    def __getstate__(self):
        return {"files": self.files, "key": self.key}

    def get(self) -> Tokenizers:
        if self.key not in _held:
            _held.clear()
            _held[self.key] = Tokenizers(*self.files.value)
        return _held[self.key]


COUNTS = ("n_a", "n_b", "n_groups", "n_links")
STORED = (
    "chunk long, " + "".join(f"{c} long, " for c in COUNTS)
    + "groups_sha256 string, codes array<long>, numbers array<long>, chunk_codes array<long>, chunk_numbers array<long>"
)


def encode_chunks(shared: Shared):
    """The documents with their links; the last one of a chunk has how many of its documents hold each pair."""

    def counts(rows: int, partial: list[pa.Table]) -> list[pa.Array]:
        if not partial:
            return [pa.ListArray.from_arrays(np.zeros(rows + 1, np.int32), pa.array([], pa.int64()))] * 2
        merged = pa.concat_tables(partial).group_by("code", use_threads=False).aggregate([("documents", "sum")])
        offsets = np.append(np.zeros(rows, np.int32), np.int32(len(merged)))
        return [pa.ListArray.from_arrays(offsets, merged[c].combine_chunks()) for c in ("code", "documents_sum")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.get()
        chunk, size, partial, held = TaskContext.get().partitionId() << 32, 0, [], None
        for batch in batches:
            given = [c for c in batch.schema.names if c != "text"]
            names = [*(c.split()[0] for c in STORED.split(", ")), *given]
            lengths = pc.utf8_length(batch["text"]).to_numpy()
            for at, n in cuts(lengths, SLICE):
                if held:
                    ended = size >= CHUNK
                    yield pa.record_batch([*held[0], *counts(len(held[0][0]), partial if ended else []), *held[1]], held[2])
                    if ended:
                        chunk, size, partial = chunk + 1, 0, []
                part = batch.slice(at, n)
                found = Aligned(known, part["text"].to_pylist())
                pairs = found.pairs.sort_by([("document", "ascending"), ("code", "ascending")])
                offsets = prefix_sums(np.bincount(pairs["document"].to_numpy(), minlength=n)).astype(np.int32)
                head = [
                    pa.array(np.full(n, chunk, np.int64)), *(pa.array(getattr(found, c).astype(np.int64)) for c in COUNTS),
                    pa.array(found.digests, pa.string()),
                    *(pa.ListArray.from_arrays(offsets, pairs[c].combine_chunks()) for c in ("code", "links_sum")),
                ]
                held = head, [part[c] for c in given], names
                of_pairs = pairs.group_by("code", use_threads=False).aggregate([("document", "count")])
                partial.append(of_pairs.rename_columns(["code", "documents"]))
                size += int(lengths[at : at + n].sum())
        if held:
            yield pa.record_batch([*held[0], *counts(len(held[0][0]), partial), *held[1]], held[2])

    return run


def add_up(docs: pa.Table, replies: pa.Table) -> pa.Table:
    """The documents of a chunk with the sums of their links' counts."""
    code, count, best = (replies[c].to_numpy() for c in ("code", "count", "best"))
    order = np.argsort(code)
    code, count, best = code[order], count[order], best[order]
    codes, numbers = (docs[c].combine_chunks() for c in ("codes", "numbers"))
    at = np.searchsorted(code, codes.flatten().to_numpy())
    number, edges = numbers.flatten().to_numpy(), prefix_sums(codes.value_lengths().to_numpy())
    sums = [pa.array(np.diff(prefix_sums(number * of[at])[edges])) for of in (best.astype(np.int64), count)]
    kept = [c for c in docs.column_names if c != "chunk"]
    return pa.table([*(docs[c] for c in kept), *sums], [*kept, "n_best", "count_sum"])


def align_tokens(
    df: DataFrame, vocabulary: str, model: str, text: str = "text", alignment: str = "alignment"
) -> DataFrame:
    """The columns of ``df`` but ``text``, and a struct ``alignment`` of each whole text's two encodings.

    Its fields: ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links`` (pairs of an A and a B token of one group),
    ``n_best`` (links whose id pair stands in as many documents as any pair of its A id), ``count_sum`` (over links, the
    number of documents that hold the pair), ``groups_sha256`` (lowercase hex of ``a1,a2|b1;a3|b2``, ids in order), and
    ``links`` (A's id, B's id and their links within the text).

    ``vocabulary`` is a byte-level BPE file of the tokenizers library, ``model`` a sentencepiece model. A encodes a
    space and the text, B the text, to which it adds the space. Special tokens' strings are plain text. A null
    or empty text, and one whose tokens of A or B do not join to its bytes, has no tokens: zeros, '' and no links.
    All rows stay, and each counts as a document, repeated ones too; other columns pass through, whatever their
    names, one named like ``alignment`` raises ValueError. An empty table gives an empty table.
    """
    require(df, text)
    if alignment.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"a column {alignment!r} is there already")
    spark = df.sparkSession
    shared = Shared(spark, vocabulary, model)
    others = [(f"c{i}", c) for i, c in enumerate(df.columns) if c != text]
    given = df.select(F.coalesce(named(text), F.lit("")).alias("text"), *[named(c).alias(held) for held, c in others])
    kept = [f for f in given.schema if f.name != "text"]
    stored, path = StructType([*StructType.fromDDL(STORED), *kept]), fresh_folder(spark, "alignment")
    given.mapInArrow(encode_chunks(shared), stored).write.parquet(path)
    rows = spark.read.schema(stored).parquet(path)
    pairs = F.explode(F.arrays_zip("chunk_codes", "chunk_numbers")).alias("pair")
    parts = rows.select(F.col("chunk").alias("asking"), pairs).select(
        "asking", F.col("pair.chunk_codes").alias("code"), F.col("pair.chunk_numbers").alias("numbers")
    )
    counts = parts.groupBy("code").agg(F.sum("numbers").alias("count"))
    counts = counts.withColumn("a", F.floor(F.col("code") / shared.n_b))
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    judged = counts.join(most, "a").select("code", "count", (F.col("count") == F.col("most")).alias("best"))
    replies = parts.join(judged, "code").select("asking", "code", "count", "best")
    docs = rows.drop("chunk_codes", "chunk_numbers")
    summed = StructType([
        *[f for f in docs.schema if f.name != "chunk"], *StructType.fromDDL("n_best long, count_sum long"),
    ])
    found = docs.groupBy("chunk").cogroup(replies.groupBy("asking")).applyInArrow(add_up, summed)
    links = F.transform(F.arrays_zip("codes", "numbers"), lambda p: F.struct(
        F.floor(p["codes"] / shared.n_b).cast("int").alias("a"), F.pmod(p["codes"], F.lit(shared.n_b)).cast("int").alias("b"),
        p["numbers"].alias("links"),
    ))
    fields = [*COUNTS, "n_best", "count_sum", "groups_sha256"]
    return found.select(*[F.col(held).alias(c) for held, c in others], F.struct(*fields, links.alias("links")).alias(alignment))

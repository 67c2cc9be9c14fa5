"""Byte-level BPE: encode texts to token ids and decode ids to texts.

Each word (piece of the pre-tokenizer's pattern) is a doubly linked list of symbols. A priority queue
holds the merge ranks of neighbours; the lowest rank, leftmost first, is merged, its new neighbours are
queued, and entries whose symbols have changed meanwhile are skipped when they come up. Decoding joins
the vocabulary strings of the ids and maps them back to bytes.

The vocabulary file is read by the driver and broadcast (its size is that of a vocabulary, a few MB,
whatever the corpus). Texts are independent: no shuffle, and a lost executor costs only its tasks.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm.common import free_name, named, require, slices

# The pre-tokenizer's pattern of byte-level vocabularies; a fixed value. L, N and S stand for
# letters, numbers and white space.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[L]+| ?[N]+| ?[^SLN]+|[S]+(?![^S])|[S]+"
# Below this code point all Unicode versions agree on letters, numbers and white space. Texts with
# later characters are cut by the tokenizers library, whose tables are the yardstick.
SAME_CLASSES = 0x558
CACHED_WORDS = 150_000
ROWS, BYTES = 128, 1_000_000  # texts whose Python objects are held at a time, and their bytes
LONGEST_CACHED = 64


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in letters:
            letters[b], extra = chr(extra), extra + 1
    return [letters[b] for b in range(256)]


def word_pattern() -> re.Pattern:
    """PATTERN with its classes written out for the characters below SAME_CLASSES."""
    low = [chr(c) for c in range(SAME_CLASSES)]
    classes = {
        "L": "".join(c for c in low if unicodedata.category(c)[0] == "L"),
        "N": "".join(c for c in low if unicodedata.category(c)[0] == "N"),
        "S": "\t\n\v\f\r \x85\xa0",
    }
    inside = re.compile(r"\[(\^?)([LNS]+)\]")
    return re.compile(inside.sub(lambda m: f"[{m[1]}{''.join(map(classes.get, m[2]))}]", PATTERN))


class Codec:
    """Encoder and decoder of one vocabulary file (JSON of the tokenizers library, byte-level BPE)."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        plain = {"dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"}
        if (
            model.get("type", "BPE") != "BPE" or spec.get("normalizer") or before.get("type") != "ByteLevel"
            or before.get("add_prefix_space") or not before.get("use_regex", True) or any(model.get(k) for k in plain)
        ):
            raise ValueError("only plain byte-level BPE vocabularies are supported")
        letters = byte_letters()
        vocabulary: dict[str, int] = model["vocab"]
        self.byte_ids = [vocabulary[letter] for letter in letters]
        # (left, right) as one number -> (rank, merged id)
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            key = vocabulary[left] << 32 | vocabulary[right]
            self.merges[key] = (rank, vocabulary[left + right])
        self.special = {}
        for token in spec.get("added_tokens") or ():
            if token.get("lstrip") or token.get("rstrip") or token.get("single_word") or token.get("normalized"):
                raise ValueError(f"unsupported added token {token['content']!r}")
            self.special[token["content"]] = token["id"]
        back = {letter: b for b, letter in enumerate(letters)}
        self.pieces: dict[int, bytes] = {
            i: bytes(back[letter] for letter in string) for string, i in vocabulary.items() if all(x in back for x in string)
        }
        self.pieces |= {i: content.encode() for content, i in self.special.items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.special else None
        self.words, self.late = word_pattern(), re.compile(f"[^\\x00-{chr(SAME_CLASSES - 1)}]")
        self.cache: dict[str, tuple[int, ...]] = {}
        self._library = None

    def merge(self, symbols: list[int]) -> list[int]:
        """Apply the merges to one word's byte symbols."""
        n, merges = len(symbols), self.merges
        if n < 2:
            return symbols
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        for i in range(n - 1):
            found = merges.get(symbols[i] << 32 | symbols[i + 1])
            if found:
                queue.append((found[0], i, symbols[i], symbols[i + 1], found[1]))
        heapq.heapify(queue)
        while queue:
            _, i, left, right, merged = heapq.heappop(queue)
            j = after[i]
            if symbols[i] != left or j == n or symbols[j] != right:
                continue  # stale: one of the two has been merged since
            symbols[i], symbols[j] = merged, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                found = merges.get(merged << 32 | symbols[k])
                if found:
                    heapq.heappush(queue, (found[0], i, merged, symbols[k], found[1]))
            h = before[i]
            if h >= 0:
                found = merges.get(symbols[h] << 32 | merged)
                if found:
                    heapq.heappush(queue, (found[0], h, symbols[h], merged, found[1]))
        return [s for s in symbols if s >= 0]

    def encode_word(self, word: str) -> tuple[int, ...]:
        byte_ids = self.byte_ids
        ids = tuple(self.merge([byte_ids[b] for b in word.encode()]))
        if len(word) <= LONGEST_CACHED:
            if len(self.cache) >= CACHED_WORDS:
                self.cache.clear()
            self.cache[word] = ids
        return ids

    def split(self, text: str) -> Iterable[str]:
        """The words of a text without special tokens."""
        if not self.late.search(text):
            return self.words.findall(text)
        if self._library is None:
            from tokenizers.pre_tokenizers import ByteLevel

            self._library = ByteLevel(add_prefix_space=False, use_regex=True)
        return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]

    def encode(self, text: str) -> list[int]:
        cached, encode_word, out = self.cache.get, self.encode_word, []
        for part in self.cut.split(text) if self.cut else (text,):
            if part in self.special:
                out.append((self.special[part],))
            elif part:
                out.extend([cached(w) or encode_word(w) for w in self.split(part)])
        return list(chain.from_iterable(out))

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.pieces.__getitem__, ids)).decode("utf-8", "replace")


_codecs: dict[int, Codec] = {}


def codec_of(shared) -> Codec:
    """The codec of a broadcast vocabulary, built once per Python worker."""
    if shared._jbroadcast_id not in _codecs:
        _codecs.clear()
        _codecs[shared._jbroadcast_id] = Codec(shared.value)
    return _codecs[shared._jbroadcast_id]


class SharedVocabulary:
    """A vocabulary file's content, sent to each executor once."""

    def __init__(self, spark: SparkSession, path: str):
        content = Path(path).read_text(encoding="utf-8")
        self.codec = Codec(content)  # fails early on an unsupported file
        self._broadcast = spark.sparkContext.broadcast(content)
        self._jbroadcast_id = hash(content)

    def __getstate__(self):
        return {"_broadcast": self._broadcast, "_jbroadcast_id": self._jbroadcast_id}

    @property
    def value(self) -> str:
        return self._broadcast.value


def encode_column(shared: SharedVocabulary, text: Column) -> Column:
    """Token ids (``array<int>``) of a text column; null stays null, an empty text has no ids."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = codec_of(shared)
        for batch in batches:
            for at, n in slices(batch, ROWS, BYTES):
                texts = batch.slice(at, n).to_pylist()
                yield pa.array([None if t is None else codec.encode(t) for t in texts], pa.list_(pa.int32()))

    return F.arrow_udf(_typed(run), "array<int>")(text)


def decode_column(shared: SharedVocabulary, ids: Column) -> Column:
    """Text of a column of token ids; null stays null. An id outside the vocabulary fails the job."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = codec_of(shared)
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                rows = batch.slice(at, ROWS).to_pylist()
                yield pa.array([None if i is None else codec.decode(i) for i in rows], pa.string())

    return F.arrow_udf(_typed(run), "string")(ids)


def both(codec: Codec, texts: list[str]) -> pa.Array:
    ids = [codec.encode(t) for t in texts]
    return pa.StructArray.from_arrays(
        [pa.array(ids, pa.list_(pa.int32())), pa.array(map(codec.decode, ids), pa.string())], ["ids", "text"]
    )


def _typed(run):
    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return run


def encode_and_decode(
    df: DataFrame, vocabulary: str, text: str = "text", ids: str = "token_ids", decoded: str = "decoded_text"
) -> DataFrame:
    """``df`` with the token ids of each whole text and the text decoded from these ids.

    A null text counts as empty: no ids, empty text. Every row stays, repeated rows included; other
    columns pass through, whatever their names. If ``ids`` or ``decoded`` is the name of a column
    already, ValueError. An empty table gives an empty table. Special tokens' strings in a text become
    these tokens, as the library does it.
    """
    require(df, text)
    for name in (ids, decoded):
        if name.lower() in {c.lower() for c in df.columns}:
            raise ValueError(f"a column {name!r} is there already")
    shared = SharedVocabulary(df.sparkSession, vocabulary)
    held = free_name(df, "encoded")
    both = _encode_decode(shared, F.coalesce(named(text), F.lit("")))
    kept = [named(c) for c in df.columns]
    return df.withColumn(held, both).select(
        *kept, named(held)["ids"].alias(ids), named(held)["text"].alias(decoded)
    )


def _encode_decode(shared: SharedVocabulary, text: Column) -> Column:
    """Both directions in one pass over the Arrow batches. Results are handed on by the part, not by the batch."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = codec_of(shared)
        for batch in batches:
            for at, n in slices(batch, ROWS, BYTES):
                yield both(codec, batch.slice(at, n).to_pylist())

    return F.arrow_udf(_typed(run), "struct<ids:array<int>,text:string>")(text)

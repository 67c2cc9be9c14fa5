"""Removal of byte strings that repeat across documents, by intervals of a Burrows-Wheeler transform.

A byte goes if a window of ``least`` bytes that covers it also starts in a document with a smaller id. No
suffix array of the whole corpus is built; windows that may be equal are brought together first:

1. *Anchors*: of the ``least - K + 1`` places of a window where a string of K bytes starts, the leftmost one of
   the smallest hash. Equal windows have equal anchors. Runs of windows with the same anchor are one
   string; its key hashes the bytes around the anchor that all these windows share (33 or 34 of 50).
2. *Candidates*: documents are dealt to chunks of some MB. Each chunk sends its keys, once each, to buckets; a
   bucket tells the chunks which keys stand in two documents. All other windows are unique.
3. *Intervals*: the candidate strings, once per chunk, are dealt by key. A task takes blocks of whole keys, joins the
   different strings to one text, sorts its rotations, and extends intervals of the transform backward, breadth
   first: in round l all boundaries with a common prefix of l bytes are found. After ``least`` rounds the
   boundaries that are still unknown lie between rows with longer common prefixes; these intervals are the
   groups of equal windows, and each group has its smallest document.
4. The windows found go back to their chunks, where they become spans.

The number of chunks and buckets follows the size of the texts. A key with more than ``HOT`` different strings
(the end of a boilerplate line with what follows it in each document, say) is cut down to single windows, each
of which is a key of its own; a window that stands in very many chunks streams through its task in order of its
documents, so no group is ever held whole. Documents are shuffled once; no step collects anything.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from millrace.llm.common import named, require

CHUNK_BYTES = 12 << 20
BUCKET_BYTES = 8 << 20  # of text, whose keys one bucket holds
SLICE = 1 << 20  # bytes whose hashes are in memory at a time
BLOCK = 1 << 20  # bytes of strings and their places in one transform, if keys allow it
ROWS = 2048  # that are taken at a time
HOT = 8192  # strings of one key, and rows of one window that are held at a time
NO_ID = 2**63 - 1  # stands for a null id: after all others
PLACE = np.dtype([("row", "<i4"), ("start", "<i4")])
SPAN = np.dtype([("row", "<i4"), ("start", "<i4"), ("end", "<i4"), ("doc", "<i8")])
ODD = 0x9E3779B97F4A7C15  # any odd number


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers spread over their range."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Hashes:
    """Hashes of all substrings of one slice: differences of running sums over powers of an odd base."""

    _up = _down = np.zeros(0, np.uint64)
    _letters = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(ODD))

    def __init__(self, data: np.ndarray):
        n = len(data)
        if len(Hashes._up) <= n:
            Hashes._up, Hashes._down = powers(ODD, n + 4096), powers(pow(ODD, -1, 2**64), n + 4096)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(Hashes._letters[data] * Hashes._up[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return mixed((self.sums[start + length] - self.sums[start]) * Hashes._down[start] + np.uint64(1))


def leftmost_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values the place of its smallest one, the leftmost if several are."""
    place, best, size = np.arange(len(values), dtype=np.int32), values, 1
    while size * 2 <= width:
        later = best[size:] < best[:-size]
        place = np.where(later, place[size:], place[:-size])
        best = np.where(later, best[size:], best[:-size])
        size *= 2
    n, rest = len(values) - width + 1, width - size
    return np.where(best[rest : rest + n] < best[:n], place[rest : rest + n], place[:n])


def runs(data: np.ndarray, document: np.ndarray, least: int, buckets: int):
    """(start, windows, key, hashes) of the runs of windows that share an anchor, within documents."""
    n = len(data) - least + 1
    short = anchor_bytes(least)
    hashes = Hashes(data)
    values = hashes.of(np.arange(len(data) - short + 1), short)
    anchor = leftmost_smallest(values, least - short + 1)
    start = np.flatnonzero(document[:n] == document[least - 1 :])
    anchor = anchor[start]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(fresh)
    windows = np.diff(np.append(first, len(start)))
    key = values[anchor[first]]
    # The bucket in the upper half, 32 bits of the hash in the lower one.
    key = (key >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32) | key & np.uint64(0xFFFFFFFF)
    return start[first], windows, key.astype(np.int64), hashes


def anchor_bytes(least: int) -> int:
    return max(1, least * 2 // 5)


def slices(texts: list[bytes], least: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(bytes, piece, text and begin of the text of each byte) in slices that together hold each window once."""
    held, size = [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(len(text) - least + 1, 0), SLICE):
            piece = text[at : at + SLICE + least - 1]
            held.append((i, at, piece))
            size += len(piece)
            if size >= SLICE:
                yield joined(held)
                held, size = [], 0
    if held:
        yield joined(held)


def joined(held: list[tuple[int, int, bytes]]):
    lengths = np.array([len(piece) for _, _, piece in held])
    data = np.frombuffer(b"".join(piece for _, _, piece in held), np.uint8)
    begins = np.repeat(np.cumsum(lengths) - lengths - np.array([at for _, at, _ in held]), lengths)
    return data, np.repeat(np.arange(len(held)), lengths), np.repeat(np.array([i for i, _, _ in held]), lengths), begins


def rows_of(table: pa.Table) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Texts, row ids and document ids of a chunk; a repeated row once."""
    row, at = np.unique(table["row"].to_numpy(), return_index=True)
    texts = table["bytes"].take(pa.array(at)).to_pylist()
    return texts, row, table["doc"].to_numpy()[at]


def packed(numbers: np.ndarray) -> bytes:
    """Ascending 32-bit numbers as the bytes of their differences, highest bytes (mostly 0) together."""
    steps = np.diff(numbers, prepend=numbers.dtype.type(0))
    return steps.view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4")
    return np.cumsum(steps, dtype=np.uint32)


def keys_of_chunk(least: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        texts, _, doc = rows_of(table)
        keys, strings, docs = [], [], []
        for data, piece, text, _ in slices(texts, least):
            start, windows, key, hashes = runs(data, piece, least, buckets)
            keys.append(key)
            strings.append(hashes.of(start, windows + least - 1))
            docs.append(doc[text[start]])
        if not keys:
            return KEYS.empty_table()
        key, string, doc = np.concatenate(keys), np.concatenate(strings), np.concatenate(docs)
        order = np.lexsort((string, key))
        key, string, doc = key[order], string[order], doc[order]
        fresh = np.append(True, key[1:] != key[:-1])
        first = np.flatnonzero(fresh)
        shared = np.minimum.reduceat(doc, first) < np.maximum.reduceat(doc, first)
        different = fresh | np.append(True, string[1:] != string[:-1])
        many = np.add.reduceat(different.astype(np.int64), first)  # different strings of the key in this chunk
        key = key[first]
        edges = np.append(np.flatnonzero(np.append(True, np.diff(key >> 32) != 0)), len(key))
        chunk, out = table["chunk"][0].as_py(), []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            # With two documents of one chunk a key is a candidate wherever else it stands.
            weight = np.minimum(many[a:b], 0x7FFF).astype("<u2") | (shared[a:b].astype("<u2") << 15)
            out.append({
                "bucket": int(key[a] >> 32), "chunk": chunk,
                "keys": packed((key[a:b] & 0xFFFFFFFF).astype("<u4")), "weights": weight.tobytes(),
            })
        return pa.Table.from_pylist(out, KEYS)

    return run


KEYS = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()), ("weights", pa.binary())])
REPLIES = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("keys", pa.binary()), ("hot", pa.binary())])


def candidates_of_bucket(table: pa.Table) -> pa.Table:
    """For each chunk, which of its keys stand in two documents, and which of these are hot."""
    parts = [unpacked(b) for b in table["keys"].to_pylist()]
    key = np.concatenate(parts)
    weight = np.concatenate([np.frombuffer(b, "<u2") for b in table["weights"].to_pylist()])
    distinct, inverse, chunks = np.unique(key, return_inverse=True, return_counts=True)
    shared = np.zeros(len(distinct), bool)
    shared[inverse[weight >> 15 == 1]] = True
    hot = (np.bincount(inverse, weight & 0x7FFF, len(distinct)) > HOT)[inverse]
    wanted = ((chunks > 1) | shared)[inverse]
    at, out = 0, []
    for part, chunk, bucket in zip(parts, table["chunk"].to_pylist(), table["bucket"].to_pylist()):
        mine = wanted[at : at + len(part)]
        if mine.any():
            out.append({
                "chunk": chunk, "bucket": bucket, "keys": packed(part[mine]),
                "hot": hot[at : at + len(part)][mine].tobytes(),
            })
        at += len(part)
    return pa.Table.from_pylist(out, REPLIES)


STRINGS = pa.schema([
    ("key", pa.int64()), ("string", pa.binary()), ("smallest", pa.int64()), ("chunk", pa.int64()), ("places", pa.binary()),
])


def binary_array(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A binary array whose values follow each other in ``values``."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    upto = np.cumsum(length)
    return np.arange(upto[-1] if len(upto) else 0) + np.repeat(start - (upto - length), length)


def strings_of_chunk(least: int, buckets: int):
    """The candidate strings of a chunk, each with all its places; hot ones cut down to windows (keys below 0).

    A place is the text's number among the chunk's rows (in order of their ids) and where the string starts.
    """

    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not len(table) or not len(replies):
            return STRINGS.empty_table()
        told = [
            unpacked(k).astype(np.int64) | b << 32
            for k, b in zip(replies["keys"].to_pylist(), replies["bucket"].to_pylist())
        ]
        wanted, hot = np.concatenate(told), np.concatenate([np.frombuffer(h, bool) for h in replies["hot"].to_pylist()])
        order = np.argsort(wanted)
        wanted, hot = wanted[order], hot[order]
        texts, _, doc = rows_of(table)
        keys, strings, places = [], [], []
        for data, piece, text, begins in slices(texts, least):
            start, windows, key, hashes = runs(data, piece, least, buckets)
            found = np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)
            taken = wanted[found] == key
            start, windows, key, is_hot = start[taken], windows[taken], key[taken], hot[found[taken]]
            if is_hot.any():
                single = ranges(start[is_hot], windows[is_hot])
                own = (hashes.of(single, least) >> np.uint64(1)).astype(np.int64) | np.int64(-(2**63))
                start, key = np.append(start[~is_hot], single), np.append(key[~is_hot], own)
                windows = np.append(windows[~is_hot], np.ones(len(single), windows.dtype))
            lengths = windows + least - 1
            keys.append(key)
            strings.append(binary_array(data[ranges(start, lengths)], lengths))
            place = np.empty(len(start), PLACE)
            place["row"], place["start"] = text[start], start - begins[start]
            places.append(place)
        if not keys:
            return STRINGS.empty_table()
        key, place = np.concatenate(keys), np.concatenate(places)
        # Equal strings have equal keys, since their windows have the same anchors.
        same = pa.concat_arrays(strings).dictionary_encode()
        string = same.indices.to_numpy()
        order = np.argsort(string, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(string[order]) != 0)[: len(order)])
        place = place[order]
        return pa.table([
            pa.array(key[order][first]), same.dictionary, pa.array(np.minimum.reduceat(doc[place["row"]], first)),
            pa.array(np.full(len(first), table["chunk"][0].as_py(), np.int64)),
            binary_array(place.view(np.uint8), np.diff(np.append(first, len(place))) * PLACE.itemsize),
        ], schema=STRINGS)

    return run


def rotations(data: np.ndarray, least: int) -> np.ndarray:
    """The order of the rotations of ``data`` by their first ``least`` bytes at least (prefix doubling)."""
    n, size, key, bits = len(data), 1, data.astype(np.uint64), 8 * data.itemsize
    while size * bits < 64:
        key = key << np.uint64(bits * size) | np.roll(key, -size)
        size *= 2
    while True:
        order = np.argsort(key)
        sorted_keys = key[order]
        if size >= least:
            return order
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(np.append(False, sorted_keys[1:] != sorted_keys[:-1])).astype(np.uint64)
        key = rank * np.uint64(n) + np.roll(rank, -size)
        size *= 2


def known_boundaries(last: np.ndarray, least: int) -> np.ndarray:
    """Which rows differ from the row before within ``least`` bytes, from the transform ``last`` alone.

    Breadth first: the intervals of strings of l bytes are extended backward by each byte that precedes them. Where
    the interval of the longer string ends at a boundary not met before, the rows there have l bytes in
    common; only such intervals are extended further, so all rounds together take time in proportion to the
    rows met. Strings with the letter 0 are not followed: boundaries between rows of which one has a 0 within
    ``least`` bytes may stay unknown.
    """
    n = len(last)
    order = np.argsort(last, kind="stable").astype(np.int32)
    back = np.empty(n, np.int32)  # row of the rotation that begins one byte earlier
    back[order] = np.arange(n, dtype=np.int32)
    same = last[order[1:]] == last[order[:-1]]
    later, earlier = np.full(n, n, np.int32), np.full(n, -1, np.int32)  # nearest rows with the same byte
    later[order[:-1][same]] = order[1:][same]
    earlier[order[1:][same]] = order[:-1][same]
    known, followed = np.zeros(n + 1, bool), last != 0
    known[[0, n]] = True
    low, high = np.array([0], np.int32), np.array([n], np.int32)
    for _ in range(least):
        width = high - low
        upto = np.cumsum(width)
        row = np.arange(upto[-1], dtype=np.int32) + np.repeat(low - (upto - width).astype(np.int32), width)
        row, low, high = row[followed[row]], np.repeat(low, width)[followed[row]], np.repeat(high, width)[followed[row]]
        low, high = np.sort(back[row[earlier[row] < low]]), np.sort(back[row[later[row] >= high]]) + 1
        fresh = ~known[high]
        known[high] = True
        low, high = low[fresh], high[fresh]
        if not len(low):
            break
    return known[:n]


def groups(strings: list[bytes], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, place, group) of all windows of ``least`` bytes in row order; equal windows share a group."""
    data = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
    lengths = np.array([len(s) for s in strings]) + 1
    begins = np.cumsum(lengths) - lengths
    # Letters are the bytes that occur, numbered from 1; 0 ends a string. UTF-8 has fewer than 255 of them.
    numbers = np.cumsum(np.bincount(data, minlength=256) > 0)
    letters = numbers[data].astype(np.uint8 if numbers[-1] < 256 else np.uint16)
    letters[begins + lengths - 1] = 0
    order = rotations(letters, least)
    known = known_boundaries(letters[order - 1], least)
    string = np.repeat(np.arange(len(strings)), lengths)
    place = np.arange(len(letters)) - begins[string]
    whole = (place + least < lengths[string])[order]  # the window stands within its string
    # Equal windows follow each other; a row that is no window stands between different ones only.
    group = np.cumsum(known | ~whole | np.append(True, ~whole[:-1]))
    at = order[whole]
    return string[at], place[at], group[whole]


RESULT = pa.schema([("chunk", pa.int64()), ("spans", pa.binary())])


def spans_of_block(block: pa.Table, carried: dict[bytes, int], least: int) -> Iterator[pa.RecordBatch]:
    """The windows of a block of strings that may also start in a smaller document, as spans by chunk.

    A span has the smallest document of its windows, which its chunk compares with its own. ``carried`` has the
    smallest documents of strings whose earlier rows stood in the block before.
    """
    given = pa.chunked_array([pa.array(list(carried), pa.binary()), *block["string"].chunks]).combine_chunks().dictionary_encode()
    number, strings = given.indices.to_numpy(), given.dictionary.to_pylist()
    low = np.full(len(strings), NO_ID, np.int64)
    np.minimum.at(low, number, np.append(np.fromiter(carried.values(), np.int64, len(carried)), block["smallest"].to_numpy()))
    number = number[len(carried) :]
    string, window, group = groups(strings, least)
    window_doc = np.full(group.max(initial=0) + 1, NO_ID, np.int64)
    np.minimum.at(window_doc, group, low[string])
    order = np.lexsort((window, string))
    window_doc = window_doc[group[order]]
    count = np.bincount(string, minlength=len(strings))
    # Runs of windows with one smallest document; the first document of all has nothing before it.
    string, window = string[order], window[order]
    first = np.flatnonzero(np.append(True, (string[1:] != string[:-1]) | (window_doc[1:] != window_doc[:-1])))
    size = np.diff(np.append(first, len(string)))
    string, window, window_doc = string[first], window[first], window_doc[first]
    begin = np.searchsorted(string, np.arange(len(strings)))
    runs_of = np.bincount(string, minlength=len(strings))
    places = block["places"].combine_chunks()
    n_places = np.diff(np.frombuffer(places.buffers()[1], np.int32)[places.offset : places.offset + len(places) + 1]) // PLACE.itemsize
    edges = np.frombuffer(places.buffers()[1], np.int32)[[places.offset, places.offset + len(places)]]
    place = np.frombuffer(places.buffers()[2], np.uint8)[edges[0] : edges[1]].view(PLACE)
    # A row whose smallest document is that of its only run, and which has one place, loses nothing.
    smallest = block["smallest"].to_numpy()
    useless = (n_places == 1) & (runs_of[number] == 1) & (window_doc[begin[number]] == smallest)
    chosen = np.repeat(~useless, n_places)
    place, row = place[chosen], np.repeat(np.arange(len(block)), n_places)[chosen]
    if not len(place):
        return
    of = number[row]
    which = np.repeat(np.arange(len(place)), runs_of[of])
    part = ranges(begin[of], runs_of[of])
    spans = np.empty(len(which), SPAN)
    spans["row"], spans["doc"] = place["row"][which], window_doc[part]
    spans["start"] = place["start"][which] + window[part]
    spans["end"] = spans["start"] + size[part] - 1 + least
    chunk = block["chunk"].to_numpy()[row][which]
    order = np.argsort(chunk, kind="stable")
    chunk, spans = chunk[order], spans[order]
    edges = np.append(np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1])), len(chunk))
    yield pa.record_batch([
        pa.array(chunk[edges[:-1]]), binary_array(spans.view(np.uint8), np.diff(edges) * SPAN.itemsize)
    ], schema=RESULT)


def spans_of_partition(least: int):
    """Blocks of whole keys from rows sorted by key and smallest document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, carried = [], 0, {}
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                held.append(batch)
                size += batch.nbytes
                if size < BLOCK:
                    continue
                rows = pa.Table.from_batches(held)
                key = rows["key"].to_numpy()
                begin = int(np.searchsorted(key, key[-1]))  # of the last key, which may go on
                if begin:
                    yield from spans_of_block(rows.slice(0, begin), carried, least)
                    carried, rows = {}, rows.slice(begin)
                elif key[-1] < 0 and len(rows) >= HOT:
                    # One window in very many chunks: the first of its rows has its smallest document.
                    yield from spans_of_block(rows, carried, least)
                    lows = zip(rows["string"].to_pylist(), rows["smallest"].to_pylist())
                    for string, low in lows:
                        carried[string] = min(low, carried.get(string, NO_ID))
                    rows = rows.slice(len(rows))
                held, size = rows.combine_chunks().to_batches(), rows.nbytes
        if held and sum(b.num_rows for b in held):
            yield from spans_of_block(pa.Table.from_batches(held), carried, least)

    return run


def union(spans: np.ndarray, length: int) -> np.ndarray:
    """Maximal covered runs as (start, end) pairs."""
    steps = np.zeros(length + 1, np.int32)
    np.add.at(steps, spans["start"], 1)
    np.add.at(steps, spans["end"], -1)
    inside = np.cumsum(steps[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    return edges.reshape(-1, 2)


def cut_of_chunk(table: pa.Table, found: pa.Table) -> pa.Table:
    """The rows of a chunk with their removed spans and the bytes that stay."""
    spans = np.concatenate([np.zeros(0, SPAN), *(np.frombuffer(b, SPAN) for b in found["spans"].to_pylist())])
    spans = spans[np.argsort(spans["row"], kind="stable")]
    _, number = np.unique(table["row"].to_numpy(), return_inverse=True)
    first, final = (np.searchsorted(spans["row"], number, side).tolist() for side in ("left", "right"))
    removed, kept = [], []
    for text, doc, a, b in zip(table["bytes"].to_pylist(), table["doc"].to_pylist(), first, final):
        mine = spans[a:b]
        mine = mine[mine["doc"] < doc]
        edges = union(mine, len(text)).tolist() if len(mine) else []
        parts = [text[x:y] for x, y in zip([0, *(e for _, e in edges)], [*(s for s, _ in edges), len(text)])]
        removed.append([{"start": x, "end": y} for x, y in edges])
        kept.append(b"".join(parts))
    given = [c for c in table.column_names if c not in ("chunk", "row", "doc")]
    return pa.table(
        [*(table[c] for c in given), pa.array(removed, REMOVED), pa.array(kept, pa.binary())], [*given, "removed", "kept"]
    )


REMOVED = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def remove_repeats(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 50, removed: str = "removed_spans",
    kept: str = "kept_bytes",
) -> DataFrame:
    """``df`` with the byte spans that repeat an earlier document, and the bytes that stay.

    ``removed``: maximal runs of bytes (start, end exclusive; UTF-8) covered by a string of ``least`` bytes that also
    starts in a document with a smaller id, judged on the whole input. ``kept``: the other bytes as binary, since a
    cut may fall within a character. Within one document, and between rows of one id, nothing repeats.

    Ids are integers, negative ones included; a null id comes after all others. A null text is empty: no spans,
    no bytes. All rows stay, repeated rows too; other columns pass through, whatever their names, those named
    ``removed`` or ``kept`` raise ValueError. An empty table gives an empty table. Memory is that of a chunk of
    ``CHUNK_BYTES`` and the longest text.
    """
    require(df, doc_id, text)
    if least < 4:
        raise ValueError("least must be four at least")
    for name in (removed, kept):
        if name.lower() in {c.lower() for c in df.columns}:
            raise ValueError(f"a column {name!r} is there already")
    if df.schema[doc_id].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise ValueError("ids must be integers")
    total = df.agg(F.sum(F.octet_length(named(text)).cast("long"))).first()[0] or 0
    chunks, buckets = total // CHUNK_BYTES + 1, total // BUCKET_BYTES + 1
    number = F.coalesce(named(doc_id).cast("long"), F.lit(NO_ID))
    whole = F.coalesce(named(text), F.lit(""))
    row = F.xxhash64(number, whole)
    # Columns are numbered, so that no names can clash. One exchange of these rows serves all three readers.
    others = [(f"c{i}", c) for i, c in enumerate(df.columns) if c != text]
    dealt = df.select(
        F.pmod(row, F.lit(chunks)).alias("chunk"), row.alias("row"), number.alias("doc"),
        F.isnull(named(text)).alias("nothing"), whole.cast("binary").alias("bytes"),
        *[named(c).alias(held) for held, c in others],
    )
    by_chunk = dealt.groupBy("chunk")
    replies = (
        by_chunk.applyInArrow(keys_of_chunk(least, buckets), "bucket long, chunk long, keys binary, weights binary")
        .groupBy("bucket").applyInArrow(candidates_of_bucket, "chunk long, bucket long, keys binary, hot binary")
    )
    strings = by_chunk.cogroup(replies.groupBy("chunk")).applyInArrow(
        strings_of_chunk(least, buckets), "key long, string binary, smallest long, chunk long, places binary"
    )
    spans = strings.repartition("key").sortWithinPartitions("key", "smallest").mapInArrow(
        spans_of_partition(least), "chunk long, spans binary"
    )
    kind = [f for f in dealt.schema if f.name not in ("chunk", "row", "doc")]
    cut = by_chunk.cogroup(spans.groupBy("chunk")).applyInArrow(
        cut_of_chunk, StructType([*kind, *StructType.fromDDL("removed array<struct<start:int,end:int>>, kept binary")])
    )
    held = {c: F.col(name) for name, c in others} | {text: F.when(~F.col("nothing"), F.col("bytes").cast("string"))}
    return cut.select(*[held[c].alias(c) for c in df.columns], F.col("removed").alias(removed), F.col("kept").alias(kept))

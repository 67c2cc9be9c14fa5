"""Quality rules on repetition, by suffix arrays.

The suffix array of a text's words is built by prefix doubling; the ranks of all levels give the longest
common prefix of neighbouring suffixes by binary lifting. Each interval of the LCP table is a maximal
repeated substring; the union of the spans of those with at least ``MIN_REPEAT`` words is what a text
repeats. A text is kept if the covered share of its words and its longest repeat stay below their limits.

Texts are independent: one Arrow function per text, no shuffle. Memory is about 100 bytes per word of
the longest text of a batch that repeats anything; texts without a repeated window of ``MIN_REPEAT``
words never get a suffix array.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import free_name, named, require

MIN_REPEAT = 8  # words; a power of two
MAX_COVERED = 0.25  # share of the words
MAX_LONGEST = 100  # words
SYMBOLS = "#*$%&|<>"
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat",
)


def word_ids(words: list[bytes]) -> np.ndarray:
    """The same number for the same word."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def ranked(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Dense ranks and how many there are."""
    values, ranks = np.unique(keys, return_inverse=True)
    return ranks, len(values)


def doubled(ranks: np.ndarray, width: int) -> tuple[np.ndarray, int]:
    """Ranks of the windows of twice the width; beyond the end stands a smallest word."""
    later = np.zeros(len(ranks), np.int64)
    later[: max(len(ranks) - width, 0)] = ranks[width:] + 1
    return ranked(ranks * (len(ranks) + 1) + later)


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` places the spans cover."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + lengths, -1)
    return np.cumsum(steps[:-1]) > 0


def repeated_triples(ids: np.ndarray) -> int:
    """Words within 3-word windows that stand twice or more in the text."""
    if len(ids) < 3:
        return 0
    pairs, _ = ranked(ids[:-1] * (len(ids) + 1) + ids[1:])
    triples = pairs[:-1] * (len(ids) + 1) + ids[2:]
    _, inverse, times = np.unique(triples, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(times[inverse] > 1)
    return int(covered(starts, np.full(len(starts), 3), len(ids)).sum())


def repeats(ids: np.ndarray, least: int = MIN_REPEAT) -> tuple[np.ndarray, int]:
    """(covered, longest): the union of all maximal repeats of at least ``least`` words, as a mask."""
    n = len(ids)
    nothing = np.zeros(n, bool), 0
    if n <= least:
        return nothing
    levels, width = [ranked(ids)[0]], 1
    while True:
        new, distinct = doubled(levels[-1], width)
        levels.append(new)
        width *= 2
        if width == least and len(np.unique(new[: n - least + 1])) == n - least + 1:
            return nothing  # all windows of that many words differ
        if distinct == n:
            break
    suffixes = np.argsort(levels[-1])
    left, right = suffixes[:-1].copy(), suffixes[1:].copy()
    lcp = np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = (left < n) & (right < n)
        same = np.zeros(n - 1, bool)
        same[inside] = levels[k][left[inside]] == levels[k][right[inside]]
        lcp[same] += 1 << k
        left[same] += 1 << k
        right[same] += 1 << k
    # The deepest interval that holds a suffix has the larger of the two LCP values beside it.
    deepest = np.zeros(n, np.int64)
    deepest[:-1] = lcp
    deepest[1:] = np.maximum(deepest[1:], lcp)
    held = deepest >= least
    return covered(suffixes[held], deepest[held], n), int(lcp.max())


def measure(text: str, least: int = MIN_REPEAT) -> dict:
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # white space: U+0020, U+0009 to U+000D
    ids = word_ids(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    mask, longest = repeats(ids, least)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return {
        "n_words": len(words),
        "word_chars": len(text) - sum(map(text.count, " \t\n\v\f\r")),
        "n_symbols": sum(map(text.count, SYMBOLS)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeated_triples(ids),
        "covered_words": int(mask.sum()),
        "longest_repeat": longest if longest >= least else 0,
        "spans": [{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)],
    }


def measures_column(text, least: int):
    whole = pa.struct(
        [(n, pa.int64()) for n in MEASURES]
        + [("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]
    )
    kind = f"struct<{','.join(n + ':long' for n in MEASURES)},spans:array<struct<start:int,end:int>>>"

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.concat_arrays(
                pa.array([measure(t, least) for t in batch.slice(at, 256).to_pylist()], whole)
                for at in range(0, max(len(batch), 1), 256)
            )

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, kind)(text)


def judge_repetition(
    df: DataFrame, text: str = "text", least: int = MIN_REPEAT, max_covered: float = MAX_COVERED,
    max_longest: int = MAX_LONGEST, min_words: int = 50, max_repeated: float = 0.5, verdict: str = "repetition",
) -> DataFrame:
    """``df`` with a struct ``verdict``: the measures, ``base_failed`` and ``kept``.

    Measures: ``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_dup_lines`` (lines
    with a word that equal an earlier line), ``n_repeat_words`` (words in 3-word windows that stand twice
    or more), ``covered_words`` and ``spans`` (word places, end exclusive) of maximal repeats of at least
    ``least`` words, ``longest_repeat``. Base rules fail below ``min_words`` words or above
    ``max_repeated`` repeated words; the method rejects above ``max_covered`` covered words or
    ``max_longest`` words of the longest repeat.

    A null text counts as empty: no words, base rules fail. All rows stay, repeated ones too; other
    columns pass through; one named like ``verdict`` raises ValueError. Empty table: empty table.
    """
    require(df, text)
    if least & (least - 1) or least < 2:
        raise ValueError("least must be a power of two, two at least")
    if verdict.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"a column {verdict!r} is there already")
    held = free_name(df, "measures")
    m = named(held)
    failed = (m["n_words"] < min_words) | (m["n_repeat_words"] > max_repeated * m["n_words"])
    kept = ~failed & (m["covered_words"] <= max_covered * m["n_words"]) & (m["longest_repeat"] <= max_longest)
    return df.withColumn(held, measures_column(F.coalesce(named(text), F.lit("")), least)).select(
        *map(named, df.columns),
        F.struct(*[m[f].alias(f) for f in (*MEASURES, "spans")], failed.alias("base_failed"), kept.alias("kept")).alias(verdict),
    )

"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages (``PASSAGE`` words each, all of them). A passage is encoded from hashed
character trigrams and a few shares (upper case, digits, symbols, distinct words); gated attention
weighs the encodings, and a logistic unit scores the weighted mean. Only document labels are needed.

The model is trained in numpy on the driver, on at most ``SAMPLE`` labelled documents (a documented
bound, chosen by a hash of the id), whose passages the executors encode. Scoring is one Arrow function
per text with the trained weights (some 40 kB, whatever the corpus): no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import broadcast_if_small, named, require, slices
from millrace.workspace import cut_lineage

PASSAGE = 100  # words
SAMPLE = 6000  # labelled documents to learn from, at most
BAG_PASSAGES = 64  # passages of one of them to learn from, at most
BUCKETS = 128
PRIOR = 60
SHARES = 12
WIDTH = BUCKETS + SHARES
HIDDEN, GATE = 32, 16
EPOCHS, BAGS, RATE, DECAY = 30, 64, 3e-3, 1e-4
ROWS, BYTES = 256, 1_000_000  # texts encoded at a time, and their bytes
WINDOW = 500_000  # bytes whose trigrams are counted at a time

_KINDS = np.zeros(256, np.uint8)
for _kind, _bytes in enumerate(
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b"!?", b"#*$%&|<>", b".,;:", b" ", bytes(range(128, 256)))
):
    _KINDS[list(_bytes)] = _kind + 1


def passages_of(text: str, passage: int = PASSAGE) -> list[list[bytes]]:
    words = text.encode("utf-8", "surrogatepass").split()
    return [words[a : a + passage] for a in range(0, len(words), passage)] or [[]]


def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(features of all passages, number of passages of each text); an empty text is one empty passage."""
    parts, counts, waiting, size = [], [], [], 0
    for text in texts:  # the words of some ``WINDOW`` bytes, or of one text, are held at a time
        bag = passages_of(text)
        counts.append(len(bag))
        for passage in bag:
            waiting.append(passage)
            size += sum(map(len, passage)) + len(passage) + 1
            if size >= WINDOW:
                parts.append(_features(waiting))
                waiting, size = [], 0
    if waiting:
        parts.append(_features(waiting))
    return np.concatenate(parts) if parts else np.zeros((0, WIDTH), np.float32), np.array(counts, np.int64)


def _trigrams(chars: np.ndarray, owner: np.ndarray, passages: int) -> np.ndarray:
    """How often each bucket of trigrams occurs in each passage, counted window by window."""
    table = np.zeros(passages * BUCKETS, np.int64)
    for at in range(0, len(chars) - 2, WINDOW):
        wide, own = chars[at : at + WINDOW + 2].astype(np.uint32), owner[at : at + WINDOW + 2]
        trigram = wide[:-2] * np.uint32(0x9E3779B1) + wide[1:-1] * np.uint32(0x85EBCA6B) + wide[2:] * np.uint32(0xC2B2AE35)
        bucket = ((trigram ^ (trigram >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(25)
        inside = own[:-2] == own[2:]
        table += np.bincount(own[:-2][inside] * BUCKETS + bucket[inside], minlength=len(table))
    return table.reshape(-1, BUCKETS)


def _features(passages: list[list[bytes]]) -> np.ndarray:
    joined = [b" ".join(p) + b" " for p in passages]
    sizes = np.array([len(j) for j in joined])
    owner = np.repeat(np.arange(len(joined), dtype=np.int32), sizes)
    chars = np.frombuffer(b"".join(joined), np.uint8)
    out = np.zeros((len(passages), WIDTH), np.float32)
    table = _trigrams(chars, owner, len(passages))
    # A short passage's frequencies are noise: they count as if PRIOR more bytes without trigrams stood there.
    out[:, :BUCKETS] = np.sqrt(table / (sizes + PRIOR)[:, None]) * 4
    kinds = np.zeros(len(passages) * 9, np.int64)
    for at in range(0, len(chars), WINDOW):
        kinds += np.bincount(owner[at : at + WINDOW] * 9 + _KINDS[chars[at : at + WINDOW]], minlength=len(kinds))
    kinds = kinds.reshape(-1, 9)
    out[:, BUCKETS : BUCKETS + 9] = np.sqrt(kinds / np.maximum(sizes, 1)[:, None])
    words = np.array([len(p) for p in passages])
    distinct = np.array([len(set(p)) for p in passages])
    out[:, BUCKETS + 9] = words / PASSAGE
    out[:, BUCKETS + 10] = distinct / np.maximum(words, 1)
    out[:, BUCKETS + 11] = np.log1p(sizes / np.maximum(words, 1))
    return out


class Model:
    """Encoder, gated attention and scoring unit."""

    def __init__(self, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(WIDTH, np.float32), np.ones(WIDTH, np.float32)
        make = lambda *shape: (draw.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.weights = {
            "E": make(WIDTH, HIDDEN), "e": np.zeros(HIDDEN, np.float32),
            "V": make(HIDDEN, GATE), "U": make(HIDDEN, GATE), "a": make(GATE, 1)[:, 0],
            "c": make(HIDDEN, 1)[:, 0], "d": np.zeros(1, np.float32),
        }

    def forward(self, x: np.ndarray, counts: np.ndarray) -> dict:
        w = self.weights
        starts = np.cumsum(counts) - counts
        h = np.tanh(((x - self.mean) / self.scale) @ w["E"] + w["e"])
        t, s = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
        logits = (t * s) @ w["a"]
        logits = logits - np.repeat(np.maximum.reduceat(logits, starts), counts)
        share = np.exp(logits)
        share = share / np.repeat(np.add.reduceat(share, starts), counts)
        z = np.add.reduceat(share[:, None] * h, starts)
        score = 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["d"], -30, 30)))
        return {"h": h, "t": t, "s": s, "share": share, "z": z, "score": score, "starts": starts}

    def gradient(self, x: np.ndarray, counts: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        w, f = self.weights, self.forward(x, counts)
        off = ((f["score"] - label) / len(label)).astype(np.float32)
        dz = off[:, None] * w["c"]
        dz_each = np.repeat(dz, counts, axis=0)
        dshare = (dz_each * f["h"]).sum(1)
        mean = np.repeat(np.add.reduceat(f["share"] * dshare, f["starts"]), counts)
        dlogit = f["share"] * (dshare - mean)
        dgate = dlogit[:, None] * w["a"]
        dt, ds = dgate * f["s"] * (1 - f["t"] ** 2), dgate * f["t"] * f["s"] * (1 - f["s"])
        dh = f["share"][:, None] * dz_each + dt @ w["V"].T + ds @ w["U"].T
        dpre = dh * (1 - f["h"] ** 2)
        scaled = (x - self.mean) / self.scale
        return {
            "E": scaled.T @ dpre, "e": dpre.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ ds,
            "a": (f["t"] * f["s"]).T @ dlogit, "c": f["z"].T @ off, "d": np.array([off.sum()], np.float32),
        }

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> "Model":
        """Adam over shuffled batches of bags."""
        everything = np.concatenate(bags)
        self.mean, self.scale = everything.mean(0), everything.std(0) + 1e-2
        draw, step = np.random.default_rng(seed), 0
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for _ in range(epochs):
            order = draw.permutation(len(bags))
            for at in range(0, len(order), BAGS):
                part = order[at : at + BAGS]
                x, counts = np.concatenate([bags[k] for k in part]), np.array([len(bags[k]) for k in part])
                step += 1
                for k, g in self.gradient(x, counts, labels[part]).items():
                    g = g + DECAY * self.weights[k]
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.001 * (g * g - second[k])
                    rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                    self.weights[k] = (self.weights[k] - rate * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
        return self

    def score(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        x, counts = encode(texts)
        return self.forward(x, counts)["score"].astype(np.float64)


def spaced(passages: np.ndarray, limit: int = BAG_PASSAGES) -> np.ndarray:
    """At most ``limit`` of a document's passages, in even steps from the first to the last."""
    if len(passages) <= limit:
        return passages
    return passages[np.arange(limit) * (len(passages) - 1) // (limit - 1)]


def train(
    documents: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id",
    text: str = "text", sample: int = SAMPLE,
) -> Model:
    """A model from at most ``sample`` labelled documents, those with the smallest hash of their id.

    Of a longer document it learns from ``BAG_PASSAGES`` passages in even steps, so what comes to the driver
    is bounded (some 215 MB at the default sample); scores are made from all passages.

    Rows with a null id or label are not learned from; null texts are empty. A document that is labelled
    twice counts with its smaller label. Without labels of both kinds the model scores by their prior.
    """
    require(documents, doc_id, text)
    require(labels, doc_id, label)
    labelled = cut_lineage(
        labels.select(named(doc_id).alias("_id"), named(label).cast("int").alias("_label")).dropna()
        .join(documents.select(named(doc_id).alias("_id")).dropna().distinct(), "_id", "left_semi")
        .groupBy("_id").agg(F.min("_label").alias("_label")).withColumn("_hash", F.xxhash64("_id")),
        "labelled",
    )
    # Only ids whose hash is small enough to come into question are put in order, so the one task that
    # orders them gets about as many rows whatever the number of labels.
    share = min(1.0, 2 * (sample + 100) / max(labelled.count(), 1))
    highest = min(int(share * 2**64) - 2**63, 2**63 - 1)
    near = labelled.where(F.col("_hash") <= highest)
    chosen = near.orderBy("_hash", "_id").limit(sample).drop("_hash")
    chosen = cut_lineage(chosen, "sample")
    texts = documents.select(named(doc_id).alias("_doc"), F.coalesce(named(text), F.lit("")).alias("_text"))
    joined = texts.join(broadcast_if_small(chosen, max(sample, 1)), F.col("_doc") == F.col("_id"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, (at, n) in ((b, run) for b in batches for run in slices(b.column(2), ROWS, BYTES)):
            part = batch.slice(at, n)
            x, counts = encode(part.column(2).to_pylist())
            ends = np.cumsum(counts)
            bags = [spaced(x[e - c : e]).tobytes() for e, c in zip(ends, counts)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(bags, pa.binary())], names=["id", "label", "bag"])

    encoded = joined.select("_id", "_label", "_text").mapInArrow(features, "id long, label int, bag binary")
    rows = sorted(encoded.dropDuplicates(["id"]).collect(), key=lambda r: r["id"])  # at most ``sample`` rows
    model = Model()
    if not rows:
        model.weights["c"] *= 0
        return model
    bags = [np.frombuffer(r["bag"], np.float32).reshape(-1, WIDTH) for r in rows]
    target = np.array([r["label"] for r in rows], np.float32)
    if len(set(target.tolist())) < 2:
        model.weights["c"] *= 0
        model.weights["d"] += 5.0 if target[0] else -5.0
        return model
    return model.fit(bags, target)


def score_column(model: Model, text: Column) -> Column:
    """Probability of label 1 for a text column; a null text is an empty one."""
    state = (model.weights, model.mean, model.scale)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Model()
        own.weights, own.mean, own.scale = state
        for batch in batches:
            for at, n in slices(batch, ROWS, BYTES):
                yield pa.array(own.score([t or "" for t in batch.slice(at, n).to_pylist()]), pa.float64())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "double")(text)


def score_quality(
    documents: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
    sample: int = SAMPLE, score: str = "quality_score",
) -> DataFrame:
    """``documents`` with ``score``, the probability of label 1, learned from ``labels``.

    All rows stay, repeated ones and those without an id too; null and empty texts get the score of an
    empty passage. Other columns pass through; one named like ``score`` gives way to it. Nothing but the
    text enters a score. An empty table gives an empty table.
    """
    model = train(documents, labels, label, doc_id, text, sample)
    kept = [c for c in documents.columns if c.lower() != score.lower()]
    return documents.select(*map(named, kept), score_column(model, named(text)).alias(score))

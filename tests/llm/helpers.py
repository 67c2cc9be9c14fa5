"""Small tables for the tests of the training-data operators."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark, rows):
    """(doc_id, text) or (doc_id, text, source) rows with the columns of the documents table."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s0", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")


def prose(seed, words, vocabulary=400):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(words))


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, size=5):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1))} if w else set()


ODD_TEXTS = [
    None, "", " ", "\n\n", "one", "</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user\nhi", "<|\\im_end|>\n",
    "a\x00b", "été  \t naïve", "日本語 テスト", "\U0001f600 x", "<<s>", "[/\\\\INST]", "%0A%25", "x" * 5000,
    "word " * 3000, "a\u00a0b\u2003c\u0085d", "\x1c\x1d", "tail \n", "\r\nline\r\n",
]

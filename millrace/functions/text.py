"""Text cleaning as built-in Column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# The white space a text is stripped of (zero-width space is not among it).
_SPACE_RANGES = [
    (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
    (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
]
WHITE_SPACE = "".join(chr(c) for low, high in _SPACE_RANGES for c in range(low, high + 1))

# Hidden characters deleted from anywhere in a text.
CONTROL_CLASS = r"[\x00-\x1F]"

# A text that cleaning leaves as it is: printable ASCII at both ends, nothing hidden between.
_CLEAN_ALREADY = r"^[!-~]([^\x00-\x1F]*[!-~])?\z"

# Texts a CSV reader takes for a missing value.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def strip(text: Column) -> Column:
    """Remove Unicode white space from both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def is_blank(text: Column) -> Column:
    """True for texts of white space only; looks no further than the first other character."""
    return F.ltrim(text, F.lit(WHITE_SPACE)) == ""


def clean_text(text: Column) -> Column:
    """Strip, delete control characters, and turn what is then blank into null.

    The text is not stripped again after the deletion: ``"\\x01 ab"`` gives ``" ab"``. Most cells
    need nothing done, which one pattern tells several times faster than cleaning them does.
    """
    visible = F.regexp_replace(strip(text), CONTROL_CLASS, "")
    cleaned = F.when(~is_blank(visible), visible)
    return F.when(text.rlike(_CLEAN_ALREADY), text).otherwise(cleaned)


def null_if(text: Column, tokens: Iterable[str]) -> Column:
    """Null where the text is one of ``tokens``."""
    return F.when(~text.isin(*tokens), text)

"""Column helpers for text with Python's Unicode semantics, all evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 characters that Python's str.split and str.strip call whitespace.
WHITESPACE_CLASS = r"[\p{IsWhite_Space}\x1c-\x1f]"
NON_WHITESPACE_CLASS = r"[^\p{IsWhite_Space}\x1c-\x1f]"
WHITESPACE_CHARS = "".join(
    chr(code)
    for first, last in [
        (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
        (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F),
        (0x3000, 0x3000),
    ]
    for code in range(first, last + 1)
)


def strip(text: Column) -> Column:
    """Remove leading and trailing Unicode whitespace (plain ``trim`` removes spaces only)."""
    return F.btrim(text, F.lit(WHITESPACE_CHARS))


def is_blank(text: Column) -> Column:
    """True for null, empty and all-whitespace text."""
    return F.coalesce(strip(text) == "", F.lit(True))


def is_empty(text: Column) -> Column:
    """True for null and empty text; whitespace counts as content."""
    return F.coalesce(text == "", F.lit(True))


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words."""
    return F.regexp_count(text, F.lit(NON_WHITESPACE_CLASS + "+"))


def has_words(text: Column, minimum: int) -> Column:
    """Whether the text has at least ``minimum`` words; stops reading after that many."""
    if minimum <= 0:
        return text.isNotNull()
    word, gap = NON_WHITESPACE_CLASS + "++", WHITESPACE_CLASS + "++"
    pattern = f"^{WHITESPACE_CLASS}*+(?:{word}{gap}){{{minimum - 1}}}{NON_WHITESPACE_CLASS}"
    return text.rlike(pattern)


def clip(text: Column, limit: int) -> Column:
    """The first ``limit`` characters."""
    return F.substring(text, 1, limit)


def fingerprint(*columns: Column) -> Column:
    """16-byte MD5 of the concatenation, without separators; nulls count as empty.

    Kept as binary: half the shuffle and comparison cost of the hex form.
    """
    parts = [F.coalesce(c, F.lit("")) for c in columns]
    return F.unhex(F.md5(F.concat(*parts)))


def seeded_key(seed: int, row_id: Column) -> Column:
    """A uniform, reproducible sort key: the hex MD5 of seed and row id.

    Ordering by it is a seeded shuffle that does not depend on partitioning, retries or the
    engine.  Row ids must be unique.
    """
    return F.md5(F.concat_ws("|", F.lit(str(seed)), row_id.cast("string")))


def literal_map(values: dict[str, str], key: Column, default: str | None = None) -> Column:
    """Look a column up in a small fixed mapping.

    A constant map names the key once, where a CASE chain would repeat, and re-evaluate, the
    expression behind it for every entry.
    """
    entries = [F.lit(part) for pair in values.items() for part in pair]
    found = F.try_element_at(F.create_map(*entries), key)
    return found if default is None else F.coalesce(found, F.lit(default))

"""Text column expressions: regex search and replace, tokens, encodings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Between words of letters of any script.
NO_LETTERS = r"[^\p{L}]+"


def unicode_regex(pattern: str) -> str:
    """Make Java's classes Unicode-aware and ``.`` stop at newline only (it is ASCII by default)."""
    return f"(?dU){pattern}"


def find_all(col: Column, pattern: str, group: int = 0) -> Column:
    """All non-overlapping matches, left to right, as an array; ``group`` picks a capture group."""
    return F.regexp_extract_all(col, F.lit(unicode_regex(pattern)), F.lit(group))


def replace_all(col: Column, pattern: str, replacement: str) -> Column:
    """Regex replacement; an unescaped ``.`` in ``pattern`` stays a wildcard."""
    return F.regexp_replace(col, F.lit(unicode_regex(pattern)), F.lit(replacement))


def split_text(col: Column, separator: str, index: int) -> Column:
    """1-based piece of a literal-separated text; a missing piece is an empty string."""
    return F.split_part(col, F.lit(separator), F.lit(index))


def pieces(col: Column, boundary: str = NO_LETTERS) -> Column:
    """Lower-cased text between ``boundary`` matches; the first and last piece may be empty."""
    return F.split(F.lower(col), boundary)


def tokens(col: Column, boundary: str = NO_LETTERS) -> Column:
    """:func:`pieces` without the empty ones, as an array."""
    return F.array_remove(pieces(col, boundary), "")


def to_utf8(col: Column) -> Column:
    return F.encode(col, "UTF-8")


def from_utf8(col: Column) -> Column:
    return F.decode(col, "UTF-8")

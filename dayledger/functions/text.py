"""Text cells: trimming, key normalisation, sentinels, truthiness."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell texts that mean "not measured" / "no".
MISSING_MARKS = ("y", "Y")
FALSY_TEXTS = ("", "0", "false")

_OUTER_SPACE = r"^[\s\p{Z}\x{FEFF}]+|[\s\p{Z}\x{FEFF}]+$"


def trim_all(text: Column) -> Column:
    """Strip spaces, tabs, line breaks and no-break spaces from both ends."""
    return F.regexp_replace(text, _OUTER_SPACE, "")


def key_text(text: Column) -> Column:
    """Lookup form of a name or number: ``' 642.0 '`` and ``'642'`` are one key."""
    return F.regexp_replace(trim_all(text.cast("string")), r"(?<=\d)\.0+$", "")


def prefix_key(text: Column, length: int = 5) -> Column:
    """First ``length`` characters, trimmed afterwards."""
    return trim_all(F.substring(text, 1, length))


def without_sentinel(text: Column) -> Column:
    return F.when(~text.isin(*MISSING_MARKS), text)


def decimal_point(text: Column) -> Column:
    """Decimal commas become points; the result stays text."""
    return F.replace(text, F.lit(","), F.lit("."))


def truthy(text: Column) -> Column:
    """Null, empty, zero and false are false; any other text is true."""
    return F.coalesce(~text.isin(*FALSY_TEXTS), F.lit(False))


def file_extension(path: Column) -> Column:
    """Lower-case extension with its dot, or '' when there is none."""
    return F.lower(F.regexp_extract(path, r"[^/](\.[^./]*)$", 1))


def differs(left: Column, right: Column) -> Column:
    """Null-safe inequality; never null."""
    return ~left.eqNullSafe(right)


def padded_count(count: Column, width: int = 6) -> Column:
    """Right-aligned number for summary lines."""
    text = count.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit(" "))

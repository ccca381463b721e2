"""Text cleaning as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters stripped from a name part, U+0000 to U+0020.
BLANKS = "".join(chr(code) for code in range(0x21))


def to_text(value: Column) -> Column:
    """Canonical text of a value; null stays null."""
    return value.cast("string")


def default_missing(value: Column, default: str) -> Column:
    """Text of the value, or ``default`` where it is missing."""
    return F.coalesce(to_text(value), F.lit(default))


def split_dv(value: Column) -> tuple[Column, Column]:
    """Split a tax id into (id, check digit).

    The check digit is the last character, upper-cased. A missing or empty
    text gives two empty texts, a single character an empty id.
    """
    text = default_missing(value, "")
    number = F.when(text != "", F.left(text, F.length(text) - 1)).otherwise(F.lit(""))
    digit = F.upper(F.right(text, F.lit(1)))
    return number, digit


def trim_blanks(value: Column) -> Column:
    """Strip every leading and trailing character up to U+0020."""
    return F.btrim(value, F.lit(BLANKS))


def full_name(first: Column, *rest: Column) -> Column:
    """Upper-cased parts joined by one blank each.

    A missing part counts as empty text and still takes its blank, so the
    result may hold double or trailing blanks.
    """
    pieces: list[Column] = []
    for part in (first, *rest):
        if pieces:
            pieces.append(F.lit(" "))
        pieces.append(trim_blanks(default_missing(part, "")))
    return F.upper(F.concat(*pieces))

"""Whitespace, null and letter-case expressions shared by the other modules.

Patterns carry ``(?U)`` so that ``\\s``, ``\\w`` and ``\\b`` follow Unicode, the
way the source files (which hold no-break spaces and accented names) need.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Street-address texts that stand for "no address".
ADDRESS_PLACEHOLDERS = r"^(not applicable|na|n\s*/\s*a|null|none|0)$"

# Every character that Unicode counts as whitespace.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
# The same without the four separators of ASCII, which patterns do not take for white space.
SPACES = "".join(c for c in WHITESPACE if not "\x1c" <= c <= "\x1f")


def let(col: Column, body: Callable[[Column], Column]) -> Column:
    """``body(col)`` with ``col`` computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(col), body), F.lit(0))


def is_ascii(col: Column) -> Column:
    return F.octet_length(col) == F.char_length(col)


def strip(col: Column) -> Column:
    """Remove Unicode whitespace from both ends (``trim`` knows only U+0020)."""
    return F.btrim(col, F.lit(WHITESPACE))


def collapse_spaces(col: Column) -> Column:
    """Turn every run of whitespace into one space and trim the ends."""
    return F.trim(F.regexp_replace(col, r"(?U)\s+", " "))


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def dash_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit("-"))


def null_to_blank(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def fold(col: Column) -> Column:
    """Key form used to compare place texts: lower case, no outer whitespace."""
    return strip(F.lower(col))


def title_words(col: Column, word: str = r"\p{L}") -> Column:
    """Upper-case the first character of every run of ``word`` characters.

    ``initcap`` starts words at spaces only.  A marker and a space are put
    before each run, so that ``initcap`` sees every run as a word of its own,
    and are taken out again afterwards.  With the default class a letter after
    any non-letter is raised (``O'Neil``, ``2Nd``).
    """
    marked = F.regexp_replace(
        F.lower(col), f"(?<!{word})(?={word})", "\u0001 "
    )
    return F.replace(F.initcap(marked), F.lit("\u0001 "), F.lit(""))


def annex_status(col: Column) -> Column:
    return fold(col)


def street_address(col: Column) -> Column:
    """Lower, strip dashes, drop placeholder texts, then title case.

    Words start after non-alphanumerics here, so ``2nd`` stays ``2nd``.
    """
    bare = F.regexp_replace(
        F.lower(collapse_spaces(col)), r"(?U)^[\s\-]+|[\s\-]+$", ""
    )
    kept = blank_to_null(F.regexp_replace(bare, ADDRESS_PLACEHOLDERS, ""))
    return title_words(kept, r"[\p{L}\p{N}]")

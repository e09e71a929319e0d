"""Normal forms of region, province, municipality and barangay names."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import collapse_spaces, is_ascii, let, strip

# Roman numerals one to ten.
ROMAN = ["I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X"]

# An N-tilde written in UTF-8 and read as Latin-1.
BROKEN_ENYE = "Ã‘"
ENYE = "Ñ"


@lru_cache(maxsize=1)
def _ascii_forms() -> tuple[str, str, dict[str, str]]:
    """ASCII form of every compatible character, from the Unicode tables.

    Returns the one-to-one characters, their replacements, and the characters
    that expand to several letters.  Characters without an ASCII form are not
    listed; they are dropped.
    """
    source, target, wide = [], [], {}
    for point in range(0x80, sys.maxunicode + 1):
        if 0xAC00 <= point <= 0xD7A3 or 0xD800 <= point <= 0xDFFF:
            continue
        char = chr(point)
        plain = unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode()
        if len(plain) == 1:
            source.append(char)
            target.append(plain)
        elif plain:
            wide[char] = plain
    return "".join(source), "".join(target), wide


def ascii_letters(col: Column) -> Column:
    """Replace accented and compatibility characters by their ASCII form.

    Plain ASCII rows skip the work.  Only rows that still hold other characters
    after the one-to-one replacement (a ligature, a fraction) are looked at one
    character at a time.
    """
    source, target, wide = _ascii_forms()
    # One literal, folded to an array once; no form holds the separator.
    forms = F.split(F.lit("\u0001".join(wide.values())), "\u0001")

    def expand(rest: Column) -> Column:
        spelled = F.transform(
            F.split(rest, ""),
            lambda ch: F.coalesce(
                F.get(forms, F.position(ch, F.lit("".join(wide))) - 1), ch
            ),
        )
        return F.regexp_replace(F.array_join(spelled, ""), r"[^\x00-\x7F]", "")

    return F.when(is_ascii(col), col).otherwise(
        let(
            F.translate(col, source, target),
            lambda rest: F.when(is_ascii(rest), rest).otherwise(expand(rest)),
        )
    )


def region_name(col: Column) -> Column:
    """Lower case, no bracketed text, letters and digits only, single spaces."""
    bare = F.regexp_replace(strip(F.lower(col)), r"\(.*?\)", "")
    return F.trim(F.regexp_replace(bare, "[^a-z0-9]+", " "))


def place_name(col: Column) -> Column:
    """Comparable form of a place name.

    ``Sto. Tomas`` gives ``santo tomas``; ``City of Manila`` gives
    ``manila city``; bracketed text, dots, commas and accents go.
    """
    plain = ascii_letters(strip(F.lower(col)))
    plain = strip(F.regexp_replace(plain, r"\(.*?\)", ""))
    plain = F.translate(plain, ".,", "")
    plain = F.regexp_replace(plain, r"\bst([oa])\b", "sant$1")
    plain = F.regexp_replace(plain, r"(?s)^city of \s*(.*?)\s*$", "$1 city")
    return collapse_spaces(plain)


def trailing_roman(col: Column) -> Column:
    """Write a Roman numeral I-X at the end of a name in Arabic digits."""
    ending = r"(?iU)\b(" + "|".join(ROMAN) + r")\b\.?$"

    def arabic(name: Column) -> Column:
        numeral = F.upper(F.regexp_extract(name, ending, 1))
        value = F.array_position(F.array(*[F.lit(r) for r in ROMAN]), numeral)
        return F.concat(F.regexp_replace(name, ending, ""), value.cast("string"))

    return let(
        col, lambda name: F.when(name.rlike(ending), arabic(name)).otherwise(name)
    )


def repair_enye(col: Column) -> Column:
    return F.replace(col, F.lit(BROKEN_ENYE), F.lit(ENYE))


def barangay_name(col: Column) -> Column:
    return trailing_roman(place_name(repair_enye(col)))

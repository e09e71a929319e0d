"""School names in one spelling.

The steps run in a fixed order inside one expression: no join, no shuffle, no
Python.  Most names need few of the rules, so each group of patterns stands
behind a cheap test on the name.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

from .places import ROMAN
from .text import collapse_spaces, let, strip, title_words

# Abbreviations that stay in capitals after title case.
ABBREVIATIONS = [
    "ES", "PS", "CES", "MES", "CS", "SPED", "JHS", "SHS", "NHS", "MHS", "HS", "IS",
    "NATL",
]

# Abbreviation patterns and their expansions, in order of use.
EXPANSIONS = [
    (r"\bES\b", "Elementary School"),
    (r"\bE/S\b", "Elementary School"),
    (r"\bElem\.?( School)?\b", "Elementary School"),
    (r"\bElem\b", "Elementary School"),
    (r"\bPS\b", "Primary School"),
    (r"\bC/S\b", "Central School"),
    (r"\bCS\b", "Central School"),
    (r"\bCES\b", "Central Elementary School"),
    (r"\bMES\b", "Memorial Elementary School"),
    (r"\bMem\.?\b", "Memorial"),
    (r"\bMeml\.?\b", "Memorial"),
    (r"\bJHS\b", "Junior High School"),
    (r"\bSHS\b", "Senior High School"),
    (r"\bNHS\b", "National High School"),
    (r"\bMHS\b", "Memorial High School"),
    (r"\bIS\b", "Integrated School"),
    (r"\bHS\b", "High School"),
    (r"(?i)\bNatl\b", "National"),
    (r"(?i)\bNational\b", "National"),
    (r"(?i)\bVoc'l\.?\b", "Vocational"),
    (r"(?i)\bInd'l\.?\b", "Industrial"),
    (r"(?i)\bAgro\b", "Agricultural"),
    (r"(?i)\bAgro-\b", "Agricultural-"),
]

# Phrases that are written once when they stand repeated.
REPEATED_MEMORIAL = ["Memorial Elementary School", "Memorial High School"]
REPEATED_ANY = [
    "Elementary School",
    "High School",
    "Integrated School",
    "Central School",
    "Central Elementary School",
    "Memorial Elementary School",
    "Memorial High School",
]


Rules = list[tuple[str, str]]


def _replace(col: Column, rules: Rules) -> Column:
    return reduce(lambda c, r: F.regexp_replace(c, "(?U)" + r[0], r[1]), rules, col)


def _replace_if(
    col: Column, holds: Callable[[Column], Column], rules: Rules
) -> Column:
    return let(col, lambda n: F.when(holds(n), _replace(n, rules)).otherwise(n))


def _replace_words(col: Column, rules: Rules) -> Column:
    """Rules that start at a word; one runs only where its first word occurs.

    Looking for a plain text costs a small part of a pattern search.
    """

    def step(name: Column, rule: tuple[str, str]) -> Column:
        starts = set(re.findall(r"\\b([A-Za-z/']+)", rule[0]))
        holds = [
            F.lower(name).contains(w.lower()) if "(?i)" in rule[0] else name.contains(w)
            for w in sorted(starts)
        ]
        return F.when(
            reduce(lambda a, b: a | b, holds), _replace(name, [rule])
        ).otherwise(name)

    return reduce(lambda c, rule: let(c, lambda n: step(n, rule)), rules, col)


def _repeats(phrases: list[str]) -> Rules:
    return [(rf"(?i)({p})(?:\s+{p})+", "$1") for p in phrases]


def _two_schools(name: Column) -> Column:
    return name.rlike(r"(?iU)school\s.*school")


def pre_clean(col: Column) -> Column:
    """Dots, spaces before punctuation, apostrophes, ``Nat'l`` and ``Ind'l``."""
    tidy = _replace(col, [(r"\.{2,}", "."), (r"\s+([.,&\-])", "$1")])
    tidy = F.translate(tidy, "’`", "''")
    tidy = _replace_if(
        tidy,
        lambda n: F.lower(n).contains("nat"),
        [(r"(?i)\bnat'?l(?:\.?l?)+", "Natl")],
    )
    return _replace_if(
        tidy,
        lambda n: F.lower(n).contains("agro"),
        [(r"(?i)\bAgro\s*[-–]\s*Ind'?l\.?", "Agricultural–Industrial")],
    )


def clean_spacing(col: Column) -> Column:
    return _replace(collapse_spaces(col), [(r"\s*[-–—]\s*", "-")])


def standardize_case(col: Column) -> Column:
    """Title case, with the known abbreviations put back in capitals."""
    written = [a.capitalize() for a in ABBREVIATIONS]
    rules = [(rf"\b{w}\b", a) for w, a in zip(written, ABBREVIATIONS)]
    return _replace_words(title_words(col), rules)


def expand_abbreviations(col: Column) -> Column:
    """The expansions in order; neighbours with one expansion share a pass."""
    rules = [
        ("|".join(f"(?:{pattern})" for pattern, _ in group), expansion)
        for expansion, group in groupby(EXPANSIONS, key=lambda rule: rule[1])
    ]
    return _replace_words(col, rules)


def roman_numerals(col: Column) -> Column:
    """Upper-case numerals i-x that stand as words; their dots go."""
    numerals = F.create_map(*[F.lit(x) for r in ROMAN for x in (r.lower(), r)])

    def raised(name: Column) -> Column:
        words = F.filter(F.split(name, r"(?U)\s+"), lambda w: w != "")
        plain = lambda w: F.lower(F.replace(w, F.lit("."), F.lit("")))
        return F.array_join(
            F.transform(words, lambda w: F.coalesce(numerals[plain(w)], w)), " "
        )

    candidate = r"(?iU)(?<!\S)[ivx.]+(?!\S)"
    return let(
        col, lambda n: F.when(n.rlike(candidate), raised(n)).otherwise(n)
    )


def memorial_once(col: Column) -> Column:
    dotless = _replace_if(
        col,
        lambda n: F.lower(n).contains("memorial."),
        [(r"(?i)Memorial\.", "Memorial")],
    )
    return _replace_if(dotless, _two_schools, _repeats(REPEATED_MEMORIAL))


def complete_school_type(col: Column) -> Column:
    """Add the missing ``School`` to a name that ends in its type.

    Only the text before the first comma is looked at.  A name that holds
    ``Elementary`` is not tried for ``High``, nor one with either of the two
    for ``Integrated``.
    """
    before = r"[^,]*"
    elementary = rf"{before}\bElementary\b"
    high = rf"{before}\bHigh\b"
    integrated = rf"{before}\bIntegrated\b"
    parted = _replace_if(
        col,
        lambda n: n.contains(","),
        [(rf"^\s*({before}?)\s*,\s*(.*?)\s*$", "$1, $2")],
    )
    return _replace_if(
        parted,
        lambda n: n.rlike("(Elementary|High|Integrated)(,|$)"),
        [
            (rf"^(?={elementary})({before})Elementary(?=,|$)", "$1Elementary School"),
            (rf"^(?!{elementary})(?={high})({before})High(?=,|$)", "$1High School"),
            (
                rf"^(?!{elementary})(?!{high})(?={integrated})({before})Integrated(?=,|$)",
                "$1Integrated School",
            ),
        ],
    )


def site_dash(col: Column) -> Column:
    return _replace(col, [(r"\s*[-–]\s*", "–")])


def finalize(col: Column) -> Column:
    return strip(_replace_if(col, _two_schools, _repeats(REPEATED_ANY)))


STEPS = [
    pre_clean,
    clean_spacing,
    standardize_case,
    expand_abbreviations,
    roman_numerals,
    memorial_once,
    complete_school_type,
    site_dash,
    finalize,
]


def clean_school_name(col: Column) -> Column:
    """All steps in order; null gives the empty text."""
    return reduce(lambda c, step: step(c), STEPS, F.coalesce(col, F.lit("")))

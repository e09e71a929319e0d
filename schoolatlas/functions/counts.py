"""Counts, identifiers and code arithmetic.

Source text never goes through a plain ``cast``: ANSI mode would fail the job
on the first bad cell.  A cell that does not parse becomes null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SPACES, blank_to_null, strip

CODE_LENGTH = 10
WHOLE = "^[0-9]+$"
DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def whole_count(col: Column) -> Column:
    """Student count: commas and outer spaces go, digits only, else null.

    The text is tested before it is cast: a cast that fails is caught as an
    exception, which costs far more than the pattern.
    """
    digits = F.regexp_extract(_bare(col.cast("string")), WHOLE, 0)
    return F.when(digits != "", digits.try_cast("bigint"))


def is_whole_count(col: Column) -> Column:
    return _bare(col).rlike(WHOLE)


def count_or_zero(col: Column) -> Column:
    """As ``whole_count``, with 0 for a cell that is no count.

    The column is mentioned once, so the expression can stand right behind an
    unpivot: generated code does not share a repeated part of one there.
    """
    return F.concat(F.lit("0"), F.regexp_extract(_bare(col), WHOLE, 0)).try_cast("bigint")


def _bare(col: Column) -> Column:
    """Without commas and outer white space (trimmed, as a pattern for Unicode's is far slower)."""
    return F.btrim(F.replace(col, F.lit(","), F.lit("")), F.lit(SPACES))


def decimal_text(col: Column) -> Column:
    """A cell as ``decimal_of`` reads it: without commas and outer white space."""
    return strip(F.replace(col, F.lit(","), F.lit("")))


def decimal_of(text: Column) -> Column:
    """The number of a ``decimal_text``; null for any other text."""
    return F.when(text.rlike(DECIMAL), text.try_cast("double"))


def lenient_double(col: Column) -> Column:
    """Decimal number text, commas ignored; anything else is null."""
    return decimal_of(decimal_text(col))


def lenient_long(col: Column) -> Column:
    """Integer text, or a decimal text with an integral value (``12.0``)."""
    text = strip(col)
    as_double = F.when(text.rlike(DECIMAL), text.try_cast("double"))
    return F.when(
        text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint")
    ).otherwise(F.when(as_double == F.floor(as_double), as_double.try_cast("bigint")))


def truncated_number(col: Column) -> Column:
    """Comma-grouped number text; fractions are cut, NaN and blanks are null."""
    return lenient_double(col).try_cast("bigint")


def count_as_long(col: Column) -> Column:
    return F.when(col.rlike(DECIMAL), col.try_cast("double")).try_cast("bigint")


def cell_text(col: Column) -> Column:
    """Workbook cell: the error text ``#N/A`` and the empty text are null."""
    return F.nullif(blank_to_null(col), F.lit("#N/A"))


def header_text(col: Column) -> Column:
    return blank_to_null(strip(col))


def digits_only(col: Column) -> Column:
    return F.regexp_replace(F.coalesce(col, F.lit("")), "[^0-9]", "")


def school_id_text(col: Column) -> Column:
    """Identifier as text: trimmed, ``.0`` of a float cell removed, blank null."""
    return blank_to_null(F.regexp_replace(strip(col), r"\.0$", ""))


def school_id_from(lis: Column, beis: Column) -> Column:
    """First identifier that is present, digits only; no digits gives ``0``."""
    digits = digits_only(school_id_text(F.coalesce(lis, beis)))
    return F.regexp_replace(F.concat(F.lit("0"), digits), "^0+(?=.)", "")


def place_code(col: Column) -> Column:
    """Code of a place as ten digits; a longer number is no code."""
    digits = F.when(col.rlike(DECIMAL), col.try_cast("decimal(20,0)")).cast("string")
    return F.when(F.length(digits) <= CODE_LENGTH, F.lpad(digits, CODE_LENGTH, "0"))


def region_part(code: Column) -> Column:
    return F.substring(code, 1, 2)


def province_part(code: Column) -> Column:
    return F.substring(code, 1, 5)


def municipality_part(code: Column) -> Column:
    return F.substring(code, 1, 7)


def municipality_of(code: Column) -> Column:
    """Municipality code that holds a barangay code."""
    return F.concat(municipality_part(code), F.lit("000"))


def _ten_digits(code: Column) -> Column:
    digits = F.ltrim(digits_only(code), F.lit("0"))
    return F.when(
        (digits_only(code) != "") & (F.length(digits) <= CODE_LENGTH), F.lpad(digits, CODE_LENGTH, "0")
    )


def province_scope(code: Column) -> Column:
    """Five-digit prefix that bounds the municipalities of a province or city."""
    return F.substring(_ten_digits(code), 1, 5)


def allowed_prefixes(code: Column) -> Column:
    """Prefixes under which a municipality of this province/city may stand.

    Five trailing zeros mark a province: five digits only.  Anything finer adds
    the seven-digit prefix.  A missing code allows no prefix (empty array).
    """
    ten = _ten_digits(code)
    five = F.substring(ten, 1, 5)
    return (
        F.when(ten.isNull(), F.array().cast("array<string>"))
        .when(ten.endswith("00000"), F.array(five))
        .otherwise(F.array(five, F.substring(ten, 1, 7)))
    )


def address_hash(*codes: Column) -> Column:
    """Sixty bits of the MD5 of the codes joined by ``|``, nulls as empty text."""
    joined = F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in codes])
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("bigint")


def school_year(file_name: Column) -> Column:
    """``yyyy-yyyy`` found in a file name; a name without one fails the query."""
    year = blank_to_null(F.regexp_extract(file_name, r"([0-9]{4}-[0-9]{4})", 1))
    return F.coalesce(
        year,
        F.raise_error(
            F.concat(F.lit("no school year in file name: "), file_name)
        ).cast("string"),
    )

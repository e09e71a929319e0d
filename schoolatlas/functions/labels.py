"""Column labels of the wide sources, parsed into grade, strand and sex."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_null, let, strip

LABEL_TYPE = "struct<grade:string,strand:string,sex:string>"


def _label(grade: Column, strand: Column | None, sex: Column) -> Column:
    empty = F.lit(None).cast("string")
    return F.struct(
        grade.alias("grade"),
        (empty if strand is None else strand).alias("strand"),
        sex.alias("sex"),
    )


def split_label(col: Column) -> Column:
    """``grade[_strand...]_sex`` as a struct.

    The first part is the grade and the last the sex; whatever lies between is
    the strand, underscores included.  A single part is a grade alone.
    """
    label = blank_to_null(col)
    grade = F.substring_index(label, "_", 1)
    sex = F.when(label.contains("_"), F.substring_index(label, "_", -1))
    between = F.length(label) - F.length(grade) - F.length(sex) - 1
    strand = F.when(
        between > 0, F.substring(label, F.length(grade) + 2, between - 1)
    )
    return _label(grade, strand, sex)


def _sex(is_male: Column, is_female: Column) -> Column:
    return F.when(is_female, "f").when(is_male, "m")


def _layout_2022(label: Column) -> Column:
    """``G11 ACAD - STEM Male Dropout``, ``K Female Dropout``, ``NG Elem ...``."""
    word = F.regexp_extract(label, "(Male|Female)", 1)
    senior = r"(?Us)^G(1[12])\s+(.+)$"

    def parse(base: Column) -> Column:
        strand = strip(F.lower(F.regexp_extract(base, senior, 2)))
        strand = F.regexp_replace(strand, r"(?U)^acad\s*-?\s*(?=.)", "")
        number = F.regexp_extract(base, r"^G(1[0-2]|[1-9])(?![0-9])", 1)
        grade = (
            F.when(base == "K", "kinder")
            .when(base.startswith("NG Elem"), "esng")
            .when(base.startswith("NG Second"), "jhsng")
            .when(number != "", F.concat(F.lit("g"), number))
        )
        return _label(
            grade,
            F.when(base.rlike(senior), strand),
            _sex(word == "Male", word == "Female"),
        )

    ending = r"(?U)\s+(Male|Female)\s+Dropout$"
    return let(strip(F.regexp_replace(label, ending, "")), parse)


def _layout_2023(label: Column) -> Column:
    """``Grade 4 Female``, ``Kindergarten Male``, ``Non-Graded Male``."""
    lower = F.lower(label)
    number = F.regexp_extract(lower, r"(?U)^grade\s+(1[0-2]|[1-9])(?!\d)", 1)
    grade = (
        F.when(lower.startswith("kindergarten"), "kinder")
        .when(lower.startswith("non-graded"), "esng")
        .when(number != "", F.concat(F.lit("g"), number))
    )
    return _label(grade, None, _sex(lower.endswith("male"), lower.endswith("female")))


def _layout_2024(label: Column) -> Column:
    """``dropout_g4_female``, ``dropout_k_male``, ``dropout_ng_male``."""
    lower = F.lower(label)
    pattern = "^dropout_([^_]+)_(male|female)"
    code = F.regexp_extract(lower, pattern, 1)
    word = F.regexp_extract(lower, pattern, 2)
    grade = (
        F.when(code == "k", "kinder")
        .when(code == "ng", "esng")
        .when(code.startswith("g"), code)
    )
    return _label(grade, None, _sex(word == "male", word == "female"))


DROPOUT_LAYOUTS = {"2022": _layout_2022, "2023": _layout_2023, "2024": _layout_2024}


def dropout_label(label: Column, layout: Column | str) -> Column:
    """Parse a dropout column label; grade, strand and sex come together.

    ``layout`` names the label style: a plain text fixed at plan time, or a
    column when rows of several years stand in one table.  A label that the
    style does not know gives nulls; an unknown style is an error.
    """
    if isinstance(layout, str):
        if layout not in DROPOUT_LAYOUTS:
            raise ValueError(f"unknown dropout label layout: {layout}")
        parsed = DROPOUT_LAYOUTS[layout](label)
    else:
        parsed = F.raise_error(
            F.concat(F.lit("unknown dropout label layout: "), layout)
        ).cast(LABEL_TYPE)
        for name, parse in DROPOUT_LAYOUTS.items():
            parsed = F.when(layout == name, parse(label)).otherwise(parsed)
    return let(
        parsed,
        lambda p: F.when(p["grade"].isNotNull() & p["sex"].isNotNull(), p),
    )


def teacher_position(col: Column) -> Column:
    """Older sheets say ``sped teacher ii`` for ``sped/sned teacher ii``."""
    return F.regexp_replace(
        col, r"(?U)^sped teacher\s+([iv]+)$", "sped/sned teacher $1"
    )

"""Yearly enrollment tables to school metadata, offered levels and counts.

All cleaning of a school's attributes happens on its wide row, before the
table is made some eighty times longer.  Metadata and levels never see the long
form, and the three outputs need no shared intermediate result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.counts import (
    count_or_zero,
    is_whole_count,
    school_id_text,
    whole_count,
)
from ..functions.school_names import clean_school_name
from ..functions.text import annex_status, collapse_spaces, street_address
from ..operators.cleaning import clean_locations
from ..operators.distinct import first_per_key
from ..operators.joins import per_distinct
from ..operators.quality import invalid_values, type_misfits, type_profile
from ..operators.reshape import (
    flags_to_levels,
    label_table,
    union_all,
    value_columns,
    wide_to_long,
)
from ..session import durable
from ..sources.csv_folder import fitting, misfits, read_yearly_csvs, stage_yearly

OFFERS = ["offers_es", "offers_jhs", "offers_shs"]
ATTRIBUTES = [
    "school_name", "sector", "school_management", "annex_status", "region",
    "province", "municipality", "barangay", "street_address",
    "legislative_district", "division", "school_district",
]
SPACED = [
    "province", "municipality", "barangay", "division", "school_district",
    "legislative_district", "school_name", "school_management",
]
IDS = ["school_year", "source_file", "school_id", *ATTRIBUTES, *OFFERS]
FACTS = ["school_year", "school_id", "grade", "sex", "strand", "num_students"]
META = ["school_year", "school_id", *ATTRIBUTES]


def clean_wide(wide: DataFrame) -> DataFrame:
    """Known columns present and cleaned, count columns as they come."""
    present = [
        (F.col(c) if c in wide.columns else F.lit(None).cast("string")).alias(c)
        for c in IDS
    ]
    texts: dict[str, Column] = {c: collapse_spaces(F.col(c)) for c in SPACED}
    return wide.select(*present, *value_columns(wide, IDS)).withColumns(
        texts
        | {
            "school_id": school_id_text(F.col("school_id")),
            "annex_status": annex_status(F.col("annex_status")),
            "street_address": street_address(F.col("street_address")),
        }
        | {c: F.col(c).try_cast("boolean") for c in OFFERS}
    )


def melt_enrollment(wide: DataFrame, ids: list[str]) -> DataFrame:
    """Non-zero counts with grade, strand and sex.

    Labels are column names: they are parsed once per column, in a table of as
    many rows, and not once per cell.
    """
    columns = value_columns(wide, IDS)
    long = wide_to_long(wide, ids, "label", "raw_count", columns)
    counted = long.select(
        *ids, "label", count_or_zero(F.col("raw_count")).alias("num_students")
    ).where("num_students > 0")
    # Broadcast: one row per column of the source file.
    labels = F.broadcast(label_table(wide.sparkSession, columns))
    return counted.join(labels, "label").drop("label")


def enrollment_facts(wides: list[DataFrame]) -> DataFrame:
    return union_all(
        [melt_enrollment(w, ["school_year", "school_id"]).select(*FACTS) for w in wides]
    )


def invalid_counts(wides: list[DataFrame]) -> DataFrame:
    """Per source file: cells that are no counts, with a few of their texts."""
    cells = union_all(
        [
            wide_to_long(w, ["source_file"], "label", "raw_count", value_columns(w, IDS))
            for w in wides
        ]
    )
    readable = is_whole_count(F.col("raw_count"))
    return invalid_values(cells, "source_file", "raw_count", readable)


def with_students(wide: DataFrame) -> DataFrame:
    """Rows with at least one non-zero count (identifier columns only)."""
    columns = value_columns(wide, IDS)
    if not columns:
        return wide.select(*IDS).limit(0)
    cells = F.array(*[F.col(c).cast("string") for c in columns])
    return wide.where(F.exists(cells, lambda cell: whole_count(cell) != 0)).select(*IDS)


def school_rows(wides: list[DataFrame], keep_empty_schools: bool = False) -> DataFrame:
    kept = [w.select(*IDS) if keep_empty_schools else with_students(w) for w in wides]
    return union_all(kept)


def school_year_meta(schools: DataFrame, rules: dict) -> DataFrame:
    """One row per school and year with cleaned names."""
    one = first_per_key(schools.select(*META), ["school_year", "school_id"])
    return with_clean_names(clean_locations(one, rules))


def with_clean_names(meta: DataFrame) -> DataFrame:
    """Clean school names; a school keeps its name over years, so each once."""
    return per_distinct(
        meta,
        ["school_name"],
        lambda names: names.withColumn(
            "school_name", clean_school_name(F.col("school_name"))
        ),
    )


def offered_levels(schools: DataFrame, upper: bool = False) -> DataFrame:
    """Every year of a school with the levels its latest row offers.

    One aggregate holds both the latest flags and the set of years, so no join
    is needed; the years of one school are few by nature.
    """
    latest = F.max(F.struct("school_year", *OFFERS))
    per_school = schools.groupBy("school_id").agg(
        latest.alias("latest"), F.collect_set("school_year").alias("years")
    )
    pairs = per_school.select(
        "school_id",
        F.explode("years").alias("school_year"),
        *[F.col(f"latest.{c}").alias(c) for c in OFFERS],
    )
    return flags_to_levels(pairs, ["school_id", "school_year"], upper)


def offered_levels_from_meta(
    meta: DataFrame, enrollment: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(metadata without flags, levels of every enrolled school and year).

    Flags come from the metadata rows of a school, one row per school; labels
    are in upper case here.
    """
    flags = first_per_key(meta.select("school_id", *OFFERS), ["school_id"])
    pairs = enrollment.select("school_id", "school_year").distinct()
    joined = pairs.join(flags, "school_id", "left")
    levels = flags_to_levels(joined, ["school_id", "school_year"], upper=True)
    return meta.drop(*OFFERS), levels


def read_enrollment(
    spark: SparkSession, folder: str, latest_only: bool = False
) -> list[DataFrame]:
    return [clean_wide(w) for w in read_yearly_csvs(spark, folder, latest_only)]


def enrollment_tables(
    spark: SparkSession,
    folder: str,
    rules: dict,
    latest_only: bool = False,
    keep_empty_schools: bool = False,
    store: Callable[[DataFrame], DataFrame] = durable,
) -> dict[str, DataFrame]:
    """Metadata, counts and levels of a folder of yearly CSV files.

    The files are parsed once; all tables, audits among them, read the columns they need of the
    stored copy.
    """
    staged = stage_yearly(spark, folder, latest_only, store)
    wides = [clean_wide(w) for w in fitting(staged)]
    schools = school_rows(wides, keep_empty_schools)
    return {
        "school_year_meta": school_year_meta(schools, rules),
        "enrollment": enrollment_facts(wides),
        "school_levels": offered_levels(schools),
        "invalid_counts": invalid_counts(wides),
        "csv_rejects": misfits(staged),
        "type_misfits": type_misfits(type_profile(fitting(staged), "source_file", ["school_year"]), "source_file"),
    }

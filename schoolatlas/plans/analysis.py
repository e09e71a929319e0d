"""Questions analysts ask of the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows_per_school_year(df: DataFrame) -> DataFrame:
    return df.groupBy("school_year", "school_id").agg(F.count("*").alias("num_records"))


def schools_per_year(df: DataFrame, management: str) -> DataFrame:
    """Distinct schools of one management type by year.

    Spark counts distinct pairs first and years after, so a year that holds
    most rows is spread over many tasks.
    """
    return (
        df.where(F.col("school_management") == management)
        .groupBy("school_year")
        .agg(F.count_distinct("school_id").alias("num_schools"))
    )


def schools_per_year_estimate(df: DataFrame, management: str) -> DataFrame:
    """As ``schools_per_year``, by sketch: one pass without a distinct shuffle."""
    return (
        df.where(F.col("school_management") == management)
        .groupBy("school_year")
        .agg(F.approx_count_distinct("school_id").alias("num_schools"))
    )


#: Buckets of a sketch, as a power of two; counts are within ``SKETCH_ERROR`` (three standard errors).
SKETCH_BITS, SKETCH_ERROR = 14, 0.025


def school_sketches(df: DataFrame) -> DataFrame:
    """(school_year, school_management, schools): a mergeable sketch of each group's distinct schools.

    Stored once, some kilobytes a row; any union of years and types is then a
    question to these rows and not to the schools.
    """
    return df.groupBy("school_year", "school_management").agg(
        F.hll_sketch_agg("school_id", SKETCH_BITS).alias("schools")
    )


def schools_from_sketches(sketches: DataFrame, *by: str) -> DataFrame:
    """Distinct schools by any of the sketches' columns, schools of several groups counted once."""
    united = sketches.groupBy(*by).agg(F.hll_union_agg("schools").alias("schools"))
    return united.withColumn("schools", F.hll_sketch_estimate("schools")).withColumnRenamed("schools", "num_schools")


def unmatched_barangays(meta: DataFrame) -> DataFrame:
    """Barangay names without a code, most frequent first."""
    return (
        meta.where(F.col("psgc_brgy_id").isNull())
        .groupBy("psgc_muni_id", "barangay")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "psgc_muni_id", "barangay")
    )


def search_places(codes: DataFrame, text: str, municipality: str, geo: str = "Bgy") -> DataFrame:
    """Places of a municipality whose present or former name holds a text."""
    wanted = F.lit(text.lower())
    named = F.lower("name").contains(wanted) | F.lower("old_names").contains(wanted)
    return codes.where(
        (F.col("geo") == geo) & F.col("id").startswith(municipality[:7]) & named
    )


def with_conformed_sex(df: DataFrame) -> DataFrame:
    """``male``/``female`` in every table; dropout facts say ``m`` and ``f``."""
    sex = F.col("sex")
    return df.withColumn(
        "sex", F.when(sex == "m", "male").when(sex == "f", "female").otherwise(sex)
    )

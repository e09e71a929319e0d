"""Teacher workbooks to headcounts by position."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.counts import lenient_long, school_id_from
from ..functions.labels import teacher_position
from ..operators.quality import require_rows
from ..session import durable
from ..sources.layouts import TEACHER_LAYOUTS, Layout
from ..sources.sheets import check_sheets, labelled_rows
from ..sources.workbook import read_workbooks

LIS = "lis school id"
BEIS = "beis school id"
FACTS = ["school_year", "school_id", "level", "position", "num"]


def melt_teachers(rows: DataFrame) -> DataFrame:
    """Non-zero headcounts of labelled rows.

    The school is named by either of two id columns, the first that is filled;
    every other column is a position.
    """
    labels = F.transform("column_labels", lambda c: F.lower(F.trim(c)))
    named = rows.withColumn("cells", F.map_from_arrays(labels, "values"))
    has_id = F.array_contains(labels, LIS) | F.array_contains(labels, BEIS)
    school = F.when(
        has_id,
        school_id_from(F.try_element_at("cells", F.lit(LIS)), F.try_element_at("cells", F.lit(BEIS))),
    ).otherwise(F.raise_error(F.concat(F.lit("no school id column in "), "source_file")).cast("string"))
    cells = named.select(
        "school_year",
        "level",
        school.alias("school_id"),
        F.explode(
            F.map_filter("cells", lambda label, _: ~label.isin(LIS, BEIS))
        ).alias("position", "raw"),
    )
    return cells.select(
        "school_year",
        "school_id",
        "level",
        teacher_position(F.col("position")).alias("position"),
        lenient_long(F.col("raw")).alias("num"),
    ).where("num <> 0")


def judge_teachers(facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without a usable school id (``0``) are set aside."""
    return facts.where("school_id <> '0'"), facts.where("school_id = '0'")


def teacher_tables(
    spark: SparkSession, folder: str, layouts: list[Layout] = TEACHER_LAYOUTS
) -> dict[str, DataFrame]:
    """Headcounts and rejects of every workbook of a folder."""
    grid = read_workbooks(spark, folder, sorted({l.sheet for l in layouts}))
    grid = durable(grid.repartition("source_file", "row_idx"))
    require_rows(grid, f"teacher workbooks in {folder}")
    check_sheets(grid, layouts)
    facts, rejected = judge_teachers(melt_teachers(labelled_rows(grid, layouts)))
    return {"teachers": require_rows(facts, "teacher reading"), "teacher_rejects": rejected}

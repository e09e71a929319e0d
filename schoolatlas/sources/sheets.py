"""From workbook rows to long tables, by layout.

The layouts are a small table joined to the rows on (school year, sheet), so
sheets of all years and levels go through one plan.  A sheet holds at most
1,048,576 rows, which bounds what shares one header.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.counts import cell_text, school_year
from ..operators.reshape import (
    forward_fill,
    joined_headers,
    named_headers,
    unique_headers,
)
from .layouts import Layout
from .workbook import column_indexes

SHEET = ["source_file", "sheet"]


def layout_table(grid: DataFrame, layouts: list[Layout]) -> DataFrame:
    rows = [
        (
            l.school_year, l.sheet, column_indexes(l.columns), l.header_start,
            l.header_rows, l.data_start, l.level, l.id_label, l.labels,
        )
        for l in layouts
    ]
    return grid.sparkSession.createDataFrame(
        rows,
        "school_year string, sheet string, indexes array<int>, header_start int,"
        " header_rows int, data_start int, level string, id_label string, labels string",
    )


def check_sheets(grid: DataFrame, layouts: list[Layout]) -> None:
    """Raise when a workbook's year has no layout or a sheet of it is missing."""
    heights = grid.groupBy(*SHEET).agg(F.max("row_idx").alias("last"))
    files = heights.select("source_file").distinct().withColumn(
        "school_year", school_year(F.col("source_file"))
    )
    # The layouts are a list in driver memory: a handful of rows.
    wanted = F.broadcast(layout_table(grid, layouts))
    found = files.join(wanted, "school_year", "left").join(heights, SHEET, "left")
    problem = (
        F.when(
            F.col("sheet").isNull(),
            F.concat(F.lit("no layout for school year "), "school_year"),
        )
        .when(F.col("last").isNull(), F.concat(F.lit("sheet "), "sheet", F.lit(" is missing")))
        .when(
            F.col("header_start") > F.col("last"),
            F.concat(F.lit("the header row is beyond sheet "), "sheet"),
        )
    )
    first = (
        found.select("source_file", problem.alias("problem"))
        .where("problem IS NOT NULL")
        .take(1)
    )
    if first:
        raise ValueError(f"{first[0]['problem']} in {first[0]['source_file']}")


def labelled_rows(
    grid: DataFrame,
    layouts: list[Layout],
    parse: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """Data rows with the column labels and the chosen cells as arrays.

    A header of several rows is filled to the right before its rows are joined
    by spaces.  Blank labels are named by position, repeated ones numbered, and
    a layout's ``id_label`` replaces the first label.

    ``parse(label, style)`` is applied to each label of a header, so once per
    column and not once per cell; its answers go along as ``label_parts``.
    """
    # The layouts are a list in driver memory: a handful of rows.
    table = F.broadcast(layout_table(grid, layouts))
    placed = grid.withColumn("school_year", school_year(F.col("source_file"))).join(
        table, ["school_year", "sheet"]
    )
    in_header = F.col("row_idx").between(
        F.col("header_start"), F.col("header_start") + F.col("header_rows") - 1
    )
    clean = F.transform("cells", cell_text)
    # A few header rows per sheet meet here, never its data.
    headers = (
        placed.where(in_header)
        .groupBy(*SHEET, "level")
        .agg(
            F.first("indexes").alias("indexes"),
            F.first("id_label").alias("id_label"),
            F.first("header_rows").alias("header_rows"),
            F.first("labels").alias("style"),
            F.array_sort(F.collect_list(F.struct("row_idx", clean.alias("cells")))).alias("rows"),
        )
        .withColumn("rows", F.col("rows.cells"))
        .withColumn(
            "all_labels",
            F.when(F.col("header_rows") == 1, F.col("rows")[0]).otherwise(
                joined_headers(F.transform("rows", forward_fill))
            ),
        )
        .withColumn(
            "chosen", F.transform("indexes", lambda i: F.get("all_labels", i))
        )
        .withColumn("chosen", unique_headers(named_headers(F.col("chosen"), F.col("indexes"))))
        .select(
            *SHEET,
            "level",
            F.when(F.col("id_label") == "", F.col("chosen"))
            .otherwise(
                F.concat(F.array("id_label"), F.slice("chosen", F.lit(2), F.greatest(F.size("chosen") - 1, F.lit(0))))
            )
            .alias("column_labels"),
            "style",
        )
    )
    if parse is not None:
        headers = headers.withColumn(
            "label_parts",
            F.transform("column_labels", lambda label: parse(label, F.col("style"))),
        )
    data = placed.where(F.col("row_idx") >= F.col("data_start")).select(
        *SHEET,
        "level",
        "school_year",
        (F.col("row_idx") + 1).cast("bigint").alias("source_row"),
        F.transform("indexes", lambda i: cell_text(F.get("cells", i))).alias("values"),
    )
    return data.join(headers.drop("style"), [*SHEET, "level"])

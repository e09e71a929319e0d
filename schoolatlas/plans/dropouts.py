"""Dropout workbooks to facts, rejects and run metrics."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.counts import decimal_of, decimal_text, school_id_text
from ..functions.labels import dropout_label
from ..operators.distinct import last_per_key
from ..operators.quality import split_rejects
from ..session import durable
from ..sources.layouts import DROPOUT_LAYOUTS, Layout
from ..sources.sheets import check_sheets, labelled_rows
from ..sources.workbook import read_workbooks

KEY = ["school_year", "school_id", "grade", "strand", "sex"]
FACTS = [*KEY, "num_dropouts", "source_file", "source_row", "ingested_at"]


def melt_sheet(rows: DataFrame) -> DataFrame:
    """Cells of labelled rows with a count of one or more.

    The first cell of a row is the school; every other cell is a count under a
    label that has been parsed with its header.
    """
    cells = F.arrays_zip("column_labels", "label_parts", "values")
    # The generator's rows are taken apart before the count is parsed, so that
    # parsing is generated code.
    taken = rows.select(
        "school_year",
        school_id_text(F.element_at("values", 1)).alias("school_id"),
        F.posexplode(F.slice(cells, F.lit(2), F.greatest(F.size(cells) - 1, F.lit(0)))).alias("col_pos", "cell"),
        "source_file",
        "source_row",
    )
    return taken.select(
        "school_year",
        "school_id",
        "cell.label_parts.*",
        # A column of its own: the parser looks at the text twice.
        decimal_text(F.col("cell.values")).alias("_text"),
        F.col("cell.column_labels").alias("raw_col"),
        F.col("cell.values").alias("raw_count"),
        "col_pos",
        "source_file",
        "source_row",
    ).where("_text <> ''").withColumn("num_dropouts", decimal_of(F.col("_text")).try_cast("bigint")).select(
        "school_year", "school_id", "grade", "strand", "sex", "num_dropouts", "raw_col", "raw_count",
        "col_pos", "source_file", "source_row",
    ).where("num_dropouts >= 1")


def judge(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with a reason)."""
    return split_rejects(
        parsed,
        {
            "label": F.col("grade").isNull(),
            "school id": F.col("school_id").isNull(),
        },
    )


def latest_facts(valid: DataFrame) -> DataFrame:
    """Last occurrence per key in reading order: by column, then by row."""
    picked = last_per_key(
        valid.select(*FACTS, "col_pos"), KEY, F.col("col_pos"), F.col("source_row")
    )
    return picked.select(*FACTS)


def dropout_metrics(parsed: DataFrame, read: DataFrame | None = None) -> DataFrame:
    """One row of run counters, in two small aggregates.

    ``read`` names the files read (``source_file``), those without a count too.

    Rows are counted per key before anything is compared across the table, so
    the number of duplicates needs no distinct over wide rows.
    """
    ok = F.col("grade").isNotNull() & F.col("school_id").isNotNull()
    per_key = parsed.groupBy("source_file", ok.alias("ok"), *KEY).agg(
        F.count("*").alias("rows")
    )
    if read is not None:
        files = read.select("source_file").distinct().withColumn("rows", F.lit(0).cast("bigint"))
        per_key = per_key.unionByName(files, allowMissingColumns=True)
    return per_key.agg(
        F.count_distinct("source_file").alias("dropouts_files"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("dropouts_rows_melted"),
        F.count_if("ok").alias("dropouts_valid_rows"),
        F.coalesce(F.sum(F.when(~F.col("ok"), F.col("rows"))), F.lit(0)).alias(
            "dropouts_invalid_rows"
        ),
        F.coalesce(F.sum(F.when(F.col("ok"), F.col("rows") - 1)), F.lit(0)).alias(
            "dropouts_duplicates_removed"
        ),
    )


def dropout_tables(
    spark: SparkSession, folder: str, layouts: list[Layout] = DROPOUT_LAYOUTS
) -> dict[str, DataFrame]:
    """Facts, rejects and metrics of one ``<year>-dropouts.xlsx`` per layout."""
    paths = [f"{folder.rstrip('/')}/{l.school_year}-dropouts.xlsx" for l in layouts]
    # Parsed once and stored: headers, facts, rejects and metrics all read it.
    # A workbook is read by one task; its rows are spread before anything else.
    grid = read_workbooks(spark, paths, sorted({l.sheet for l in layouts}))
    grid = durable(grid.repartition("source_file", "row_idx"))
    check_sheets(grid, layouts)
    melted = melt_sheet(labelled_rows(grid, layouts, parse=dropout_label))
    # Counted while it is written: facts and rejects read the stored cells, metrics read nothing.
    cells, kept = Observation(), Observation()
    ok = F.col("grade").isNotNull() & F.col("school_id").isNotNull()
    parsed = durable(melted.observe(cells, F.count("*").alias("rows"), F.count_if(ok).alias("ok")))
    if not cells.get["ok"]:
        raise ValueError("dropout reading produced no rows")
    valid, rejected = judge(parsed)
    stamped = valid.withColumn("ingested_at", F.lit(datetime.now(timezone.utc)))
    facts = durable(latest_facts(stamped).observe(kept, F.count("*").alias("rows")))
    counted = {
        "dropouts_files": len(paths),
        "dropouts_rows_melted": cells.get["rows"],
        "dropouts_valid_rows": kept.get["rows"],
        "dropouts_invalid_rows": cells.get["rows"] - cells.get["ok"],
        "dropouts_duplicates_removed": cells.get["ok"] - kept.get["rows"],
    }
    metrics = spark.createDataFrame([tuple(counted.values())], ", ".join(f"{name} long" for name in counted))
    return {"dropouts": facts, "dropout_rejects": rejected, "dropout_metrics": metrics}

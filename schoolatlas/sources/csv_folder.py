"""CSV sources, read as text: no type is guessed from the data.

Quotes within a quoted field are doubled; a quoted field may hold line breaks
(``records`` finds where such a record ends).  A record with more or fewer fields
than its header is no row: it goes to the rejects.  Every file is parsed once,
into a stored copy that all later steps read by column.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.counts import lenient_double, school_id_text, school_year
from ..session import durable
from .records import csv_headers, read_records

BAD_LINE = "_bad_line"
#: Options of every CSV source; ``from_csv`` takes the same.
OPTIONS = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE}


def parse_record(record: Column, header: tuple[str, ...]) -> Column:
    """A record as a struct of texts; ``_bad_line`` holds a record that does not fit the header."""
    schema = StructType([StructField(c, StringType()) for c in (*header, BAD_LINE)])
    return F.from_csv(record, schema.toDDL(), OPTIONS)


def read_table(
    spark: SparkSession,
    paths: list[str],
    header: tuple[str, ...],
    store: Callable[[DataFrame], DataFrame] = durable,
) -> DataFrame:
    """(file, name, row) of files with one header."""
    return read_records(spark, paths, lambda record: parse_record(record, header), store)


def stage_yearly(
    spark: SparkSession,
    folder: str,
    latest_only: bool = False,
    store: Callable[[DataFrame], DataFrame] = durable,
) -> list[DataFrame]:
    """Yearly files as one stored DataFrame (name, row) per distinct header, rejects included."""
    headers = csv_headers(spark, folder)
    if not headers:
        raise ValueError(f"no CSV files in {folder}")
    if headers[0][1][0].endswith(folder.rstrip("/").rpartition("/")[2]):
        raise ValueError(f"expected a folder, got a file: {folder}")
    if latest_only:
        name, path, header = max((p.rpartition("/")[2], p, h) for h, paths in headers for p in paths)
        headers = [(header, [path])]
    return [read_table(spark, paths, header, store) for header, paths in headers]


def fitting(staged: list[DataFrame]) -> list[DataFrame]:
    """The rows that fit, with ``school_year`` and ``source_file`` from the file name."""
    return [
        t.where(F.col("row").isNotNull() & F.col("row")[BAD_LINE].isNull())
        .select(school_year(F.col("name")).alias("school_year"), F.col("name").alias("source_file"), "row.*")
        .drop(BAD_LINE)
        for t in staged
    ]


def misfits(staged: list[DataFrame]) -> DataFrame:
    """(source_file, line) of the records that do not fit their header."""
    bad = [
        t.select(F.col("name").alias("source_file"), F.col("row")[BAD_LINE].alias("line")).where("line IS NOT NULL")
        for t in staged
    ]
    out = bad[0]
    for other in bad[1:]:
        out = out.unionByName(other)
    return out


def read_yearly_csvs(spark: SparkSession, folder: str, latest_only: bool = False) -> list[DataFrame]:
    """Yearly files as one DataFrame per distinct header.

    Each carries ``school_year`` and ``source_file`` from the file name.
    """
    return fitting(stage_yearly(spark, folder, latest_only))


def rejected_lines(spark: SparkSession, folder: str, latest_only: bool = False) -> DataFrame:
    """(source_file, line) of the records that do not fit their header."""
    return misfits(stage_yearly(spark, folder, latest_only))


def read_coordinates(spark: SparkSession, path: str) -> DataFrame:
    """(school_id, longitude, latitude) of a coordinate list."""
    (header, paths), *others = csv_headers(spark, path)
    if others:
        raise ValueError(f"files of different headers in {path}")
    (table,) = fitting([read_table(spark, paths, header)])
    return table.select(
        school_id_text(F.col("id")).alias("school_id"),
        lenient_double(F.col("longitude")).alias("longitude"),
        lenient_double(F.col("latitude")).alias("latitude"),
    )

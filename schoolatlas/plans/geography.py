"""Place codes, address dimension and the geography table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.counts import address_hash, cell_text, place_code
from ..functions.text import dash_to_null, null_to_blank
from ..operators.distinct import first_per_key
from ..operators.joins import lookup_join
from ..operators.matching import PLACE_IDS
from ..operators.ordinals import with_ordinal
from ..operators.quality import require_rows
from ..sources.layouts import PLACE_COLUMNS, PLACE_POSITIONS, PLACE_SHEET
from ..sources.workbook import cells_at, read_workbooks


def clean_place_codes(raw: DataFrame) -> DataFrame:
    """Ten-digit ids, no dashes, former names for provinces, plain classes.

    Dashes go first, so that a province whose former name is ``-`` keeps its
    present one.
    """
    texts = {c: dash_to_null(F.col(f"`{c}`")) for c in PLACE_COLUMNS}
    former = (F.col("geo") == "Prov") & F.col("old_names").isNotNull()
    return raw.withColumns(texts).withColumns(
        {
            "id": place_code(F.col("id")),
            "name": F.when(former, F.col("old_names")).otherwise(F.col("name")),
            "income_class": F.replace(
                null_to_blank(F.col("income_class")), F.lit("*"), F.lit("")
            ),
            "city_class": null_to_blank(F.col("city_class")),
        }
    )


def read_place_codes(spark: SparkSession, path: str) -> DataFrame:
    """The place table of a workbook, columns taken by position.

    A sheet of ten or fewer columns is taken as it stands.
    """
    grid = read_workbooks(spark, path, [PLACE_SHEET])
    header = require_rows(
        grid.where("row_idx = 0").select(F.size("cells").alias("width")),
        f"sheet {PLACE_SHEET} of {path}",
    ).first()
    positions = PLACE_POSITIONS if header["width"] > 10 else list(range(10))
    cells = F.transform(cells_at(positions), cell_text)
    rows = grid.where("row_idx > 0").select(cells.alias("c"))
    return clean_place_codes(
        rows.select(*[F.col("c")[i].alias(n) for i, n in enumerate(PLACE_COLUMNS)])
    )


def with_address_hash(meta: DataFrame) -> DataFrame:
    return meta.withColumn("_addr_hash", address_hash(*[F.col(c) for c in PLACE_IDS]))


def address_dimension(hashed: DataFrame) -> DataFrame:
    """Distinct addresses, numbered in the order of their codes."""
    distinct = first_per_key(hashed.select(*PLACE_IDS, "_addr_hash"), ["_addr_hash"])
    order = [F.asc_nulls_first(c) for c in [*PLACE_IDS, "_addr_hash"]]
    return with_ordinal(distinct, "address_id", *order)


def address_bridge(hashed: DataFrame, dimension: DataFrame) -> DataFrame:
    """(school, year, address) without repeats."""
    uses = hashed.select("school_id", "school_year", "_addr_hash").distinct()
    return lookup_join(uses, dimension.select("_addr_hash", "address_id"), ["_addr_hash"])


def with_coordinates(meta: DataFrame, coordinates: DataFrame) -> DataFrame:
    """Longitude and latitude by school; a school listed twice counts once."""
    one = first_per_key(coordinates, ["school_id"])
    return lookup_join(meta, one, ["school_id"])


def geography(
    hashed: DataFrame, dimension: DataFrame, coordinates: DataFrame
) -> DataFrame:
    """School-year rows with coordinates and address key.

    The address key is a function of the hash, so it comes from the dimension;
    the bridge, which is as long as the table, need not be joined.
    """
    placed = with_coordinates(hashed, coordinates)
    return lookup_join(placed, dimension.select("_addr_hash", "address_id"), ["_addr_hash"])

"""Wide to long, headers, and unions of tables that differ in columns."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.counts import header_text
from ..functions.labels import split_label
from ..functions.text import let


def value_columns(df: DataFrame, ids: list[str]) -> list[str]:
    """All columns that are not identifiers, in table order."""
    return [c for c in df.columns if c not in ids]


def wide_to_long(
    df: DataFrame,
    ids: list[str],
    name: str,
    value: str,
    values: list[str] | None = None,
) -> DataFrame:
    """One row per identifier row and value column; values become text.

    Unpivot needs one type for all values, and source cells are text anyway.
    It is a map-side expansion: no shuffle.
    """
    values = value_columns(df, ids) if values is None else values
    texts = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in values])
    return texts.unpivot(ids, values, name, value)


def label_table(spark: SparkSession, labels: list[str]) -> DataFrame:
    """Grade, strand and sex of each label: one row per column of a source."""
    table = spark.createDataFrame([(label,) for label in labels], "label string")
    return with_label_parts(table, "label")


def with_label_parts(df: DataFrame, label: str) -> DataFrame:
    """Add grade, strand and sex columns parsed from a compound label."""
    return df.withColumn("_parts", split_label(F.col(label))).select(
        *df.columns, "_parts.*"
    )


def flags_to_levels(df: DataFrame, ids: list[str], upper: bool = False) -> DataFrame:
    """``offers_<level>`` flag columns as (level, offered) rows."""
    flags = [c for c in df.columns if c.startswith("offers_")]
    level = F.regexp_replace("level", "^offers_", "")
    return df.unpivot(ids, flags, "level", "offered").withColumn(
        "level", F.upper(level) if upper else F.lower(level)
    )


def _runs(starts: Column, size: Column) -> Column:
    """(start, end) of the runs that begin at the given places, one before the first place included."""
    return F.arrays_zip(
        F.concat(F.array(F.lit(0)), starts).alias("start"), F.concat(starts, F.array(size)).alias("end")
    )


def _where(array: Column, holds: Callable[[Column], Column]) -> Column:
    """Places of an array at which ``holds(place)`` is true."""
    places = F.transform(array, lambda _, i: F.when(holds(i), i))
    return F.filter(places, lambda i: i.isNotNull())


def forward_fill(cells: Column) -> Column:
    """Array in which a blank cell takes the last text before it.

    The cells from one text to the next repeat it, so a row of any width is gone through once.
    """

    def filled(texts: Column) -> Column:
        runs = _runs(_where(texts, lambda i: F.get(texts, i).isNotNull()), F.size(texts))
        return F.flatten(F.transform(runs, lambda r: F.array_repeat(F.get(texts, r["start"]), r["end"] - r["start"])))

    return let(F.transform(cells, header_text), filled)


def joined_headers(rows: Column) -> Column:
    """Header tokens of several rows (array of arrays) joined column by column."""
    width = F.array_max(F.transform(rows, F.size))
    positions = F.sequence(F.lit(0), F.greatest(width - 1, F.lit(0)))
    return F.transform(
        positions,
        lambda i: F.trim(
            F.regexp_replace(
                F.array_join(F.transform(rows, lambda row: F.get(row, i)), " "),
                r"(?U)\s+",
                " ",
            )
        ),
    )


def named_headers(labels: Column, indexes: Column) -> Column:
    """Blank labels become ``column_<sheet index>``."""
    return F.zip_with(
        labels,
        indexes,
        lambda label, i: F.coalesce(
            header_text(label), F.concat(F.lit("column_"), i.cast("string"))
        ),
    )


def unique_headers(labels: Column) -> Column:
    """The second and later uses of a label get ``_1``, ``_2`` ...

    Labels are sorted with their places, numbered in each run of equals, and sorted back.
    """

    def ranked(ordered: Column) -> Column:
        starts = _where(ordered, lambda j: (j > 0) & ~F.get(ordered, j)["label"].eqNullSafe(F.get(ordered, j - 1)["label"]))
        ranks = F.flatten(
            F.transform(_runs(starts, F.size(ordered)), lambda r: F.sequence(F.lit(0), r["end"] - r["start"] - 1))
        )
        placed = F.zip_with(ordered, ranks, lambda o, rank: F.struct(o["place"], rank.alias("rank"), o["label"]))
        return F.transform(
            F.array_sort(placed),
            lambda p: F.when(p["rank"] > 0, F.concat(p["label"], F.lit("_"), p["rank"].cast("string"))).otherwise(p["label"]),
        )

    places = F.transform(labels, lambda label, i: F.struct(label.alias("label"), i.alias("place")))
    return F.when(F.size(labels) == 0, labels).otherwise(let(F.array_sort(places), ranked))


def coerce_to(df: DataFrame, schema: StructType) -> DataFrame:
    """Give a table the columns and types of ``schema``; extra columns stay.

    The cast is strict: a value that does not fit fails the query.
    """
    wanted = [
        (F.col(f.name) if f.name in df.columns else F.lit(None))
        .cast(f.dataType)
        .alias(f.name)
        for f in schema.fields
    ]
    extra = [c for c in df.columns if c not in schema.names]
    return df.select(*wanted, *extra)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by column name; columns a table lacks are null in its rows."""
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), frames
    )


def union_coerced(frames: list[DataFrame]) -> DataFrame:
    """Union in which the first table sets the types of the later ones."""
    first = frames[0].schema
    return union_all([frames[0], *[coerce_to(f, first) for f in frames[1:]]])


def leading_columns(df: DataFrame, leading: list[str]) -> DataFrame:
    """The named columns first, the others after them in table order."""
    return df.select(
        *[c for c in leading if c in df.columns],
        *[c for c in df.columns if c not in leading],
    )

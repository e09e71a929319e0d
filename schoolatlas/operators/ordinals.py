"""Consecutive numbers over an ordered table, without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable
from .joins import lookup_join

ROW_BITS = 33


def with_ordinal(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """Number the rows 1, 2, 3 ... in the given (total) order.

    The table is split into ranges of the order and each range is numbered on
    its own.  The only data that meets in one place is one count per range.
    The numbered ranges are stored once, because a second evaluation of a range
    split could cut elsewhere.
    """
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    marked = durable(ranges.withColumn("_mark", F.monotonically_increasing_id()))
    part = F.shiftright("_mark", ROW_BITS)
    within = F.col("_mark").bitwiseAND((1 << ROW_BITS) - 1)

    sizes = marked.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    # One row per range partition, so its size is the partition count.
    return (
        marked.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + within + 1)
        .drop("_mark", "_part", "_offset")
    )


def with_group_ordinal(
    df: DataFrame, name: str, group: str, *order: Column
) -> DataFrame:
    """Number the rows of each group 1, 2, 3 ...; rows without a group get 0.

    The group's first overall number is taken off the row's overall number, so
    a group of any size stays spread over the range partitions.
    """
    numbered = with_ordinal(df, "_all", F.asc_nulls_first(group), *order)
    starts = numbered.groupBy(group).agg(F.min("_all").alias("_first"))
    return (
        lookup_join(numbered, starts, [group])
        .withColumn(
            name,
            F.coalesce(F.col("_all") - F.col("_first") + 1, F.lit(0)).cast("bigint"),
        )
        .select(*df.columns, name)
    )

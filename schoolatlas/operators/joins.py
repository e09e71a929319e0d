"""Left joins against lookup tables that hold one row per key.

Every left row comes out exactly once.  How a lookup travels is left to
adaptive execution, which knows its size when it is there: a small one is sent
to the tasks, and of a large join the partitions of hot keys (null is one) are
split on the left side.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(left: DataFrame, lookup: DataFrame, on: list[str]) -> DataFrame:
    """Left join; null keys match nothing.  Columns: the left's, then the new."""
    joined = left.join(lookup, on, "left")
    return joined.select(*left.columns, *[c for c in lookup.columns if c not in on])


def spread(df: DataFrame) -> DataFrame:
    """The same rows, dealt evenly over tasks before costly work on each of them.

    A table of few files, or one that comes out of a join with few keys, stands in
    few tasks however many cores there are.  Adaptive execution sets the number of
    tasks by the size of the rows, so a small table is not cut up.
    """
    return df.hint("rebalance")


def per_distinct(
    df: DataFrame, columns: list[str], resolve: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Apply a costly row-wise ``resolve`` once per distinct value combination.

    Names and addresses repeat over years and copies, so the patterns run on a
    table that is orders of magnitude shorter; equal values are merged inside
    each map task before they move.  ``resolve`` gets the distinct rows, may
    change or add columns and drop rows; rows it drops are dropped here.  The
    table is read twice, once for its values.  Null values are values.
    """
    key = F.struct(*columns)
    resolved = resolve(df.select(*columns).distinct().withColumn("_values", key))
    changed = [c for c in resolved.columns if c != "_values"]
    kept = [c for c in df.columns if c not in changed]
    answer = resolved.select("_values", F.struct(*changed).alias("_answer"))
    joined = df.select(*kept, key.alias("_values")).join(answer, "_values")
    order = [*df.columns, *[c for c in changed if c not in df.columns]]
    return joined.select(*kept, "_answer.*").select(*order)

"""One row per key.

Each pick is a ``min`` or ``max`` over a struct, so every map task already
reduces its rows to one per key before the shuffle.  A key that holds a third
of the table costs one row per map task, not a sort of that third.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: list[str], order: list[Column], aggregate) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    ranked = F.struct(
        F.struct(*order).alias("order") if order else F.lit(0).alias("order"),
        F.struct(*rest).alias("row"),
    )
    picked = df.groupBy(*keys).agg(aggregate(ranked).alias("picked"))
    return picked.select(*keys, "picked.row.*").select(*df.columns)


def first_per_key(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The least row of each key: by ``order``, then by all other columns.

    The remaining columns complete the order, so the row that stays does not
    depend on how the input is split.  Nulls come first.
    """
    return _pick(df, keys, list(order), F.min)


def last_per_key(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The greatest row of each key, ties broken by the other columns."""
    return _pick(df, keys, list(order), F.max)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().dropna()

"""Labels to keys: lookup tables and the foreign keys that point at them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .distinct import distinct_values, first_per_key
from .joins import lookup_join
from .ordinals import with_ordinal


def with_surrogate_key(df: DataFrame, name: str = "id") -> DataFrame:
    """Key column first, numbered in the order of the natural key columns."""
    order = [F.asc_nulls_first(c) for c in df.columns]
    return with_ordinal(df, name, *order).select(name, *df.columns)


def build_lookup(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values of a column with a key each."""
    return with_surrogate_key(distinct_values(df, column))


def label_to_key(
    df: DataFrame,
    column: str,
    lookup: DataFrame,
    key_column: str,
    label: str = "label",
    key: str = "id",
) -> DataFrame:
    """Replace a label column by the key of that label in a lookup.

    A label the lookup does not hold becomes null, null stays null, letter case
    counts.  Of several keys for one label the least is taken.
    """
    if column not in df.columns:
        raise ValueError(f"column not found: {column}")
    for needed in (label, key):
        if needed not in lookup.columns:
            raise ValueError(f"lookup column not found: {needed}")
    keys = first_per_key(
        lookup.where(F.col(label).isNotNull()).select(
            F.col(label).alias(column), F.col(key).alias(key_column)
        ),
        [column],
    )
    place = [key_column if c == column else c for c in df.columns]
    return lookup_join(df, keys, [column]).select(*place)


def extract_lookup(
    df: DataFrame, column: str, key_column: str
) -> tuple[DataFrame, DataFrame]:
    """Move a label column into a table of its own; returns (facts, lookup)."""
    lookup = build_lookup(df, column)
    return label_to_key(df, column, lookup, key_column, label=column), lookup

"""Contract checks, reject audits, orphan reports and run metrics."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..contracts import Contract
from ..functions.counts import DECIMAL
from .reshape import union_all, wide_to_long

SAMPLE_VALUES = 5


class ContractError(ValueError):
    """A table does not meet its contract."""


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row with the number of nulls of each column, in one pass."""
    return df.agg(
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns or df.columns]
    )


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*key).agg(F.count("*").alias("rows")).where("rows > 1")


def shape_errors(df: DataFrame, contract: Contract, dtypes: bool = False) -> list[str]:
    """Missing columns and, on demand, other types; from the schema alone."""
    errors = []
    missing = sorted(set(contract.schema.names) - set(df.columns))
    if missing:
        errors.append(f"[{contract.name}] missing columns: {', '.join(missing)}")
    if dtypes:
        errors += [
            f"[{contract.name}] column '{f.name}' is {df.schema[f.name].dataType.simpleString()}"
            f", not {f.dataType.simpleString()}"
            for f in contract.schema.fields
            if f.name in df.columns and df.schema[f.name].dataType != f.dataType
        ]
    return errors


def null_errors(contract: Contract, counts: Mapping[str, int]) -> list[str]:
    return [f"[{contract.name}] column '{c}' contains nulls" for c in contract.required if counts.get(c)]


def key_errors(df: DataFrame, contract: Contract) -> list[str]:
    if duplicate_keys(df, list(contract.key)).isEmpty():
        return []
    return [f"[{contract.name}] key {', '.join(contract.key)} is not unique"]


def contract_errors(
    df: DataFrame, contract: Contract, dtypes: bool = False, keys: bool = False
) -> list[str]:
    """Missing columns and nulls in required columns; types and keys on demand."""
    errors = shape_errors(df, contract, dtypes)
    required = [c for c in contract.required if c in df.columns]
    if required:
        errors += null_errors(contract, null_counts(df, required).first().asDict())
    if keys and set(contract.schema.names) <= set(df.columns):
        errors += key_errors(df, contract)
    return errors


def _raise(errors: list[str], df: DataFrame) -> None:
    if errors:
        sample = [row.asDict() for row in df.take(3)]
        raise ContractError(f"{'; '.join(errors)}; sample={sample}")


def require_contract(df: DataFrame, contract: Contract, **checks: bool) -> DataFrame:
    """Return the table, or raise with the errors and three sample rows."""
    _raise(contract_errors(df, contract, **checks), df)
    return df


def store_checked(
    df: DataFrame, contract: Contract, store: Callable[[DataFrame], DataFrame], keys: bool = False
) -> DataFrame:
    """Store a table and hold it against its contract.

    Columns and types are checked before anything runs and nulls are counted by the
    write itself.  ``keys`` asks for a unique key, which takes a job of its own.
    """
    _raise(shape_errors(df, contract, dtypes=True), df)
    required = [c for c in contract.required if c in df.columns]
    nulls = Observation()
    counts = [F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in required]
    stored = store(df.observe(nulls, *counts) if counts else df)
    _raise(null_errors(contract, nulls.get if counts else {}), stored)
    if keys:
        _raise(key_errors(stored, contract), stored)
    return stored


def key_report(tables: dict[str, DataFrame], contracts: dict[str, Contract]) -> DataFrame:
    """(table, key, repeated_keys, rows) of the tables whose declared key repeats."""
    found = [
        duplicate_keys(tables[name], list(contract.key))
        .agg(F.count("*").alias("repeated_keys"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
        .select(F.lit(name).alias("table"), F.lit(", ".join(contract.key)).alias("key"), "repeated_keys", "rows")
        for name, contract in contracts.items()
        if name in tables
    ]
    return reduce(DataFrame.unionByName, found).where("repeated_keys > 0")


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} produced no rows")
    return df


def invalid_values(
    df: DataFrame, group: str, raw: str, valid: Column, samples: int = SAMPLE_VALUES
) -> DataFrame:
    """Per group: cells that hold a text but no value, and the least few texts.

    ``valid`` tells whether the text of a cell can be read.

    Equal texts are counted before they move, and the sample is cut to size
    inside each map task, so a group with any number of bad cells is cheap.
    """
    bad = (
        df.where(F.col(raw).isNotNull() & ~valid)
        .groupBy(group, F.col(raw).alias("_raw"))
        .agg(F.count("*").alias("_rows"))
    )
    # Both branches read one shuffle: they need the same columns of it, and are
    # put together by a union, which adds no filter of its own to either.
    counts = bad.groupBy(group).agg(F.sum("_rows").alias("_count"))
    order = Window.partitionBy(group).orderBy("_raw", "_rows")
    least = bad.withColumn("_rank", F.row_number().over(order)).where(
        F.col("_rank") <= samples
    )
    parts = counts.select(group, "_count", F.lit(None).cast("string").alias("_raw"))
    return (
        parts.unionByName(least.select(group, "_raw"), allowMissingColumns=True)
        .groupBy(group)
        .agg(
            F.sum("_count").alias("invalid_rows"),
            F.sort_array(F.collect_list("_raw")).alias("samples"),
        )
    )


#: Types of texts from narrow to wide; an empty text has none.
TEXT_TYPES = ["long", "double", "text"]


def type_profile(tables: list[DataFrame], by: str, skip: list[str]) -> DataFrame:
    """(by, column, long, double, text, sample): how many values of each type a file's column holds.

    One pass over all files; cells are counted before they move.  ``sample`` is the least text.
    """
    cells = union_all(
        [wide_to_long(t, [by], "column", "value", [c for c in t.columns if c not in (by, *skip)]) for t in tables]
    )
    value = F.btrim("value")
    kind = F.when(value.rlike("^[+-]?[0-9]+$"), 0).when(value.rlike(DECIMAL), 1).when(value != "", 2)
    typed = cells.select(by, "column", value.alias("value"), kind.alias("kind")).where("kind IS NOT NULL")
    return typed.groupBy(by, "column").agg(
        *[F.count_if(F.col("kind") == i).alias(name) for i, name in enumerate(TEXT_TYPES)],
        F.min(F.when(F.col("kind") == 2, F.col("value"))).alias("sample"),
    )


def type_misfits(profile: DataFrame, by: str) -> DataFrame:
    """(by, column, wanted, misfits, sample): values of later files that do not fit the first file's type.

    The first file (by name) with a value in a column sets its type, the widest that its values need.
    """
    wanted = F.when(F.col("text") > 0, 2).when(F.col("double") > 0, 1).otherwise(0)
    first = profile.groupBy("column").agg(F.min_by(wanted, by).alias("wanted"))
    misfits = F.when(F.col("wanted") == 0, F.col("double") + F.col("text")).when(F.col("wanted") == 1, F.col("text"))
    return (
        profile.join(first, "column")
        .withColumn("misfits", misfits)
        .where("misfits > 0")
        .select(by, "column", F.get(F.array(*map(F.lit, TEXT_TYPES)), F.col("wanted")).alias("wanted"), "misfits", "sample")
    )


def split_rejects(
    df: DataFrame, reasons: dict[str, Column]
) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with the first reason that holds)."""
    reason = F.lit(None).cast("string")
    for name, holds in reversed(reasons.items()):
        reason = F.when(holds, F.lit(name)).otherwise(reason)
    judged = df.withColumn("reject_reason", reason)
    return (
        judged.where("reject_reason IS NULL").drop("reject_reason"),
        judged.where("reject_reason IS NOT NULL"),
    )


def orphans(
    facts: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Values of a foreign key without a parent, with the rows that hold them.

    The facts are counted per value first; only distinct values are joined.
    """
    used = (
        facts.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("rows"))
    )
    known = parent.select(F.col(parent_column).alias("value")).distinct()
    return used.join(known, "value", "left_anti").select(
        F.lit(column).alias("key"), "value", "rows"
    )


def geography_orphans(geo: DataFrame, codes: DataFrame, ids: list[str]) -> DataFrame:
    """Place ids of the geography table that the place table does not hold.

    All id columns are checked in one pass: they are stacked and counted, so
    the place table is read and joined once.
    """
    stacked = (
        geo.select(*ids)
        .unpivot([], ids, "key", "value")
        .where("value IS NOT NULL")
        .groupBy("key", "value")
        .agg(F.count("*").alias("rows"))
    )
    known = codes.select(F.col("id").alias("value")).distinct()
    return stacked.join(known, "value", "left_anti").select("key", "value", "rows")

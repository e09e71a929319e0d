"""Stored tables: replace whole, insert or replace by key, or replace the partitions of a load.

New files are written beside the table and put in place at the end, so a load that
fails leaves the table as it was.
"""

from __future__ import annotations

import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.distinct import last_per_key
from ..operators.ordinals import with_ordinal


def _files(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def is_stored(spark: SparkSession, folder: str, name: str) -> bool:
    files, place = _files(spark, f"{folder}/{name}")
    return files.exists(place)


def _write(df: DataFrame, path: str, partition: str | None) -> None:
    """Large partitions become several files, the small parts of one few."""
    if partition:
        df.hint("rebalance", partition).write.partitionBy(partition).mode("overwrite").parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def store(df: DataFrame, folder: str, name: str, partition: str | None = None) -> DataFrame:
    """Replace a table and return it as it was written."""
    _write(df, f"{folder}/{name}", partition)
    return df.sparkSession.read.parquet(f"{folder}/{name}")


def _swap(spark: SparkSession, pairs: list[tuple[str, str]], aside: str) -> None:
    """Move each new folder to its place; what stood there goes, or comes back if a move fails."""
    done: list[tuple[str, str]] = []
    try:
        for number, (new, place) in enumerate(pairs):
            files, target = _files(spark, place)
            away = f"{aside}/{number}"
            _, old = _files(spark, away)
            if files.exists(target):
                files.mkdirs(old.getParent())
                if not files.rename(target, old):
                    raise OSError(f"can't move {place}")
                done.append((away, place))
            _, fresh = _files(spark, new)
            if files.exists(fresh):
                files.mkdirs(target.getParent())
                if not files.rename(fresh, target):
                    raise OSError(f"can't move {new}")
    except BaseException:
        for away, place in reversed(done):
            files, target = _files(spark, place)
            files.delete(target, True)
            files.rename(_files(spark, away)[1], target)
        raise
    files, old = _files(spark, aside)
    files.delete(old, True)


def _replace(df: DataFrame, folder: str, name: str, partition: str | None, values: list | None) -> DataFrame:
    """Write the rows beside the table; swap in the partitions of ``values`` (None: the whole table)."""
    spark, path = df.sparkSession, f"{folder}/{name}"
    beside = f"{folder}/_next/{name}-{uuid.uuid4().hex}"
    _write(df, f"{beside}/new", partition)
    if values is None:
        pairs = [(f"{beside}/new", path)]
    else:
        named = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
        parts = [named(partition, None if v is None else str(v)) for v in values]
        pairs = [(f"{beside}/new/{part}", f"{path}/{part}") for part in parts]
    try:
        _swap(spark, pairs, f"{beside}/old")
    finally:
        files, place = _files(spark, beside)
        files.delete(place, True)
    spark.catalog.refreshByPath(path)
    return spark.read.parquet(path)


def _like(old: DataFrame, new: DataFrame) -> DataFrame:
    """The stored rows under the types of the new ones (a partition column is read as it looks)."""
    types = dict(new.dtypes)
    return old.select(*[F.col(c).cast(types[c]) if c in types else F.col(c) for c in old.columns])


def _greatest(table: DataFrame, key: str) -> Column:
    return F.lit(table.agg(F.max(key)).first()[0] or 0)


def merge_by_key(
    df: DataFrame, folder: str, name: str, key: str = "id", partition: str | None = None
) -> DataFrame:
    """Insert or replace: a row takes the place of the stored row with its key, all others stay.

    Of equal keys in the load the greatest row counts.  A load without the key
    column is appended, numbered after the greatest key.  Only partitions that
    gain or lose a row are written anew, unless the load has other columns.
    Columns that one side lacks are null there.
    """
    spark = df.sparkSession
    stored = is_stored(spark, folder, name)
    old = spark.read.parquet(f"{folder}/{name}") if stored else None
    if key not in df.columns:
        rows = with_ordinal(df, key, *[F.asc_nulls_first(c) for c in df.columns]).select(key, *df.columns)
        if old is None:
            return store(rows, folder, name, partition)
        df = rows.withColumn(key, F.col(key) + _greatest(old, key))
    new = last_per_key(df, [key])
    if old is None:
        return store(new, folder, name, partition)
    old, values = _like(old, new), None
    if partition and set(old.columns) == set(new.columns):
        gone = old.join(new.select(key), key, "left_semi")
        # One row per partition, as many as the table has folders.
        values = [r[0] for r in new.select(partition).union(gone.select(partition)).distinct().collect()]
        touched = F.lit(False)
        for value in values:
            touched = touched | F.col(partition).eqNullSafe(F.lit(value))
        old = old.where(touched)
    kept = old.join(new.select(key), key, "left_anti")
    return _replace(kept.unionByName(new, allowMissingColumns=True), folder, name, partition, values)


def replace_partitions(df: DataFrame, folder: str, name: str, partition: str) -> DataFrame:
    """A load takes the place of the stored partitions that it has rows of; the others stay."""
    spark = df.sparkSession
    if not is_stored(spark, folder, name):
        return store(df, folder, name, partition)
    values = [r[0] for r in df.select(partition).distinct().collect()]
    return _replace(df, folder, name, partition, values)


def extend_lookup(df: DataFrame, column: str, known: DataFrame | None, key: str = "id") -> DataFrame:
    """(key, label): known labels keep their key, new ones follow the greatest in the labels' order."""
    labels = df.select(column).distinct().dropna()
    if known is None:
        return with_ordinal(labels, key, F.asc(column)).select(key, column)
    fresh = with_ordinal(labels.join(known.select(column), column, "left_anti"), key, F.asc(column))
    numbered = fresh.select((F.col(key) + _greatest(known, key)).alias(key), column)
    return known.select(F.col(key).cast("bigint").alias(key), column).unionByName(numbered)

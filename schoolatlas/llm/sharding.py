"""Two-pass external shuffle into shards.

Pass one scatters the records uniformly, by seeded hashes, into buckets that fit in a task's
memory; pass two shuffles each bucket by Fisher-Yates (``numpy``'s ``Generator.permutation``)
with a seed of its own and numbers its records, bucket after bucket, without gaps.

The law is ``key``: a record's shard is the one with the highest seeded hash of (shard, id), so
the id and the number of shards decide, and one more shard takes records only into itself.
A shard has one bucket per ``BUCKET_BYTES`` of its records; inside the shard the bucket follows
from a hash of id and text, so repeated ids spread over the buckets.

Reruns agree: a bucket is put in the order of id, text checksum and a hash of the whole row
before it is shuffled, and its seed depends on shard and bucket alone.

Defined cases: null ids share a shard; a null text has no bytes and checksum 0; rows equal in
every column are interchangeable; columns of the input named like the added ones are replaced,
others pass through; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from schoolatlas.llm.common import ship, store

SHARDS = 24
SEED = 7
BUCKET_BYTES = 16 << 20
ROW_BYTES = 8
MADE = ("shard", "bucket", "slot")

ship(__name__)


def shard_of(doc_id: Column, shards: int = SHARDS, seed: int = SEED) -> Column:
    """The shard with the highest hash; a further shard changes only the records that it takes."""
    scores = [F.struct(F.xxhash64(F.lit(seed), F.lit(i), doc_id).alias("h"), F.lit(i).alias("i")) for i in range(shards)]
    return reduce(lambda a, b: F.greatest(a, b), scores)["i"] if shards > 1 else F.lit(0)


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


def checksum(text: Column) -> Column:
    return F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long")


def shuffle(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The records with ``shard``, ``bucket`` (within the shard) and ``slot`` (within the shard, from 0)."""
    docs = docs.drop(*MADE)
    text = docs["text"]
    keyed = docs.select(
        F.struct("*").alias("row"),
        docs["doc_id"].alias("id"),
        checksum(text).alias("crc"),
        size_of(text).alias("size"),
        shard_of(docs["doc_id"], shards, seed).alias("shard"),
    )
    # Finer cells than any number of buckets: bucket = cell * buckets / cells, for whatever number comes out.
    cells = 1 << 20
    cell = F.pmod(F.xxhash64(F.lit(seed + 1), F.col("id"), F.col("crc")), F.lit(cells))
    slim = keyed.select("shard", cell.alias("cell"), "size")
    sizes = slim.groupBy("shard").agg(F.ceil(F.sum("size") / bucket_bytes).alias("buckets"))
    sizes = store(sizes)
    place = F.floor(F.col("cell") * F.col("buckets") / cells).cast("int").alias("bucket")
    counts = slim.join(sizes, "shard").groupBy("shard", place).agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = store(counts.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"))
    scattered = (
        keyed.join(sizes, "shard")
        .withColumn("cell", cell)
        .select("row", "id", "crc", "shard", place)
        .withColumn("hash", F.xxhash64("row"))
        .join(offsets, ["shard", "bucket"])
    )

    def fisher_yates(records: pa.Table) -> pa.Table:
        records = records.sort_by([("id", "ascending"), ("crc", "ascending"), ("hash", "ascending")])
        shard, bucket, offset = (records.column(c)[0].as_py() for c in ("shard", "bucket", "offset"))
        order = np.random.default_rng([seed, shard, bucket]).permutation(records.num_rows)
        slots = pa.array(offset + np.arange(records.num_rows, dtype=np.int64))
        return records.select(["row", "shard", "bucket"]).take(pa.array(order)).append_column("slot", slots)

    schema = T.StructType([T.StructField("row", docs.schema)])
    for name, kind in (("shard", "integer"), ("bucket", "integer"), ("slot", "long")):
        schema = schema.add(name, kind)
    shuffled = scattered.groupBy("shard", "bucket").applyInArrow(fisher_yates, schema)
    return shuffled.select("row.*", *MADE)


def write(shuffled: DataFrame, path: str) -> None:
    """One folder per shard, one file per bucket, records in slot order."""
    shuffled.repartition("shard", "bucket").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)

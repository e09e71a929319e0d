"""Token counts of documents in flat token files, by a scan for separators.

A token file is a plain row of little-endian 16-bit token ids; every document ends with the
separator, and no index says where.  The file is cut into blocks that any task can take.  Each
block is searched for separators by one vector comparison; documents that run over a border are
stitched by a prefix scan over the blocks' sums (tokens, separators, place of the last
separator).  The scan runs over one short row per block, so documents may span any number of
blocks and a file may have any length.

``token_blocks`` makes such files from documents (a word's token is its hash), ``read_files``
cuts existing files, and ``count_tokens`` does the work on either.

Defined cases: an empty document counts 0 tokens; tokens after the last separator are a last
document with ``complete`` false; an empty file has no documents; blocks may be empty or of
unequal length; a null text is an empty document; a null id counts as 0 when files are chosen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from schoolatlas.llm.common import prefix_sums, ship, slices, span_hashes, store, text_bytes, word_spans

SEPARATOR = 0xFFFF
BLOCK_TOKENS = 1 << 18
DOCS_PER_FILE = 4096
#: Spark hands a file over as one value; longer files are to be written in parts, named in order.
MAX_FILE_BYTES = 1 << 28

ship(__name__)


def _blocks(parts: Iterator[tuple[int, bytes]], block_bytes: int) -> Iterator[tuple[int, int, bytes]]:
    """(file, block, bytes) from pieces of files that come one file after the other."""
    file, number, held = None, 0, bytearray()
    for name, piece in parts:
        if name != file:
            if held:
                yield file, number, bytes(held)
            file, number, held = name, 0, bytearray()
        held += piece
        while len(held) >= block_bytes:
            yield file, number, bytes(held[:block_bytes])
            number += 1
            del held[:block_bytes]
    if held:
        yield file, number, bytes(held)


def _batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    files, blocks, data = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(files, pa.int64()), pa.array(blocks, pa.int64()), pa.array(data, pa.binary())], names=["file", "block", "data"]
    )


def file_of(docs: DataFrame, docs_per_file: int = DOCS_PER_FILE) -> DataFrame:
    """The documents with the number of the file they go to, some ``docs_per_file`` in each."""
    files = max(1, -(-docs.count() // docs_per_file))
    return docs.withColumn("file", F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(files)).cast("long"))


def token_blocks(docs: DataFrame, docs_per_file: int = DOCS_PER_FILE, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, block, data): the texts' tokens as flat files, in order of id and length within a file."""

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for a, b in slices(np.diff(offsets), 1 << 20):
                own, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                first, last, word_of = word_spans(own, at)
                ids = (span_hashes(prefix_sums(own), first, last) % np.uint64(SEPARATOR)).astype("<u2")
                with_end = np.insert(ids, word_of[1:], SEPARATOR)
                bounds = 2 * (word_of + np.arange(b - a + 1))
                tokens = pa.Array.from_buffers(
                    pa.large_binary(), b - a, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(with_end.tobytes())]
                )
                kept = [batch.column(c).slice(a, b - a) for c in ("file", "doc_id")]
                yield pa.RecordBatch.from_arrays([*kept, tokens.cast(pa.binary())], names=["file", "doc_id", "tokens"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = ((f, t) for batch in batches for f, t in zip(*(batch.column(c).to_pylist() for c in ("file", "tokens")), strict=True))
        for row in _blocks(pieces, 2 * block_tokens):
            yield _batch([row])

    numbered = file_of(docs.select("doc_id", "text"), docs_per_file).select("file", F.col("doc_id").cast("long"), "text")
    tokens = numbered.mapInArrow(tokenise, "file bigint, doc_id bigint, tokens binary")
    sorted_files = tokens.repartition("file").sortWithinPartitions("file", "doc_id", F.length("tokens"), F.xxhash64("tokens"))
    return sorted_files.select("file", "tokens").mapInArrow(join, "file bigint, block bigint, data binary")


def read_files(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, block, data) of the token files under a path; ``file`` is a hash of the path."""
    files = spark.read.format("binaryFile").load(path)
    too_long = F.raise_error(F.concat(F.lit("longer than a part may be: "), F.col("path"))).cast("binary")
    content = F.when(F.col("length") > MAX_FILE_BYTES, too_long).otherwise(F.col("content"))
    files = files.select(F.xxhash64("path").alias("file"), content.alias("content"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = ((f, c) for batch in batches for f, c in zip(*(batch.column(c).to_pylist() for c in ("file", "content")), strict=True))
        for row in _blocks(pieces, 2 * block_tokens):
            yield _batch([row])

    return files.mapInArrow(cut, "file bigint, block bigint, data binary")


def find_separators(blocks: DataFrame, separator: int = SEPARATOR) -> DataFrame:
    """(file, block, n_tokens, ends): the places of the separators in each block."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("data"))
            tokens, bounds = np.frombuffer(data.tobytes(), "<u2"), offsets // 2
            hits = np.flatnonzero(tokens == separator)
            cuts = np.searchsorted(hits, bounds)
            ends = hits - np.repeat(bounds[:-1], np.diff(cuts))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("file"),
                    batch.column("block"),
                    pa.array(np.diff(bounds)),
                    pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ends.astype(np.int64))),
                ],
                names=["file", "block", "n_tokens", "ends"],
            )

    return blocks.mapInArrow(search, "file bigint, block bigint, n_tokens bigint, ends array<bigint>")


def count_tokens(blocks: DataFrame, separator: int = SEPARATOR) -> DataFrame:
    """Per document: file, ``ordinal`` in the file, ``start`` token, ``n_tokens`` without the separator, ``complete``."""
    found = store(find_separators(blocks, separator))
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    sums = found.select("file", "block", "n_tokens", F.size("ends").alias("n"), F.get("ends", F.size("ends") - 1).alias("last"))
    offset = F.coalesce(F.sum("n_tokens").over(before), F.lit(0))
    scanned = sums.withColumn("offset", offset).withColumn("end", F.col("offset") + F.col("last"))
    scanned = scanned.select(
        "file",
        "block",
        "offset",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"),
        # Where the document open at the block's start began.
        (F.coalesce(F.max("end").over(before), F.lit(-1)) + 1).alias("open"),
    )
    totals = sums.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    rows = found.select("file", "block", "ends").join(scanned, ["file", "block"])
    own = F.transform(
        "ends",
        lambda end, i: F.struct(
            (F.col("first") + i).alias("ordinal"),
            F.when(i == 0, F.col("open")).otherwise(F.col("offset") + F.get("ends", i - 1) + 1).alias("start"),
            (F.col("offset") + end).alias("end"),
        ),
    )
    whole = rows.select("file", F.explode(own).alias("d")).select(
        "file", "d.ordinal", "d.start", (F.col("d.end") - F.col("d.start")).alias("n_tokens"), F.lit(True).alias("complete")
    )
    last = scanned.join(sums.select("file", "block", "n", "last", "n_tokens"), ["file", "block"])
    closed = F.coalesce(F.col("offset") + F.col("last") + 1, F.col("open"))
    last = last.groupBy("file").agg(F.max(closed).alias("start"), F.sum("n").alias("ordinal")).join(totals, "file")
    tail = last.filter("start < total").select(
        "file", "ordinal", "start", (F.col("total") - F.col("start")).alias("n_tokens"), F.lit(False).alias("complete")
    )
    return whole.unionByName(tail)


def manifest(docs: DataFrame, docs_per_file: int = DOCS_PER_FILE) -> DataFrame:
    """(file, ordinal, doc_id): where ``token_blocks`` puts a document."""
    order = Window.partitionBy("file").orderBy(F.col("doc_id").asc_nulls_first())
    numbered = file_of(docs.select("doc_id"), docs_per_file)
    return numbered.select("file", (F.row_number().over(order) - 1).cast("long").alias("ordinal"), "doc_id")

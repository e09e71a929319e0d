"""Quality rules with cross-document line frequency.

One pass over the texts gives per document the base counts and the hashes of its normalised
lines (A-Z lower-cased, white space as one space).  Spark then counts in how
many distinct documents of its host (``source``) each line stands; copies of a whole text
count once, since they are one document.  A line in more than ``MIN_DOCS`` and ``DOC_SHARE`` of the
host's distinct documents is removed, and on every host a line in more than ``MANY_DOCS``; a document
is rejected when less than ``KEPT_SHARE`` of its words remain, or when the base rules reject it.

Counting is pre-aggregated in the map tasks, keyed by (host, text, line) and then by
(host, line), so neither a common line nor a large host nor a group of copies gathers in a task.

Defined cases: a null or empty text has no words and fails the base rules; a null source is a
host of its own; lines without a word are neither counted nor removed; a text just at a limit
stays; repeated rows get the same answer each; other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from schoolatlas.llm.common import (
    LOWER,
    prefix_sums,
    sequence_hashes,
    ship,
    shingles,
    slices,
    span_hashes,
    store,
    text_bytes,
    text_key,
    word_spans,
)

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30  # per cent of the words
MIN_DOCS = 8
DOC_SHARE = 0.01
#: A line in more documents goes by itself, however large its host is.
MANY_DOCS = 50
KEPT_SHARE = 0.5

ship(__name__)

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

_MEASURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
_LINES = "lines array<struct<line: bigint, words: bigint>>"
BASE = [x.split()[0] for x in _MEASURES.split(", ")]


def _per_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return np.diff(sums[offsets])


def _repeated(raw: np.ndarray, word_of: np.ndarray) -> np.ndarray:
    """Per row: words within windows that stand twice or more in the row."""
    covered = np.zeros(len(raw) + 1, np.int64)
    windows = shingles(raw, WINDOW)
    row = np.repeat(np.arange(len(word_of) - 1), np.diff(word_of))
    inside = row[: len(windows)] == row[WINDOW - 1 :][: len(windows)]
    at = np.flatnonzero(inside)
    keys = windows[at] ^ (row[at].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(at) + 1, bool)
    twice[1:-1] = same[: len(at)]
    twice = twice[:-1] | twice[1:] if len(at) else np.zeros(0, bool)
    hits = at[order[twice]]
    np.add.at(covered, hits, 1)
    np.add.at(covered, hits + WINDOW, -1)
    return _per_row(np.cumsum(covered[:-1]) > 0, word_of)


def line_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per line: its row, start and end byte, hash of its normalised words, and number of words."""
    breaks = np.flatnonzero(data == 10)
    row = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, "right") - 1])
    starts = np.concatenate([offsets[:-1], breaks + 1])
    order = np.lexsort((starts, row))
    row, starts = row[order], starts[order]
    ends = offsets[1:][row]
    goes_on = np.flatnonzero(row[1:] == row[:-1])
    ends[goes_on] = starts[goes_on + 1] - 1
    first, last, _ = word_spans(data, offsets)
    words = span_hashes(prefix_sums(LOWER[data]), first, last)
    a, b = np.searchsorted(first, starts), np.searchsorted(first, ends)
    return row, starts, ends, sequence_hashes(words, a, b), b - a


def _measure(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    first, last, word_of = word_spans(data, offsets)
    sums = prefix_sums(data)
    covered = np.zeros(len(data) + 1, np.int64)
    covered[first] = 1
    covered[last] -= 1
    in_word = np.cumsum(covered[:-1]) > 0
    row, starts, ends, line, n = line_hashes(data, offsets)
    raw = span_hashes(sums, starts, ends) ^ (row.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    worded = n > 0
    row, line, n, raw = row[worded], line[worded], n[worded], raw[worded]
    again = np.ones(len(raw), bool)
    again[np.unique(raw, return_index=True)[1]] = False
    rows = len(offsets) - 1
    measures = [
        np.diff(word_of),
        _per_row(in_word & ((data & 0xC0) != 0x80), offsets),
        _per_row(_SYMBOL[data], offsets),
        np.bincount(row, again, rows).astype(np.int64),
        _repeated(span_hashes(sums, first, last), word_of),
    ]
    # Equal lines of a row as one, with their words together.
    order = np.lexsort((line, row))
    row, line, n = row[order], line[order], n[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (line[1:] != line[:-1])
    at = np.flatnonzero(new)
    total = np.add.reduceat(n, at) if len(at) else n
    return measures, [np.searchsorted(row[at], np.arange(rows + 1)), line[at].view(np.int64), total]


def measure(docs: DataFrame, *keep: str) -> DataFrame:
    """The ``keep`` columns, the base counts, and the (line, words) of each document, in one pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for a, b in slices(np.diff(offsets), 1 << 20):
                counts, (bounds, line, words) = _measure(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                lines = pa.ListArray.from_arrays(
                    pa.array(bounds, pa.int32()),
                    pa.StructArray.from_arrays([pa.array(line), pa.array(words.astype(np.int64))], names=["line", "words"]),
                )
                kept = [batch.column(c).slice(a, b - a) for c in keep]
                yield pa.RecordBatch.from_arrays(
                    [*kept, *(pa.array(c.astype(np.int64)) for c in counts), lines], names=[*keep, *BASE, "lines"]
                )

    schema = T.StructType([docs.schema[c] for c in keep])
    for field in T._parse_datatype_string(f"{_MEASURES}, {_LINES}"):
        schema = schema.add(field)
    return docs.select(*keep, "text").mapInArrow(run, schema)


def frequent_lines(
    lines: DataFrame, min_docs: int = MIN_DOCS, doc_share: float = DOC_SHARE, many_docs: int = MANY_DOCS
) -> DataFrame:
    """(host, line) above the limits; ``lines`` has a row per host, text and distinct line of the text."""
    sizes = lines.filter("line is null").groupBy("host").agg(F.count("*").alias("host_docs"))
    counted = lines.filter("line is not null").groupBy("host", "line").agg(F.count("*").alias("line_docs"))
    above = counted.filter(F.col("line_docs") > min_docs).join(sizes, "host")
    limit = F.least(F.col("host_docs") * doc_share, F.lit(many_docs))
    return above.filter(F.col("line_docs") > limit).select("host", "line")


def rate(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    doc_share: float = DOC_SHARE,
    kept_share: float = KEPT_SHARE,
    many_docs: int = MANY_DOCS,
) -> DataFrame:
    """Per document: doc_id, base counts, ``base_failed``, words in removed lines, their hashes, and ``kept``."""
    keyed = docs.select(
        "doc_id",
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("host"),
        *text_key(F.col("text")),
        "text",
    )
    measured = store(measure(keyed, "doc_id", "host", "text_1", "text_2"))
    # A row without a line for each text counts the host's distinct texts in the same shuffle.
    own = F.explode(F.concat(F.array(F.lit(None).cast("struct<line: bigint, words: bigint>")), "lines"))
    lines = measured.select("host", "text_1", "text_2", own.alias("l")).select("host", "text_1", "text_2", "l.line", "l.words")
    lines = store(lines.groupBy("host", "text_1", "text_2", "line").agg(F.max("words").alias("words")))
    removed = (
        lines.join(frequent_lines(lines, min_docs, doc_share, many_docs), ["host", "line"])
        .groupBy("host", "text_1", "text_2")
        .agg(F.sum("words").alias("n_removed_words"), F.collect_set("line").alias("removed_lines"))
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    lost = F.coalesce("n_removed_words", F.lit(0))
    return measured.join(removed, ["host", "text_1", "text_2"], "left").select(
        "doc_id",
        "host",
        "text_1",
        "text_2",
        *BASE,
        failed.alias("base_failed"),
        lost.alias("n_removed_words"),
        F.coalesce("removed_lines", F.array().cast("array<bigint>")).alias("removed_lines"),
        (~failed & (F.col("n_words") - lost >= F.col("n_words") * kept_share)).alias("kept"),
    )


def clean(docs: DataFrame, **limits: float) -> DataFrame:
    """The kept documents with their columns, the removed lines taken out of the text."""
    rated = rate(docs, **limits).filter("kept").select("host", "text_1", "text_2", "removed_lines").distinct()
    host = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    one, two = text_key(F.col("text"))
    names = docs.columns
    row = docs.select(F.struct(*docs.columns).alias("row"), host.alias("host"), one, two)
    joined = row.join(rated, ["host", "text_1", "text_2"]).select("row.*", "removed_lines")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        for batch in batches:
            data, offsets = text_bytes(batch.column(at))
            texts = []
            for i, drop in enumerate(batch.column(len(names)).to_pylist()):
                own = data[offsets[i] : offsets[i + 1]]
                if drop:
                    _, a, b, line, n = line_hashes(own, np.array([0, len(own)]))
                    gone = np.isin(line.view(np.int64), drop) & (n > 0)
                    texts.append(b"\n".join(own[x:y].tobytes() for x, y in zip(a[~gone], b[~gone], strict=True)))
                else:
                    texts.append(own.tobytes())
            columns = [batch.column(i) for i in range(len(names))]
            columns[at] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.mapInArrow(run, docs.schema)

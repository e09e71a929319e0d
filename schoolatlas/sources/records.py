"""Records of CSV text whose quoted fields may hold line breaks; files stay splittable.

A line is read with what is known of it alone: whether a quoted field is open
behind it if none was open before, and if one was.  Such functions of two states
compose, so each block of a file (a split of the reader) sums up to one of them,
and a prefix scan over a file's blocks tells which blocks begin inside a quoted
field.  That is rare.  The lines are therefore joined to records as if no block
did, the blocks' functions come out beside them, and only where the scan finds such a
block the lines are read once more, now with the right start.  A record that
crosses blocks leaves each as a fragment; fragments are joined by file and order.

A quote opens a field only at its start, doubled quotes within are text.  A
field that is never closed takes the rest of its file into one record.
"""

from __future__ import annotations

import csv
import re
import sys
from collections.abc import Callable, Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Executors get this module's functions by value: they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TEXT = r'(?:[^"]|"")*+'
_OPENS = rf'(?:(?:"{_TEXT}"[^,]*+|[^",][^,]*+|),)*+"{_TEXT}\Z'
#: A line that leaves a field open: if none was open before, and if one was.
LEAVES_OPEN = (re.compile(_OPENS), re.compile(rf'{_TEXT}(?:\Z|"[^,]*+,{_OPENS})'))

RECORD, HEAD, MIDDLE, TAIL, HEADER_TAIL, BLOCK = "record", "head", "middle", "tail", "header", "block"
PIECES = "file string, name string, start long, kind string, text string, opened boolean, stays boolean"


class _Block:
    """One split of a file, line after line."""

    def __init__(self, file: str, name: str, start: int, inside: bool) -> None:
        self.place = (file, name, start)
        self.state = self.at_start = inside
        self.effect = [False, True]
        self.lines: list[str] = []
        self.continues, self.is_header = inside, start == 0 and not inside

    def add(self, lines: list[str]) -> Iterator[tuple[str, str]]:
        """(kind, text) of the records that end in these lines."""
        for line in lines:
            if '"' in line:
                self.effect = [bool(LEAVES_OPEN[e].match(line)) for e in self.effect]
                self.state = self.effect[self.at_start]
            self.lines.append(line)
            if not self.state:
                yield from self._finish(HEAD if self.continues else RECORD)

    def _finish(self, kind: str) -> Iterator[tuple[str, str]]:
        text = "\n".join(self.lines)
        self.lines, self.continues = [], False
        if kind == RECORD and not text:
            return  # an empty line
        if self.is_header:
            self.is_header = False
            return
        yield kind, text

    def end(self) -> Iterator[tuple[str, str]]:
        if self.lines:
            yield MIDDLE if self.continues else HEADER_TAIL if self.is_header else TAIL, "\n".join(self.lines)
        yield BLOCK, ""


def _pieces(inside: frozenset[tuple[str, int]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Lines to pieces of records; ``inside`` holds the blocks that begin in a quoted field."""
    names = [field.split()[0] for field in PIECES.split(", ")]

    def batch_of(block: _Block, pieces: list[tuple[str, str]]) -> pa.RecordBatch:
        n = len(pieces)
        columns = [pa.repeat(v, n) for v in block.place[:2]] + [pa.repeat(pa.scalar(block.place[2], pa.int64()), n)]
        columns += [pa.array([p[i] for p in pieces], pa.string()) for i in (0, 1)]
        return pa.RecordBatch.from_arrays([*columns, *(pa.repeat(e, n) for e in block.effect)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for batch in batches:
            values, files, starts = (batch.column(i) for i in (0, 1, 3))
            # Rows of one block follow each other.
            ends = pc.run_end_encode(pa.array(starts)).run_ends.to_pylist() if batch.num_rows else []
            file_ends = pc.run_end_encode(pa.array(files)).run_ends.to_pylist() if batch.num_rows else []
            row = 0
            for end in sorted({*ends, *file_ends}):
                place = (files[row].as_py(), batch.column(2)[row].as_py(), starts[row].as_py())
                if block is None or block.place != place:
                    if block is not None:
                        yield batch_of(block, list(block.end()))
                    block = _Block(*place, (place[0], place[2]) in inside)
                yield batch_of(block, list(block.add(values.slice(row, end - row).to_pylist())))
                row = end
        if block is not None:
            yield batch_of(block, list(block.end()))

    return run


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    meta = F.col("_metadata")
    return spark.read.text(paths).select(
        "value", meta["file_path"].alias("file"), meta["file_name"].alias("name"), meta["file_block_start"].alias("start")
    )


def blocks_inside(pieces: DataFrame) -> frozenset[tuple[str, int]]:
    """(file, start) of the blocks that begin in a quoted field: a prefix scan over a row per block."""
    blocks = pieces.where(F.col("kind") == BLOCK).select("file", "start", "opened", "stays")
    before = Window.partitionBy("file").orderBy("start")
    until = before.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The last block whose end does not depend on its start, and the turns since then.
    fixed = F.when(F.col("opened") == F.col("stays"), F.col("start"))
    turns = F.sum((F.col("opened") & ~F.col("stays")).cast("int")).over(until)
    scanned = blocks.select("*", F.max(fixed).over(until).alias("fixed"), turns.alias("turns"))
    fixed_end = F.max(F.when(F.col("start") == F.col("fixed"), F.struct("start", "opened", "turns"))).over(until)
    ended = scanned.select("*", fixed_end.alias("last")).select(
        "file",
        "start",
        (F.coalesce(F.col("last.opened").cast("int"), F.lit(0)) + F.col("turns") - F.coalesce("last.turns", F.lit(0))).alias("state"),
    )
    begun = ended.select("file", "start", F.lag("state", 1, 0).over(before).alias("state"))
    return frozenset((r["file"], r["start"]) for r in begun.where("state % 2 = 1").collect())


def stitched(pieces: DataFrame) -> DataFrame:
    """(file, name, text) of the records that cross blocks."""
    until = Window.partitionBy("file").orderBy("start", "turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_start = F.col("kind").isin(TAIL, HEADER_TAIL)
    fragments = (
        pieces.where(F.col("kind").isin(TAIL, HEADER_TAIL, HEAD, MIDDLE))
        .withColumn("turn", is_start.cast("int"))  # a block's head comes before its tail
        .withColumn("number", F.sum("turn").over(until))
    )
    joined = fragments.groupBy("file", "name", "number").agg(
        F.sort_array(F.collect_list(F.struct("start", "turn", "text"))).alias("parts"),
        F.max((F.col("kind") == HEADER_TAIL).cast("int")).alias("header"),
    )
    text = F.concat_ws("\n", F.transform("parts", lambda p: p["text"]))
    return joined.where("header = 0").select("file", "name", text.alias("text"))


def read_records(
    spark: SparkSession,
    paths: list[str],
    parse: Callable[[Column], Column],
    store: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """(file, name, row) of every record but the header, ``row`` made by ``parse`` and stored by ``store``."""
    lines = _lines(spark, paths)

    def stage(inside: frozenset[tuple[str, int]]) -> DataFrame:
        pieces = lines.mapInArrow(_pieces(inside), PIECES)
        whole = F.col("kind") == RECORD
        return store(
            pieces.select(
                "file", "name", "start", "kind", "opened", "stays",
                F.when(~whole, F.col("text")).alias("text"),
                F.when(whole, parse(F.col("text"))).alias("row"),
            )
        )

    staged = stage(frozenset())
    if inside := blocks_inside(staged):
        staged = stage(inside)
    records = staged.where(F.col("kind") == RECORD).select("file", "name", "row")
    crossing = stitched(staged).select("file", "name", parse(F.col("text")).alias("row"))
    return records.unionByName(crossing)


#: Lines of a file that may hold its header, and files that are looked at in one job.
HEAD_LINES, FILES_A_JOB = 64, 200


def _first_record(lines: list[str]) -> str | None:
    """The first record of a file's first lines; None without any."""
    block = _Block("", "", 1, False)
    for line in lines:
        for _, text in block.add([line]):
            return text
    if len(lines) == HEAD_LINES:
        raise ValueError(f"a header of more than {HEAD_LINES} lines: {lines[0][:80]}")
    return "\n".join(lines) if any(lines) else None


def csv_headers(spark: SparkSession, path: str) -> list[tuple[tuple[str, ...], list[str]]]:
    """(header, files) for each distinct header below a path, in order of the first file name.

    A task per file stops after its first lines, so little more than a read
    buffer of each file is read.  These lines come to the driver.
    """
    listing = spark.read.option("pathGlobFilter", "*.csv").text(path)
    files = sorted(unquote(file) for file in listing.inputFiles())
    session = spark.newSession()  # with settings of its own: a file is one partition, of which the limit reads the start
    session.conf.set("spark.sql.files.maxPartitionBytes", "1t")
    session.conf.set("spark.sql.files.minPartitionNum", "1")
    found: dict[str, list[str]] = {}
    for start in range(0, len(files), FILES_A_JOB):
        part = files[start : start + FILES_A_JOB]
        heads = [session.read.text(file).limit(HEAD_LINES).select(F.lit(i).alias("i"), "value") for i, file in enumerate(part)]
        lines: list[list[str]] = [[] for _ in part]
        for row in reduce(DataFrame.unionAll, heads).collect():
            lines[row["i"]].append(row["value"])
        for file, own in zip(part, lines):
            if (header := _first_record(own)) is not None:
                found.setdefault(header, []).append(file)
    parsed = [(tuple(next(csv.reader([header.lstrip("\ufeff")]))), own) for header, own in found.items()]
    return sorted(parsed, key=lambda p: p[1][0].rpartition("/")[2])

"""Hard negatives: candidates of another label whose score lies close below that of a positive.

Vectors become integers (floor of 256 times a component) and a score is their
exact inner product.  Every anchor takes its ``POSITIVES`` best other rows of its
own label; every pair of an anchor and a positive takes its ``NEGATIVES`` best
rows of other labels whose score lies in the window from 80 % of the positive's
score to that score.  Higher scores come first, ties by smaller ``vec_id``.

Anchors and candidates are dealt into blocks of a bounded number of components;
every block of anchors meets every block of candidates in a task of its own.
There, tiles of both are multiplied by Strassen's recursion on 64-bit integers:
odd sizes get a line of zeros, seven products replace eight, all additions are
exact.  Every tile's scores go into heaps of a few rows for each anchor (first
pass: positives) or each anchor and positive (second pass: window).  Heaps merge:
the tasks' heaps are cut again by rank, before and after the shuffle.

Defined cases.  Rows without ``vec_id``, label or vector, or with a null or
non-finite component, take no part.  Components beyond 65,536 count as that
(``LIMIT``), so that scores of up to 6,500 components are exact in 64 bits.
Vectors of different lengths: the shorter one ends in zeros; an empty vector scores 0 with all.
Repeated rows are rows of their own, but rows with the anchor's ``vec_id`` are
never its partners.  Labels are compared as they are; one label may hold all rows
(then there are no negatives) and a pair whose window is empty has no row.  A
negative positive score has an empty window.  Empty tables give no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from schoolatlas.llm.common import ship, store

ship(__name__)

POSITIVES, NEGATIVES = 5, 5
#: Anchors are the rows whose id this divides.
ANCHOR_STEP = 100
SCALE, LIMIT = 256, 1 << 24
#: The least score of a negative, as a fraction of the positive's (numerator, denominator).
LEAST = (4, 5)
#: Components of a block of a task; rows and components of a tile.
BLOCK_VALUES, TILE_ROWS, TILE_VALUES = 1 << 21, 512, 1 << 22
#: Strassen's recursion ends at products with a side of so many.
LEAF = 16
_LEAST_SCORE = np.iinfo(np.int64).min


def integers(vector: Column) -> Column:
    """floor(256 * component) as integers, held within ``LIMIT``."""
    scaled = lambda x: F.floor(F.greatest(F.least(x.cast("double") * SCALE, F.lit(float(LIMIT))), F.lit(-float(LIMIT))))
    return F.transform(vector, lambda x: scaled(x).cast("int"))


def usable(rows: DataFrame, label: Column, vector: str = "embedding") -> DataFrame:
    """vec_id, label and integer vector of the rows that take part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(vector).alias("v")
    ).filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & F.forall("v", finite)
    ).withColumn("v", integers(F.col("v")))


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The matrix product, exact modulo 2 ** 64 (so exact where it fits in 64 bits)."""
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= LEAF:
        return a @ b
    if m & 1 or k & 1 or n & 1:
        a = np.pad(a, ((0, m & 1), (0, k & 1)))
        b = np.pad(b, ((0, k & 1), (0, n & 1)))
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2  # noqa: E741
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    p1 = strassen(a11 + a22, b11 + b22)
    p2 = strassen(a21 + a22, b11)
    p3 = strassen(a11, b12 - b22)
    p4 = strassen(a22, b21 - b11)
    p5 = strassen(a11 + a12, b22)
    p6 = strassen(a21 - a11, b11 + b12)
    p7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * i, 2 * l), np.int64)
    out[:i, :l] = p1 + p4 - p5 + p7
    out[:i, l:] = p3 + p5
    out[i:, :l] = p2 + p4
    out[i:, l:] = p1 - p2 + p3 + p6
    return out[:m, :n]


class Heaps:
    """The ``size`` best (score, id) of every slot; pushes in any order give the same rows."""

    def __init__(self, slots: int, size: int) -> None:
        self.size = size
        self.slot = np.zeros(0, np.int64)
        self.score, self.vec_id = self.slot, self.slot
        self.worst = np.full(slots, _LEAST_SCORE)

    def push(self, slot: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score = np.concatenate([self.slot, slot]), np.concatenate([self.score, score])
        vec_id = np.concatenate([self.vec_id, vec_id])
        order = np.lexsort((vec_id, -score, slot))
        slot = slot[order]
        first = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
        rank = np.arange(len(slot)) - np.repeat(first, np.diff(np.r_[first, len(slot)]))
        kept = rank < self.size
        order, full = order[kept], rank == self.size - 1
        self.slot, self.score, self.vec_id = slot[kept], score[order], vec_id[order]
        self.worst[slot[full]] = self.score[rank[kept] == self.size - 1]


class Block:
    """Rows of a block, their vectors still ragged."""

    def __init__(self, table: pa.Table) -> None:
        self.vec_id, self.label = (table.column(c).to_numpy().astype(np.int64) for c in ("vec_id", "label"))
        vectors = table.column("v").combine_chunks() if table.num_rows else pa.array([], pa.list_(pa.int32()))
        vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
        self.values = vectors.flatten().to_numpy(zero_copy_only=False)
        self.offsets = np.r_[0, np.cumsum(np.diff(vectors.offsets.to_numpy()))].astype(np.int64)
        self.lengths = np.diff(self.offsets)

    def tiles(self, rows: np.ndarray) -> Iterator[np.ndarray]:
        """The rows in parts of at most ``TILE_ROWS`` rows and about ``TILE_VALUES`` components."""
        rows = rows[np.argsort(self.lengths[rows], kind="stable")]
        while len(rows):
            width = np.maximum(1, self.lengths[rows[:TILE_ROWS]])
            n = max(1, int(np.count_nonzero(width * np.arange(1, len(width) + 1) <= TILE_VALUES)))
            yield rows[:n]
            rows = rows[n:]

    def dense(self, rows: np.ndarray, width: int) -> np.ndarray:
        """The rows' first ``width`` components, with zeros behind shorter ones."""
        place = np.arange(width)
        inside = place < self.lengths[rows][:, None]
        at = np.minimum(self.offsets[rows][:, None] + place, max(0, len(self.values) - 1))
        return np.where(inside, self.values[at] if len(self.values) else 0, 0).astype(np.int64)

    def widest(self, rows: np.ndarray) -> int:
        return int(self.lengths[rows].max(initial=0))


def scores(anchors: Block, rows: np.ndarray, others: Block, columns: np.ndarray) -> np.ndarray:
    width = min(anchors.widest(rows), others.widest(columns))
    return strassen(anchors.dense(rows, width), np.ascontiguousarray(others.dense(columns, width).T))


def _positives(left: pa.Table, right: pa.Table) -> pa.Table:
    """The block's best candidates of every anchor's own label."""
    anchors, others = Block(left), Block(right)
    heaps = Heaps(left.num_rows, POSITIVES)
    for label in np.intersect1d(anchors.label, others.label):
        for rows in anchors.tiles(np.flatnonzero(anchors.label == label)):
            for columns in others.tiles(np.flatnonzero(others.label == label)):
                score = scores(anchors, rows, others, columns)
                hit = (score >= heaps.worst[rows][:, None]) & (anchors.vec_id[rows][:, None] != others.vec_id[columns])
                i, j = np.nonzero(hit)
                heaps.push(rows[i], score[i, j], others.vec_id[columns[j]])
    anchor = left.column("anchor").to_numpy()
    return pa.table(
        {"anchor": anchor[heaps.slot], "positive_id": heaps.vec_id, "positive_score": heaps.score}
    )


def _negatives(left: pa.Table, right: pa.Table) -> pa.Table:
    """The block's best candidates of other labels in the window of every anchor and positive."""
    anchors, others = Block(left), Block(right)
    n = left.num_rows
    bounds = np.full((n, POSITIVES), _LEAST_SCORE)
    ids = np.zeros((n, POSITIVES), np.int64)
    for row, found in enumerate(left.column("positives").to_pylist()):
        for place, positive in enumerate(found):
            bounds[row, place], ids[row, place] = positive["positive_score"], positive["positive_id"]
    heaps = Heaps(n * POSITIVES, NEGATIVES)
    for rows in anchors.tiles(np.arange(n)):
        top = bounds[rows]
        for columns in others.tiles(np.arange(right.num_rows)):
            score = scores(anchors, rows, others, columns)
            other = anchors.label[rows][:, None] != others.label[columns]
            for place in range(POSITIVES):
                positive, slot = top[:, place, None], rows * POSITIVES + place
                hit = other & (positive >= 0) & (score <= positive) & (score * LEAST[1] >= positive * LEAST[0])
                i, j = np.nonzero(hit & (score >= heaps.worst[slot][:, None]))
                heaps.push(slot[i], score[i, j], others.vec_id[columns[j]])
    row, place = heaps.slot // POSITIVES, heaps.slot % POSITIVES
    return pa.table(
        {
            "anchor": left.column("anchor").to_numpy()[row],
            "anchor_id": anchors.vec_id[row],
            "place": place,
            "positive_id": ids[row, place],
            "positive_score": bounds[row, place],
            "negative_id": heaps.vec_id,
            "negative_score": heaps.score,
        }
    )


def _ranked(rows: DataFrame, key: list[str], kind: str, size: int, rank: str) -> DataFrame:
    """The ``size`` best rows of a key; heaps are merged in the map tasks first."""
    order = Window.partitionBy(*key).orderBy(F.desc(f"{kind}_score"), f"{kind}_id")
    return rows.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= size)


def mine(rows: DataFrame, label: str | Column = "label", vector: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    label = F.col(label) if isinstance(label, str) else label
    numbered = store(usable(rows, label, vector).withColumn("row", F.monotonically_increasing_id()))
    is_anchor = F.col("vec_id") % ANCHOR_STEP == 0
    n, n_anchors, values = numbered.agg(
        F.count("*"), F.count_if(is_anchor), F.coalesce(F.sum(F.size("v")), F.lit(0))
    ).first()
    block_rows = max(1, BLOCK_VALUES * max(1, n) // max(1, values, n))
    blocks, anchor_blocks = -(-n // block_rows) or 1, -(-n_anchors // block_rows) or 1
    dealt = lambda count: F.pmod(F.xxhash64("row"), F.lit(count))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)).cast("array<long>"))
    candidates = numbered.select("vec_id", "label", "v", dealt(blocks).alias("block"), every(anchor_blocks).alias("part"))
    anchors = numbered.filter(is_anchor).select(F.col("row").alias("anchor"), "vec_id", "label", "v", dealt(anchor_blocks).alias("part"))

    def meet(own: DataFrame, run: object, schema: str) -> DataFrame:
        own = own.select("*", every(blocks).alias("block"))
        return own.groupBy("part", "block").cogroup(candidates.groupBy("part", "block")).applyInArrow(run, schema)

    found = meet(anchors, _positives, "anchor long, positive_id long, positive_score long")
    positives = (
        _ranked(found, ["anchor"], "positive", POSITIVES, "place")
        .groupBy("anchor")
        .agg(F.sort_array(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("positives"))
    )
    armed = store(anchors.join(positives, "anchor"))
    found = meet(
        armed,
        _negatives,
        "anchor long, anchor_id long, place long, positive_id long, positive_score long, negative_id long, negative_score long",
    )
    return _ranked(found, ["anchor", "place"], "negative", NEGATIVES, "rank").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )

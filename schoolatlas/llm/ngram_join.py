"""N-gram Jaccard self-join of documents with prefix trees.

A document's set is its distinct shingles of ``k`` lower-cased words; two documents link when
``100 * |intersection| >= percent * |union|``, and the result is each document's component.

1. Equal sets are one set, named by a 64-bit hash; everything below works on distinct sets.
2. Shingles get a global order, rare ones first.  Of two linked sets each must hold a common
   shingle among its first ``n - ceil(percent n / 100) + 1``.  Counting how many sets hold a shingle
   needs only the ``LOW_SHARE`` of the shingles with the smallest hashes: order those by their
   count, then all others by hash, then the heavy ones (in a ``HEAVY_PART``-th of all sets or more,
   found by map-side counts).  Counts are made in buckets of shingles, packed as arrays.
3. A shingle counted once links nothing.  Sets that share one of their first shingles form
   candidate components; ordinary documents share none and are done.
4. Within a candidate component the sets, ordered alike, stand in a prefix tree, laid out level by
   level.  A set is held against the tree from the root down: sets with a common beginning share
   its partial overlap (the tail of a set alone below a node is held against it in steps), and a
   subtree is left as soon as the overlap so far and the shingles that
   remain in the set or in the subtree's longest one can't reach the threshold, or when it holds
   no set outside the component that the set has already joined.  Every set is probed but those of
   one last component, so no link between components is lost, and the sets of a large family of
   near copies need no pair of their own.
5. A candidate component beyond ``BLOCK_SHINGLES`` is cut into parts by hash, and every pair of
   parts is one task; the links found are merged by connected components in Spark.

Copies never meet: the map tasks merge them.  Heavy shingles never gather in one bucket.

Defined cases: a null text, or one without words, has an empty set and is a component of its own,
named by its id; fewer than k words make one shingle; a null id never names a component that has
other ids; repeated rows share a component; other columns do not matter.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schoolatlas.llm.common import (
    LOWER,
    mix,
    prefix_sums,
    ship,
    shingles,
    slices,
    span_hashes,
    store,
    text_bytes,
    word_spans,
)
from schoolatlas.llm.components import components

WORDS, PERCENT = 4, 85
LOW_SHARE = 0.3
HEAVY_PART = 500
HEAVY_LEAST = 64
SEEN_LEAST = 16
BUCKET_TOKENS = 1 << 19
BLOCK_SHINGLES = 1_000_000
SLICE = 2 << 20
SLICES_SEEN = 4
_LOW = np.uint64(int(LOW_SHARE * 2**64))
_ODD = np.uint64(0xD6E8FEB86659FD93)

ship(__name__)


def sets_of(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    data = LOWER[data]
    first, last, word_of = word_spans(data, offsets)
    words = span_hashes(prefix_sums(data), first, last)
    grams = shingles(words, k)
    out = []
    for a, b in zip(word_of[:-1].tolist(), word_of[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(grams[a : b - k + 1]))
        else:
            out.append(shingles(words[a:b], b - a) ^ np.uint64(b - a) if b > a else np.zeros(0, np.uint64))
    return out


def name_of(tokens: np.ndarray) -> int:
    """The 64-bit name of a set, never 0 unless it is empty."""
    if not len(tokens):
        return 0
    with np.errstate(over="ignore"):
        total = mix((tokens * _ODD).sum(dtype=np.uint64) + np.uint64(len(tokens)))
    return int(total.astype(np.int64)) or 1


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def _slices(batch: pa.RecordBatch, limit: int, k: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    data, offsets = text_bytes(batch.column("text"))
    for a, b in slices(np.diff(offsets), limit):
        yield a, b, sets_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], k)


def describe(docs: DataFrame, k: int) -> DataFrame:
    """Per document: doc_id, text_1, ``n`` shingles, the set's ``id``, and on some rows the shingles seen often near it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, some = {}, []
            for a, b, sets in _slices(batch, SLICE, k):
                names = [name_of(s) for s in sets]
                held.update(zip(names, sets, strict=True))
                some.append(a)
                often = []
                if len(some) == SLICES_SEEN or b == batch.num_rows:
                    token, n = np.unique(np.concatenate([*held.values(), np.zeros(0, np.uint64)]), return_counts=True)
                    token, n = token[n >= SEEN_LEAST].view(np.int64), n[n >= SEEN_LEAST]
                    often = [{"token": t, "n": c} for t, c in zip(token.tolist(), n.tolist(), strict=True)]
                    held, some = {}, []
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(a, b - a) for c in ("doc_id", "text_1")),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(names, pa.int64()),
                        pa.array([often] + [None] * (b - a - 1), pa.list_(pa.struct([("token", pa.int64()), ("n", pa.int64())]))),
                    ],
                    names=["doc_id", "text_1", "n", "id", "seen"],
                )

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_1"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_1 bigint, n bigint, id bigint, seen array<struct<token: bigint, n: bigint>>")


_PACKED = "bucket bigint, ids binary, rooms binary, lengths binary, tokens binary"


def _pack(bucket: int, ids: list, rooms: list, tokens: list[np.ndarray]) -> tuple:
    joined = np.concatenate(tokens)
    lengths = np.array([len(t) for t in tokens], np.int64)
    return bucket, np.array(ids, np.int64).tobytes(), np.array(rooms, np.int64).tobytes(), lengths.tobytes(), joined.tobytes()


def first_tokens(docs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """(token, id): the shingles within the sets' prefixes that other sets hold too.  ``classes``: described rows."""
    spark = docs.sparkSession
    sets, total = classes.filter("n > 0").agg(F.approx_count_distinct("id"), F.sum("n")).first()
    seen = classes.filter("seen is not null").select(F.explode("seen").alias("s")).groupBy("s.token").agg(F.sum("s.n").alias("n"))
    # At most HEAVY_PART shingles per shingle of the mean set can be in a HEAVY_PART-th of all sets.
    heavy = seen.filter(F.col("n") >= max(HEAVY_LEAST, (sets or 0) // HEAVY_PART)).toArrow()
    heavy_token = np.sort(heavy.column("token").to_numpy().astype(np.int64).view(np.uint64))
    at = np.argsort(heavy.column("token").to_numpy().astype(np.int64).view(np.uint64))
    heavy_count = heavy.column("n").to_numpy().astype(np.int64)[at]
    buckets = max(1, int((total or 0) * LOW_SHARE) // BUCKET_TOKENS)
    held = spark.sparkContext.broadcast((heavy_token, heavy_count))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy_token, heavy_count = held.value
        for batch in batches:
            for _, _, sets in _slices(batch, SLICE, k):
                ids, rooms, low, direct_ids, direct = [], [], [], [], []
                for name, tokens in {name_of(s): s for s in sets if len(s)}.items():
                    place = np.searchsorted(heavy_token, tokens)
                    is_heavy = np.zeros(len(tokens), bool)
                    inside = place < len(heavy_token)
                    is_heavy[inside] = heavy_token[place[inside]] == tokens[inside]
                    light = tokens[~is_heavy]
                    n_low = int(np.searchsorted(light, _LOW))
                    room = prefix_length(len(tokens), percent) - n_low
                    if n_low:
                        ids.append(name)
                        rooms.append(room)
                        low.append(light[:n_low])
                    if room > 0:
                        late = tokens[is_heavy][np.lexsort((tokens[is_heavy], heavy_count[place[is_heavy]]))]
                        direct_ids.append(name)
                        direct.append(np.concatenate([light[n_low:], late])[:room])
                rows = []
                if ids:
                    owner = np.repeat(np.arange(len(ids)), [len(t) for t in low])
                    tokens = np.concatenate(low)
                    bucket = (mix(tokens) % np.uint64(buckets)).astype(np.int64)
                    order = np.argsort(bucket, kind="stable")
                    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
                    name, room = np.array(ids, np.int64), np.array(rooms, np.int64)
                    for a, b in zip(cuts, np.append(cuts[1:], len(order)), strict=True):
                        own = owner[order[a:b]]
                        runs = np.flatnonzero(np.diff(own, prepend=-1))
                        lengths = np.diff(np.append(runs, b - a)).astype(np.int64)
                        who = own[runs]
                        rows.append(
                            (int(bucket[order[a]]), name[who].tobytes(), room[who].tobytes(), lengths.tobytes(), tokens[order[a:b]].tobytes())
                        )
                if direct_ids:
                    rows.append(_pack(-1 - direct_ids[0] % buckets, direct_ids, [0] * len(direct_ids), direct))
                if rows:
                    columns = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(columns[0], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[1:])],
                        names=["bucket", "ids", "rooms", "lengths", "tokens"],
                    )

    def count(table: pa.Table) -> pa.Table:
        numbers = lambda c, kind=np.int64: np.frombuffer(b"".join(table.column(c).to_pylist()), kind)
        lengths = numbers("lengths")
        token = numbers("tokens", np.uint64)
        name, room = np.repeat(numbers("ids"), lengths), np.repeat(numbers("rooms"), lengths)
        if table.column("bucket")[0].as_py() < 0:
            n = np.full(len(token), -1, np.int64)
        else:
            order = np.lexsort((name, token))
            token, name, room = token[order], name[order], room[order]
            new = np.ones(len(token), bool)
            new[1:] = (token[1:] != token[:-1]) | (name[1:] != name[:-1])
            token, name, room = token[new], name[new], room[new]
            starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
            sizes = np.diff(np.append(starts, len(token)))
            n = np.repeat(sizes, sizes).astype(np.int64)
            shared = n > 1
            token, name, room, n = token[shared], name[shared], room[shared], n[shared]
        return pa.table({"id": name, "room": room, "token": token.view(np.int64), "n": n})

    sent = docs.select("text").mapInArrow(send, _PACKED)
    counted = store(sent.groupBy("bucket").applyInArrow(count, "id bigint, room bigint, token bigint, n bigint"))
    # Of n_low low shingles the shared ones come last: of those the first ``shared + room`` are in the prefix.
    prefix = (
        counted.filter("n > 0")
        .groupBy("id", "room")
        .agg(F.array_sort(F.collect_list(F.struct("n", "token"))).alias("shared"))
        .withColumn("places", F.size("shared") + F.col("room"))
        .filter("places > 0")
    )
    chosen = prefix.select("id", F.explode(F.slice("shared", F.lit(1), F.col("places").cast("int"))["token"]).alias("token"))
    return counted.filter("n < 0").select("id", "token").unionByName(chosen).distinct()


def _needed(n: np.ndarray, own: int, percent: int) -> np.ndarray:
    """The least overlap of sets of n and own shingles that link."""
    return -(-percent * (n + own) // (100 + percent))


def _ranges(first: np.ndarray, width: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (width[0] numbers), first[1], ..."""
    return np.repeat(first - (np.cumsum(width) - width), width) + np.arange(width.sum())


class PrefixTree:
    """Sets of small integers, each ascending, in a prefix tree laid out level by level.

    The sets are put in lexicographic order, so a node's sets are a range.  Nodes of one set are not
    laid out: the rest of that set is a tail that hangs from the last node it shares.
    """

    def __init__(self, sets: list[np.ndarray], vocabulary: int):
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">i4").tobytes())
        sets = [sets[i] for i in self.order]
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.n = len(sets)
        self.flat = np.concatenate([*sets, np.zeros(0, np.int64)])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.marked = np.zeros(vocabulary, bool)
        self.tail_from = self.sizes.copy()
        #: Per level: token and range of sets of each node; by node of the level before, the ranges of its nodes and tails.
        self.token, self.lo, self.hi, self.child, self.tails, self.tail = [], [], [], [], [], []
        #: Per level: the sets that have a node there, and that node.
        self.rows, self.node = [], []
        rows, parent, parents, level = np.arange(self.n), np.zeros(self.n, np.int64), 1, 0
        while len(rows):
            longer = self.sizes[rows] > level
            rows, parent = rows[longer], parent[longer]
            values = self.flat[self.starts[rows] + level]
            new = np.ones(len(rows), bool)
            new[1:] = (values[1:] != values[:-1]) | (parent[1:] != parent[:-1])
            group = np.cumsum(new) - 1
            alone = np.bincount(group, minlength=1)[group] == 1 if len(rows) else np.zeros(0, bool)
            self.tail_from[rows[alone]] = level
            self.tails.append(rows[alone])
            self.tail.append(np.searchsorted(parent[alone], np.arange(parents + 1)))
            rows, parent, values, new = rows[~alone], parent[~alone], values[~alone], new[~alone]
            first = np.flatnonzero(new)
            self.token.append(values[first])
            self.lo.append(rows[first])
            self.hi.append(rows[np.append(first[1:], len(rows)) - 1] + 1 if len(first) else rows)
            self.child.append(np.searchsorted(parent[first], np.arange(parents + 1)))
            parent, parents, level = np.cumsum(new) - 1, len(first), level + 1
            self.rows.append(rows)
            self.node.append(parent)
        self.candidate = np.zeros(self.n, bool)
        #: By token the sets that have it among their first tokens, one of which a linked set must share.
        self.index_at = np.zeros(vocabulary + 1, np.int64)
        self.index = np.zeros(0, np.int64)

    def index_first(self, percent: int) -> None:
        """Index the first tokens of every set: all but as many as the least overlap of a link, less one."""
        width = self.sizes - -(-percent * self.sizes // 100) + 1
        owner = np.repeat(np.arange(self.n), width)
        token = self.flat[_ranges(self.starts, width)] if self.n else owner
        self.index = owner[np.argsort(token, kind="stable")]
        self.index_at = np.searchsorted(np.sort(token), np.arange(len(self.index_at)))

    def probe(self, tokens: np.ndarray, wanted: Callable[[np.ndarray], np.ndarray], percent: int) -> np.ndarray:
        """Places of the wanted sets that link with the tokens.

        Both sets of a link share one of their first tokens, so only the tree's paths to the sets that the
        index names are gone down, each node once for all the sets below it.
        """
        own = len(tokens)
        at_least, at_most = -(-percent * own // 100), 100 * own // percent
        first = tokens[: own - at_least + 1]
        start, end = self.index_at[first], self.index_at[first + 1]
        listed = self.index[_ranges(start, end - start)]
        if 8 * len(listed) > self.n:  # long lists are marked, short ones sorted
            self.candidate[listed] = True
            rows = np.flatnonzero(self.candidate)
            self.candidate[rows] = False
        else:
            rows = np.unique(listed)
        rows = rows[(self.sizes[rows] >= at_least) & (self.sizes[rows] <= at_most)]
        rows = rows[wanted(rows)]
        fewest = _needed(np.array([at_least]), own, percent)[0]
        self.marked[tokens], self.candidate[rows] = True, True
        found, tails, shared_by = [], [], []
        # Nodes on the way to candidates, what each shares with the tokens, and its range of the candidates.
        node, overlap, a, b = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64), np.array([len(rows)])
        for level in range(min(len(self.token), at_most) if len(rows) else 0):
            tail, tail_end = self.tail[level][node], self.tail[level][node + 1]
            child, child_end = self.child[level][node], self.child[level][node + 1]
            if (tail_end - tail + child_end - child).sum() <= (b - a).sum():  # few branches: look at each
                hanging, shared = self.tails[level][_ranges(tail, tail_end - tail)], np.repeat(overlap, tail_end - tail)
                keep = self.candidate[hanging]
                hanging, shared_tail = hanging[keep], shared[keep]
                shared = np.repeat(overlap, child_end - child)
                child = _ranges(child, child_end - child)
                a, b = np.searchsorted(rows, self.lo[level][child]), np.searchsorted(rows, self.hi[level][child])
                alive = b > a
                child, shared, a, b = child[alive], shared[alive], a[alive], b[alive]
            else:  # few candidates: look for their branches
                place, shared = _ranges(a, b - a), np.repeat(overlap, b - a)
                here = self.sizes[rows[place]] > level
                place, shared = place[here], shared[here]
                tailed = self.tail_from[rows[place]] == level
                hanging, shared_tail = rows[place[tailed]], shared[tailed]
                place, shared = place[~tailed], shared[~tailed]
                below = self.node[level][np.searchsorted(self.rows[level], rows[place])]
                first = np.flatnonzero(np.r_[True, below[1:] != below[:-1]]) if len(below) else np.zeros(0, np.int64)
                child, shared, a = below[first], shared[first], place[first]
                b = place[np.append(first[1:], len(below)) - 1] + 1 if len(first) else a
            tails.append(hanging)
            shared_by.append(shared_tail)
            if not len(child):
                break
            token = self.token[level][child]
            shared = shared + self.marked[token]
            left = np.minimum(own - np.searchsorted(tokens, token, "right"), at_most - level - 1)
            alive = shared + left >= fewest
            node, overlap, a, b = child[alive], shared[alive], a[alive], b[alive]
            # A set that ends here stands first in its node's range; equal sets do not occur.
            lo = self.lo[level][node]
            ends = self.sizes[lo] == level + 1
            done = lo[ends]
            linked = self.candidate[done] & (100 * overlap[ends] >= percent * (own + level + 1 - overlap[ends]))
            found.append(done[linked])
        if tails:
            found.append(self._follow(np.concatenate(tails), np.concatenate(shared_by), tokens, percent))
        self.marked[tokens], self.candidate[rows] = False, False
        return np.concatenate([*found, np.zeros(0, np.int64)])

    def _follow(self, rows: np.ndarray, shared: np.ndarray, tokens: np.ndarray, percent: int, step: int = 24) -> np.ndarray:
        """Of the sets whose tails are still to be held against the tokens, those that link."""
        own, at, found = len(tokens), self.tail_from[rows], []
        while len(rows):
            width = np.minimum(step, self.sizes[rows] - at)
            values = self.flat[_ranges(self.starts[rows] + at, width)]
            shared = shared + np.add.reduceat(self.marked[values], np.cumsum(width) - width, dtype=np.int64)
            at = at + width
            last = self.flat[self.starts[rows] + at - 1]
            size = self.sizes[rows]
            left = np.minimum(own - np.searchsorted(tokens, last, "right"), size - at)
            alive = shared + left >= _needed(size, own, percent)
            done = alive & (at == size)
            found.append(rows[done])
            go = alive & ~done
            rows, shared, at = rows[go], shared[go], at[go]
        return np.concatenate([*found, np.zeros(0, np.int64)])


def join_sets(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """The component of each of some distinct sets of hashes, as the place of one of its sets."""
    tokens, inverse, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(tokens), np.int64)
    rank[np.lexsort((tokens, n))] = np.arange(len(tokens))
    bounds = np.cumsum([0, *map(len, sets)])
    ranked = [np.sort(rank[inverse[a:b]]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    tree = PrefixTree(ranked, len(tokens))
    tree.index_first(percent)
    own = [ranked[i] for i in tree.order]
    comp = np.arange(tree.n)
    members = {i: [i] for i in range(tree.n)}
    unprobed = [1] * tree.n  # by component
    probed = np.zeros(tree.n, bool)
    queue: list[tuple[int, int]] = []

    def probe(i: int) -> None:
        probed[i] = True
        unprobed[comp[i]] -= 1
        linked = tree.probe(own[i], lambda rows: comp[rows] != comp[i], percent)
        for other in np.unique(comp[linked]).tolist():
            small, large = sorted((other, int(comp[i])), key=lambda c: len(members[c]))
            comp[members[small]] = large
            members[large] += members.pop(small)
            unprobed[large] += unprobed[small]
            heapq.heappush(queue, (unprobed[large], large))

    for i in range(tree.n):  # first the sets that no set before has reached
        if len(members[comp[i]]) == 1:
            probe(i)
    # Then the component with the fewest sets left, till one has any.
    queue.extend((unprobed[c], c) for c in members if unprobed[c])
    heapq.heapify(queue)

    def fewest(beside: int = -1) -> int:
        while queue:
            left, c = heapq.heappop(queue)
            # Else it has grown, is part of another, or stands in the queue twice.
            if c != beside and left and c in members and unprobed[c] == left:
                return c
        return -1

    while (now := fewest()) >= 0 and (then := fewest(now)) >= 0:
        heapq.heappush(queue, (unprobed[then], then))
        for i in [i for i in members[now] if not probed[i]]:
            probe(i)
        c = int(comp[i])
        heapq.heappush(queue, (unprobed[c], c))
    out = np.empty(tree.n, np.int64)
    out[np.array(tree.order)] = np.array(tree.order)[comp]
    return out


def linked_sets(docs: DataFrame, candidates: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, b) edges that connect the linked sets.  ``candidates``: id, block, n, doc_id, text_1 of one document per set."""
    parts = candidates.groupBy("block").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("parts"))
    named = candidates.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    # One task per pair of parts (i <= j); a block of one part is one task.
    others = F.sequence(F.lit(0), F.col("parts") - 1)
    pair = F.transform(others, lambda o: F.struct(F.least("part", o).alias("i"), F.greatest("part", o).alias("j")))
    named = store(named.select("id", "block", F.col("doc_id").alias("_doc"), F.col("text_1").alias("_text"), pair.alias("pairs")))
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_1"), "text")
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_1") == F.col("_text"))
    # The candidates grow with the corpus: the join shuffles at every size.
    texts = texts.join(named.hint("merge"), same).dropDuplicates(["id"])
    texts = texts.select("id", "block", F.explode("pairs").alias("pair"), "text").select("id", "block", "pair.i", "pair.j", "text")

    def join(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        data, offsets = text_bytes(table.column("text"))
        sets = []
        for a, b in slices(np.diff(offsets), SLICE):
            sets += sets_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], k)
        least = ids[join_sets(sets, percent)]
        return pa.table({"a": ids, "b": least}).filter(pa.array(ids != least))

    return texts.groupBy("block", "i", "j").applyInArrow(join, "a bigint, b bigint")


def resolve(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, ``n_shingles``, set ``id`` and ``component_id``, the least doc_id that links reach."""
    described = store(describe(docs.select("doc_id", "text"), k))
    tokens = store(first_tokens(docs, described, k, percent))
    leaders = tokens.groupBy("token").agg(F.min("id").alias("b"), F.count("*").alias("n")).filter("n > 1")
    edges = tokens.join(leaders, "token").select(F.col("id").alias("a"), "b").distinct()
    blocks = components(edges).select(F.col("node").alias("id"), F.col("component").alias("block"))
    classes = (
        described.filter("n > 0")
        .groupBy("id")
        .agg(F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "text_1")).alias("one"), F.first("n").alias("n"))
    )
    classes = store(classes.select("id", "least", "n", "one.doc_id", "one.text_1"))
    candidates = store(classes.join(blocks, "id").select("id", "block", "n", "doc_id", "text_1"))
    joined = components(linked_sets(docs, candidates, k, percent))
    joined = joined.select(F.col("node").alias("id"), F.col("component"))
    members = classes.join(joined, "id", "left").select("id", "least", F.coalesce("component", "id").alias("component"))
    # Components of several sets take the least id of all their sets.
    names = members.groupBy("component").agg(F.min("least").alias("component_id"))
    named = store(members.join(names, "component").select("id", "component", "component_id"))
    full = described.filter("n > 0").join(named, "id").select("doc_id", "text_1", "n", "component", "component_id")
    empty = described.filter("n = 0").select(
        "doc_id", "text_1", "n", F.lit(None).cast("bigint").alias("component"), F.col("doc_id").alias("component_id")
    )
    return full.unionByName(empty).withColumnRenamed("n", "n_shingles")


def keep_one(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each component, the one of the least id, with all columns; empty ones all stay."""
    rows = store(resolve(docs, k, percent).filter("component is not null").select("doc_id", "text_1", "component"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_1")).alias("one")
    kept = rows.groupBy("component").agg(least).select("component", "one.doc_id", "one.text_1")
    # (id, text) of what goes, and of what stays although it stands in several rows.
    counts = rows.groupBy("component", "doc_id", "text_1").agg(F.count("*").alias("n"))
    kept = kept.select(*(F.col(c).alias(f"_{c}") for c in kept.columns))
    first = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_1") == F.col("_text_1"))
    judged = counts.join(kept, F.col("component") == F.col("_component")).select("doc_id", "text_1", "n", first.alias("stays"))
    listed = store(judged.filter("not stays or n > 1"))
    own = F.xxhash64(docs["text"])

    def named(which: DataFrame) -> tuple[DataFrame, Column]:
        which = which.select("doc_id", "text_1").hint("merge")  # grows with the corpus, so it is never sent whole
        return which, docs["doc_id"].eqNullSafe(which["doc_id"]) & (own == which["text_1"])

    single = docs.join(*named(listed), "left_anti")
    several = docs.join(*named(listed.filter("stays")), "left_semi").dropDuplicates(["doc_id", "text"])
    return single.unionByName(several)

"""Spelling variants: words one code point apart, and the frequent form that each leads to.

``count_words`` makes the vocabulary: runs of Latin letters, lower-cased in A-Z,
with a seeded deletion of one code point in every ``DAMAGE``-th occurrence, at
least ``LEAST_LENGTH`` code points long and met ``LEAST_COUNT`` times or more.
``group_variants`` finds all words at an edit distance of exactly one.

The words stand in a trie: its levels are groups of letters, an edge is the number
of the word's letters in that group.  A word one edit away lies on a path with at
most one letter more and at most one letter less than the word's own.  The search
goes down depth first with a budget of one surplus and one deficit and drops every
branch that needs more; the words of the leaves it reaches are verified.

Spark holds the trie's top: a word's rows travel to every node that its budgets
reach within the first ``START`` levels (13 at most).  A node with more than
``NODE_WORDS`` words is split by the next level, as often as needed, so a common
letter pattern does not gather in one task.  Below, every task walks its node's
subtree, an array of words sorted by their counts, with all queries of a branch
at once.  Pairs are counted where they are found; only a count and the best form
of each word leave the task.  Forms are followed by pointer doubling: a form has
at least twice its word's count, so a chain has at most 62 steps, six doublings.

Defined cases.  Null and empty texts have no words.  A null ``doc_id`` counts as
an empty one in the seed.  Very long texts are searched by Spark's own functions, a
row at a time; very long words are compared with those of their letter counts only.
Ties between forms: larger count, then code-point order.  Repeated rows
count each.  Empty tables give no words; other columns are ignored.  Words that
agree in all ``len(LEVELS)`` counts stay in one task; there, more than
``PAIRS`` pairs are not compared but joined by their first or last halves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schoolatlas.llm.common import ship, store

ship(__name__)

#: Runs of Latin letters.
RUN = "[A-Za-zÀ-ÿ]+"
DAMAGE, LEAST_LENGTH, LEAST_COUNT = 97, 5, 3
#: A form has at least so many times its word's count.
FORM_RATIO = 2
#: Letter groups by code point modulo 16, in the order of the trie's levels.
LEVELS = (5, 4, 14, 1, 9, 2, 3, 15, 12, 8, 13, 0, 7, 6, 10, 11)
START, NODE_WORDS = 3, 20_000
#: Pairs of a leaf that are compared directly; pairs that are verified at a time.
PAIRS, BATCH = 1 << 18, 1 << 18
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def count_words(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """word, n: the vocabulary of whole texts."""
    lowered = F.translate(F.col(text), UPPER, UPPER.lower())
    runs = docs.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))).alias("run")
    ).filter(F.length("run") >= LEAST_LENGTH)
    seed = F.crc32(F.concat("id", F.lit(":"), "run"))
    place = (F.col("seed") % F.length("run")).cast("int")
    damaged = F.concat(F.substring("run", F.lit(1), place), F.substring(F.col("run"), place + 2, F.length("run")))
    word = F.when(F.col("seed") % DAMAGE == 0, damaged).otherwise(F.col("run"))
    words = runs.withColumn("seed", seed).select(word.alias("word")).filter(F.length("word") >= LEAST_LENGTH)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _letters(level: int) -> str:
    return "".join(map(chr, (c for c in (*range(97, 123), *range(0xC0, 0x100)) if c % 16 == LEVELS[level])))


def _count(level: int) -> Column:
    """The word's letters of a level's group."""
    return F.length("word") - F.length(F.translate("word", _letters(level), ""))


def _edge(node: Column, count: Column) -> Column:
    return F.concat(node, count.cast("string"), F.lit("."))


def _descend(rows: DataFrame, level: int, where: Column | None = None) -> DataFrame:
    """One level down: to the node of the same count, of one less and of one more, as far as the budgets go."""
    node, more, less, count = F.col("node"), F.col("surplus"), F.col("deficit"), F.col("count")
    step = lambda c, m, d: F.struct(_edge(node, c).alias("node"), m.alias("surplus"), d.alias("deficit"))
    steps = F.array(
        step(count, more, less),
        F.when((more > 0) & (count > 0), step(count - 1, more - 1, less)),
        F.when(less > 0, step(count + 1, more, less - 1)),
    )
    if where is not None:
        steps = F.when(where, steps).otherwise(F.array(F.struct("node", "surplus", "deficit")))
    counted = rows.withColumn("count", _count(level))
    stepped = counted.select("word", "n", F.explode(F.filter(steps, lambda x: x.isNotNull())).alias("to"))
    return stepped.select("word", "n", "to.node", "to.surplus", "to.deficit")


def route(words: DataFrame) -> DataFrame:
    """word, n, node, surplus, deficit: every word at all nodes of the trie's top that its budgets reach."""
    rows = words.select("word", "n", F.lit("").alias("node"), F.lit(1).alias("surplus"), F.lit(1).alias("deficit"))
    node = F.lit("")
    for level in range(START):
        rows, node = _descend(rows, level), _edge(node, _count(level))
    own = words.select("word", node.alias("node"))
    for level in range(START, len(LEVELS)):
        crowded = store(own.groupBy("node").count().filter(F.col("count") > NODE_WORDS).select("node", F.lit(True).alias("crowded")))
        if crowded.isEmpty():
            break
        own = own.join(crowded, "node", "left_semi").withColumn("node", _edge(F.col("node"), _count(level)))
        rows = _descend(rows.join(crowded, "node", "left"), level, F.col("crowded").isNotNull())
    return rows


def counts_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Letters of every level's group in every word (rows: words)."""
    level = np.empty(16, np.int64)
    level[list(LEVELS)] = np.arange(16)
    word = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    flat = np.bincount(word * 16 + level[data % 16], minlength=16 * (len(offsets) - 1))
    return flat.reshape(-1, 16).astype(np.int32)


class Subtree:
    """Words (members) and queries below one node, Latin-1 bytes each; ``pairs`` walks the trie."""

    def __init__(self, words: list[str], members: np.ndarray, depth: int, surplus: np.ndarray, deficit: np.ndarray) -> None:
        raw = [word.encode("latin-1") for word in words]
        self.data = np.frombuffer(b"".join(raw) + b"\0", np.uint8)
        self.lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        self.offsets = np.r_[0, np.cumsum(self.lengths)]
        self.counts = counts_of(self.data[:-1], self.offsets)
        own = self.counts[members]
        self.members = members[np.lexsort(own.T[::-1])]
        self.sorted = self.counts[self.members]
        changes = self.sorted[1:] != self.sorted[:-1]
        #: The first level at which a member differs from the one before.
        self.change = np.where(changes.any(1), changes.argmax(1), len(LEVELS)) if len(changes) else np.zeros(0, np.int64)
        #: The node's level, and what the way to it has left of every query's budgets.
        self.depth, self.surplus, self.deficit = depth, surplus, deficit

    def leaves(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Queries and members that meet at a leaf, within the budgets."""
        stack = [(0, len(self.members), self.depth, np.arange(len(self.lengths)), self.surplus, self.deficit)]
        while stack:
            low, high, level, rows, surplus, deficit = stack.pop()
            change = self.change[low : high - 1]
            fork = int(change.min(initial=len(LEVELS)))  # down to there the branch is one path
            if fork > level:
                over = self.counts[rows, level:fork] - self.sorted[low, level:fork]
                surplus = surplus - np.maximum(over, 0).sum(1)
                deficit = deficit + np.minimum(over, 0).sum(1)
                kept = (surplus >= 0) & (deficit >= 0)
                rows, surplus, deficit = rows[kept], surplus[kept], deficit[kept]
                if not len(rows):
                    continue
            if fork == len(LEVELS):
                yield rows, self.members[low:high]
                continue
            cuts = (low + 1 + np.flatnonzero(change == fork)).tolist()
            count = self.counts[rows, fork]
            for start, end in zip([low, *cuts], [*cuts, high]):
                over = count - self.sorted[start, fork]
                kept = np.flatnonzero((over <= surplus) & (-over <= deficit))
                if len(kept):
                    over = over[kept]
                    stack.append(
                        (start, end, fork + 1, rows[kept], surplus[kept] - np.maximum(over, 0), deficit[kept] + np.minimum(over, 0))
                    )

    def halves(self, rows: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs that share the first or the last half of the shorter word, as all words one edit apart do."""
        text = lambda i: self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()
        by_half: dict[tuple, list[int]] = {}
        for i in members.tolist():
            word = text(i)
            for n in (len(word), len(word) - 1):
                by_half.setdefault((n, 0, word[: n // 2]), []).append(i)
                by_half.setdefault((n, 1, word[len(word) - (n - n // 2) :]), []).append(i)
        found: set[tuple[int, int]] = set()
        for i in rows.tolist():
            word = text(i)
            for n in (len(word), len(word) - 1):
                found.update((i, j) for j in by_half.get((n, 0, word[: n // 2]), ()))
                found.update((i, j) for j in by_half.get((n, 1, word[len(word) - (n - n // 2) :]), ()))
        both = np.array(sorted(found), np.int64).reshape(-1, 2)
        return both[:, 0], both[:, 1]

    def verified(self, rows: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs that are exactly one edit apart."""
        out = []
        short = np.minimum(self.lengths[rows], self.lengths[members])
        longer = np.where(self.lengths[rows] >= self.lengths[members], rows, members)
        other = np.where(self.lengths[rows] >= self.lengths[members], members, rows)
        same = self.lengths[rows] == self.lengths[members]
        for n in np.unique(short).tolist():
            place = np.arange(n)
            for equal in (True, False):
                at = np.flatnonzero((short == n) & (same == equal))
                step = max(1, (BATCH << 4) // max(1, n))
                for at in np.split(at, range(step, len(at), step)):  # noqa: B020
                    a, b = self.offsets[longer[at]][:, None] + place, self.offsets[other[at]][:, None] + place
                    head = self.data[a] == self.data[b]
                    if equal:
                        out.append(at[head.sum(1) == n - 1])
                    else:
                        tail = self.data[a + 1] == self.data[b]
                        ahead = np.where(head.all(1), n, head.argmin(1)) if n else np.zeros(len(at), np.int64)
                        behind = np.where(tail.all(1), n, tail[:, ::-1].argmin(1)) if n else ahead
                        out.append(at[ahead + behind >= n])
        at = np.concatenate(out) if out else np.zeros(0, np.int64)
        return rows[at], members[at]

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Queries and the members one edit away."""
        left, right, size = [], [], 0
        for rows, members in self.leaves():
            if len(rows) * len(members) > PAIRS:
                a, b = self.halves(rows, members)
            else:
                a, b = np.repeat(rows, len(members)), np.tile(members, len(rows))
            left.append(a)
            right.append(b)
            size += len(a)
            if size >= BATCH:
                yield self.verified(np.concatenate(left), np.concatenate(right))
                left, right, size = [], [], 0
        if left:
            yield self.verified(np.concatenate(left), np.concatenate(right))


def _search(rows: pa.Table) -> pa.Table:
    """word, n_near, form_n, form of every query that has a word of this node one edit away."""
    words = rows.column("word").to_pylist()
    n = rows.column("n").to_numpy()
    surplus, deficit = (rows.column(c).to_numpy().astype(np.int64) for c in ("surplus", "deficit"))
    members = np.flatnonzero((surplus == 1) & (deficit == 1))
    n_near, best = np.zeros(len(words), np.int64), np.full(len(words), len(words), np.int64)
    order = np.array(sorted(members.tolist(), key=lambda i: (-n[i], words[i])), np.int64)
    rank = np.zeros(len(words), np.int64)
    rank[order] = np.arange(len(order))
    if len(members):
        depth = rows.column("node")[0].as_py().count(".")
        for query, member in Subtree(words, members, depth, surplus, deficit).pairs():
            n_near += np.bincount(query, minlength=len(words))
            np.minimum.at(best, query, rank[member])
    found = np.flatnonzero(n_near)
    form = order[best[found]]
    return pa.table(
        {
            "word": pa.array([words[i] for i in found.tolist()], pa.string()),
            "n_near": n_near[found],
            "form_n": n[form],
            "form": pa.array([words[i] for i in form.tolist()], pa.string()),
        }
    )


def follow(forms: DataFrame) -> DataFrame:
    """word, root of every word that has a form: pointers are doubled until none moves."""
    pointers = store(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = pointers.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        moved = store(pointers.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved")))
        pointers = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return pointers


def group_variants(words: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n, root of a vocabulary (word, n) of distinct words."""
    words = store(words.select("word", "n"))
    found = route(words).groupBy("node").applyInArrow(_search, "word string, n_near long, form_n long, form string")
    near = found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("rank"), "form")).alias("best")
    )
    taken = -F.col("best.rank") >= FORM_RATIO * F.col("n")
    rows = store(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(taken, F.col("best.form")).alias("form"),
            F.when(taken, -F.col("best.rank")).alias("form_n"),
        )
    )
    roots = follow(rows.filter(F.col("form").isNotNull()))
    return rows.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))

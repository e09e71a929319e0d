"""Benchmark decontamination by spaced-seed hashing.

Words are the lower-cased runs of letters and digits.  From every word of a benchmark item and
of a document on, each fixed mask picks some of the next ``SPAN`` words and skips the others, so
a hash of the picked words survives substitutions at the skipped places.  Equal hashes are hits;
hits of a document and an item on near diagonals (document place minus item place) are verified
on the words themselves.  An item is reported if the hits cover ``CANDIDATE`` of it and the words
that stand at their place on one of those diagonals reach ``SIMILARITY`` of the item, or if they
reach ``SIMILARITY`` of any run of ``RUN`` or more of its words, however long the item is.

Every mask picks the first and the last word, so a document's windows are first held against the
benchmark's (first, last) pairs, and only the few that pass are hashed under each mask.  The
benchmark's hashes are sent to the tasks while they are at most ``BROADCAST_SEEDS`` (counted, some
50 bytes each); beyond that the join shuffles.  Documents never move before the verification, and
then only those with candidates.  Only DataFrame functions are used.

Defined cases: null or empty texts and items have no words; items of fewer than ``SPAN`` words
carry too little to tell a leak from chance and match nothing; a part of an item, or a passage cut
off by the document's start or end, is a leak from ``RUN`` words on; rows equal in id and text give
one result, for whole items before parts; equal items with different ids are each reported; other columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schoolatlas.llm.common import store, text_key

#: Fixed masks: 1 picks a word, 0 skips it.
MASKS = ("1110111", "1101011", "1011101", "1100111")
SPAN = 7
#: Diagonals are joined in overlapping bands of this width, for words left out or put in.
BAND = 8
CANDIDATE = 0.4
SIMILARITY = 0.8
#: So many words of an item in a row, from an equal word to an equal word, are a leak by themselves.
RUN = 14
BROADCAST_SEEDS = 1_000_000
CHUNK = 2048


def words(text: Column) -> Column:
    """The normalised words of a text; none for null."""
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), F.array().cast("array<string>"))


def _windows(rows: DataFrame, *keep: str) -> DataFrame:
    """Per place of ``words``: ``at``, and the hashes w0 to w6 of the words from there on.

    Texts are cut into chunks of places first, so no row grows with a text's length by more than its words.
    """
    hashed = rows.select(*keep, F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    places = F.size("h") - (SPAN - 1)
    chunk = F.transform(
        F.sequence(F.lit(1), F.greatest(places, F.lit(1)), F.lit(CHUNK)),
        lambda s: F.struct((s - 1).alias("from"), F.slice("h", s, CHUNK + SPAN - 1).alias("h")),
    )
    chunks = hashed.filter(places > 0).select(*keep, F.explode(chunk).alias("c")).select(*keep, "c.from", "c.h")
    n = F.size("h") - (SPAN - 1)
    columns = [F.slice("h", i + 1, n).alias(f"w{i}") for i in range(SPAN)]
    zipped = chunks.select(*keep, "from", F.posexplode(F.arrays_zip(*columns)).alias("i", "w"))
    return zipped.select(*keep, (F.col("from") + F.col("i")).alias("at"), "w.*")


def _masked(windows: DataFrame, *keep: str) -> DataFrame:
    """A row per window and mask: ``mask`` and ``seed``."""
    seeds = F.array(
        *(F.xxhash64(F.lit(m), *(F.col(f"w{i}") for i in range(SPAN) if mask[i] == "1")) for m, mask in enumerate(MASKS))
    )
    return windows.select(*keep, F.posexplode(seeds).alias("mask", "seed"))


def _pair() -> Column:
    return F.xxhash64("w0", f"w{SPAN - 1}")


def _holds_run(standing: Column, similarity: float) -> Column:
    """Whether RUN or more consecutive places, the first and the last of which stand, stand by ``similarity``."""
    high = F.lit(1 << 40)
    gain, loss = F.lit(round(1000 * (1 - similarity))).cast("long"), F.lit(-round(1000 * similarity)).cast("long")
    # The sum so far, the sums before each of the last RUN places that stand, and the least sum before older ones.
    start = F.struct(
        F.lit(0).cast("long").alias("total"), F.array(*[high] * RUN).alias("last"), high.alias("least"), F.lit(False).alias("found")
    )

    def step(state: Column, stands: Column) -> Column:
        total = state["total"] + F.when(stands, gain).otherwise(loss)
        last = F.concat(F.slice(state["last"], 2, RUN - 1), F.array(F.when(stands, state["total"]).otherwise(high)))
        least = F.least(state["least"], F.get(state["last"], F.lit(1)))
        found = state["found"] | (stands & (total >= least))
        return F.struct(total.alias("total"), last.alias("last"), least.alias("least"), found.alias("found"))

    return F.aggregate(standing, start, step, lambda state: state["found"])


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, text_1, text_2, item_id, n_words, n_matched, similarity, start) of every leaked item.

    ``start`` is the word of the document at which the item's first word stands, or would (below 0 for the
    later part of an item).
    """
    items = benchmark.select("item_id", words(F.col("text")).alias("item_words"))
    items = store(items.distinct().withColumn("n_words", F.size("item_words")))
    windows = _windows(items.withColumnRenamed("item_words", "words"), "item_id", "n_words")
    seeds = store(_masked(windows.withColumn("pair", _pair()), "item_id", "n_words", F.col("at").alias("item_at"), "pair").distinct())
    pairs = seeds.select("pair").distinct()
    if seeds.count() <= BROADCAST_SEEDS:
        seeds, pairs = F.broadcast(seeds), F.broadcast(pairs)
    keyed = docs.select("doc_id", *text_key(F.col("text")), words(F.col("text")).alias("words"))
    key = ["doc_id", "text_1", "text_2"]
    near = _windows(keyed, *key).withColumn("pair", _pair()).join(pairs, "pair", "left_semi")
    hits = _masked(near, *key, "at").join(seeds.drop("pair"), ["mask", "seed"])
    diagonal = (F.col("at") - F.col("item_at")).alias("diagonal")
    picked = F.lit(None)
    for m, mask in enumerate(MASKS):
        steps = F.array(*(F.col("item_at") + i for i in range(SPAN) if mask[i] == "1"))
        picked = F.when(F.col("mask") == m, steps).otherwise(picked)
    band = F.explode(F.array(F.floor(F.col("diagonal") / BAND) * 2, F.floor((F.col("diagonal") + BAND // 2) / BAND) * 2 + 1))
    covered = (
        hits.select(*key, "item_id", "n_words", diagonal, picked.alias("picked"))
        .groupBy(*key, "item_id", "n_words", "diagonal")
        .agg(F.array_distinct(F.flatten(F.collect_set("picked"))).alias("covered"))
        .withColumn("band", band)
    )
    by_band = covered.groupBy(*key, "item_id", "n_words", "band").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("covered")))).alias("n_covered"),
        F.collect_set("diagonal").alias("diagonals"),
    )
    # Distinct (document, item, diagonals): the two overlapping bands often hold the same.
    # Any hit can be part of a run.
    whole = (F.col("n_covered") >= F.col("n_words") * CANDIDATE).alias("whole")
    candidates = store(
        by_band.filter(whole | (F.col("n_words") >= RUN))
        .groupBy(*key, "item_id", F.array_sort("diagonals").alias("diagonals"))
        .agg(F.max(whole).alias("whole"))
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]
    wanted = candidates.select(*(F.col(c).alias(f"_{c}") for c in key)).distinct()
    texts = keyed.join(wanted, same[0] & same[1] & same[2], "left_semi").dropDuplicates(key)
    named = candidates.select(*(F.col(c).alias(f"_{c}") for c in key), "item_id", "diagonals", "whole")
    both = texts.join(named, same[0] & same[1] & same[2]).join(items, "item_id")
    stands = lambda place: F.exists(
        "diagonals", lambda d: F.get("words", (place + d).cast("int")).eqNullSafe(F.get("item_words", place))
    )
    standing = F.transform(F.sequence(F.lit(0), F.col("n_words") - 1), stands).alias("standing")
    found = both.select(*key, "item_id", "n_words", "whole", F.array_min("diagonals").alias("start"), standing)
    found = found.withColumn("n_matched", F.size(F.filter("standing", lambda s: s)))
    found = found.withColumn("similarity", F.col("n_matched") / F.col("n_words"))
    found = found.withColumn("whole", F.col("whole") & (F.col("similarity") >= similarity))
    part = F.when(F.col("n_matched") >= RUN * similarity, _holds_run(F.col("standing"), similarity)).otherwise(False)
    verified = found.filter(F.col("whole") | part)
    best = F.max_by(F.struct("n_matched", "similarity", "start"), F.struct("whole", "n_matched", -F.col("start"))).alias("best")
    return verified.groupBy(*key, "item_id", "n_words").agg(best).select(*key, "item_id", "n_words", "best.*")


def clean(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents without a leaked item, columns as they are."""
    found = store(leaks(docs, benchmark, similarity).select("text_1", "text_2").distinct())
    one, two = text_key(docs["text"])
    return docs.join(found, (one == found["text_1"]) & (two == found["text_2"]), "left_anti")

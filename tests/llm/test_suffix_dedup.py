"""Suffix arrays and removals against brute force."""

import hashlib

import numpy as np
import pytest

from schoolatlas.llm import suffix_dedup
from schoolatlas.llm.suffix_array import suffix_arrays


@pytest.mark.parametrize("letters", [1, 2, 4])
def test_suffix_arrays(letters):
    rng = np.random.default_rng(letters)
    for turn in range(60):
        rows, width = rng.integers(1, 12), rng.integers(1, 50)
        lengths = rng.integers(1, width + 1, rows)
        symbols = rng.integers(1, letters + 1, (rows, width)).astype(np.int32)
        if turn % 3 == 0:
            symbols = np.resize(symbols[:, :3], (rows, width)).copy()
        for row, n in enumerate(lengths):
            symbols[row, n - 1 :] = 0
        arrays = suffix_arrays(symbols, lengths)
        for row, n in enumerate(lengths):
            own = symbols[row, :n].tolist()
            assert arrays[row, :n].tolist() == sorted(range(n), key=lambda i, own=own: own[i:])


def brute(rows, length=50):
    least = {}
    texts = [(float("inf") if d is None else d, d, (t or "").encode()) for d, t in rows]
    for rank, _, text in texts:
        for i in range(len(text) - length + 1):
            window = text[i : i + length]
            least[window] = min(least.get(window, rank), rank)
    out = []
    for rank, doc_id, text in texts:
        gone = bytearray(len(text) + 1)
        for i in range(len(text) - length + 1):
            if least[text[i : i + length]] < rank:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(text, gone, strict=False) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


SMALL = {"MOST_CONTEXTS": 3, "HEAVY_LEAST": 4, "SEEN_LEAST": 2, "HEAVY_PART": 10**6, "BUCKET_BYTES": 1 << 15,
         "BUCKET_ANCHORS": 3000, "BATCH_CELLS": 1 << 12, "SLICE": 1 << 13}


@pytest.mark.parametrize("tables", ["sf_dir", "edge"])
@pytest.mark.parametrize("change", [{}, SMALL])
def test_removals(spark, request, monkeypatch, tables, change):
    for name, value in change.items():
        monkeypatch.setattr(suffix_dedup, name, value)
    docs = spark.read.parquet(f"{request.getfixturevalue(tables)}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = suffix_dedup.remove_repeats(docs, with_kept=True).collect()
    assert sorted((tuple(r)[:5] for r in found), key=str) == brute(rows)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in found)


def test_different_windows_of_a_heavy_seed(spark, monkeypatch):
    # The first two windows have the same lower 40 bits.
    seed = "upbzzdqapsjmwlucptwkayat"
    edges = [("lfyekkdnaojya", "jxyzjvbhiofua"), ("sarevxlotoqfq", "xwpgxglqvepdw")]
    edges += [(c * 13, c * 13) for c in "abcde"] + [edges[0]]
    rows = [(i, a + seed + b) for i, (a, b) in enumerate(edges)]
    data = np.frombuffer("".join(t for _, t in rows).encode(), np.uint8)
    heavy = suffix_dedup.runs(data, np.arange(0, len(data) + 1, 50), np.zeros(0, np.uint64))[3]
    windows = suffix_dedup.runs(data, np.arange(0, len(data) + 1, 50), heavy[:1])[4]
    assert len(set(heavy.tolist())) == 1 and (windows[0] ^ windows[1]) % np.uint64(1 << 40) == 0 and windows[0] != windows[1]
    for name, value in SMALL.items():
        monkeypatch.setattr(suffix_dedup, name, value)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    assert sorted((tuple(r) for r in suffix_dedup.remove_repeats(docs).collect()), key=str) == brute(rows)
    # Bytes of all texts, and three windows a document.
    longer = spark.createDataFrame([(i, t + "zz") for i, t in rows], "doc_id bigint, text string").coalesce(1)
    assert suffix_dedup.heavy_seeds(longer)[1:] == (52 * len(rows), 3 * len(rows))


def test_a_context_is_compared_once(spark, monkeypatch):
    # The repeated word's context stands in the first text a thousand times, the other texts share its seeds.
    word = "areanerator "
    rows = [(1, word * 1000 + "one"), (2, "of " + word * 6 + "two of these"), (3, "to " + word * 5 + "three to those"), (4, word * 30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    compared = suffix_dedup.equal_windows

    def compare(contexts, owner, group):
        if sum(map(len, contexts)) > 5000:
            raise ValueError("contexts are compared for each of their places")
        return compared(contexts, owner, group)

    monkeypatch.setattr(suffix_dedup, "equal_windows", compare)
    assert sorted((tuple(r) for r in suffix_dedup.remove_repeats(docs).collect()), key=str) == brute(rows)


def test_contexts_and_windows_go_by_bucket(spark, monkeypatch):
    for name, value in {"MOST_CONTEXTS": 3, "BUCKET_BYTES": 1 << 13, "BUCKET_ANCHORS": 300}.items():
        monkeypatch.setattr(suffix_dedup, name, value)
    shared = ["Shared words of every second text, and nothing that matters. ", "Seeds of few contexts stand in three of the texts alone. "]
    rows = [(i, f"{i * 7919} {i * 104729} " * 9 + shared[0][i % 9 :] + f"{i}" + shared[1] * (i % 20 == 0)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(20)
    plan = suffix_dedup.Plan(docs)
    found = suffix_dedup.cut_out(docs, suffix_dedup.match_runs(docs, plan), plan).groupBy("kind", "bucket").count().collect()
    # A bucket of ids has a row for a bucket, and not one for each of its pieces.
    assert {r["kind"] for r in found} == {suffix_dedup.COVER, suffix_dedup.CONTEXT, suffix_dedup.SINGLE}
    assert all(r["count"] <= plan.doc_buckets for r in found) and plan.doc_buckets < 20
    assert sorted((tuple(r) for r in suffix_dedup.remove_repeats(docs).collect()), key=str) == brute(rows)

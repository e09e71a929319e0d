"""Components against brute force."""

import re
import time
from collections import Counter

import numpy as np
import pytest

from schoolatlas.llm import ngram_join
from schoolatlas.llm.components import components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(rows, k, percent):
    """component of each row of (doc_id, text), as the least id; and the set sizes."""
    sets = []
    for _, text in rows:
        words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode())
        sets.append(frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders, first = {}, {}
    for i, own in enumerate(sets):
        if own in first:
            parent[find(i)] = find(first[own])
            continue
        if own:
            first[own] = i
        shared = Counter(j for g in own for j in holders.get(g, ()))
        for j, n in shared.items():
            if 100 * n >= percent * (len(own) + len(sets[j]) - n):
                parent[find(i)] = find(j)
        for g in own:
            holders.setdefault(g, []).append(i)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            root = find(i)
            least[root] = min(least.get(root, doc_id), doc_id)
    return sorted(
        ((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str
    )


@pytest.mark.parametrize("tables", ["sf_dir", "edge"])
@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80)])
def test_components(spark, request, tables, k, percent):
    docs = spark.read.parquet(f"{request.getfixturevalue(tables)}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = ngram_join.resolve(docs, k, percent).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(rows, k, percent)


@pytest.mark.parametrize("change", [{"BLOCK_SHINGLES": 300}, {"HEAVY_LEAST": 3, "SEEN_LEAST": 2, "HEAVY_PART": 10**6}, {"BUCKET_TOKENS": 500}])
def test_parts_heavy_shingles_and_buckets(spark, edge, sf_dir, monkeypatch, change):
    for name, value in change.items():
        monkeypatch.setattr(ngram_join, name, value)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.read.parquet(f"{edge}/documents.parquet").selectExpr("doc_id + 100000 as doc_id", "text"))
    rows = [tuple(r) for r in docs.collect()]
    found = ngram_join.resolve(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(rows, 4, 85)


def test_one_of_each_group_stays(spark, edge):
    docs = spark.read.parquet(f"{edge}/documents.parquet")
    kept = ngram_join.keep_one(docs, 5, 80)
    assert kept.columns == docs.columns
    names = Counter(c for _, _, c in brute([tuple(r) for r in docs.select("doc_id", "text").collect()], 5, 80))
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == sorted(n for n in names if n is not None)
    assert 11 not in ids or ids.count(11) == 1


def test_join_sets_property():
    rng = np.random.default_rng(3)
    for _ in range(60):
        sets, seen = [], set()
        for _ in range(rng.integers(1, 6)):
            base = np.unique(rng.integers(0, 200, rng.integers(1, 60)).astype(np.uint64))
            for _ in range(rng.integers(1, 8)):
                own = base[rng.random(len(base)) > rng.choice([0, 0.03, 0.1])]
                own = np.unique(np.concatenate([own, rng.integers(0, 400, rng.integers(0, 4)).astype(np.uint64)]))
                if len(own) and own.tobytes() not in seen:
                    seen.add(own.tobytes())
                    sets.append(own)
        if not sets:
            continue
        plain = [set(s.tolist()) for s in sets]
        label = list(range(len(sets)))
        for i in range(len(sets)):
            for j in range(i):
                n = len(plain[i] & plain[j])
                if 100 * n >= 85 * (len(plain[i]) + len(plain[j]) - n):
                    label = [label[j] if x == label[i] else x for x in label]
        found = ngram_join.join_sets(sets, 85).tolist()
        assert len(set(zip(found, label, strict=True))) == len(set(found)) == len(set(label))


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 2000 + i) for i in range(50)] + [(7, 7), (2049, 3000)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert all(found[i] == 0 for i in range(301))
    assert all(found[i] == 1000 for i in [1000, 3000, *range(2000, 2050)])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sets_without_links_take_time_in_proportion():
    """Eight thousand unlinked sets, and as many that share most words without a link, in a few seconds each."""
    rng = np.random.default_rng(0)
    common = rng.integers(0, 1 << 60, 40, dtype=np.uint64)
    own = lambda k: rng.integers(0, 1 << 60, k, dtype=np.uint64)
    for sets in ([np.unique(own(8)) for _ in range(8000)], [np.unique(np.r_[common, own(12)]) for _ in range(8000)]):
        start = time.process_time()
        assert len(set(ngram_join.join_sets(sets, 85).tolist())) == 8000
        assert time.process_time() - start < 4
    chain = [np.arange(i, i + 40, dtype=np.uint64) for i in range(3000)]  # each links with its neighbours only
    assert len(set(ngram_join.join_sets(chain, 85).tolist())) == 1

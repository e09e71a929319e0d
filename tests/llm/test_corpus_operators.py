"""Sharding, mixing, line rules, token files, secrets and decontamination beyond their SQL."""

import hashlib
import math
import struct
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from schoolatlas.llm import decontaminate, line_rules, mixing, secrets, sharding, token_counts

from .conftest import ITEM


def hash_chain(*values):
    """Spark's xxhash64 of ints (as int32) and ids (as int64)."""
    h = 42
    for kind, value in values:
        if value is not None:
            h = xxhash.xxh64_intdigest(struct.pack(kind, value), seed=h)
    return h - (1 << 64) if h >> 63 else h


def shard_of(doc_id, shards, seed):
    return max((hash_chain(("<i", seed), ("<i", i), ("<q", doc_id)), i) for i in range(shards))[1]


@pytest.mark.parametrize("tables", ["sf_dir", "edge", "empty"])
def test_shards_and_slots(spark, request, tables):
    docs = spark.read.parquet(f"{request.getfixturevalue(tables)}/documents.parquet")
    rows = sharding.shuffle(docs, bucket_bytes=4096).collect()
    assert len(rows) == docs.count()
    slots, buckets = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.shard == shard_of(r.doc_id, 24, 7)
        slots[r.shard].append((r.slot, r.bucket))
        buckets[r.shard, r.bucket].append(r.slot)
    for own in slots.values():
        assert [s for s, _ in sorted(own)] == list(range(len(own)))
        assert [b for _, b in sorted(own)] == sorted(b for _, b in own)  # bucket after bucket
    again = sharding.shuffle(docs.repartition(7), bucket_bytes=4096).collect()
    key = lambda r: (str(r.doc_id), str(r.text), r.shard, r.bucket, r.slot)
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_bucket_order_is_the_seeded_permutation(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(200)], "doc_id long, text string")
    rows = sharding.shuffle(docs, shards=2).collect()
    for shard in (0, 1):
        own = sorted(r.doc_id for r in rows if r.shard == shard)
        order = np.random.default_rng([7, shard, 0]).permutation(len(own))
        assert [r.doc_id for r in sorted(rows, key=lambda r: r.slot) if r.shard == shard] == [own[i] for i in order]


def test_one_more_shard_takes_only_into_itself(spark):
    ids = spark.range(2000).select(F.col("id").alias("d"))
    for n in (1, 2, 24):
        rows = ids.select(sharding.shard_of(F.col("d"), n).alias("a"), sharding.shard_of(F.col("d"), n + 1).alias("b")).collect()
        assert all(r.a == r.b or r.b == n for r in rows) and any(r.b == n for r in rows)


def test_written_shards(spark, edge, tmp_path):
    docs = spark.read.parquet(f"{edge}/documents.parquet")
    sharding.write(sharding.shuffle(docs), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count() and set(docs.columns) <= set(back.columns)


@pytest.mark.parametrize("tables", ["sf_dir", "edge"])
def test_mix_meets_its_targets(spark, request, tables):
    docs = spark.read.parquet(f"{request.getfixturevalue(tables)}/documents.parquet")
    rows = mixing.mix(docs).collect()
    taken, of, sizes = Counter(), {}, Counter()
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
        sizes[r.source] += r.size
        of[r.source] = r.target
    assert all(abs(taken[s] - of[s]) <= 1 and of[s] <= 3 * sizes[s] + 1e-6 for s in of)
    assert sum(of.values()) == pytest.approx(sum(sizes.values()))
    # Weights 5, 2, 1 by code point order, null last: what is not capped shares one level.
    order = sorted((s for s in of if s is not None), key=lambda s: s.encode()) + [None] * (None in of)
    levels = {s: of[s] / (5, 2, 1)[i % 3] for i, s in enumerate(order) if of[s] < 3 * sizes[s] - 1e-6}
    assert max(levels.values()) == pytest.approx(min(levels.values()))
    assert all(3 * sizes[s] / (5, 2, 1)[i % 3] <= max(levels.values()) + 1e-6 for i, s in enumerate(order) if s not in levels)


def draw_key(doc_id, text):
    text = text or ""
    name = f"{'' if doc_id is None else doc_id}/{hashlib.md5(text.encode()).hexdigest()}"
    u = (int(hashlib.md5(name.encode()).hexdigest()[:12], 16) + 0.5) / (1 << 48)
    return -math.log(u) * (1 + 20 * sum(c in "#*$%&|<>" for c in text) / max(len(text), 1))


def test_repeat_takes_smallest_keys(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = mixing.repeat(docs)
    assert out.columns == docs.columns
    copies = Counter(r.doc_id for r in out.select("doc_id").collect())
    plan = {r.doc_id: r for r in mixing.mix(docs).collect()}
    by_source = defaultdict(list)
    for r in docs.collect():
        if plan[r.doc_id].size:
            by_source[r.source].append((draw_key(r.doc_id, r.text), plan[r.doc_id], copies[r.doc_id]))
    for own in by_source.values():
        own.sort(key=lambda x: x[0])
        assert all(abs(key - p.draw_key) < 1e-9 for key, p, _ in own)
        for _, p, n in own:
            assert n == p.epochs + (2 * (p.taken - p.epochs * p.size) >= p.size)
        assert [n for _, _, n in own] == sorted((n for _, _, n in own), reverse=True)


def test_lines_are_removed(spark, edge):
    docs = spark.read.parquet(f"{edge}/documents.parquet")
    kept = line_rules.clean(docs)
    assert kept.columns == docs.columns
    rows = {r.doc_id: r.text for r in kept.collect()}
    assert len([d for d in rows if d and d >= 100]) == 30
    given = {r.doc_id: r.text for r in docs.collect()}
    assert all(rows[100 + i] == given[100 + i].split("\n")[1] for i in range(30))
    rated = {r.doc_id: r for r in line_rules.rate(docs).collect()}
    assert rated[16].base_failed and not rated[16].kept and rated[100].kept


def test_depleted_documents_go(spark):
    rows = [(i, f"menu of the site with many words in it\nand a second row of links to all its parts\nown words number {i} here at last", "h") for i in range(20)]
    found = line_rules.rate(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert all(not r.base_failed and r.n_removed_words == 19 and not r.kept for r in found)
    copies = [(i, "exactly the same page with enough words to pass all of the base rules that there are here today, friend", "h") for i in range(50)]
    found = line_rules.rate(spark.createDataFrame(copies, "doc_id long, text string, source string")).collect()
    assert all(r.kept for r in found)  # one document, however often it stands there


def test_lines_of_a_large_host(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.concat(
            F.when(F.col("id") < 51, F.lit("subscribe to our letter\n")).otherwise(F.lit("")),
            F.when(F.col("id") < 50, F.lit("a line in fifty documents\n")).otherwise(F.lit("")),
            F.concat_ws(" ", *(F.concat(F.lit(f"w{i}x"), "id") for i in range(25))),
        ).alias("text"),
        F.lit("hot").alias("source"),
    )
    removed = {r.doc_id: r.n_removed_words for r in line_rules.rate(docs).filter("n_removed_words > 0").collect()}
    assert removed == dict.fromkeys(range(51), 4)


@pytest.mark.parametrize("block", [1, 3, 7, 1000])
def test_token_files(spark, tmp_path, block):
    files = {"a": [[1, 2, 3], [], [4] * 20, [5]], "b": [[]], "c": [[9] * 10]}
    tail = {"a": [], "b": [7, 8], "c": []}
    for name, docs in files.items():
        tokens = [t for d in docs for t in [*d, token_counts.SEPARATOR]] + tail[name]
        (tmp_path / name).write_bytes(np.array(tokens, "<u2").tobytes())
    (tmp_path / "none").write_bytes(b"")
    rows = token_counts.count_tokens(token_counts.read_files(spark, str(tmp_path), block)).collect()
    found = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.ordinal):
        found[r.file].append((r.ordinal, r.n_tokens, r.start, r.complete))
    expected = []
    for name, docs in files.items():
        start, own = 0, []
        for i, d in enumerate(docs):
            own.append((i, len(d), start, True))
            start += len(d) + 1
        if tail[name]:
            own.append((len(docs), len(tail[name]), start, False))
        expected.append(own)
    assert sorted(found.values()) == sorted(expected)


def test_weak_parts_need_each_other(spark, edge):
    found = {r.doc_id: r for r in secrets.report(spark.read.parquet(f"{edge}/documents.parquet")).collect()}
    kinds = [s.split(":")[0] for s in found[25].spans.split(",")]
    assert sorted(kinds) == ["access", "assign", "endpoint", "identifier", "secret"]
    assert [s.split(":")[0] for s in found[26].spans.split(",")] == ["hex"]  # the name stands too far away
    assert [s.split(":")[0] for s in found[27].spans.split(",")] == ["assign", "endpoint"]
    text = "é" * 30 + " token = ü secret= 'AAAAbbbbCCCC1234' \U0001f600 10.0.0.1"
    start, end = map(int, found[27].spans.split(",")[0].split(":")[1:])
    assert text[start:end] == "secret= 'AAAAbbbbCCCC1234"
    assert found[16].spans == "" and found[16].base_sha256 == hashlib.sha256(b"").hexdigest()


def test_substitutions_are_tolerated(spark):
    words = ITEM.split()
    texts = [ITEM, ITEM.upper(), " ".join(words[:3] + words[4:])]
    for step in (5, 6, 9):
        texts.append(" ".join(f"other{i}" if i % step == 2 else w for i, w in enumerate(words)))
    clean = [" ".join(words[: len(words) // 2]), " ".join(reversed(words)), "nothing of it", None, ""]
    docs = [(i, f"some words before it {t} and after it" if t else t) for i, t in enumerate(texts + clean)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(7, ITEM), (8, None)], "item_id long, text string")
    found = {r.doc_id: r for r in decontaminate.leaks(docs, items).collect()}
    assert set(found) == set(range(len(texts)))
    assert all(r.item_id == 7 and r.similarity >= 0.8 and r.start == 4 for r in found.values() if r.doc_id != 2)
    left = decontaminate.clean(docs, items)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == list(range(len(texts), len(texts + clean)))


def test_seeds_by_shuffle_give_the_same(spark, sf_dir, monkeypatch):
    docs, items = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "benchmark"))
    sent = sorted(map(tuple, decontaminate.leaks(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", -1)
    assert sent and sorted(map(tuple, decontaminate.leaks(docs, items).collect())) == sent


def test_part_of_a_long_item_is_a_leak(spark):
    item = [f"word{i}" for i in range(60)]
    other = [f"other{i}" for i in range(30)]
    swapped = item[20:60]
    swapped[::6] = other[: len(swapped[::6])]
    texts = {
        1: other + item[10:50] + other,  # 40 of 60 words
        2: item[40:] + other,  # the end of the item at the document's start
        3: other + item[:14],
        4: other + swapped + other,  # five of six words
        5: other + item[:13] + other,  # too short
        6: other + item[5:12] + other + item[30:37],  # two short runs, far from each other
        7: item,
    }
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id bigint, text string")
    long = [f"long{i}" for i in range(500)]
    docs = docs.union(spark.createDataFrame([(8, " ".join(other + long[100:400] + other))], docs.schema))
    items = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(long))], "item_id bigint, text string")
    found = {r.doc_id: (r.item_id, r.n_words, r.n_matched, r.start) for r in decontaminate.leaks(docs, items).collect()}
    assert found == {
        1: (1, 60, 40, 20), 2: (1, 60, 20, -40), 3: (1, 60, 14, 30), 4: (1, 60, 33, 10), 7: (1, 60, 60, 0), 8: (2, 500, 300, -70),
    }
    assert sorted(r.doc_id for r in decontaminate.clean(docs, items).collect()) == [5, 6]


def test_runs_of_matched_places(spark, rng=np.random.default_rng(5)):
    rows = [(i, (rng.random(rng.integers(0, 60)) < rng.choice([0.5, 0.7, 0.8])).tolist()) for i in range(300)]
    got = spark.createDataFrame(rows, "i bigint, standing array<boolean>")
    got = dict(map(tuple, got.select("i", decontaminate._holds_run(F.col("standing"), 0.8)).collect()))
    for i, s in rows:
        ends = [(a, b) for a in range(len(s)) for b in range(a + decontaminate.RUN, len(s) + 1)]
        assert got[i] == any(s[a] and s[b - 1] and 5 * sum(s[a:b]) >= 4 * (b - a) for a, b in ends)
    assert 50 < sum(got.values()) < 250

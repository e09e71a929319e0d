"""Code lengths against a plain version, and what is predicted."""

import math
import random
from collections import defaultdict
from types import SimpleNamespace
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from schoolatlas.llm import language
from schoolatlas.llm.common import text_bytes
from schoolatlas.llm.queries import QUERIES


def counted(texts_by_lang, order):
    rows = []
    for lang, texts in texts_by_lang.items():
        n = defaultdict(int)
        for text in texts:
            symbols = [0] * order + [b + 1 for b in text.encode()]
            for i in range(order, len(symbols)):
                for length in range(1, order + 2):
                    n[length, tuple(symbols[i - length + 1 : i + 1])] += 1
        for (length, gram), count in n.items():
            rows.append((lang, length, gram, count))
    return rows


def plain_bits(rows, lang, text, order):
    seen = defaultdict(dict)
    for own, _, gram, n in rows:
        if own == lang:
            seen[gram[:-1]][gram[-1]] = n
    symbols = [0] * order + [b + 1 for b in text.encode()]
    total = 0.0
    for i in range(order, len(symbols)):
        for length in range(order, -2, -1):
            if length < 0:
                total += 8
                break
            follow = seen.get(tuple(symbols[i - length : i]))
            if not follow:
                continue
            whole = sum(follow.values()) + len(follow)
            if symbols[i] in follow:
                total -= math.log2(follow[symbols[i]] / whole)
                break
            total -= math.log2(len(follow) / whole)
    return total


@pytest.mark.parametrize("order", [1, 3])
def test_bits_are_those_of_a_plain_version(order):
    rng = random.Random(order)
    learnt = {"a": ["abracadabra, abba", "cab"], "b": ["zigzag abba zoo", "ézé"], "c": ["q"]}
    rows = counted(learnt, order)
    model = language.Model(
        [
            SimpleNamespace(lang=a, length=n, gram=sum(s * 257 ** (len(g) - 1 - i) for i, s in enumerate(g)), n=c)
            for a, n, g, c in rows
        ],
        order,
    )
    texts = ["", "abba", "zebra", "ééé", "xyz", "".join(rng.choices("abczé ,q", k=300))]
    data, offsets = text_bytes(pa.array(texts))
    bits = model.total_bits(data, offsets)
    expected = [[plain_bits(rows, lang, text, order) for lang in model.langs] for text in texts]
    assert np.allclose(bits, expected)
    for piece in (1, 2, 7, 64):  # pieces of any size give the bits of the whole
        assert np.allclose(model.total_bits(data, offsets, piece), expected)


def test_held_out_documents_are_predicted(spark, sf_dir):
    found = {r.doc_id: r for r in QUERIES["op1_language"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()
    assert len(found) == len(docs)
    assert all(found[d.doc_id].held_out == (crc32(str(d.doc_id).encode()) % 5 == 0) for d in docs)
    held = [d for d in docs if found[d.doc_id].held_out]
    right = sum(found[d.doc_id].lang_pred == d.lang for d in held)
    assert held and right >= 0.9 * len(held)
    assert all(0 <= r.score <= 1 for r in found.values())


def test_edge_cases(spark, edge):
    rows = QUERIES["op1_language"](spark, edge).collect()
    found = {r.doc_id: r for r in rows}
    assert len(rows) == spark.read.parquet(f"{edge}/documents.parquet").count()
    for und in (16, 17, 18, 19):
        assert (found[und].lang_pred, found[und].score) == ("und", 0.0)
    assert found[14].lang_pred == "de" and found[10].lang_pred == "en"
    assert not found[None].held_out


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "words", None)], "doc_id long, text string, lang string")
    assert language.identify(docs, language.learn(docs)).first().lang_pred == "und"


def test_long_texts_do_not_take_a_language_s_budget(spark):
    """Every tenth English text is longer than the whole budget; both languages fill theirs."""
    rows = [(i, "the brown fox " * (9000 if i % 10 == 0 else 10), "en") for i in range(400)]
    rows += [(i, "der braune Fuchs " * 10, "de") for i in range(400, 800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = language.learning_sample(docs, bytes_per_language=20_000, part_chars=500)
    taken = {r.lang: (r.n, r.b) for r in sample.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b")).collect()}
    for lang in ("en", "de"):
        n, size = taken[lang]
        assert n > 80 and 19_000 <= size <= 20_000
    assert sample.agg(F.max(F.length("text"))).first()[0] == 500
    only_long = docs.where("lang = 'en' AND doc_id % 10 = 0")
    assert language.learning_sample(only_long, part_chars=500).count() > 20
    model = language.learn(docs)
    found = language.identify(docs, model).groupBy("lang", "lang_pred").count().collect()
    assert {(r.lang, r.lang_pred) for r in found} == {("en", "en"), ("de", "de")}

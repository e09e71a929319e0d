"""The pipeline stage by stage against plain versions, and as a whole."""

import re
from collections import Counter

import corpus_pipeline
from schoolatlas.llm import language
from schoolatlas.llm.common import store

from .test_corpus_operators import shard_of
from .test_ngram_join import brute


def leaked(text, items):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    for item in items:
        own = re.findall(r"[^\W_]+", (item or "").lower())
        for at in range(len(words) - len(own) + 1) if own else ():
            if sum(a == b for a, b in zip(words[at:], own, strict=False)) >= 0.8 * len(own):
                return True
    return False


def test_stages_against_plain_versions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    model = language.learn(docs)
    for (name, stage), number in zip(corpus_pipeline.STAGES, (1, 4, 10, 3, 8), strict=True):
        before = docs.collect()
        after = store(stage(spark, docs, sf_dir))
        rows = after.collect()
        if number != 8:
            assert after.columns == docs.columns, name
        ids = Counter(r.doc_id for r in rows)
        if number == 1:
            kept = language.identify(docs.select("doc_id", "text"), model).filter("lang_pred <> 'und' and score >= 0.5")
            assert set(ids) == {r.doc_id for r in kept.collect()} and len(rows) >= 0.98 * len(before)
        if number == 4:
            assert set(ids) == {c for _, _, c in brute([(r.doc_id, r.text) for r in before], 5, 80)}
        if number == 10:
            assert set(ids) == {r.doc_id for r in before if not leaked(r.text, items)}
        if number == 3:
            assert set(ids) <= {r.doc_id for r in before} and max(ids.values()) <= 3
        if number == 8:
            assert ids == Counter(r.doc_id for r in before)
            assert all(r.shard == shard_of(r.doc_id, 24, 7) for r in rows)
        docs = after
    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(str, whole.collect())) == sorted(map(str, docs.collect()))


def test_edge_cases_and_no_rows(spark, edge, empty):
    rows = corpus_pipeline.run(spark, edge).collect()
    assert rows and not {16, 17, 18, 19, 22, 23} & {r.doc_id for r in rows}
    assert corpus_pipeline.run(spark, empty).collect() == []

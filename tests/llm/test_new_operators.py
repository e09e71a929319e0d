"""Hard negatives, sentence pieces and spelling variants against plain versions."""

import hashlib
import random
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from schoolatlas.llm import hard_negatives, sentence_pieces, spelling_variants
from schoolatlas.llm.queries import QUERIES

MODEL = Path(public_tokenizers.path("piece_bpe_32k.model"))


# Hard negatives


@pytest.mark.parametrize("shape", [(1, 1, 1), (16, 40, 16), (17, 17, 17), (33, 65, 50), (64, 100, 31), (129, 40, 129)])
def test_strassen_is_the_exact_product(shape):
    rng = np.random.default_rng(sum(shape))
    m, k, n = shape
    a, b = rng.integers(-(1 << 24), 1 << 24, (m, k)), rng.integers(-(1 << 24), 1 << 24, (k, n))
    assert (hard_negatives.strassen(a, b) == a @ b).all()


def test_heaps_merge_in_any_order():
    rng = np.random.default_rng(3)
    slot, score, ids = rng.integers(0, 7, 900), rng.integers(0, 40, 900), rng.permutation(900)
    expected = []
    for s in range(7):
        own = sorted((-score[i], ids[i]) for i in range(900) if slot[i] == s)[:5]
        expected += [(s, -a, b) for a, b in own]
    for seed in range(4):
        order = np.random.default_rng(seed).permutation(900)
        heaps = hard_negatives.Heaps(7, 5)
        for part in np.array_split(order, 9 + seed):
            heaps.push(slot[part], score[part], ids[part])
        assert list(zip(heaps.slot.tolist(), heaps.score.tolist(), heaps.vec_id.tolist())) == expected
        assert heaps.worst.tolist() == [expected[5 * s + 4][1] for s in range(7)]


def test_blocks_and_tiles_give_the_same_rows(spark, sf_dir, edge, monkeypatch):
    for folder in (sf_dir, edge):
        whole = sorted(QUERIES["op11_hard_negatives"](spark, folder).collect())
        with monkeypatch.context() as patch:
            patch.setattr(hard_negatives, "BLOCK_VALUES", 4000)
            patch.setattr(hard_negatives, "TILE_ROWS", 20)
            patch.setattr(hard_negatives, "TILE_VALUES", 600)
            patch.setattr(hard_negatives, "LEAF", 2)
            assert sorted(QUERIES["op11_hard_negatives"](spark, folder).collect()) == whole
        assert whole


# Sentence pieces


@pytest.fixture(scope="module")
def encoder():
    return sentence_pieces.Encoder(MODEL.read_bytes())


def ids_of(encoder, text):
    return np.frombuffer(encoder.encode(text), "<u4").tolist()


_MARKS = st.text(alphabet="abcdeéñ \n\t▁,.0123 the ing 中文字🎉\u0000﻿​<s></s>", max_size=80)


@given(st.one_of(_MARKS, st.text(max_size=60), st.text(alphabet="a ", max_size=90)))
@settings(max_examples=600, deadline=None)
def test_ids_are_the_library_s(encoder, text):
    assert ids_of(encoder, text) == encoder.library.encode(text, add_bos=True, add_eos=True)


def test_searches_step_back_and_cross_windows_and_blocks(encoder, monkeypatch):
    rng = random.Random(2)
    syllables = ["un", "der", "ing", "tion", "s", "th", "e", "rr", "qu", "x", "ab", "str", "ess"]
    texts = ["".join(rng.choices(syllables, k=n)) for n in (3, 30, 300, 3000)] + ["aaaa" * 3000, " " * 9001 + "b", "z\n" * 4000]
    texts += [" ".join("".join(rng.choices(syllables, k=4)) for _ in range(2000))]
    expected = [encoder.library.encode(t, add_bos=True, add_eos=True) for t in texts]
    assert [ids_of(encoder, t) for t in texts] == expected
    monkeypatch.setattr(sentence_pieces, "WINDOW", 32)
    monkeypatch.setattr(sentence_pieces, "BLOCK", 50)
    monkeypatch.setattr(sentence_pieces, "MOST_CUTS", 20)
    encoder.clear()
    assert [ids_of(encoder, t) for t in texts] == expected


def test_a_search_that_fails_first():
    """With 'ab', 'bc' better than 'ab', longest matches from the left give a sequence that doesn't fit."""
    encoder = sentence_pieces.Encoder.__new__(sentence_pieces.Encoder)
    encoder.score = {"a": 0.0, "b": 0.0, "c": 0.0, "d": 0.0, "ab": -3.0, "bc": -1.0, "cd": -2.0, "abc": -9.0}
    encoder.pairs, encoder.longest = {}, 3
    import ahocorasick

    encoder.found = ahocorasick.Automaton()
    for piece in encoder.score:
        encoder.found.add_word(piece, (len(piece) - 1, piece))
    encoder.found.make_automaton()
    for n in range(1, 9):
        for k in range(4**n if n < 6 else 400):
            text = "".join("abcd"[k * 2654435761 // 4**i % 4 if n >= 6 else k // 4**i % 4] for i in range(n))
            assert encoder.search(text) == encoder.merged(text), text


def test_query_against_the_library(spark, sf_dir, edge, encoder):
    for folder in (sf_dir, edge):
        docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
        expected = []
        for doc_id, text in docs:
            ids = encoder.library.encode(text or "", add_bos=True, add_eos=True)
            sha = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
            expected.append((doc_id, len(ids), sha, hashlib.sha256(encoder.library.decode(ids).encode()).hexdigest()))
        assert Counter(map(tuple, QUERIES["op12_sentence_pieces"](spark, folder).collect())) == Counter(expected)


def test_columns_stay_and_results_replace(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, None, "y")], "row long, text string, tokens string")
    rows = sentence_pieces.encode(docs, MODEL.read_bytes())
    assert rows.columns == ["row", "text", "tokens", "decoded"]
    assert [(r.row, r.text, r.decoded) for r in rows.orderBy("row").collect()] == [(1, "a b", "a b"), (2, None, "")]


def test_pieces_with_a_mark_behind_are_refused():
    with pytest.raises(ValueError):
        sentence_pieces.character_classes(["ab", "b▁"])
    assert sorted(sentence_pieces.character_classes(["▁ab", "cd", "x", "▁.", "bd"])) == ["abcd"]


# Spelling variants


def variants(words):
    """near words of every word by all their patterns, forms and roots."""
    near, holes, shorter = defaultdict(set), defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[w[:i], w[i + 1 :]].add(w)
            shorter[w[:i] + w[i + 1 :]].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    for w in words:
        for longer in shorter.get(w, ()):
            near[w].add(longer)
            near[longer].add(w)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best and words[best] >= 2 * words[w]:
            form[w] = best
    out = set()
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out.add((w, words[w], len(near[w]), form.get(w), words.get(form.get(w)), root))
    return out


def found(rows):
    return {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in rows.collect()}


@pytest.mark.parametrize("limits", [(3, 20_000, 1 << 18, 1 << 18), (1, 5, 1 << 18, 50), (1, 30, 0, 50)])
def test_variants_of_made_words(spark, monkeypatch, limits):
    start, node_words, pairs, batch = limits
    monkeypatch.setattr(spelling_variants, "START", start)
    monkeypatch.setattr(spelling_variants, "NODE_WORDS", node_words)
    monkeypatch.setattr(spelling_variants, "PAIRS", pairs)
    monkeypatch.setattr(spelling_variants, "BATCH", batch)
    rng = random.Random(8)
    words = {"".join(rng.choices("abe×é", k=rng.randint(1, 7))): rng.randint(1, 40) for _ in range(700)}
    words |= {"".join(rng.choices("etaoinshrdlu", k=rng.randint(5, 6))): rng.randint(1, 4) ** 4 for _ in range(600)}
    words |= {"a" * n: 3**n for n in range(1, 20)}  # a chain of eighteen forms
    words |= {"x" * 5000: 1, "x" * 4999 + "y": 2, "x" * 4999: 9}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert found(spelling_variants.group_variants(frame)) == variants(words)


def test_letter_counts_are_the_same_in_spark_and_in_tasks(spark):
    words = ["hello", "ÿéßÀ×÷", "zzz", "quick"]
    raw = [w.encode("latin-1") for w in words]
    counts = spelling_variants.counts_of(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    rows = frame.select("word", *[spelling_variants._count(i).alias(f"c{i}") for i in range(16)]).collect()
    assert {r[0]: list(r[1:]) for r in rows} == dict(zip(words, counts.tolist()))
    assert [sum(c) for c in counts.tolist()] == [len(w) for w in words]


def test_search_of_a_node_without_members():
    rows = pa.table({"word": ["abcde"], "n": [3], "node": ["0.1.0."], "surplus": [0], "deficit": [1]})
    assert spelling_variants._search(rows).num_rows == 0

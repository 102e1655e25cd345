from __future__ import annotations

import math
import zlib
from collections import Counter
from functools import partial

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import ODD, SMALL, odd, table
from helpers import table as table_rows
from millrace.llm import hmm
from millrace.llm.hmm import (
    BUCKETS,
    Model,
    bucket_of,
    emission_table,
    emissions,
    encoded,
    expected_counts,
    log_likelihood,
    most_frequent,
    scored,
    trained,
    unpacked,
    vocabulary,
    word_counts,
)
from millrace.llm.queries import QUERIES


def random_model(states: int, symbols: int) -> Model:
    rng = np.random.default_rng(1)

    def rows(*shape: int) -> np.ndarray:
        a = rng.random(shape)
        return a / a.sum(axis=-1, keepdims=True)

    return Model(rows(states), rows(states, states), rows(states, symbols))


LENGTHS = [5, 0, 1, 17, 40, 3]
OFFSETS = np.concatenate([[0], np.cumsum(LENGTHS)])
SYMBOLS = np.random.default_rng(2).integers(0, 7, OFFSETS[-1])


def forward(m: Model, x: np.ndarray) -> list[np.ndarray]:
    alphas = [m.start * m.emit[:, x[0]]]
    for s in x[1:]:
        alphas.append((alphas[-1] @ m.move) * m.emit[:, s])
    return alphas


@pytest.mark.parametrize("window", [1, 4, 7, 1000])
def test_recursion_is_exact_however_sequences_are_cut(window):
    m = random_model(3, 7)
    expected = [math.log(forward(m, SYMBOLS[a:b])[-1].sum()) if b > a else 0.0 for a, b in zip(OFFSETS, OFFSETS[1:])]
    assert log_likelihood(m, SYMBOLS, OFFSETS, window) == pytest.approx(expected, abs=1e-10)


def test_expected_counts():
    m = random_model(3, 7)
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 7))
    for a, b in zip(OFFSETS, OFFSETS[1:]):
        x = SYMBOLS[a:b]
        if not len(x):
            continue
        alphas, betas = forward(m, x), [np.ones(3)]
        for s in x[:0:-1]:
            betas.insert(0, m.move @ (m.emit[:, s] * betas[0]))
        total = alphas[-1].sum()
        for t, s in enumerate(x):
            gamma = alphas[t] * betas[t] / total
            emit[:, s] += gamma
            if t:
                move += np.outer(alphas[t - 1], m.emit[:, s] * betas[t]) * m.move / total
            else:
                start += gamma
    log = sum(math.log(forward(m, SYMBOLS[a:b])[-1].sum()) for a, b in zip(OFFSETS, OFFSETS[1:]) if b > a)
    for found, wanted in zip(expected_counts(m, SYMBOLS, OFFSETS, 1000), (start, move, emit, log)):
        assert np.allclose(found, wanted, atol=1e-4)


@pytest.mark.parametrize("window", [1, 4, 7, 17])
def test_expected_counts_do_not_depend_on_cuts(window):
    sticky = random_model(3, 7)
    sticky.move[:] = 0.001 * sticky.move + 0.999 * np.eye(3)
    for m in (random_model(3, 7), sticky):
        for found, wanted in zip(expected_counts(m, SYMBOLS, OFFSETS, window), expected_counts(m, SYMBOLS, OFFSETS, 1000)):
            assert np.allclose(found, wanted, atol=1e-4)


def test_query(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op7_lm_scoring"](spark, SMALL).collect()}
    docs = {r[0]: (r[1] or "").encode().lower().split() for r in table("documents")}
    held_out = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in docs}
    counts = Counter(w for d, own in docs.items() if not held_out[d] for w in own)
    ends = sum(not h for h in held_out.values())
    total, distinct = sum(counts.values()) + ends, len(counts) + 1
    for d, own in docs.items():
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own) + math.log10((ends + 1) / (total + distinct + 1))
        r = rows[d]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held_out[d], len(own) + 1, total)
        assert r["n_known"] == sum(w in counts for w in own) + 1 and r["base_score"] == pytest.approx(base, rel=1e-9)
    unseen = [r for r in rows.values() if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


@pytest.mark.parametrize("frequent, known", [(8192, 1 << 18), (500, 2000)])
def test_score_is_the_plain_recursion_over_single_words(spark, monkeypatch, frequent, known):
    monkeypatch.setattr(hmm, "vocabulary", partial(vocabulary, frequent=frequent, known=known))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    held_out = F.col("doc_id") % 5 == 2
    rows = {r["doc_id"]: r["score"] for r in scored(docs, ~held_out, states=3).collect()}
    # the same model by its parts
    counts = word_counts(docs.filter(~held_out))
    vocab = vocabulary(counts, frequent, BUCKETS, known)
    documents = encoded(docs.filter(~held_out).select("doc_id", "text"), vocab).persist()
    ends = documents.count()
    model = trained(documents, vocab, ends, 3)
    table = emission_table(documents, model, vocab)
    shared, _ = emissions(table, vocab, 3)
    names = list(vocab.words)
    held = {
        names[vocab.own + r["number"]] if r["word"] is None else r["word"]: (r["c"], unpacked(np.array([r["shares"]]), 3)[0])
        for r in table.collect()
    }
    exact = {r["word"]: r["c"] for r in counts.collect()}
    assert {w: c for w, (c, _) in held.items()} == {w: c for w, c in exact.items() if vocab.words.get(w, vocab.own) >= vocab.own}
    assert known > len(exact) or {w for w in held if w not in vocab.words}

    def emission(word):
        if word is None:
            return model.emit[:, -1]
        if vocab.words.get(word, vocab.own) < vocab.own:
            return model.emit[:, vocab.words[word]]
        b = bucket_of(word, BUCKETS)
        c, parts = held.get(word, (0, np.zeros(3)))
        kinds, tokens, own = vocab.bucket_words[b], vocab.bucket_tokens[b], shared.state_tokens[b]
        mixed = np.array([kinds / (o + kinds) if o > 0 else 1.0 for o in own])
        by_state = np.array([c * p / o if o > 0 else 0.0 for p, o in zip(parts, own)])
        return model.emit[:, vocab.own + b] * ((1 - mixed) * by_state + mixed * (c + 1) / (tokens + kinds + 1))

    for doc_id, text, *_ in table_rows("documents")[:60]:
        alpha, total = None, 0.0
        for word in [*(text or "").encode().lower().decode().split(), None]:
            alpha = (model.start if alpha is None else alpha @ model.move) * emission(word)
            total += math.log10(alpha.sum())
            alpha = alpha / alpha.sum()
        assert rows[doc_id] == pytest.approx(total, rel=1e-4, abs=1e-3)
    # a distribution: all training words, the end and one unseen word per bucket sum to one in every state
    unseen = sum(model.emit[:, vocab.own + b] * shared.factors(np.zeros(1), np.zeros((1, 3)), np.array([b]))[0]
                 * shared.frequencies(np.zeros(1), np.array([b])) for b in range(BUCKETS))
    assert sum((emission(w) for w in exact), emission(None)) + unseen == pytest.approx(np.ones(3), rel=1e-6)


def test_most_frequent_words_are_as_many_as_asked_for(spark):
    rows = [(f"w{i}", 1 + (i % 50) ** 2) for i in range(5000)] + [("top", 10**9)]
    counts = spark.createDataFrame(rows, "word string, c bigint")
    for limit in (1, 37, 800, 5001, 9000):
        chosen = {r["word"]: r["c"] for r in counts.filter(most_frequent(counts, limit)).collect()}
        left = [c for w, c in rows if w not in chosen]
        assert len(chosen) <= limit and len(chosen) >= min(limit, 5001) * 0.9 - 2
        assert not left or min(chosen.values()) >= max(left) or limit < 2 or max(left) in chosen.values() or min(chosen.values()) > 1000


def test_rounds_end_when_little_is_gained(spark):
    docs = spark.createDataFrame([(i, "aa bb aa bb " * 5 if i % 2 else "cc dd cc dd " * 5) for i in range(40)], "doc_id bigint, text string")
    docs = docs.withColumn("row", F.col("doc_id"))
    vocab = vocabulary(word_counts(docs))
    documents = encoded(docs.select("row", "text"), vocab).persist()
    model = trained(documents, vocab, 40, states=2, tolerance=1e-4)
    # one state, or pair of states, per kind of text
    kinds = model.emit[:, [vocab.words[w] for w in ("aa", "cc")]]
    assert ((kinds > 0.2).sum(axis=1) == 1).all()


def test_odd_rows_and_no_training(spark):
    rows = scored(odd(spark), F.lit(True), tolerance=0.5).collect()
    assert len(rows) == len(ODD) and all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    assert len({r["score"] for r in rows if r["doc_id"] is None}) == 1
    none = scored(odd(spark), F.lit(False), tolerance=0.5).collect()
    assert {r["base_score"] for r in none} == {0.0} and {r["train_tokens"] for r in none} == {0}
    assert scored(odd(spark, []), F.lit(True), tolerance=0.5).count() == 0

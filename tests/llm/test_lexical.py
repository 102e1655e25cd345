from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import ODD, ascii_lower, odd
from millrace.llm import lexical
from millrace.llm.lexical import TERM, Best, _lengths, ranked_documents, sharing, term_lists


def terms(text: str | None) -> list[str]:
    return re.findall(TERM, ascii_lower(text or ""))


def expected(docs: list[tuple], items: list[tuple], top: int) -> list[tuple]:
    own = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in own]
    n_docs, total = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for (doc_id, c), n in zip(own, sizes):
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * (75 + 25 * n * n_docs // total)))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, r, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


ITEMS = [
    (1, "one and the same line of more than forty characters"), (2, "One and the same line, again and again"), (3, None), (4, ""),
    (5, "漢字 É ſ word WORD"), (6, "no such thing: zzz"), (7, "very long very long document 3"), (7, "very long very long document 3"),
    (None, "words of the same id"), (9, "a null id, a null id"),
]


def items_of(spark, rows=ITEMS):
    return spark.createDataFrame(rows, "item_id bigint, text string").selectExpr("*", "1 AS words", "2 AS rank", "3 AS key")


@pytest.mark.parametrize("top, block_terms", [(20, 10**6), (3, 10**6), (4, 12)])
def test_odd_rows_equal_brute_force(spark, top, block_terms):
    # nulls, empty and long texts, ties, repeated documents and items; blocks of a few terms
    got = ranked_documents(odd(spark), items_of(spark), top, block_terms).collect()
    assert sorted(map(tuple, got), key=repr) == expected([r[:2] for r in ODD], ITEMS, top)


def test_empty_tables(spark):
    assert ranked_documents(odd(spark, []), items_of(spark)).count() == 0
    assert ranked_documents(odd(spark), items_of(spark, [])).count() == 0
    assert ranked_documents(odd(spark), items_of(spark, [(3, None)])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcdefgh"), max_size=12), max_size=12))
def test_the_graph_keeps_every_item(items):
    plan = sharing(items)

    def spelled(symbol: int) -> list[str]:
        if symbol < len(plan.terms):
            return [plan.terms[symbol]]
        a, b = plan.parts[symbol - len(plan.terms)]
        assert max(a, b) < symbol
        return spelled(a) + spelled(b)

    assert [sorted(t for s in own for t in spelled(s)) for own in plan.items] == [sorted(own) for own in items]
    assert sorted(i for level in plan.depths() for i in level.tolist()) == list(range(len(plan.parts)))


def test_shared_sets_are_scored_once():
    common = [f"w{i}" for i in range(30)]
    plan = sharing([[*common, f"own{i}"] for i in range(50)])
    assert all(len(own) == 2 for own in plan.items) and len(plan.parts) == 29


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aZ9 _\t\n\x00-é漢\x7f", max_size=20)), max_size=6))
def test_terms_of_any_text(texts):
    of, at, distinct = term_lists(pa.array(["skipped", *texts], pa.string()).slice(1))
    names = distinct.to_pylist()
    assert [[names[a] for a, o in zip(at, of) if o == i] for i in range(len(texts))] == [terms(t) for t in texts]


def test_lengths_beyond_64_bits():
    n = np.array([1, 10**9])
    assert _lengths(n, 10**12, 10**15).tolist() == [75, 75 + 25 * 10**9 // 1000]


def test_ties_across_batches(monkeypatch, spark):
    best = Best(1, 2)
    for ids in ([9, 8], [7, 3], [5, 6]):
        best.add(np.array([[4, 4]]), np.array(ids))
    assert best.id.tolist() == [3, 5]
    monkeypatch.setattr(lexical, "CELLS", 1)
    docs = spark.createDataFrame([(i, "same words") for i in range(100)], "doc_id bigint, text string").repartition(3)
    got = ranked_documents(docs, spark.createDataFrame([(1, "words"), (2, "other")], "item_id bigint, text string"), 5).collect()
    assert sorted((r["item_id"], r["rank"], r["doc_id"]) for r in got) == [(1, i + 1, i) for i in range(5)]

from __future__ import annotations

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import ODD, SMALL, odd, quality_counts, table
from millrace.llm.quality import LADDER, binomial_tail, chosen_rungs, keep_good, measured
from millrace.llm.queries import QUERIES


def test_query_equals_brute_force(spark):
    found = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op2_quality_rules"](spark, SMALL).collect()}
    for doc_id, text, *_ in table("documents"):
        counts = quality_counts(text)
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        assert found[doc_id][:6] == (*counts, failed)
        assert not (failed and found[doc_id][6])


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t#|é", max_size=60), min_size=1, max_size=8))
def test_counts_of_any_text(spark, texts):
    frame = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string")
    m = measured(frame).select("doc_id", "measures.*")
    for r in m.collect():
        found = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert found == quality_counts(texts[r["doc_id"]])


def exact_tail(k: int, n: int, p: float) -> float:
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


@pytest.mark.parametrize("k, n", [(0, 1), (0, 85), (3, 200), (10, 200), (40, 1000), (0, 700)])
def test_binomial_tail(spark, k, n):
    found = spark.range(1).select(binomial_tail(F.lit(k), F.lit(n), 0.05)).first()[0]
    assert found == pytest.approx(exact_tail(k, n, 0.05), rel=1e-10)


def test_binomial_tail_of_many(spark):
    found = spark.range(1).select(binomial_tail(F.lit(4_990_000), F.lit(100_000_000), 0.05)).first()[0]
    assert 0 < found < 1e-5


def test_strictest_admissible_rung(spark):
    # 1,000 good documents: the first rung rejects none, the second 10, the third 49, which is not below 5 % for sure
    good = [(0,)] * 0 + [(1,)] * 10 + [(2,)] * 39 + [(len(LADDER),)] * 951
    frame = spark.createDataFrame([("s", p) for (p,) in good] + [(None, 5)] * 20, "stratum string, passed int")
    level = 0.05 / (2 * len(LADDER))
    assert exact_tail(10, 1000, 0.05) <= level < exact_tail(49, 1000, 0.05)
    assert [tuple(r) for r in chosen_rungs(frame).collect()] == [("s", 2, 1000, 10)]


def test_odd_rows_and_clashing_names(spark):
    labels = spark.createDataFrame([(5, 1), (5, 0), (None, 1), (7, None)], "doc_id bigint, quality int")
    kept = keep_good(odd(spark), labels)
    assert kept.columns == odd(spark).columns
    ids = sorted(r["doc_id"] for r in kept.collect())  # rows have no order
    assert ids == [i for i, t, *_ in ODD if quality_counts(t)[0] >= 10 and 100 * quality_counts(t)[4] <= 20 * quality_counts(t)[0]]
    assert keep_good(odd(spark, []), labels.limit(0)).count() == 0

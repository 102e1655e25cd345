from __future__ import annotations

from collections import Counter

import pytest

from helpers import ODD, SMALL, odd, table, words
from millrace.llm.mixing import mixed, mixture, targets
from millrace.llm.queries import QUERIES


def filled(sizes: dict, weights=(3, 1, 2), share=1.5, cap=2) -> dict:
    """Targets by the rule itself: share by weight, stop at the cap, share the excess again."""
    ordered = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(ordered)}
    whole, full = share * sum(sizes.values()), set()
    while True:
        rest = whole - sum(cap * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in sizes if s not in full)
        found = {s: cap * sizes[s] if s in full else rest * weight[s] / open_weight for s in sizes}
        over = {s for s in sizes if s not in full and found[s] > cap * sizes[s]}
        if not over:
            return found
        full |= over


def test_query(spark):
    rows = QUERIES["op8_mixing"](spark, SMALL).collect()
    documents = {r[0]: (r[1], r[3]) for r in table("documents")}
    sizes, taken = Counter(), Counter()
    for r in rows:
        assert r["size"] == len(words(documents[r["doc_id"]][0])) and 0 <= r["taken"] <= 2 * r["size"]
        sizes[documents[r["doc_id"]][1]] += r["size"]
        taken[documents[r["doc_id"]][1]] += r["taken"]
    expected = filled(sizes)
    for r in rows:
        source = documents[r["doc_id"]][1]
        assert r["target"] == pytest.approx(expected[source]) and r["source_size"] == sizes[source]
    assert len(rows) == len(documents)
    for source, wanted in expected.items():
        largest = max(r["size"] for r in rows if documents[r["doc_id"]][1] == source)
        assert abs(taken[source] - wanted) <= largest
    again = QUERIES["op8_mixing"](spark, SMALL).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, None: 10}, {"a": 1, "b": 1000, "c": 3}, {"a": 5}, {"a": 0, "b": 7, "": 2}, {"a": 0}])
def test_targets(spark, sizes):
    rows = [("" if s is None else "=" + s, size, 1) for s, size in sizes.items()]
    found = {r["skey"]: r["target"] for r in targets(spark.createDataFrame(rows, "skey string, size bigint, n bigint")).collect()}
    assert found == {("" if s is None else "=" + s): pytest.approx(t) for s, t in filled(sizes).items()}


def test_one_hot_group_of_equal_rows(spark):
    rows = [(1, "same words here", "en", "a", 0)] * 300 + [(i, "w " * i, "en", "b", 0) for i in range(1, 60)]
    found = [r for r in mixture(odd(spark, rows)).collect()]
    for size in {r["source_size"] for r in found}:
        own = [r for r in found if r["source_size"] == size]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own)
    same = Counter(r["copies"] for r in found if r["doc_id"] == 1 and r["size"] == 3)
    assert max(same) - min(same) <= 1


def test_odd_rows(spark):
    found = mixture(odd(spark)).collect()
    assert len(found) == len(ODD) and sorted(r["size"] for r in found) == sorted(len(words(r[1])) for r in ODD)
    copies = Counter((r["doc_id"], r["size"]) for r in found for _ in range(r["copies"]))
    frame = mixed(odd(spark))
    assert frame.columns == odd(spark).columns
    assert Counter((r["doc_id"], len(words(r["text"]))) for r in frame.collect()) == copies
    assert mixture(odd(spark, [])).count() == 0 and mixed(odd(spark, [])).count() == 0

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from helpers import ODD, SMALL, ascii_lower, odd, table
from millrace.llm.line_dedup import LineIndex, PerfectHash, without_shared_lines
from millrace.llm.queries import QUERIES


def key(line: str) -> str:
    return ascii_lower(line.strip(" \t\n\x0b\x0c\r"))


def expected(docs: list[tuple], min_chars: int = 40, min_docs: int = 5) -> list[tuple]:
    least = -(2**63)
    holders = defaultdict(set)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            holders[key(line)].add(least if doc_id is None else doc_id)
    found = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        own = least if doc_id is None else doc_id
        kept = [
            x for x in lines if not (len(key(x)) >= min_chars and len(holders[key(x)]) >= min_docs and own < max(holders[key(x)]))
        ]
        found.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return found


def test_query_equals_brute_force(spark):
    rows = expected([r[:2] for r in table("documents")])
    hashed = sorted((*r[:3], hashlib.sha256(r[3].encode()).hexdigest()) for r in rows)
    assert sorted(map(tuple, QUERIES["op6_line_dedup"](spark, SMALL).collect())) == hashed
    assert any(r[2] for r in rows)


def test_odd_rows(spark):
    found = sorted(map(tuple, without_shared_lines(odd(spark)).collect()), key=repr)
    assert found == sorted(expected([r[:2] for r in ODD]), key=repr)
    assert sum(r[2] for r in found) == 2 + 5
    assert without_shared_lines(odd(spark, [])).count() == 0


def test_code_points_count_and_null_ids_are_one_document(spark):
    line = "é" * 40
    docs = [(None, line), (None, line), (1, line), (2, line.upper()), (3, "é" * 39), (4, line), (5, " " + line + "\t"), (6, line)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert sorted(map(tuple, without_shared_lines(frame).collect()), key=repr) == sorted(expected(docs), key=repr)


@pytest.mark.parametrize("count", [0, 1, 2, 1000, 70_000])
def test_perfect_hash(count):
    rng = np.random.default_rng(count)
    high, low = rng.integers(0, 2**64, (2, count), dtype=np.uint64)
    high[: count // 2] = 7  # keys that agree in one half
    made = PerfectHash(high, low)
    assert sorted(made.number(high, low)) == list(range(count)) and made.size == count
    bits = sum(64 * len(b) for b in made.levels)
    assert bits <= 8 * count + 64 * len(made.levels)
    index = LineIndex.from_bytes(LineIndex.over(high, low, np.arange(count), np.arange(count) * 2).to_bytes())
    counts, owners = index.probe(high, low)
    assert np.array_equal(counts, np.arange(count)) and np.array_equal(owners, np.arange(count) * 2)
    strangers = rng.integers(0, 2**64, (2, 1000), dtype=np.uint64)
    assert not index.probe(*strangers)[0].any()

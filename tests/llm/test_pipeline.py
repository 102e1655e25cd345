"""The pipeline, stage by stage, against brute force on each stage's own input."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from helpers import SMALL, grouped, odd, overlaps, quality_counts, simhash, table
from millrace.llm.common import stage
from millrace.llm.queries import ORACLES, QUERIES
from test_token_store import plain_ids


def test_every_stage(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    seen = [docs]
    for name, step in corpus_pipeline.STAGES:
        seen.append(stage(step(spark, seen[-1], SMALL), "test-stage"))
        assert name
    rows = [[tuple(r) for r in frame.collect()] for frame in seen]
    assert all(frame.columns == columns for frame in seen[:-1])

    verdict = {r["doc_id"]: r["kept"] for r in QUERIES["op2_quality_rules"](spark, SMALL).collect()}
    assert sorted(rows[1]) == sorted(r for r in rows[0] if verdict[r[0]]) and len(rows[1]) < len(rows[0])
    assert all(quality_counts(r[1])[0] >= 10 for r in rows[1])

    groups = grouped([simhash(r[1]) for r in rows[1]], 4)
    least: dict = {}
    for r, g in zip(rows[1], groups):
        least[g] = min(least.get(g, r), r)
    assert sorted(rows[2]) == sorted(least.values()) and len(rows[2]) < len(rows[1])

    held = {d for d, _ in overlaps([r[:2] for r in rows[2]], table("benchmark"))}
    assert sorted(rows[3]) == sorted(r for r in rows[2] if r[0] not in held)

    copies = Counter(rows[4])
    assert set(copies) <= set(rows[3]) and max(copies.values()) == 2

    expected = Counter((r[0], len(ids) + 1) for r, ids in zip(rows[4], plain_ids([r[1] for r in rows[4]])))
    assert Counter((r[0], r[2]) for r in rows[5]) == expected
    at = 0
    for _, start, n_tokens, _ in sorted(rows[5], key=lambda r: r[1]):
        assert start == at
        at += n_tokens
    assert corpus_pipeline.run(spark, SMALL).count() == len(rows[5])


def test_stages_take_odd_and_empty_tables(spark):
    for docs in (odd(spark), odd(spark, [])):
        for _, step in corpus_pipeline.STAGES[:-1]:
            left = step(spark, docs, SMALL)
            assert left.columns == docs.columns and left.count() <= 2 * docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == docs.count()


def test_queries_are_registered():
    from __spark_entry__ import oracle_sql, queries

    assert {*QUERIES, "pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))

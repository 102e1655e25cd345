from __future__ import annotations

from itertools import combinations

import pytest

from helpers import DOCUMENTS, ODD, SMALL, grouped, odd, simhash, table
from millrace.llm import simhash as near
from millrace.llm.components import components
from millrace.llm.queries import QUERIES
from millrace.llm.simhash import block_masks, fingerprint, linked_fingerprints, near_duplicate_groups, one_per_group, pieces_for


def test_query_equals_brute_force(spark):
    docs = [(r[0], r[1]) for r in table("documents")]
    prints = [simhash(text) for _, text in docs]
    roots = grouped(prints, 4)
    least: dict[int, int] = {}
    for (doc_id, _), root in zip(docs, roots):
        least[root] = min(least.get(root, doc_id), doc_id)
    expected = sorted((d, f"{p:016x}", least[r]) for (d, _), p, r in zip(docs, prints, roots))
    assert sorted(map(tuple, QUERIES["op4_simhash_near_dedup"](spark, SMALL).collect())) == expected


@pytest.mark.parametrize("pieces", [6, 7, 8])
def test_close_fingerprints_share_a_block(pieces):
    masks = [m % (1 << 64) for m in block_masks(pieces, 4)]
    for bits in combinations(range(0, 64, 5), 4):
        other = sum(1 << b for b in bits)
        assert any(other & mask == 0 for mask in masks)
    assert pieces_for(10, 4) == 6 and pieces_for(10**9, 4) > pieces_for(10**5, 4)


def test_dense_and_chained_groups(spark):
    # a centre with many near copies, a chain of steps of four bits, and strangers
    centre = 0x0123456789ABCDEF
    prints = {centre} | {centre ^ 1 << a ^ 1 << b for a, b in combinations(range(0, 60, 3), 2)}
    chain = [0xF0F0F0F0F0F0F0F0]
    for i in range(12):
        chain.append(chain[-1] ^ 0xF << 4 * i)
    values = sorted(prints | set(chain) | {0, (1 << 64) - 1})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v, 1) for v in signed], "fp bigint, n bigint")
    found = {r["fp"]: r["root"] for r in linked_fingerprints(frame).collect()}
    expected = grouped(values, 4)
    by_root: dict = {}
    for v, e in zip(signed, expected):
        assert by_root.setdefault(e, found[v]) == found[v]
    assert len(set(by_root.values())) == len(set(expected))


def test_block_tables_are_not_broadcast(spark, monkeypatch):
    # 15 block keys for a fingerprint, but Spark sizes the exploded table, and that of shared blocks, as if there were one
    centre = 0x0123456789ABCDEF
    values = [centre ^ 1 << a ^ 1 << b for a, b in combinations(range(0, 60, 10), 2)]
    kept = near.stage
    plans = {}

    def planned(frame, label, **options):
        plans.setdefault(label, []).append(frame._jdf.queryExecution().executedPlan().toString())
        return kept(frame, label, **options)

    monkeypatch.setattr(near, "stage", planned)
    prints = kept(spark.createDataFrame([(v, 1) for v in values], "fp bigint, n bigint"), "prints")
    roots = linked_fingerprints(prints)
    assert {r["root"] for r in roots.collect()} == {min(values)}
    (blocks,) = plans["simhash-blocks"]
    assert "Generate explode" in blocks and "SortMergeJoin" in blocks and "Broadcast" not in blocks


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert found == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(60)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_odd_rows(spark):
    rows = near_duplicate_groups(odd(spark)).collect()
    assert len(rows) == len(ODD)
    wordless = {r["doc_id"] for r in rows if r["component_id"] == 1}
    assert {1, 2, 3} <= wordless and {r["fingerprint"] for r in rows if r["doc_id"] in (1, 2, 3)} == {"0" * 16}
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None, None]
    assert near_duplicate_groups(odd(spark, [])).count() == 0
    assert fingerprint(ODD[9][1]) == simhash(ODD[9][1])


def test_one_document_of_each_group_stays(spark):
    kept = one_per_group(odd(spark))
    assert kept.columns == odd(spark).columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(None) == 1 and 1 in ids and 2 not in ids and 3 not in ids
    # two equal rows and one other text under id 5, which is a group of its own; 'word' belongs to id 4
    assert ids.count(5) == 1 and ids.count(4) == 1
    assert one_per_group(spark.createDataFrame([], DOCUMENTS)).count() == 0

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from helpers import ODD, odd
from millrace.llm.merkle import manifest, proved


def h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row: tuple) -> str:
    doc_id, text, lang, source, n_chars = row
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return h("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def tree(leaves: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root, and for every leaf its siblings before and after, level by level."""
    paths: list = [[] for _ in leaves]
    own, level = list(range(len(leaves))), leaves
    while len(level) > 1:
        for i, at in enumerate(own):
            run = at // 3 * 3
            paths[i].append(("".join(level[run:at]), "".join(level[at + 1 : run + 3])))
        level = [h("".join(level[i : i + 3])) for i in range(0, len(level), 3)]
        own = [at // 3 for at in own]
    return level[0], paths


def expected(rows: list[tuple]) -> list[tuple]:
    groups = defaultdict(list)
    for r in rows:
        groups[r[3]].append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        members = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = (members, *tree([leaf(r) for r in members]))
    root, crowns = tree([trees[s][1] for s in order])
    out = []
    for s, crown in zip(order, crowns):
        members, subroot, paths = trees[s]
        for r, path in zip(members, paths):
            steps = path + crown
            cut = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[1] is not None
            found = leaf((r[0], r[1].replace("\n", ""), *r[2:])) if cut else leaf(r)
            for before, after in steps:
                found = h(before + found + after)
            out.append((r[0], leaf(r), subroot, root, h("".join(b + a for b, a in steps)), found, found == root))
    return sorted(out, key=repr)


def found(frame) -> list[tuple]:
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.translate("text", "\n", ""))
    return sorted((tuple(r) for r in proved(frame, tampered).collect()), key=repr)


def test_odd_rows_equal_brute_force(spark):
    # nulls in every column, repeated rows and ids, a null and an empty source, columns with clashing names
    assert found(odd(spark)) == expected(ODD)


@pytest.mark.parametrize("count", [1, 2, 3, 4, 81, 82, 243, 700])
def test_trees_of_any_size(spark, count):
    rows = [(i, f"line {i}\nand another", "en", "hot" if i % 7 else f"s{i % 5}", i) for i in range(count)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(5)
    assert found(frame) == expected(rows)


def test_many_groups_and_empty_table(spark):
    rows = [(i, "x", None, f"host{i // 2}", None) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert found(frame) == expected(rows)
    assert found(odd(spark, [])) == []


def test_the_general_form_keeps_columns(spark):
    rows = spark.createDataFrame([("g", f"{i:064x}", i, "more") for i in range(5)], "group string, hash string, place int, note string")
    got = manifest(rows, "place").collect()
    assert {(r["place"], r["rank"], r["n"], r["note"]) for r in got} == {(i, i, 5, "more") for i in range(5)}
    root, paths = tree([f"{i:064x}" for i in range(5)])
    assert {r["root"] for r in got} == {root} == {r["subroot"] for r in got}
    assert {r["place"]: [tuple(s) for s in r["path"]] for r in got} == dict(enumerate(paths))

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import ODD, SMALL, odd, table
from millrace.llm import suffix_dedup
from millrace.llm.queries import QUERIES
from millrace.llm.suffix_dedup import anchors_of, common_prefixes, maximal_repeats, repeats_in_group, without_repeats
from millrace.session import session_with


def expected(texts: list, length: int) -> list[tuple]:
    """``(n_bytes, n_removed, n_spans, kept)`` per text, by counting every window."""
    own = [(t or "").encode() for t in texts]
    seen = Counter(hash(b[i : i + length]) for b in own for i in range(len(b) - length + 1))
    exact = Counter(b[i : i + length] for b in own for i in range(len(b) - length + 1) if seen[hash(b[i : i + length])] > 1)
    out = []
    for b in own:
        gone = np.zeros(len(b) + 1, dtype=bool)
        for i in range(len(b) - length + 1):
            if seen[hash(b[i : i + length])] > 1 and exact[b[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-1]])[: len(b)]).sum())
        out.append((len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, dtype=np.uint8)[~gone[: len(b)]])))
    return out


def test_query_equals_brute_force(spark):
    docs = [(r[0], r[1]) for r in table("documents")]
    wanted = [(d, n, r, s, hashlib.sha256(k).hexdigest()) for (d, _), (n, r, s, k) in zip(docs, expected([t for _, t in docs], 400))]
    got = sorted(map(tuple, QUERIES["op13_suffix_dedup"](spark, SMALL).collect()))
    assert got == sorted(wanted) and any(r[2] for r in got) and any(0 < r[2] < r[1] for r in got)


@pytest.mark.parametrize("length, group", [(400, 1024), (40, 1024), (40, 2), (12, 1)])
def test_odd_rows(spark, length, group):
    # nulls, empty and very long repetitive texts, repeated rows and ids, texts beyond ASCII; groups split to single offsets
    found = without_repeats(odd(spark), length, group)
    wanted = sorted(((r[0], *e) for r, e in zip(ODD, expected([r[1] for r in ODD], length))), key=repr)
    assert sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in found.collect()), key=repr) == wanted
    assert without_repeats(odd(spark, []), length).count() == 0


def test_hot_passages_are_split_without_loss(spark):
    rng = np.random.default_rng(3)

    def noise(n: int) -> str:
        return "".join(rng.choice(list("abcdefgh "), n))

    passage = noise(700)
    texts = [noise(int(rng.integers(0, 300))) + passage[int(rng.integers(0, 200)) : 500 + int(rng.integers(0, 200))] + noise(100) for _ in range(90)]
    near = [passage[:i] + "#" + passage[i + 1 :] for i in range(0, 700, 35)]
    rows = [(i, t) for i, t in enumerate([*texts, *near, passage, passage])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    for group in (1024, 8):
        got = sorted((r[0], r[1], r[2], r[3], bytes(r[4])) for r in without_repeats(frame, 400, group).collect())
        assert got == [(i, *e) for i, e in enumerate(expected([t for _, t in rows], 400))]


def test_pieces_of_one_group_are_dealt_to_many_tasks(monkeypatch, spark):
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    rng = np.random.default_rng(5)
    rows = [(b"hot" if i < 3000 else b"%d" % (i // 2), b"%d" % i, 1, 1, 5, rng.bytes(40)) for i in range(3400)]
    schema = "group binary, sub binary, n bigint, windows int, head int, text binary"
    pieces = suffix_dedup.stage(session_with(spark, small).createDataFrame(rows, schema).repartition(8, "sub"), "pieces")
    stage, dealt = suffix_dedup.stage, []

    def counted(frame, label):
        out = stage(frame, label)
        if label == "suffix-groups":
            dealt.append([r["count"] for r in out.groupBy(F.input_file_name()).count().collect()])
        return out

    monkeypatch.setattr(suffix_dedup, "stage", counted)
    assert suffix_dedup.repeats_of(pieces, 40).count() == 0
    assert sum(dealt[0]) == 3400 and max(dealt[0]) < 1500


def test_maximal_repeats_with_all_occurrences(spark):
    # 'shared' three times, a longer string that holds it twice
    shared, more = "0123456789abcdefghij", "KLMNOPQRST"
    rows = [(1, f"x{shared}{more}y"), (2, f"p{shared}{more}q"), (3, f"--{shared}!"), (4, shared[:19])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = defaultdict(set)
    for r in maximal_repeats(frame, 20).collect():
        found[r["repeat"], r["length"]].add((r["doc_id"], r["start"]))
    assert {(1, 1), (2, 1), (3, 2)} in found.values()
    texts = {i: t for i, t in rows}
    for (_, length), places in found.items():
        assert len({texts[d][s : s + length] for d, s in places}) == 1 and len(places) > 1 and length >= 20
        assert {(d, s) for d, t in rows for s in range(len(t)) if t.startswith(texts[next(iter(places))[0]][next(iter(places))[1] :][:length], s)} == places


@settings(max_examples=80, deadline=None)
@given(st.lists(st.binary(max_size=40).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=6), st.integers(2, 6))
def test_intervals_of_any_group(texts, least):
    pieces = [(t, len(t) - least + 1, 1) for t in texts if len(t) >= least]
    found = repeats_in_group(pieces, least)
    windows = Counter(t[i : i + least] for t, _, _ in pieces for i in range(len(t) - least + 1))
    for (t, _, _), own in zip(pieces, found):
        covered = {i for _, n, p in own for i in range(p, p + n)}
        assert covered == {j for i in range(len(t) - least + 1) if windows[t[i : i + least]] > 1 for j in range(i, i + least)}
    places = defaultdict(set)
    for k, own in enumerate(found):
        for number, n, p in own:
            places[number, n].add((k, p))
    for (_, n), at in places.items():
        k, p = next(iter(at))
        word = pieces[k][0][p : p + n]
        assert at == {(i, q) for i, (t, w, _) in enumerate(pieces) for q in range(w) if t[q:].startswith(word)}
        lefts = [pieces[i][0][q - 1] if q else None for i, q in at]
        assert None in lefts or len(set(lefts)) > 1


def test_common_prefixes_of_sorted_strings():
    rows = sorted([b"", b"a", b"a\0", b"a\0\0", b"ab", b"abc", b"abc", b"b"] + [b"c" * i for i in range(5000)])
    wanted = [0] + [next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b))) for a, b in zip(rows, rows[1:])]
    assert common_prefixes(rows).tolist() == wanted


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=60), min_size=1, max_size=5), st.integers(2, 12))
def test_every_window_has_one_anchor_by_its_content(texts, length):
    data = [t.encode() for t in texts]
    gram, at, first, last = anchors_of(np.frombuffer(b"".join(data), dtype=np.uint8), np.cumsum([len(t) for t in data]), length)
    joined, seen, count = b"".join(data), {}, 0
    for g, a, f, e in zip(gram, at, first, last):
        for p in range(f, e + 1):
            count += 1
            assert seen.setdefault(joined[p : p + length], (g, a - p)) == (g, a - p)
    assert count == sum(max(0, len(t) - length + 1) for t in data)


def test_long_texts_chunk_by_chunk(monkeypatch, spark):
    rng = np.random.default_rng(1)
    text = "".join(rng.choice(list("abcdefghij"), 5000))
    rows = [(1, text), (2, text[1000:3000] + "#" + text[3001:]), (3, "ab" * 2000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(suffix_dedup, "CHUNK", 700)
    got = sorted((r[0], r[1], r[2], r[3], bytes(r[4])) for r in without_repeats(frame, 100).collect())
    assert got == [(i, *e) for (i, _), e in zip(rows, expected([t for _, t in rows], 100))]

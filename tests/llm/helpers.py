"""Brute-force versions and odd tables for the tests of this folder."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import xxhash

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"

LONG = "One and the same line of more than forty characters. "
ODD = [
    (1, None, "en", "a", 0),
    (2, "", None, None, 0),
    (3, " \t\n\r ", "en", "a", 5),
    (4, "word", "en", "", 4),
    (5, "word", "en", "b", 4),
    (5, "word", "en", "b", 4),
    (5, "other words of the same id, quite a few of them indeed", "de", "b", 4),
    (None, "a null id", "fr", None, 9),
    (None, "a null id", "fr", None, 9),
    (7, ("very long " * 30_000).strip(), "en", "a", 300_000),
    (8, LONG + "\n" + LONG.upper(), "en", "a", 100),
    (9, "Ünïcödé ß ſ 漢字 \U0001f600 ''s don't ...", "de", "c", 30),
    *[(20 + i, f"{LONG}\nand a line of document {i}", "en", "a", 80) for i in range(6)],
]


def table(name: str, folder: str = SMALL) -> list[tuple]:
    return duckdb.sql(f"SELECT * FROM '{folder}/{name}.parquet'").fetchall()


def odd(spark, rows=None):
    """Documents with nulls, empty and long texts, repeated rows and ids, and columns with clashing names."""
    frame = spark.createDataFrame(ODD if rows is None else rows, DOCUMENTS)
    return frame.selectExpr("*", "'x' AS size", "1 AS rows", "2 AS kept", "3 AS words", "4 AS root", "5 AS text_key", "6 AS id")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def ascii_lower(text: str) -> str:
    return text.encode().lower().decode()


def simhash(text: str | None, shingle: int = 4) -> int:
    own = words(ascii_lower(text or ""))
    if not own:
        return 0
    shingles = [" ".join(own[i : i + shingle]) for i in range(max(1, len(own) - shingle + 1))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for bit in range(64):
            ones[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * ones[bit] > len(shingles))


def grouped(prints: list[int], distance: int) -> list[int]:
    """For every fingerprint the smallest index it is linked with."""
    values = np.array(prints, dtype=np.uint64)
    parent = list(range(len(prints)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(values[i] ^ values[:i]) <= distance):
            a, b = root(i), root(int(j))
            parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def quality_counts(text: str | None) -> tuple:
    own = words(text)
    n = len(own)
    windows = Counter(tuple(own[i : i + 5]) for i in range(n - 4))
    covered: set[int] = set()
    for i in range(n - 4):
        if windows[tuple(own[i : i + 5])] > 1:
            covered.update(range(i, i + 5))
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return n, sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def overlaps(docs: list[tuple], items: list[tuple], window: int = 13, substitutions: int = 2) -> dict:
    """``(doc_id, item_id): (matched, item_words, item_hits)`` by trying every place of every item."""
    found: dict = {}
    own_items = [(i, words((t or "").lower())) for i, t in items]
    for doc_id, text in docs:
        own = words((text or "").lower())
        places = defaultdict(list)
        for p, w in enumerate(own):
            places[w].append(p)
        for item_id, item in own_items:
            shifts: dict[int, set] = defaultdict(set)
            for q, w in enumerate(item):
                for p in places.get(w, ()):
                    shifts[p - q].add(q)
            width = min(window, len(item))
            needed = window - substitutions if len(item) >= window else len(item)
            for hits in shifts.values():
                best = max(sum(s <= q < s + width for q in hits) for s in range(len(item) - width + 1))
                if best >= needed:
                    old = found.get((doc_id, item_id), (0, 0, 0))
                    found[doc_id, item_id] = (max(old[0], best), len(item), max(old[2], len(hits)))
    return found

"""Ranked lexical search for many queries at once: term sets that queries share are scored once per document.

The items of a block are written as sequences of terms in one order, commonest first. Pairs of neighbours
that occur twice or more become nodes of a sharing graph, round by round, so a node stands for a term set
that several items (or other nodes) hold. Every node's partial score of a document is formed once, from
its two parts; an item's score is the sum over the few nodes it is made of.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import ASCII_UPPER, pieces_of, stage

TOP = 20
# Terms, with repeats, of the items that one pass over the documents answers; this bounds all that is sent to tasks.
BLOCK_TERMS = 200_000
# Partial scores that a task holds at once.
CELLS = 6_000_000
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_NO_ID = np.iinfo(np.int64).max

# ASCII letters in lower case, digits and all bytes above 127 as they are, any other byte a space
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def term_lists(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Of a batch of texts: the text and the place in the last array of every term, and the distinct terms; a null has none."""
    texts = pc.fill_null(texts, "").cast(pa.string())
    first, last = texts.offset, texts.offset + len(texts)
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int32)[first : last + 1]
    folded = (data.to_pybytes() if data else b"")[bounds[0] : bounds[-1]].translate(_FOLD)
    same = pa.StringArray.from_buffers(len(texts), pa.py_buffer((bounds - bounds[0]).astype(np.int32)), pa.py_buffer(folded))
    split = pc.ascii_split_whitespace(same)
    coded = split.flatten().dictionary_encode()
    of = np.repeat(np.arange(len(texts)), np.diff(np.asarray(split.offsets)))
    at = np.asarray(coded.indices, dtype=np.int64)
    empty = pc.equal(coded.dictionary, "").to_numpy(zero_copy_only=False)
    real = ~empty[at] if len(at) else np.zeros(0, dtype=bool)
    return of[real], at[real], coded.dictionary


@dataclass
class Sharing:
    """The sharing graph of a block of items.

    Symbols 0 … len(terms) - 1 are terms; symbol ``len(terms) + i`` is node ``i``, the sum of the symbols
    ``parts[i]``, which both come before it. ``items`` says which symbols make up an item.
    """

    terms: list[str]
    parts: np.ndarray
    items: list[list[int]]

    def depths(self) -> list[np.ndarray]:
        """Numbers of the nodes by depth: those of one depth need only those before."""
        depth = [0] * (len(self.terms) + len(self.parts))
        levels: list[list[int]] = []
        for i, (a, b) in enumerate(self.parts.tolist()):
            d = max(depth[a], depth[b])
            depth[len(self.terms) + i] = d + 1
            if len(levels) == d:
                levels.append([])
            levels[d].append(i)
        return [np.array(level) for level in levels]


def sharing(items: list[list[str]]) -> Sharing:
    """Mine the term sets that items, given as lists of terms with repeats, share."""
    held: dict[str, list[int]] = {}
    for i, terms in enumerate(items):
        for t in set(terms):
            held.setdefault(t, []).append(i)
    # terms that the same items hold come next to each other
    order = sorted(held, key=lambda t: (-len(held[t]), held[t], t))
    number = {t: i for i, t in enumerate(order)}
    made = [sorted(number[t] for t in terms) for terms in items]
    parts: list[tuple[int, int]] = []
    while True:
        counts: Counter = Counter()
        for own in made:
            counts.update(set(zip(own, own[1:])))
        wanted = {pair: n for pair, n in counts.items() if n > 1}
        if not wanted:
            return Sharing(order, np.array(parts, dtype=np.int64).reshape(-1, 2), made)
        node: dict[tuple[int, int], int] = {}
        for k, own in enumerate(made):
            left: list[int] = []
            i = 0
            while i < len(own):
                here = wanted.get((own[i], own[i + 1]), 0) if i + 1 < len(own) else 0
                after = wanted.get((own[i + 1], own[i + 2]), 0) if i + 2 < len(own) else 0
                if here and here >= after:
                    pair = (own[i], own[i + 1])
                    if pair not in node:
                        node[pair] = len(order) + len(parts)
                        parts.append(pair)
                    left.append(node[pair])
                    i += 2
                else:
                    left.append(own[i])
                    i += 1
            made[k] = left


def term_counts(docs: DataFrame, terms: list[str]) -> DataFrame:
    """``(doc_id, n, terms, tf)``: the number of all terms of a document, and which of ``terms``, by number, it holds how often."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(terms, pa.string())
        for batch in pieces_of(batches, "text"):
            of, at, distinct = term_lists(batch["text"])
            number = pc.fill_null(pc.index_in(distinct, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            n = np.bincount(of, minlength=batch.num_rows)
            mine = number[at]
            asked = mine >= 0
            keys, tf = np.unique(of[asked] * max(1, len(terms)) + mine[asked], return_counts=True)
            row, term = np.divmod(keys, max(1, len(terms)))
            offsets = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(term, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(tf, pa.int64())),
                ],
                ["doc_id", "n", "terms", "tf"],
            )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(counted, "doc_id bigint, n bigint, terms array<int>, tf array<bigint>")


def _lengths(n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """The length a term count is weighed with: 75 and a quarter of the document's length in hundredths of the mean."""
    if len(n) and 25 * int(n.max()) * docs >= 1 << 63:
        return np.array([75 + 25 * int(x) * docs // total for x in n], dtype=np.int64)
    return 75 + 25 * n * docs // total


class Best:
    """The highest-scoring documents of every item so far, equal scores by ascending id."""

    def __init__(self, items: int, top: int):
        self.top, self.least = top, np.ones(items, dtype=np.int64)
        self.item = self.score = self.id = np.zeros(0, dtype=np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` has a row per item and a column per document."""
        item, column = np.nonzero(scores >= self.least[:, None])
        if not len(item):
            return
        item, score, id = (
            np.concatenate(x) for x in ((self.item, item), (self.score, scores[item, column]), (self.id, ids[column]))
        )
        order = np.lexsort((id, -score, item))
        item, score, id = item[order], score[order], id[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        stay = place < self.top
        self.item, self.score, self.id = item[stay], score[stay], id[stay]
        full = place == self.top - 1
        self.least[item[full]] = score[full]


def best_of_tasks(counts: DataFrame, plan: Sharing, weights: np.ndarray, docs: int, total: int, top: int) -> DataFrame:
    """``(item, doc_id, score)``: the ``top`` documents of every item, by its number in the plan, in each task's share of ``counts``."""
    levels = plan.depths()
    base, symbols = len(plan.terms), len(plan.terms) + len(plan.parts)
    flat = np.array([s for own in plan.items for s in own], dtype=np.int64)
    filled = np.array([i for i, own in enumerate(plan.items) if own], dtype=np.int64)
    starts = np.cumsum([0, *(len(own) for own in plan.items if own)])[:-1]
    width = max(16, CELLS // (symbols + len(flat) + len(plan.items) + 1))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(plan.items), top)
        for whole in batches:
            for at in range(0, whole.num_rows, width):
                batch = whole.slice(at, width)
                n = batch["n"].to_numpy(zero_copy_only=False)
                bounds = np.asarray(batch["terms"].offsets)
                of = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
                term = batch["terms"].flatten().to_numpy(zero_copy_only=False)
                tf = batch["tf"].flatten().to_numpy(zero_copy_only=False)
                # every symbol's partial score of every document, once
                partial = np.zeros((symbols, batch.num_rows), dtype=np.int64)
                partial[term, of] = weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * _lengths(n, docs, total)[of]))
                for level in levels:
                    partial[base + level] = partial[plan.parts[level, 0]] + partial[plan.parts[level, 1]]
                scores = np.zeros((len(plan.items), batch.num_rows), dtype=np.int64)
                scores[filled] = np.add.reduceat(partial[flat], starts, axis=0)
                ids = np.asarray(pc.fill_null(batch["doc_id"], _NO_ID))
                best.add(scores, ids)
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.item, pa.int32()), pa.array(best.id, pa.int64(), mask=best.id == _NO_ID), pa.array(best.score, pa.int64())],
            ["item", "doc_id", "score"],
        )

    return counts.mapInArrow(scored, "item int, doc_id bigint, score bigint")


def ranked_documents(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``top`` highest-scoring rows of ``docs (doc_id, text, …)`` for every row of ``items (item_id, text, …)``.

    Terms are runs of ASCII letters, digits and any signs beyond ASCII, with A-Z in lower case. Scores are in
    whole numbers: a term's weight times its damped count, summed over the item's terms with repeats. Ties go
    to the smaller ``doc_id``, null last. Null and empty texts have no terms; they score for nothing and find
    nothing. Repeated documents are found each by itself; repeated items rank each by itself. Items are
    answered in blocks of about ``block_terms`` terms, one pass over the documents per block.
    """
    spark = docs.sparkSession
    lowered = F.translate(F.coalesce(F.col("text"), F.lit("")), ASCII_UPPER, ASCII_UPPER.lower())
    asked = items.select("item_id", "text").withColumn("words", F.regexp_extract_all(lowered, F.lit(TERM), 0))
    asked = asked.filter("size(words) > 0").groupBy("item_id", "words").agg(F.count("*").cast("int").alias("copies"))
    # equal items are one, so that blocks, dealt out by hash, hold about as many terms each
    asked = stage(asked.withColumn("key", F.xxhash64("item_id", "words")), "search-items")
    blocks = -(-(asked.agg(F.sum(F.size("words"))).first()[0] or 0) // block_terms)
    found = []
    for block in range(blocks):
        own = asked.filter(F.pmod("key", F.lit(blocks)) == block).collect()  # about block_terms words
        own.sort(key=lambda r: (r["item_id"] is not None, r["item_id"] or 0, r["words"]))
        plan = sharing([r["words"] for r in own])
        counts = stage(term_counts(docs, plan.terms), "search-counts")
        size = counts.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()
        if not size["total"]:
            continue
        held = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()
        weights = np.zeros(len(plan.terms), dtype=np.int64)  # a row per term of the block
        for r in held:
            weights[r["term"]] = math.floor(1000 * math.log((2 * size["docs"] + 2) / (2 * r["df"] + 1)))
        best = best_of_tasks(counts, plan, weights, size["docs"], size["total"], top)
        place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = best.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= top)
        names = spark.createDataFrame([(i, r["item_id"], r["copies"]) for i, r in enumerate(own)], "item int, item_id bigint, copies int")
        named = best.join(names, "item").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        found.append(named.select("item_id", "rank", "doc_id", "score"))
    if not found:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.unionByName, found)

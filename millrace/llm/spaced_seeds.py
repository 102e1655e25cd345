"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

A mask such as ``11101011`` covers eight consecutive words and looks at those under a 1. Passages
that differ in some words still agree on a mask laid between the differences, so hashes of masked
words find them by an equality join. The default masks together meet every window of 13 words with
two substitutions at any two places; ``test_spaced_seeds`` tries all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import let, stage, text_key, words_of

MASKS = ("11101011", "110100111")
WINDOW = 13
SUBSTITUTIONS = 2
# A seed table of at most so many rows of 28 bytes may be sent to every executor.
BROADCAST_SEEDS = 1_000_000


def word_hashes(text: Column) -> Column:
    """The words of a text, lower-cased and hashed to longs."""
    return F.transform(words_of(F.lower(text)), lambda w: F.xxhash64(w))


def _masked(words: Column, at: Column, no: int, mask: str) -> Column:
    chosen = [F.get(words, at + i) for i, c in enumerate(mask) if c == "1"]
    return F.xxhash64(F.lit(no), *chosen)


def seeds(words: Column, masks: list[str]) -> Column:
    """Hashes of all masks at all positions of an array of word hashes, those of one mask in a row.

    The first positions of mask ``m`` come first; a mask longer than the array gives nothing.
    """
    size = F.size(words)

    def of(no: int, mask: str) -> Column:
        last = size - len(mask)
        places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.struct(i.alias("p"), _masked(words, i, no, mask).alias("h")))

    return F.concat(*[of(no, mask) for no, mask in enumerate(masks)])


def runs(found: Column) -> Column:
    """Seeds ``(p, h)`` of one text as runs ``(h, p, count, step)``: places of one hash that follow each other at one distance.

    A text that repeats words holds a seed at very many places; the runs are few. Most texts hold every seed
    once, and each is a run by itself.
    """

    def single(x: Column) -> Column:
        return F.struct(x["h"].alias("h"), x["p"].alias("p"), F.lit(1).alias("count"), F.lit(0).alias("step"))

    def ordered(a: Column) -> Column:
        def gap(i: Column) -> Column:
            """The distance to the place before, null for a hash's first place."""
            return F.when((i > 0) & (F.get(a, i - 1)["h"] == F.get(a, i)["h"]), F.get(a, i)["p"] - F.get(a, i - 1)["p"])

        def first(i: Column) -> Column:
            return F.coalesce(gap(i) != gap(i - 1), F.lit(True))

        def run(firsts: Column) -> Column:
            def of(i: Column, k: Column) -> Column:
                count = F.coalesce(F.get(firsts, k + 1), F.size(a)) - i
                step = F.when(count > 1, gap(i + 1)).otherwise(0)
                return F.struct(F.get(a, i)["h"].alias("h"), F.get(a, i)["p"].alias("p"), count.alias("count"), step.alias("step"))

            return F.transform(firsts, of)

        return let(F.filter(F.sequence(F.lit(0), F.size(a) - 1), first), run)

    def of(all_: Column) -> Column:
        alike = F.size(F.array_distinct(F.transform(all_, lambda x: x["h"]))) == F.size(all_)
        by_hash = F.sort_array(F.transform(all_, lambda x: F.struct(x["h"].alias("h"), x["p"].alias("p"))))
        return F.when(alike, F.transform(all_, single)).otherwise(let(by_hash, ordered))

    return let(found, of)


def _shifts(doc: dict[str, Column], item: dict[str, Column]) -> Column:
    """By how much a run of a text and a run of an item can lie apart: the differences of their places."""
    lowest = doc["p"] - item["p"] - (item["count"] - 1) * item["step"]
    step = F.greatest(doc["step"], item["step"])
    regular = (doc["count"] == 1) | (item["count"] == 1) | (doc["step"] == item["step"])
    along = F.sequence(F.lit(0), doc["count"] + item["count"] - 2)
    pairs = F.transform(
        F.sequence(F.lit(0), item["count"] - 1),
        lambda k: F.transform(
            F.sequence(F.lit(0), doc["count"] - 1),
            lambda n: doc["p"] + n * doc["step"] - item["p"] - k * item["step"],
        ),
    )
    return F.when(regular, F.transform(along, lambda k: lowest + k * step)).otherwise(F.flatten(pairs))


def _different(shifts: Column, item: Column, doc: Column) -> Column:
    """One of all shifts that lay the item over equal words: those of a text that repeats itself are mostly alike."""

    def over(s: Column) -> Column:
        below = F.greatest(F.lit(0), F.least(F.size(item) + F.least(s, F.lit(0)), F.size(doc) - F.greatest(s, F.lit(0))))
        return F.struct(F.xxhash64(F.least(s, F.lit(0)), F.slice(doc, F.greatest(s, F.lit(0)) + 1, below)).alias("key"), s.alias("s"))

    def one(a: Column) -> Column:
        return F.filter(a, lambda x, i: F.coalesce(F.get(a, i - 1)["key"] != x["key"], F.lit(True)))

    return F.transform(let(F.sort_array(F.transform(shifts, over)), one), lambda x: x["s"])


def _best(item: Column, doc: Column, shift: Column, window: int) -> Column:
    """``(matched, hits)``: most equal words in any window of the item laid over the document at ``shift``, and equal words in all."""
    size = F.size(item)
    equal = F.transform(item, lambda w, i: F.coalesce((F.get(doc, F.when(i + shift >= 0, i + shift)) == w).cast("int"), F.lit(0)))

    def summed(e: Column) -> Column:
        width = F.least(size, F.lit(window))

        def step(a: Column, i: Column) -> Column:
            now = a["now"] + F.get(e, i) - F.coalesce(F.get(e, F.when(i >= width, i - width)), F.lit(0))
            return F.struct(now.alias("now"), F.greatest(a["matched"], now).alias("matched"), (a["hits"] + F.get(e, i)).alias("hits"))

        zero = F.struct(*[F.lit(0).alias(c) for c in ("now", "matched", "hits")])
        return F.aggregate(F.sequence(F.lit(0), size - 1), zero, step)

    return let(equal, summed)


def benchmark_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    masks: tuple[str, ...] = MASKS,
    window: int = WINDOW,
    substitutions: int = SUBSTITUTIONS,
) -> DataFrame:
    """``(text_key, item_id, matched, item_words, item_hits)`` for each text that holds a passage of a benchmark item.

    ``docs`` has ``text``; ``benchmark`` has ``item_id`` and ``text``; further columns are not read. A
    text holds a passage if, laid over the item without gaps, some ``window`` words agree but for at
    most ``substitutions``; of an item with fewer words, all must agree. Words are runs without ASCII
    white space, compared in lower case. ``matched`` is the best window's count of equal words,
    ``item_hits`` the most equal words over the whole item at one such place. Null, empty and
    wordless texts and items hold nothing. Repeated texts and repeated item rows give one row; rows
    of one ``item_id`` with different texts give the best of them, and a null ``item_id`` is an id.

    The seed join yields places only; every place is verified word by word on the whole texts.
    """
    items = stage(
        benchmark.select("item_id", word_hashes(F.col("text")).alias("item")).filter("size(item) > 0").distinct(), "seeds-items"
    )
    # items too short for a mask are looked up as a whole, by a mask of their own length
    longest = max(map(len, masks))
    short = [r[0] for r in items.filter(F.size("item") < longest).select(F.size("item")).distinct().orderBy(F.size("item")).collect()]
    all_masks = [*masks, *("1" * n for n in short)]
    planted = items.select(F.xxhash64("item_id", "item").alias("row"), F.explode(runs(seeds(F.col("item"), all_masks))).alias("i"))
    lookup = stage(planted.select("row", "i", F.col("i.h").alias("h")), "seeds-items")
    few = lookup.count() <= BROADCAST_SEEDS

    def sent(table: DataFrame) -> DataFrame:
        return F.broadcast(table) if few else table

    hashed = docs.select(text_key(F.col("text")).alias("text_key"), word_hashes(F.col("text")).alias("words"))
    placed = hashed.filter("size(words) > 0").select("text_key", F.explode(seeds(F.col("words"), all_masks)).alias("s"))
    # only seeds that some item has are put together to runs
    hit = placed.select("text_key", "s.p", "s.h").join(sent(lookup.select("h").distinct()), "h", "left_semi")
    hit = hit.groupBy("text_key").agg(F.collect_set(F.struct("p", "h")).alias("found"))  # of one text
    met = hit.select("text_key", F.explode(runs(F.col("found"))).alias("d"))
    met = met.select("text_key", "d", F.col("d.h").alias("h")).join(sent(lookup), "h")
    parts = ("p", "count", "step")
    apart = _shifts({c: F.col(f"d.{c}") for c in parts}, {c: F.col(f"i.{c}") for c in parts})
    # no more shifts than the text and the item have words
    by_text = met.groupBy("text_key", "row").agg(F.array_distinct(F.flatten(F.collect_set(apart))).alias("shifts"))
    by_text = stage(by_text, "seeds-places")

    rows = items.select("item_id", "item", F.xxhash64("item_id", "item").alias("row"))
    wanted = by_text.join(rows, "row")
    found = hashed.join(wanted, "text_key").select(
        "text_key",
        "item_id",
        F.size("item").alias("item_words"),
        F.explode(
            F.transform(_different(F.col("shifts"), F.col("item"), F.col("words")), lambda s: _best(F.col("item"), F.col("words"), s, window))
        ).alias("b"),
    )
    needed = F.when(F.col("item_words") >= window, F.lit(window - substitutions)).otherwise(F.col("item_words"))
    found = found.filter(F.col("b.matched") >= needed)
    return found.groupBy("text_key", "item_id").agg(
        F.max("b.matched").cast("long").alias("matched"),
        F.max("item_words").cast("long").alias("item_words"),
        F.max("b.hits").cast("long").alias("item_hits"),
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``(doc_id, item_id, matched, item_words, item_hits)``: a row per document and benchmark item it holds.

    Rows of one ``doc_id`` with different texts give the best of them; rows with a null ``doc_id`` count
    as one document.
    """
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("text_key")).distinct()
    found = keyed.join(benchmark_overlaps(docs, benchmark, **options), "text_key")
    return found.groupBy("doc_id", "item_id").agg(
        *[F.max(c).alias(c) for c in ("matched", "item_words", "item_hits")]
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs (text, …)`` whose text holds no passage of a benchmark item, with their columns as they are.

    Null and empty texts hold nothing and stay, as do all rows where there are no items; equal rows stay or go together, and
    no text is too long to be searched whole.
    """
    found = stage(benchmark_overlaps(docs, benchmark, **options).select("text_key").distinct(), "seeds-found")
    return docs.join(found, text_key(F.col("text")) == found["text_key"], "left_anti")

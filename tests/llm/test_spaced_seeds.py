from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from helpers import ODD, SMALL, odd, overlaps, table
from millrace.llm.common import let
from millrace.llm.queries import ORACLES, QUERIES
from millrace.llm.spaced_seeds import MASKS, SUBSTITUTIONS, WINDOW, contaminated, runs, seeds, without_contaminated, word_hashes


def test_query_equals_brute_force(spark):
    expected = overlaps([r[:2] for r in table("documents")], table("benchmark"))
    found = {(r[0], r[1]): tuple(r)[2:] for r in QUERIES["op9_benchmark_decontamination"](spark, SMALL).collect()}
    assert expected and found == expected
    assert "op9_benchmark_decontamination" in ORACLES


def test_masks_meet_every_window():
    for wrong in combinations(range(WINDOW), SUBSTITUTIONS):
        assert any(
            all(mask[i] == "0" or at + i not in wrong for i in range(len(mask)))
            for mask in MASKS
            for at in range(WINDOW - len(mask) + 1)
        )


ITEM = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen".split()


def changed(*places: int) -> str:
    return " ".join("wrong" if i in places else w for i, w in enumerate(ITEM))


def test_substitutions_short_items_and_odd_rows(spark):
    items = [(1, " ".join(ITEM)), (2, "only three words"), (3, ""), (4, None), (None, "five words of no id"), (1, " ".join(ITEM))]
    docs = [
        (1, "before " + changed(3, 9) + " after"),
        (2, changed(0, 1, 2)),
        (3, changed(5, 6, 7, 8)),
        (4, "ONLY three words"),
        (5, "only three word"),
        (6, "and five words of no id"),
        (None, changed()),
        (7, None),
        (7, ""),
        (8, changed() + " " + changed(4)),
        (8, changed() + " " + changed(4)),
    ]
    frame = spark.createDataFrame([(*d, 0) for d in docs], "doc_id bigint, text string, item int")
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id bigint, text string, words string")
    found = {(r[0], r[1]): tuple(r)[2:] for r in contaminated(frame, benchmark).collect()}
    assert found == overlaps(docs, items)
    assert (1, 1) in found and (3, 1) not in found and (5, 2) not in found and (None, 1) in found
    left = without_contaminated(frame, benchmark)
    assert left.columns == ["doc_id", "text", "item"]
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 5, 7, 7]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert without_contaminated(odd(spark), none).count() == len(ODD)
    some = spark.createDataFrame([(1, "a null id")], "item_id bigint, text string")
    assert contaminated(odd(spark, []), some).count() == 0


def test_texts_and_items_that_repeat_words(spark):
    items = [
        (1, " ".join(["w"] * 40)), (2, " ".join(["a", "b"] * 15)), (3, " ".join([*"abc"] * 9) + " end"), (4, " ".join(["x y z x y z q"] * 4)),
        (5, " ".join([*["w"] * 12, "v", *["w"] * 12])),
    ]
    docs = [
        (1, " ".join(["w"] * 700)), (2, " ".join([*["w"] * 100, "v", *["w"] * 100])), (3, " ".join(["b", "a"] * 200)),
        (4, "start " + " ".join([*"abc"] * 100) + " end"), (5, " ".join(["x y z x y z q"] * 30)), (6, " ".join(["w w w w w w u"] * 30)),
        (7, " ".join(["w"] * 11)), (8, " ".join([*"abcabd"] * 60)),
    ]
    found = contaminated(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    )
    assert {(r[0], r[1]): tuple(r)[2:] for r in found.collect()} == overlaps(docs, items)


def test_a_long_repeated_text_is_searched_by_runs(spark):
    docs = spark.createDataFrame([(1, "w " * 30_000), (2, "a b " * 15_000)], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "w " * 300), (2, "b a " * 150)], "item_id bigint, text string")
    found = {(r[0], r[1]): tuple(r)[2:] for r in contaminated(docs, items).collect()}
    assert found == {(1, 1): (13, 300, 300), (2, 2): (13, 300, 300)}
    counted = docs.select(let(word_hashes(F.col("text")), lambda w: F.size(runs(seeds(w, list(MASKS))))).alias("n")).collect()
    assert max(r["n"] for r in counted) <= 8

"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

The rules' cutoffs tighten together along a fixed ladder. Labelled good documents that pass the base
rules are the holdout: for every stratum and rung, the number of good documents the rung would
reject is tested against the allowed share with the exact binomial tail. A rung holds if the tail
is at most ``delta`` divided by the number of tests (Bonferroni over strata and rungs), so with
probability ``1 - delta`` *no* stratum uses a rung that rejects more than ``alpha`` of its good
documents. The ladder is fixed beforehand; labels serve for the tests alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import let, stage, words_of

ALPHA = 0.05
DELTA = 0.05
SYMBOLS = "#*$%&|<>"
# The ladder, loosest rung first: a document is rejected by a rung if it exceeds any of its cutoffs.
# symbols per 100 words, duplicate lines per 100 lines with a word, repeated words per 100 words,
# tenths of a character per word at most, and at least
LADDER = (
    (200, 90, 20, 200, 15),
    (150, 85, 19, 180, 17),
    (100, 80, 18, 160, 19),
    (75, 75, 17, 150, 20),
    (50, 70, 16, 140, 21),
    (35, 65, 15, 130, 22),
    (25, 60, 14, 120, 23),
    (15, 55, 13, 110, 24),
    (8, 50, 12, 105, 25),
    (4, 45, 11, 100, 26),
)


def _repeated(words: Column, width: int) -> Column:
    """Number of words that lie in a window of ``width`` words found at two or more places."""

    def of(hashed: Column) -> Column:
        last = F.size(hashed) - width
        places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return let(F.transform(places, lambda i: F.xxhash64(*[F.get(hashed, i + k) for k in range(width)])), covered)

    def covered(windows: Column) -> Column:
        # most texts repeat nothing: one hash set tells
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
            let(F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("p")))), places_of)
        )

    def places_of(ordered: Column) -> Column:
        def twice(x: Column, i: Column) -> Column:
            before = F.get(ordered, i - 1)["h"] == x["h"]
            after = F.get(ordered, i + 1)["h"] == x["h"]
            return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

        return let(F.sort_array(F.transform(F.filter(ordered, twice), lambda x: x["p"])), length)

    def length(places: Column) -> Column:
        gaps = F.transform(places, lambda p, i: F.least(F.lit(width), F.coalesce(F.get(places, i + 1) - p, F.lit(width))))
        return F.aggregate(gaps, F.lit(0), lambda a, g: a + g)

    return let(F.transform(words, lambda w: F.xxhash64(w)), of)


def with_measures(docs: DataFrame) -> DataFrame:
    """``docs`` with a struct column ``measures`` of counts over the whole text; a null or empty text counts nothing."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(F.translate(line, " \t\n\x0b\f\r", "")) > 0)

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            _repeated(words, 5).cast("long").alias("n_repeat_words"),
        )

    def of_lines(line: Column) -> Column:
        return F.struct(
            F.size(line).cast("long").alias("n_lines"),
            (F.size(line) - F.size(F.array_distinct(line))).cast("long").alias("n_dup_lines"),
        )

    symbols = F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long")
    return docs.withColumn("_w", let(words_of(text), of_words)).withColumn("_l", let(lines, of_lines)).withColumn(
        "measures", F.struct("_w.*", "_l.*", symbols.alias("n_symbols"))
    ).drop("_w", "_l")


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


def strictest_passed(m: Column) -> Column:
    """Number of the last rung, from the loosest, that does not reject the document: 0 if the first rejects it."""
    passes = [
        (100 * m["n_symbols"] <= symbols * m["n_words"])
        & (100 * m["n_dup_lines"] <= dup * m["n_lines"])
        & (100 * m["n_repeat_words"] <= repeat * m["n_words"])
        & (10 * m["word_chars"] <= longest * m["n_words"])
        & (10 * m["word_chars"] >= shortest * m["n_words"])
        for symbols, dup, repeat, longest, shortest in LADDER
    ]
    # rungs are nested: a document that one rung rejects is rejected by all stricter ones
    return sum((p.cast("int") for p in passes[1:]), passes[0].cast("int"))


def _log_factorial(x: Column) -> Column:
    """ln(x!) by Stirling's series at x + 17, brought back by the product in between; error below 1e-14."""
    z = x + F.lit(17.0)
    series = (z - 0.5) * F.log(z) - z + F.lit(0.9189385332046727) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    between = F.lit(0.0)
    for i in range(1, 17):
        between = between + F.log(x + F.lit(float(i)))
    return series - between


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), for k up to n * p; exact to double precision.

    The terms fall from k downwards at least as fast as a normal tail, so those further away than 40
    standard deviations, below 1e-300 of the largest, are left out.
    """
    n, k = n.cast("double"), k.cast("double")
    first = _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)
    first = first + k * math.log(p) + (n - k) * math.log(1 - p)
    steps = F.least(k, 40 * F.sqrt(n * p) + 100).cast("int")
    ratio = (1 - p) / p
    total = F.aggregate(
        F.sequence(F.lit(0), steps),
        F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum")),
        lambda a, i: F.struct(
            (a["term"] * (k - i) / (n - k + i + 1) * ratio).alias("term"), (a["sum"] + a["term"]).alias("sum")
        ),
    )
    return F.exp(first) * total["sum"]


def chosen_rungs(holdout: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """``(stratum, rung, n_good, n_rejected)``: the strictest rung that holds in each stratum.

    ``holdout`` has ``stratum`` and ``passed`` (see :func:`strictest_passed`) of labelled good documents.
    Strata without a rung that holds are left out; a null stratum is a stratum.
    """
    counts = holdout.groupBy("stratum").agg(
        F.count("*").alias("n_good"),
        *[F.count(F.when(F.col("passed") < rung, 1)).alias(f"r{rung}") for rung in range(1, len(LADDER) + 1)],
    )
    counts = stage(counts, "quality-counts")
    tested = counts.count() * len(LADDER)
    tests = counts.select(
        "stratum",
        "n_good",
        F.posexplode(F.array(*[F.col(f"r{rung}") for rung in range(1, len(LADDER) + 1)])).alias("at", "n_rejected"),
    )
    holds = F.when(
        F.col("n_rejected") <= alpha * F.col("n_good"),
        binomial_tail(F.col("n_rejected"), F.col("n_good"), alpha) <= delta / max(1, tested),
    ).otherwise(False)
    best = tests.filter(holds).groupBy("stratum").agg(F.max(F.struct("at", "n_good", "n_rejected")).alias("b"))
    return best.select(
        "stratum", (F.col("b.at") + 1).alias("rung"), F.col("b.n_good").alias("n_good"), F.col("b.n_rejected").alias("n_rejected")
    )


def measured(docs: DataFrame) -> DataFrame:
    """The narrow table the cutoffs are chosen from and applied to: ``(doc_id, stratum, measures, base_failed, passed)``."""
    m = F.col("measures")
    return with_measures(docs.select("doc_id", F.col("lang").alias("stratum"), "text")).select(
        "doc_id", "stratum", "measures", base_failed(m).alias("base_failed"), strictest_passed(m).alias("passed")
    )


def rungs_for(measures: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """:func:`chosen_rungs` for a table of :func:`measured`, from ``labels (doc_id, quality, …)``.

    A document is good if any of its labels says 1; null ids and null labels do not count.
    """
    good = labels.filter("quality = 1 and doc_id is not null").select("doc_id").distinct()
    holdout = measures.filter("not base_failed").join(good, "doc_id", "left_semi")
    return stage(chosen_rungs(holdout.select("stratum", "passed"), alpha, delta), "quality-rungs")


def verdicts(measures: DataFrame, rungs: DataFrame) -> DataFrame:
    """``measures`` with ``kept``: passes the base rules and the rung of its stratum. Strata without a rung reject nothing more."""
    wanted = rungs.select(F.col("stratum").alias("of"), "rung")
    joined = measures.join(wanted, F.col("stratum").eqNullSafe(F.col("of")), "left").drop("of")
    return joined.withColumn(
        "kept", ~F.col("base_failed") & (F.col("passed") >= F.coalesce("rung", F.lit(0)))
    )


def keep_good(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The rows of ``docs (doc_id, text, lang, …)`` that are kept, with their columns as they are.

    Null and empty texts have no words and fail the base rules. An empty table stays empty.
    """
    names = docs.columns
    m = F.col("measures")
    judged = with_measures(docs.select(F.struct(*names).alias("_row"), "doc_id", "text", F.col("lang").alias("stratum"))).select(
        "_row", "doc_id", "stratum", base_failed(m).alias("base_failed"), strictest_passed(m).alias("passed")
    )
    # every text is measured once: what passes the base rules is written with its rung and read twice, once narrow
    passed = stage(judged.filter("not base_failed"), "quality-passed")
    rungs = rungs_for(passed.select("doc_id", "stratum", "base_failed", "passed"), labels, alpha, delta)
    return verdicts(passed.select("_row", "stratum", "base_failed", "passed"), rungs).filter("kept").select("_row.*")

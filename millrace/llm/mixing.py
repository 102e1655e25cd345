"""Mixing sources to target weights by entropy balancing, in DataFrame functions only.

Every document gets a rate, the expected number of copies. Of all rates that give each source its
target of words, at most ``cap`` per document, entropy balancing takes those nearest to 1 in
relative entropy: ``min(cap, exp(dual * size / mean size))`` with one dual variable per source. The
dual problem is convex; Newton steps solve it, each one grouping over the table of distinct sizes.
Rates become whole copies by rounding their running sum, so the copies of a source never stray from
the running sum by more than one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import stage, text_key, words_of

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
BUCKETS = 1024
OFFSETS = 64
MAX_STEPS = 60


def with_size(docs: DataFrame) -> DataFrame:
    """``docs`` with ``size`` (words of the whole text), ``skey`` (never null, one per source) and ``order`` (a hash of the row's id and text)."""
    key = text_key(F.col("text"))
    return (
        docs.withColumn("size", F.size(words_of(F.col("text"))).cast("long"))
        .withColumn("skey", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
        .withColumn("order", F.xxhash64("doc_id", key["a"], key["b"]))
    )


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``(skey, source_size, target)`` from ``(skey, size, n)``.

    Sources in code point order, the null source last, take the weights in turn and share ``share``
    times all words. A target stops at ``cap`` times its source's words and the excess goes to the
    others by weight until none is above: every target is the smaller of that bound and a common
    level times its weight. The level follows from the sources in the order in which they fill up.
    """
    by_source = sizes.groupBy("skey").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    everything = Window.partitionBy()
    place = Window.orderBy(F.col("skey") == "", "skey")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    by_source = by_source.select(
        "skey",
        "source_size",
        F.get(turn, (F.row_number().over(place) - 1) % len(weights)).alias("weight"),
        (share * F.sum("source_size").over(everything)).alias("whole"),
    )
    by_source = by_source.withColumn("bound", cap * F.col("source_size").cast("double"))
    filling = Window.orderBy(F.col("bound") / F.col("weight"), "skey")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    after = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("whole") - F.coalesce(F.sum("bound").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    levelled = by_source.withColumn("level", level)
    # the first source, in filling order, that does not fill up sets the level; if all do, there is none
    stays = F.col("level") <= F.col("bound") / F.col("weight")
    common = F.min(F.when(stays, F.struct(F.col("bound") / F.col("weight"), "skey", "level"))).over(everything)["level"]
    return levelled.select(
        "skey",
        "source_size",
        F.least(F.col("bound"), F.coalesce(common * F.col("weight"), F.col("bound"))).alias("target"),
    )


def _exact_sum(x: Column) -> Column:
    """A sum that does not depend on the order of its terms."""
    return F.sum(x.cast("decimal(38,9)")).cast("double")


def _rate(dual: Column, size: Column, mean: Column, cap: float) -> Column:
    return F.least(F.lit(float(cap)), F.exp(F.least(dual * size / mean, F.lit(100.0))))


def solved_duals(sizes: DataFrame, wanted: DataFrame, cap: float = CAP, tolerance: float = 1e-9) -> DataFrame:
    """``(skey, source_size, target, mean, dual)``: Newton's method for all sources at once.

    ``sizes`` is ``(skey, size, n)``. Each step sums expected words and their derivative over the sizes
    of every source and moves its dual; a step that leaves the bracket is replaced by halving it.
    A source that must fill up completely, or have nothing, needs no iteration.
    """
    mean = sizes.filter("size > 0").groupBy("skey").agg(
        (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"), F.min("size").alias("least")
    )
    full = F.col("target") >= cap * F.col("source_size") * (1 - 1e-12)
    # at these duals even the shortest document is at the cap, or has a rate of nothing
    high = math.log(cap) * F.col("mean") / F.col("least") + 1
    low = -45 * F.col("mean") / F.col("least")
    state = wanted.join(mean, "skey", "left").select(
        "skey",
        "source_size",
        "target",
        F.coalesce("mean", F.lit(1.0)).alias("mean"),
        F.coalesce(low, F.lit(0.0)).alias("low"),
        F.coalesce(high, F.lit(0.0)).alias("high"),
        F.coalesce(F.when(full, high).when(F.col("target") <= 0, low), F.lit(0.0)).alias("dual"),
        (F.col("mean").isNull() | full | (F.col("target") <= 0)).alias("done"),
    )
    state = stage(state, "mix-duals")
    for _ in range(MAX_STEPS):
        if not state.filter("not done").limit(1).count():
            break
        open_ = state.filter("not done")
        rate = _rate(F.col("dual"), F.col("size"), F.col("mean"), cap)
        words = F.col("n") * F.col("size") * rate
        slope = F.when(rate < cap, words * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = sizes.join(open_, "skey").groupBy("skey").agg(
            _exact_sum(words).alias("words"), _exact_sum(slope).alias("slope")
        )
        moved = open_.join(sums, "skey")
        gap = F.col("target") - F.col("words")
        moved = moved.withColumn("low", F.when(gap > 0, F.col("dual")).otherwise(F.col("low"))).withColumn(
            "high", F.when(gap > 0, F.col("high")).otherwise(F.col("dual"))
        )
        newton = F.col("dual") + gap / F.when(F.col("slope") > 0, F.col("slope"))
        inside = (newton > F.col("low")) & (newton < F.col("high"))
        reached = (F.abs(gap) <= tolerance * F.col("target")) | (F.col("high") - F.col("low") <= 1e-13)
        moved = moved.select(
            "skey", "source_size", "target", "mean", "low", "high",
            F.when(reached, F.col("dual")).when(inside, newton).otherwise((F.col("low") + F.col("high")) / 2).alias("dual"),
            reached.alias("done"),
        )
        state = stage(state.filter("done").unionByName(moved), "mix-duals")
    return state.select("skey", "source_size", "target", "mean", "dual")


def _plan(sizes: DataFrame, duals: DataFrame, cap: float) -> DataFrame:
    """``(skey, size, source_size, target, rate, start, offset)``: where each size's documents lie on the running sum of rates.

    Sizes come in descending order. The offset of the rounding is the one of a fixed set that brings
    the source nearest to its target; the first of equals.
    """
    rate = F.round(_rate(F.col("dual"), F.col("size"), F.col("mean"), cap), 12)
    rated = sizes.join(duals, "skey").select("skey", "size", "n", "source_size", "target", rate.alias("rate"))
    mass = F.col("n") * F.col("rate")
    running = Window.partitionBy("skey").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    # a decimal running sum does not depend on how the window adds
    rated = rated.withColumn("start", F.coalesce(F.sum(mass.cast("decimal(38,12)")).over(running), F.lit(0)).cast("double"))
    rated = stage(rated, "mix-plan")
    tried = rated.select(
        "skey", "size", "target", "start", "n", "rate", F.explode(F.sequence(F.lit(0), F.lit(OFFSETS - 1))).alias("k")
    )
    offset = (F.col("k") + 0.5) / OFFSETS
    whole = F.floor(F.col("start") + F.col("n") * F.col("rate") + offset) - F.floor(F.col("start") + offset)
    sums = tried.groupBy("skey", "k").agg(F.sum(whole * F.col("size")).alias("words"), F.max("target").alias("target"))
    best = sums.groupBy("skey").agg(F.min(F.struct(F.abs(F.col("words") - F.col("target")), "k")).alias("b"))
    best = best.select("skey", ((F.col("b.k") + 0.5) / OFFSETS).alias("offset"))
    return rated.join(best, "skey").drop("n")


def with_copies(sized: DataFrame, stored: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``sized`` (see :func:`with_size`) with ``source_size``, ``target`` and ``copies``; ``stored`` are the same rows' key columns, written.

    Documents of one source and size have one rate. They are numbered by hash bucket and, inside a
    bucket, by hash, so that no source, size or group of copies is numbered in one task. Rows that are
    equal in id and text are interchangeable: their counts are fixed, not which of them has which.
    """
    by_bucket = stage(
        stored.groupBy("skey", "size", F.pmod("order", F.lit(BUCKETS)).alias("bucket")).agg(F.count("*").alias("n")), "mix-sizes"
    )
    sizes = stage(by_bucket.groupBy("skey", "size").agg(F.sum("n").alias("n")), "mix-sizes")
    duals = solved_duals(sizes, stage(targets(sizes, weights, share, cap), "mix-targets"), cap)
    plan = _plan(sizes, duals, cap)
    inner = Window.partitionBy("skey", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = by_bucket.select("skey", "size", "bucket", F.coalesce(F.sum("n").over(inner), F.lit(0)).alias("before"))
    placed = placed.join(plan, ["skey", "size"])
    rank = F.row_number().over(Window.partitionBy("skey", "size", "bucket").orderBy("order"))
    numbered = sized.withColumn("bucket", F.pmod("order", F.lit(BUCKETS))).withColumn("rank", rank)
    joined = numbered.join(placed, ["skey", "size", "bucket"])
    at = F.col("before") + F.col("rank")
    up_to = F.floor(F.col("start") + at * F.col("rate") + F.col("offset"))
    before = F.floor(F.col("start") + (at - 1) * F.col("rate") + F.col("offset"))
    copies = F.least(F.lit(int(cap)), up_to - before).cast("long")
    return joined.withColumn("copies", copies).drop("bucket", "rank", "before", "start", "rate", "offset")


def mixture(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, size, source_size, target, copies, taken)`` per row of ``docs (doc_id, text, source, …)``.

    Null and empty texts have size 0; copies of them count no words. Sources without words have
    target 0. An empty table gives an empty result.
    """
    stored = stage(with_size(docs.select("doc_id", "text", "source")).drop("text", "source"), "mix-documents")
    return with_copies(stored, stored, **options).select(
        "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mixture takes it, with their columns as they are."""
    names = docs.columns
    keys = stage(with_size(docs.select("doc_id", "text", "source")).select("skey", "size", "order"), "mix-documents")
    own = with_size(docs.select(F.struct(*names).alias("_row"), "doc_id", "text", "source"))
    counted = with_copies(own.select("_row", "skey", "size", "order"), keys, **options)
    copied = counted.filter("copies > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return copied.select("_row.*")

"""A Merkle manifest of a table: a hash tree per group of rows, a tree over the groups' roots, and proofs.

A node of a tree is known by the interval ``[lo, hi]`` of leaf ranks that it covers. Trees are built and
descended in bands of :data:`LEVELS` levels. A row of a band, a *chunk*, holds one node of the band's upper end with all
nodes below it, at most ``3 ** LEVELS`` of them on the lowest level, so every grouping and every join has
keys with that many rows at most, however large a tree is. Texts are read once; all else moves hashes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import stage

FANOUT = 3
LEVELS = 4
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_NODE = "struct<lo:bigint,hi:bigint,hash:string>"


def hash_of(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf_hash(values: Sequence[Column]) -> Column:
    """Hash of one row: every value with its length in bytes before it, a null as a single sign."""
    texts = [v.cast("string") for v in values]
    framed = [F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return hash_of(F.concat(*framed))


def ranked(leaves: DataFrame, *order: str) -> DataFrame:
    """``leaves (tree, hash, …)`` with ``rank`` from 0 and ``n``, the number of leaves, per tree; written and read back.

    Rows are dealt out by ranges of ``(tree, *order, hash)``, so a tree of any size spreads over tasks. A
    rank is the row's place in its part plus what earlier parts hold of the tree. Nulls come first.
    """
    by = ["tree", *order, "hash"]
    at = leaves.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    at = stage(at.withColumn("_part", F.shiftright("_at", 33)), "merkle-ordered")
    held = at.groupBy("_part", "tree").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))  # a row per part, or per tree
    before = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select(
        "_part", "tree", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy("tree")).alias("n"),
    )
    placed = at.join(held, ["_part", "tree"]).withColumn("rank", F.col("_at") - F.col("_first") + F.col("_before"))
    return stage(placed.drop("_at", "_part", "_first", "_before"), "merkle-ranked")


def _parents(children: Column, go_on: Column) -> Column:
    """The nodes one level up: every run of three children; none where ``go_on`` is false."""

    def parent(i: Column) -> Column:
        run = F.slice(children, FANOUT * i + 1, FANOUT)
        return F.struct(
            run[0]["lo"].alias("lo"),
            F.array_max(F.transform(run, lambda c: c["hi"])).alias("hi"),
            hash_of(F.array_join(F.transform(run, lambda c: c["hash"]), "")).alias("hash"),
        )

    runs = F.sequence(F.lit(0), F.floor((F.size(children) - 1) / FANOUT).cast("int"))
    return F.when(go_on, F.transform(runs, parent)).otherwise(F.array().cast(f"array<{_NODE}>"))


def bands(leaves: DataFrame) -> list[DataFrame]:
    """All nodes of the trees over ``leaves (tree, rank, n, hash)``, band by band from below.

    Chunks are ``(tree, bucket, lo, hi, n, l0 … l4, top, whole)``: nodes level by level as ``(lo, hi, hash)``,
    the uppermost node's hash, and whether the chunk is all that is left of its tree.
    """
    largest = leaves.agg(F.max("n")).first()[0] or 0
    nodes = leaves.select("tree", F.col("rank").alias("lo"), F.col("rank").alias("hi"), "hash", "n")
    unit, found = FANOUT**LEVELS, []
    while True:
        chunks = nodes.groupBy("tree", F.floor(F.col("lo") / unit).alias("bucket")).agg(
            F.sort_array(F.collect_list(F.struct("lo", "hi", "hash"))).alias("l0"), F.max("n").alias("n")
        )
        chunks = chunks.withColumn("whole", F.col("n") <= unit)
        for level in range(LEVELS):
            below = F.col(f"l{level}")
            chunks = chunks.withColumn(
                f"l{level + 1}", _parents(below, (F.size(below) > 1) | (~F.col("whole") & (F.size(below) > 0)))
            )
        tops = [F.when(F.size(f"l{level}") > 0, F.col(f"l{level}")[0]["hash"]) for level in range(LEVELS, -1, -1)]
        chunks = chunks.select(
            "*", F.coalesce(*tops).alias("top"), F.col("l0")[0]["lo"].alias("lo"), F.element_at("l0", -1)["hi"].alias("hi")
        )
        found.append(stage(chunks, "merkle-band"))
        if largest <= unit:
            return found
        nodes = found[-1].filter("not whole").select("tree", "lo", "hi", F.col("top").alias("hash"), "n")
        unit *= FANOUT**LEVELS


def _siblings(chunk: str, lo: Column, hi: Column, unit: int) -> Column:
    """Siblings of the lowest node ``[lo, hi]`` of a chunk and of its ancestors in it: ``(left, right)`` hashes per level.

    The parent's interval less the node's own leaves the siblings' intervals, before it and after it.
    """
    steps = []
    for level in range(LEVELS):
        place = F.floor((lo - F.col(f"{chunk}.lo")) / (unit * FANOUT ** (level + 1)))
        run = F.slice(F.col(f"{chunk}.l{level}"), (FANOUT * place + 1).cast("int"), F.lit(FANOUT))

        def joined(nodes: Column) -> Column:
            return F.array_join(F.transform(nodes, lambda x: x["hash"]), "")

        step = F.struct(
            joined(F.filter(run, lambda x: x["hi"] < lo)).alias("left"),
            joined(F.filter(run, lambda x: x["lo"] > hi)).alias("right"),
        )
        steps.append(F.when(F.size(F.col(f"{chunk}.l{level + 1}")) > 0, step))
    return F.array_compact(F.array(*steps))


def _within(rows: DataFrame, chunks: DataFrame, unit: int, lo: str, hi: str, *more: Column) -> DataFrame:
    """``rows`` joined with the chunk whose interval contains theirs, bucket by bucket, and ``path``: siblings from the row's node upwards."""
    r, c = rows.alias("r"), chunks.alias("c")
    found = r.join(
        c,
        (F.col("r.tree") == F.col("c.tree"))
        & (F.floor(F.col(f"r.{lo}") / (unit * FANOUT**LEVELS)) == F.col("c.bucket"))
        & (F.col("c.lo") <= F.col(f"r.{lo}"))
        & (F.col(f"r.{hi}") <= F.col("c.hi")),
    )
    inside = _siblings("c", F.col(f"r.{lo}"), F.col(f"r.{hi}"), unit)
    return found.select("r.*", F.concat(inside, F.col("c.path")).alias("path"), *more)


def descended(leaves: DataFrame, found: list[DataFrame], crowns: DataFrame) -> DataFrame:
    """``leaves`` with ``path`` and the columns of ``crowns (tree, path, …)``, which say how every tree's root goes on.

    From the uppermost band down, each chunk takes its path from the chunk that contains it.
    """
    carried = [c for c in crowns.columns if c not in ("tree", "path")]
    above: DataFrame | None = None
    for depth in range(len(found) - 1, -1, -1):
        chunks = found[depth]
        own = chunks.filter("whole").join(crowns, "tree")
        if above is not None:
            unit = FANOUT ** (LEVELS * (depth + 1))
            inner = _within(chunks.filter("not whole"), above, unit, "lo", "hi", *[F.col(f"c.{c}") for c in carried])
            own = own.unionByName(inner)
        above = stage(own, "merkle-paths")
    return _within(leaves, above, 1, "rank", "rank", *[F.col(f"c.{c}") for c in carried])


def tops(found: list[DataFrame]) -> DataFrame:
    """``(tree, hash)``: the root of every tree."""
    parts = [chunks.filter("whole").select("tree", F.col("top").alias("hash")) for chunks in found]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def folded(hash: Column, path: Column) -> Column:
    """The root that follows from a leaf's hash and its path."""
    return F.aggregate(path, hash, lambda h, s: hash_of(F.concat(s["left"], h, s["right"])))


def manifest(rows: DataFrame, *order: str) -> DataFrame:
    """``rows (group, hash, …)`` with ``rank``, ``n``, ``path``, ``subroot`` and ``root``.

    Every group's rows, ordered by ``order`` and then by hash, are the leaves of a tree; the trees' roots, ordered by group
    with null first and else by bytes, are the leaves of the upper tree. Every three consecutive nodes, the last
    run fewer, have the hash of their hashes as parent, until one is left. ``path`` leads from the leaf to
    ``root``: the hashes of the siblings before and after, level by level.
    """
    spark = rows.sparkSession
    tree = F.when(F.col("group").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col("group")))
    leaves = ranked(rows.withColumn("tree", tree), *order)
    lower = bands(leaves)
    groups = ranked(tops(lower).select(F.lit("").alias("tree"), F.col("tree").alias("of"), "hash"), "of")
    upper = bands(groups)
    crown = tops(upper).select(
        "tree", F.array().cast("array<struct<left:string,right:string>>").alias("path"), F.col("hash").alias("root")
    )
    placed = descended(groups, upper, crown).select(F.col("of").alias("tree"), "path", F.col("hash").alias("subroot"), "root")
    return descended(leaves, lower, stage(placed, "merkle-groups")).drop("tree")


def proved(docs: DataFrame, tampered: Column, columns: Sequence[str] = COLUMNS) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` per row of ``docs (doc_id, source, text, …)``.

    Leaves hash ``columns``; groups are sources. ``tampered`` is the text as it is found later, null for a text that
    is null or was not touched: ``folded_root`` follows from it and the original siblings, and the row is verified if
    that is the root. Null ids come first in their source; rows of one id go by their hash; equal rows
    are leaves of their own. Null sources form a group; an empty table has no rows.
    """
    values = [F.col(c) for c in columns]
    later = [F.coalesce(tampered, F.col("text")) if c == "text" else F.col(c) for c in columns]
    changed = F.coalesce(tampered != F.col("text"), F.lit(False))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("group"),
        leaf_hash(values).alias("hash"),
        F.when(changed, leaf_hash(later)).alias("found"),
    )
    found = manifest(rows, "doc_id")
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    result = found.select(
        "doc_id",
        F.col("hash").alias("leaf"),
        "subroot",
        "root",
        hash_of(siblings).alias("proof_sha256"),
        folded(F.coalesce("found", "hash"), F.col("path")).alias("folded_root"),
    )
    return result.withColumn("verified", F.col("folded_root") == F.col("root"))

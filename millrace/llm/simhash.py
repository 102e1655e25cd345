"""Near-duplicate documents by SimHash fingerprints and pigeonhole blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stage, text_key
from millrace.llm.components import components

BITS = 64
SEED = 42


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """The SimHash of one text as an unsigned integer: bit i is 1 if it is set in over half the shingle hashes.

    Words are runs without ASCII white space, A-Z lower-cased; a text with fewer words than a shingle
    is one shingle, a text without words has fingerprint 0. Repeated shingles count each time.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    total = max(1, len(words) - shingle + 1)
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, total, 4096):  # a long text is hashed piece by piece
        stop = min(total, start + 4096)
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(b" ".join(words[i : i + shingle]), SEED) for i in range(start, stop)),
            dtype="<u8",
            count=stop - start,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """``(doc_id, text_key, fp)`` per row of ``docs``; ``fp`` holds the 64 bits as a signed long."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(text.as_py(), shingle) for text in batch["text"]], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text_key"], pa.array(prints.view(np.int64))],
                ["doc_id", "text_key", "fp"],
            )

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"), "text"
    )
    return source.mapInArrow(hashed, "doc_id long, text_key struct<a:long,b:long>, fp long")


def block_masks(pieces: int, distance: int) -> list[int]:
    """Bit masks such that two fingerprints within ``distance`` bits agree on at least one of them.

    The bits are cut into ``pieces``; the differing bits touch at most ``distance`` of them, so some
    choice of ``pieces - distance`` pieces is untouched.
    """
    if pieces <= distance:
        raise ValueError("more pieces than differing bits are needed")
    ends = [BITS * i // pieces for i in range(pieces + 1)]
    whole = [((1 << ends[i + 1]) - 1) ^ ((1 << ends[i]) - 1) for i in range(pieces)]
    masks = [sum(chosen) for chosen in combinations(whole, pieces - distance)]
    return [mask - (1 << BITS) if mask >> (BITS - 1) else mask for mask in masks]


def pieces_for(count: int, distance: int) -> int:
    """Pieces so that a block has few members by chance: block keys get at least as many bits as ``count`` has.

    Every choice finds the same links; this only trades rows in the block table for chance meetings.
    """
    pieces = distance + 2
    while pieces < distance + 6 and BITS * (pieces - distance) // pieces < count.bit_length() + 6:
        pieces += 1
    return pieces


def _near(a: Column, b: Column, distance: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= distance


def linked_fingerprints(prints: DataFrame, distance: int = 4) -> DataFrame:
    """``(fp, root)``: connected components of the distinct fingerprints ``(fp, n)`` that differ in ``distance`` bits at most."""
    count = prints.count()
    masks = block_masks(pieces_for(count, distance), distance)
    blocks = F.array(
        *[F.struct(F.lit(i).alias("no"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)]
    )
    # few bytes, but many blocks for each: spread before the explode, whatever files the table came in
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = prints.repartition(tasks, "fp").select("fp", "n", F.explode(blocks).alias("block")).select("fp", "n", "block.no", "block.key")
    return linked(prints, keyed, lambda pairs: pairs.filter(_near(F.col("a"), F.col("b"), distance)), count)


def linked(prints: DataFrame, keyed: DataFrame, near: Callable[[DataFrame], DataFrame], count: int) -> DataFrame:
    """``(fp, root)``: connected components of the nodes ``prints (fp, n)``, ``count`` of them.

    ``keyed (fp, n, no, key)`` puts nodes into blocks; nodes of one block are linked where ``near``, which takes
    and gives pairs ``(a, b)``, keeps their pair.

    No group of a block is paired with itself. First every member of a block is compared with the
    block's leader, its most frequent fingerprint, which ties dense groups together. Then, per block,
    only members not tied to the leader are compared with all members: a dense group of any size is
    tied by then and costs nothing. Where that would still be much work, a new leader is taken from
    the members left over, as often as it helps. The last comparison is complete, so no link between
    members not tied already is missed, whatever the rounds before found.

    The joins on blocks are sort-merge joins: Spark sizes a table after an explode by the rows before it, and a table of
    repeated keys by its packed file, so it would send the driver many times what it takes for small.
    """
    shared = keyed.groupBy("no", "key").agg(F.count("*").alias("size"), F.max(F.struct("n", "fp")).alias("leader"))
    shared = shared.filter("size > 1").select("no", "key", "size", F.col("leader.fp").alias("leader"))
    members = stage(keyed.join(shared.hint("merge"), ["no", "key"]), "simhash-blocks")

    with_leader = [F.col("fp").alias("a"), F.col("leader").alias("b")]
    edges = near(members.filter("fp != leader").select(*with_leader))
    done = None
    while True:
        # tied: members whose best leader is the same one
        weights = prints.select(F.col("fp").alias("b"), F.col("n").alias("weight"))
        tied = edges.distinct().join(weights, "b").groupBy("a").agg(F.max(F.struct("weight", "b")).alias("best"))
        tied = stage(tied.select("a", F.col("best.b").alias("tie")), "simhash-ties")
        left = members.join(tied, members["fp"] == tied["a"], "left").select(
            "no", "key", "fp", "n", "size", "leader", F.coalesce("tie", "fp").alias("tie")
        )
        of_leader = tied.select(F.col("a").alias("leader"), F.col("tie").alias("other"))
        left = left.join(of_leader, "leader", "left").filter(
            (F.col("tie") != F.col("leader")) & (F.col("tie") != F.coalesce("other", "leader"))
        )
        left = stage(left.select("no", "key", "fp", "n", "size", "tie"), "simhash-left")
        work = left.agg(F.sum("size")).first()[0] or 0
        if work <= 4 * count + 100_000 or (done is not None and 2 * work > done):
            pairs = left.select("no", "key", F.col("fp").alias("a")).join(
                members.select("no", "key", F.col("fp").alias("b")).hint("merge"), ["no", "key"]
            )
            edges = edges.unionByName(near(pairs.filter("a != b").select("a", "b")))
            break
        done = work
        leaders = left.groupBy("no", "key").agg(F.max(F.struct("n", "fp")).alias("leader"))
        leaders = leaders.select("no", "key", F.col("leader.fp").alias("leader")).hint("merge")
        found = members.drop("leader").join(leaders, ["no", "key"])
        found = near(found.filter("fp != leader").select(*with_leader))
        edges = stage(edges.unionByName(found), "simhash-links")
    joined = prints.join(components(edges), prints["fp"] == F.col("node"), "left")
    return joined.select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicate_groups(docs: DataFrame, distance: int = 4, shingle: int = 4) -> DataFrame:
    """``(doc_id, text_key, fingerprint, component_id, root)`` for every row of ``docs (doc_id, text, …)``.

    ``component_id`` is the smallest ``doc_id`` among the documents reachable over links between
    fingerprints that differ in at most ``distance`` bits. Texts that are null, empty or without a word
    have fingerprint 0 and link like any other. Rows with a null ``doc_id`` take part; a component of
    such rows alone has a null id. ``root`` names the component even then. Repeated rows stay.
    """
    printed = stage(with_fingerprint(docs, shingle), "simhash-prints")
    prints = stage(
        printed.groupBy("fp").agg(F.count("*").alias("n"), F.min("doc_id").alias("least")), "simhash-distinct"
    )
    roots = linked_fingerprints(prints.select("fp", "n"), distance)
    named = prints.join(roots, "fp")
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = named.select("fp", "root").join(smallest, "root")
    return printed.join(by_print, "fp").select(
        "doc_id",
        "text_key",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "root",
    )


def one_per_group(docs: DataFrame, distance: int = 4, shingle: int = 4) -> DataFrame:
    """The rows of ``docs`` that stay when each near-duplicate group keeps its document with the smallest ``doc_id``.

    Where several rows have that ``doc_id`` (or a group has null ids only) the smallest text key
    decides, and of equal rows one stays.
    """
    return least_of_groups(docs, near_duplicate_groups(docs, distance, shingle))


def least_of_groups(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay by ``groups (doc_id, text_key, component_id, root)``, as in :func:`one_per_group`."""
    groups = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = groups.groupBy("root").agg(F.min(F.struct("doc_id", "text_key")).alias("k"), F.count("*").alias("rows"))
    kept = kept.select(F.col("k.doc_id").alias("kept_id"), F.col("k.text_key").alias("kept_key"), "rows")
    # the rows travel as one struct, so their columns may have any names
    own = docs.select(
        F.struct(*docs.columns).alias("_row"), F.col("doc_id").cast("long").alias("_id"), text_key(F.col("text")).alias("_key")
    )
    found = own.join(kept, F.col("_id").eqNullSafe(F.col("kept_id")) & (F.col("_key") == F.col("kept_key")))
    repeated = found.filter("rows > 1").groupBy("kept_id", "kept_key").agg(F.min("_row").alias("_row"))
    return found.filter("rows = 1").select("_row.*").unionByName(repeated.select("_row.*"))

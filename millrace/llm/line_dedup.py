"""Lines that many documents share, dropped by probing sharded minimal perfect hashes.

Lines are known by 128-bit hashes of their keys. The hashes that occur in enough documents are cut
into shards; each shard is a minimal perfect hash, a few bits per line, over compact arrays of
fingerprints, document counts and owners. The documents' hashes are dealt out by shard and stream
past its arrays; lines are never joined with lines.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import pieces_of, stage

MIN_CHARS = 40
MIN_DOCS = 5
SHARD_KEYS = 1 << 16
# Hashes that stream past one copy of a shard; busier shards are dealt out to several tasks.
SHARD_PROBES = 1 << 20
_SPACE = b" \t\n\x0b\x0c\r"
_NULL_ID = -(2**63)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def line_key(line: bytes) -> bytes:
    return line.strip(_SPACE).lower()


def _long_enough(key: bytes, min_chars: int) -> bool:
    # every code point has exactly one byte that does not continue another
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars)


def _mixed(high: np.ndarray, low: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit hash of 128-bit keys, another one for every level."""
    with np.errstate(over="ignore"):
        x = high ^ (low * _GOLDEN + np.uint64(level + 1) * np.uint64(0xD1B54A32D192ED03))
        for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
            x = (x ^ (x >> np.uint64(31))) * np.uint64(factor)
        return x ^ (x >> np.uint64(30))


class PerfectHash:
    """A minimal perfect hash over distinct 128-bit keys: key -> 0 … n-1, in a few bits per key.

    Level by level, keys that have a slot of the level to themselves stay there; the others go on to
    the next level. A key's number is the rank of its slot among the taken ones. Keys that were not in
    the set may get any number or -1.
    """

    def __init__(self, high: np.ndarray, low: np.ndarray):
        self.levels: list[np.ndarray] = []
        self.ranks: list[np.ndarray] = []
        taken = 0
        left = np.arange(len(high))
        while len(left):
            size = -(-max(64, 2 * len(left)) // 64) * 64
            slot = _mixed(high[left], low[left], len(self.levels)) % np.uint64(size)
            alone = np.bincount(slot.astype(np.int64), minlength=size) == 1
            bits = np.packbits(alone, bitorder="little").view("<u8")
            ones = np.bitwise_count(bits).astype(np.int64)
            self.levels.append(bits)
            self.ranks.append((taken + np.cumsum(ones) - ones).astype(np.int64))
            taken += int(ones.sum())
            left = left[~alone[slot.astype(np.int64)]]
        self.size = taken

    def number(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        found = np.full(len(high), -1, dtype=np.int64)
        left = np.arange(len(high))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks)):
            if not len(left):
                break
            slot = _mixed(high[left], low[left], level) % np.uint64(64 * len(bits))
            word, bit = (slot >> np.uint64(6)).astype(np.int64), slot & np.uint64(63)
            here = (bits[word] >> bit) & np.uint64(1) == 1
            below = bits[word] & ((np.uint64(1) << bit) - np.uint64(1))
            found[left[here]] = (ranks[word] + np.bitwise_count(below))[here]
            left = left[~here]
        return found


class LineIndex:
    """One shard: a perfect hash over the arrays ``fingerprint``, ``count`` and ``owner``."""

    def __init__(self, hash: PerfectHash, fingerprint: np.ndarray, count: np.ndarray, owner: np.ndarray):
        self.hash, self.fingerprint, self.count, self.owner = hash, fingerprint, count, owner

    @classmethod
    def over(cls, high: np.ndarray, low: np.ndarray, count: np.ndarray, owner: np.ndarray) -> LineIndex:
        made = PerfectHash(high, low)
        order = np.argsort(made.number(high, low))
        return cls(made, low[order], count[order], owner[order])

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        levels = {f"bits{i}": bits for i, bits in enumerate(self.hash.levels)}
        ranks = {f"ranks{i}": r for i, r in enumerate(self.hash.ranks)}
        np.savez(out, fingerprint=self.fingerprint, count=self.count, owner=self.owner, **levels, **ranks)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> LineIndex:
        with np.load(io.BytesIO(data)) as held:
            made = PerfectHash(np.empty(0, np.uint64), np.empty(0, np.uint64))
            depth = sum(name.startswith("bits") for name in held.files)
            made.levels = [held[f"bits{i}"] for i in range(depth)]
            made.ranks = [held[f"ranks{i}"] for i in range(depth)]
            made.size = len(held["owner"])
            return cls(made, held["fingerprint"], held["count"], held["owner"])

    def probe(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts and owners of keys; count 0 for keys that are not in the shard."""
        at = self.hash.number(high, low)
        if not len(self.count):
            return np.zeros(len(at), dtype=np.int64), np.full(len(at), _NULL_ID)
        known = at >= 0
        known[known] = self.fingerprint[at[known]] == low[known]
        return np.where(known, self.count[at], 0), np.where(known, self.owner[at], _NULL_ID)


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(id, high, low)``: the distinct hashes of a document's keys of at least ``min_chars`` code points; a null id is the smallest."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text"):
            ids: list[int] = []
            digests: list[bytes] = []
            for doc_id, text in zip(batch["id"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist()):
                keys = {line_key(line) for line in (text or b"").split(b"\n") if len(line) >= min_chars}
                own = [xxhash.xxh3_128_digest(k) for k in keys if _long_enough(k, min_chars)]
                ids += [doc_id] * len(own)
                digests += own
            pair = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(pair[:, 0].copy()), pa.array(pair[:, 1].copy())], ["id", "high", "low"]
            )

    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("id"), "text").mapInArrow(
        hashed, "id bigint, high bigint, low bigint"
    )


def line_index(hashes: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, int]:
    """``(shard, index)``, a :class:`LineIndex` as bytes per row, over the hashes found in ``min_docs`` documents; and the number of shards."""
    shared = hashes.distinct().groupBy("high", "low").agg(F.count("*").alias("n"), F.max("id").alias("owner"))
    shared = stage(shared.filter(F.col("n") >= min_docs), "line-counts")
    shards = 1 << max(0, (shared.count() // SHARD_KEYS).bit_length())

    def built(key: tuple, group: pa.Table) -> pa.Table:
        def column(name: str) -> np.ndarray:
            return group[name].to_numpy()

        made = LineIndex.over(column("high").view(np.uint64), column("low").view(np.uint64), column("n"), column("owner"))
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "index": pa.array([made.to_bytes()], pa.binary())})

    sharded = shared.withColumn("shard", F.pmod("high", F.lit(shards)).cast("int"))
    return stage(sharded.groupBy("shard").applyInArrow(built, "shard int, index binary"), "line-index"), shards


def dropped_lines(hashes: DataFrame, index: DataFrame, shards: int, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(id, drops)``: per document the hashes, 16 bytes each, of the keys it has to drop because a larger id holds them too."""
    probes = hashes.select(F.pmod("high", F.lit(shards)).cast("int").alias("shard"), "id", "high", "low")
    load = probes.groupBy("shard").agg(F.ceil(F.count("*") / SHARD_PROBES).cast("int").alias("copies"))
    indexed = index.join(load, "shard")
    copies = indexed.select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.lit(None).cast("bigint").alias("id"),
        F.lit(None).cast("bigint").alias("high"), F.lit(None).cast("bigint").alias("low"), "index",
    )
    routed = probes.join(indexed.select("shard", "copies"), "shard").select(
        "shard", F.pmod(F.xxhash64("id", "high"), F.col("copies")).cast("int").alias("copy"), "id", "high", "low",
        F.lit(None).cast("binary").alias("index"),
    )
    # the index of a shard comes before the hashes that go past it
    streams = copies.unionByName(routed).repartition("shard", "copy").sortWithinPartitions(
        "shard", "copy", F.col("index").isNull()
    )

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: LineIndex | None = None
        for batch in batches:
            loads = np.flatnonzero(np.asarray(batch["index"].is_valid()))
            bounds = [0, *loads.tolist(), batch.num_rows]
            for first, last in zip(bounds, bounds[1:]):
                rows = batch.slice(first, last - first)
                if rows.num_rows and rows["index"][0].is_valid:
                    held = LineIndex.from_bytes(rows["index"][0].as_py())
                    rows = rows.slice(1)
                if not rows.num_rows:
                    continue
                ids, high, low = (rows[c].to_numpy() for c in ("id", "high", "low"))
                counts, owners = held.probe(high.view(np.uint64), low.view(np.uint64))
                drop = (counts >= min_docs) & (ids < owners)
                pairs = np.ascontiguousarray(np.stack([high[drop], low[drop]], axis=1)).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[drop]), pa.array([pairs[i : i + 16] for i in range(0, len(pairs), 16)], pa.binary())],
                    ["id", "drop"],
                )

    found = streams.mapInArrow(probed, "id bigint, drop binary")
    return found.groupBy("id").agg(F.collect_set("drop").alias("drops"))


def without_shared_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, digest: bool = False
) -> DataFrame:
    r"""``(doc_id, n_lines, n_dropped, text)`` per row of ``docs (doc_id, text, …)``, with the lines left.

    Texts are split at ``\n``; a null or empty text is one empty line. A line's key is the line without
    ASCII white space at its ends and with A-Z in lower case. Keys of at least ``min_chars`` code points
    found in at least ``min_docs`` documents lose all their lines but those in the largest ``doc_id``
    that holds them. Rows of one ``doc_id`` are one document; null ids are one document, smaller than
    any. With ``digest`` the last column is ``kept_sha256`` instead, and the text stays in the task.
    """
    hashes = stage(line_hashes(docs, min_chars), "line-hashes")
    index, shards = line_index(hashes, min_docs)
    drops = stage(dropped_lines(hashes, index, shards, min_docs), "line-drops")
    last = "kept_sha256" if digest else "text"

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text"):
            n_lines: list[int] = []
            n_dropped: list[int] = []
            texts: list[str] = []
            for text, drop in zip(batch["text"].cast(pa.binary()).to_pylist(), batch["drops"].to_pylist()):
                text = text or b""
                n_lines.append(text.count(b"\n") + 1)
                if drop:
                    unwanted = set(drop)
                    lines = [
                        line
                        for line in text.split(b"\n")
                        if len(line) < min_chars
                        or not _long_enough(key := line_key(line), min_chars)
                        or xxhash.xxh3_128_digest(key) not in unwanted
                    ]
                    n_dropped.append(n_lines[-1] - len(lines))
                    text = b"\n".join(lines)
                else:
                    n_dropped.append(0)
                texts.append(hashlib.sha256(text).hexdigest() if digest else text.decode())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(texts, pa.string())],
                ["doc_id", "n_lines", "n_dropped", last],
            )

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn(
        "id", F.coalesce("doc_id", F.lit(_NULL_ID))
    )
    # shuffled at every size, so that what is seen on small input holds on large input
    return keyed.join(drops.hint("merge"), "id", "left").select("doc_id", "text", "drops").mapInArrow(
        kept, f"doc_id bigint, n_lines bigint, n_dropped bigint, {last} string"
    )

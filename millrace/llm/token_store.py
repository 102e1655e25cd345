"""Token ids of documents as compressed files: tokenization, coding and reading back.

A store is a folder with two Parquet tables and a frequency table (see :mod:`millrace.llm.rans`):

    blocks   part, block, doc_ids, lengths, payload: whole documents, one coded block per row, in
             ascending (part, block) order, a folder per part
    index    part, block, first_token: where each block begins in the stream of all ids
    table    one row with the packed frequency table

Parquet carries the blocks so that any file system Spark knows can hold them and a task that is
repeated after a lost executor replaces its output as a whole.
"""

from __future__ import annotations

import re
import sys
import types
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import pieces_of, stage, text_key
from millrace.llm.rans import PRECISION, Coder, pack_table, quantised
from millrace.workspace import fresh_dir

END_ID = 1
BLOCK_TOKENS = 1 << 20
# Bytes of words and ids that a Python worker remembers from task to task.
REMEMBERED = 16 << 20
# Bytes of text that are tokenized at once.
PIECE = 4 << 20
_PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def _kept_encoders() -> dict[str, WordEncoder]:
    """What the worker process keeps from task to task: functions travel by value, so a task's copy of this module goes with it."""
    kept = sys.modules.setdefault("_millrace_kept", types.ModuleType("_millrace_kept"))
    return kept.__dict__.setdefault("encoders", {})


class WordEncoder:
    """Ids of single words by a tokenizer that never looks across white space, remembered per worker.

    The tokenizer in question lower-cases, drops white space and splits at every change between
    letters, digits and other signs before it merges, so a text's ids are those of its words in order,
    and a word's ids those of its stem and of its trailing ASCII punctuation. The tokenizer's added tokens
    are recognised first, in the raw text; what lies between them is tokenized by itself.

    What is remembered lies in flat arrays, some 20 bytes a stem, and takes ``REMEMBERED`` bytes and those of
    one batch at most, however long the words are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = {token.content: i for i, token in added.items()}
        # Only tokens that are found as they stand, in the raw text, can be split off first.
        self.plain = not any(t.normalized or t.lstrip or t.rstrip or t.single_word or t.content.split() != [t.content] for t in added.values())
        either = "|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))
        self.split_added = re.compile(f"({either})")
        self.lowered = [c.encode().lower().decode() for c in self.added]
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self._remember(pa.array([], pa.string()), np.zeros(0, self.kind), np.zeros(0, np.int32))

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        encoders = _kept_encoders()
        if path not in encoders:
            encoders[path] = cls(path)
        return encoders[path]

    def _remember(self, known: pa.Array, flat: np.ndarray, lengths: np.ndarray, used: np.ndarray | None = None) -> None:
        self.known, self.flat, self.lengths = known, flat, lengths
        self.used = np.zeros(len(known), dtype=bool) if used is None else used

    def _encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces in one array, and their numbers.

        The tokenizer's own steps one by one, several times as fast as a call per word that does them all.
        """
        merge, split, normalize = self.tokenizer.model.tokenize, self.tokenizer.pre_tokenizer, self.tokenizer.normalizer
        found, lengths = array("H" if self.kind.itemsize == 2 else "I"), np.zeros(len(pieces), dtype=np.int32)
        for i, piece in enumerate(pieces):
            if piece.isascii() and piece.isalpha() and piece.islower():  # such a word stays as it is and whole
                tokens = merge(piece)
            else:
                tokens = [t for p, _ in split.pre_tokenize_str(normalize.normalize_str(piece)) for t in merge(p)]
            found.extend([t.id for t in tokens])
            lengths[i] = len(tokens)
        return np.frombuffer(found, dtype=self.kind) if found else np.zeros(0, self.kind), lengths

    def _of_pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For distinct pieces: an array of ids, and where in it each one's begin and how many they are."""
        at = pc.index_in(pieces, value_set=self.known)
        new = pieces.filter(pc.is_null(at))
        flat, lengths = self._encoded(new.to_pylist())
        place = np.array(pc.fill_null(at, 0))
        self.used[place[np.asarray(pc.is_valid(at))]] = True
        place[np.asarray(pc.is_null(at))] = len(self.known) + np.arange(len(new))
        self._remember(
            pa.concat_arrays([self.known, new]),
            np.concatenate([self.flat, flat]),
            np.concatenate([self.lengths, lengths]),
            np.concatenate([self.used, np.ones(len(new), dtype=bool)]),
        )
        flat, ends, lengths = self.flat, np.cumsum(self.lengths, dtype=np.int64), self.lengths[place].astype(np.int64)
        self._forget()
        return flat, ends[place] - lengths, lengths

    def _forget(self) -> None:
        """Where more than ``REMEMBERED`` bytes are held, the pieces met since the last time stay, the newest of them up to half as many."""
        sizes = np.asarray(pc.binary_length(self.known)) + 9 + self.kind.itemsize * self.lengths.astype(np.int64)
        if sizes.sum() <= REMEMBERED:
            return
        kept = self.used & (np.cumsum((sizes * self.used)[::-1])[::-1] <= REMEMBERED // 2)
        self._remember(self.known.filter(pa.array(kept)), self.flat[np.repeat(kept, self.lengths)], self.lengths[kept])

    def ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words in one array, and their numbers."""
        words = words.cast(pa.string())
        stems = pc.ascii_rtrim(words, characters=_PUNCTUATION)
        # signs of any kind form one piece together, so only what follows a letter or digit is split off
        last = pc.utf8_slice_codeunits(stems, -1).dictionary_encode()
        alnum = np.array([c.isalnum() for c in last.dictionary.to_pylist()], dtype=bool)[np.asarray(last.indices)]
        cut = alnum & np.asarray(pc.not_equal(stems, words))
        tails = pc.replace_substring_regex(words.filter(pa.array(cut)), f"(?s)^.*[^{re.escape(_PUNCTUATION)}]", "")
        pieces = pa.concat_arrays([pc.if_else(pa.array(cut), stems, words), tails]).dictionary_encode()
        flat, starts, lengths = self._of_pieces(pieces.dictionary)
        # a word is a stem and a tail, which may have no ids
        chosen = np.asarray(pieces.indices)
        parts = np.zeros((len(words), 2), dtype=np.int64)
        numbers = np.zeros((len(words), 2), dtype=np.int64)
        parts[:, 0], numbers[:, 0] = starts[chosen[: len(words)]], lengths[chosen[: len(words)]]
        parts[cut, 1], numbers[cut, 1] = starts[chosen[len(words) :]], lengths[chosen[len(words) :]]
        return flat[_places(parts.ravel(), numbers.ravel())], numbers.sum(axis=1)

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a batch of texts in one array, and the number of ids per text; a null text has none."""
        if not self.plain:
            own = [e.ids for e in self.tokenizer.encode_batch([t or "" for t in texts.to_pylist()], add_special_tokens=False)]
            return np.array([i for ids in own for i in ids], dtype=self.kind), np.array([len(ids) for ids in own], dtype=np.int64)
        split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
        coded = split.flatten().dictionary_encode()
        # an added token lies within a word, and distinct words are few
        if pc.any(pc.match_substring_regex(coded.dictionary, "|".join(map(re.escape, self.lowered)))).as_py():
            return self._around_added(texts)
        return self._of_words(split, coded)

    def _around_added(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`batch`, for texts that may hold added tokens."""
        pieces: list[str] = []
        between: list[int] = []
        counts, marks = [], []
        for text in texts.to_pylist():
            parts = self.split_added.split(text or "")
            # pieces of text and added tokens take turns, a piece first and last
            between += [len(pieces) + i for i in range(len(parts) // 2)]
            marks += [self.added[t] for t in parts[1::2]]
            pieces += parts[::2]
            counts.append(len(parts) // 2 + 1)
        split = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(pieces, pa.string())))
        flat, lengths = self._of_words(split, split.flatten().dictionary_encode())
        flat = np.insert(flat, np.cumsum(lengths)[between], np.array(marks, dtype=self.kind))
        lengths[between] += 1
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum([0, *counts])]
        return flat, np.diff(ends)

    def _of_words(self, split: pa.ListArray, coded: pa.DictionaryArray) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`batch`, for texts as lists of words and their words as a dictionary."""
        flat, lengths = self.ids(coded.dictionary)
        starts = np.cumsum(lengths) - lengths
        chosen = np.asarray(coded.indices)
        per_word = lengths[chosen]
        # words of text i are offsets[i] to offsets[i + 1]
        offsets = np.asarray(split.offsets) - np.asarray(split.offsets)[0]
        before = np.concatenate([[0], np.cumsum(per_word)])
        return flat[_places(starts[chosen], per_word)], before[offsets[1:]] - before[offsets[:-1]]


def _places(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of runs that begin at ``starts``, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat((starts - (ends - lengths)).astype(np.int32), lengths)
    at += np.arange(total, dtype=np.int32)
    return at


def tokenized(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``(part, block, doc_ids, lengths, ids, counts)``: the ids of all documents in ascending ``doc_id`` order.

    Documents are dealt out by ranges of ``doc_id``, rows of one id by the hash of their text, so a
    repeated id spreads over several parts. A block holds whole documents and ends with the one that
    takes it to ``block_tokens`` ids. Null ids come first; null and empty texts are the end id alone. Each
    part ends with a row that has only ``counts``, the frequency of every id in it.
    """

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.of(tokenizer_path)
        part, block = TaskContext.get().partitionId(), 0
        counts = np.zeros(max(encoder.size, end_id + 1), dtype=np.int64)
        doc_ids: list[int | None] = []
        lengths: list[int] = []
        held: list[np.ndarray] = []
        tokens = 0

        def row(doc_ids, lengths, ids, counts) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(
                [{"part": part, "block": block, "doc_ids": doc_ids, "lengths": lengths, "ids": ids, "counts": counts}],
                schema=schema,
            )

        for batch in pieces_of(batches, "text", PIECE):
            flat, per_text = encoder.batch(batch["text"])
            ends = np.cumsum(per_text)
            # the end id follows the ids of each document
            flat = np.insert(flat, ends, end_id)
            ends = ends + np.arange(1, len(ends) + 1)
            counts += np.bincount(flat, minlength=len(counts))
            ids, first = batch["doc_id"].to_pylist(), 0
            while first < len(ids):
                begin = int(ends[first - 1]) if first else 0
                last = min(len(ids) - 1, int(np.searchsorted(ends, begin + block_tokens - tokens)))
                end = int(ends[last])
                doc_ids += ids[first : last + 1]
                lengths += np.diff(ends[first : last + 1], prepend=begin).tolist()
                held.append(flat[begin:end])
                tokens += end - begin
                first = last + 1
                if tokens >= block_tokens:
                    yield row(doc_ids, lengths, _packed(np.concatenate(held)), None)
                    doc_ids, lengths, held, tokens, block = [], [], [], 0, block + 1
        if doc_ids:
            yield row(doc_ids, lengths, _packed(np.concatenate(held)), None)
        if counts.any():
            block = -1
            yield row(None, None, None, counts.astype("<i8").tobytes())
        # the worker waits for other tasks, and the memory of its batches would wait with it
        pa.default_memory_pool().release_unused()

    schema = pa.schema(
        [("part", pa.int32()), ("block", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
         ("ids", pa.binary()), ("counts", pa.binary())]
    )
    ordered = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", text_key(F.col("text"))["a"].alias("key")
    ).repartitionByRange("doc_id", "key")
    return ordered.sortWithinPartitions("doc_id", "key").select("doc_id", "text").mapInArrow(
        coded, "part int, block int, doc_ids array<bigint>, lengths array<bigint>, ids binary, counts binary"
    )


def _packed(ids: np.ndarray) -> bytes:
    """Ids at two or four bytes each; the first byte says which."""
    return (b"\2" if ids.itemsize == 2 else b"\4") + ids.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype="<u4" if data[0] == 4 else "<u2", offset=1).astype(np.uint32)


def frequency_table(blocks: DataFrame) -> bytes:
    """The packed frequency table over all ids; as many numbers reach the driver as the vocabulary has."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for packed in batch["counts"]:
                counts = np.frombuffer(packed.as_py(), dtype="<i8")
                total = counts.copy() if total is None else total + counts
        if total is not None:
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    counted = blocks.filter("counts is not null").select("counts").mapInArrow(summed, "id bigint, n bigint")
    rows = counted.groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in rows), default=0) + 1, dtype=np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    return pack_table(quantised(counts), PRECISION)


def write_store(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS) -> None:
    """Tokenize ``docs (doc_id, text, …)`` and write the store at ``path``."""
    spark = docs.sparkSession
    blocks = stage(tokenized(docs, tokenizer_path, end_id, block_tokens), "token-blocks", compression="zstd")
    table = frequency_table(blocks)
    schema = "part int, block int, doc_ids array<bigint>, lengths array<bigint>, payload binary"

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(table)
        for batch in batches:
            for i in range(batch.num_rows):
                payload = coder.encode(_unpacked(batch["ids"][i].as_py()))
                row = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays(
                    [row["part"], row["block"], row["doc_ids"], row["lengths"], pa.array([payload], pa.binary())],
                    ["part", "block", "doc_ids", "lengths", "payload"],
                )

    whole = blocks.filter("counts is null").select("part", "block", "doc_ids", "lengths", "ids")
    # rANS output does not compress further
    whole.mapInArrow(encoded, schema).sortWithinPartitions("part", "block").write.option("compression", "none").partitionBy(
        "part"
    ).parquet(f"{path}/blocks")
    sizes = blocks.filter("counts is null").select(
        "part", "block", F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("tokens")
    )
    sizes = stage(sizes, "token-sizes")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("tokens").alias("tokens"))  # a row per task of the tokenization
    parts = parts.select("part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    index = sizes.join(parts, "part").select(
        "part", "block", (F.col("base") + F.coalesce(F.sum("tokens").over(inside), F.lit(0))).alias("first_token")
    )
    index.write.parquet(f"{path}/index")
    spark.createDataFrame([(bytearray(table),)], "table binary").write.parquet(f"{path}/table")


def _table_of(spark: SparkSession, path: str) -> bytes:
    return bytes(spark.read.parquet(f"{path}/table").first()["table"])


def _blocks_of(spark: SparkSession, path: str) -> DataFrame:
    schema = "block int, doc_ids array<bigint>, lengths array<bigint>, payload binary, part int"
    return spark.read.schema(schema).parquet(f"{path}/blocks")


def read_documents(
    spark: SparkSession, path: str, digest: Callable[[np.ndarray], object] | None = None, digest_type: str = "array<bigint>"
) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of every document of a store, decoded block by block in parallel.

    With ``digest``, the last column is ``digest(ids)`` instead, of type ``digest_type``, and the ids stay
    in the task. Damaged blocks are an error.
    """
    table = _table_of(spark, path)
    of_ids = digest or (lambda ids: ids.astype(np.int64))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(table)
        for batch in batches:
            for i in range(batch.num_rows):
                lengths = np.asarray(batch["lengths"][i].values, dtype=np.int64)
                ids = coder.decode(batch["payload"][i].as_py())
                ends = np.cumsum(lengths)
                if len(ids) != (int(ends[-1]) if len(ends) else 0):
                    raise ValueError("a block's documents do not have as many ids as the block")
                pieces = [of_ids(ids[e - n : e]) for e, n in zip(ends, lengths)]
                count = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch["part"][i].as_py()] * count, pa.int32()),
                        pa.array([batch["block"][i].as_py()] * count, pa.int32()),
                        batch["doc_ids"][i].values,
                        pa.array(ends - lengths),
                        pa.array(lengths),
                        pa.array(pieces),
                    ],
                    ["part", "block", "doc_id", "within", "n_tokens", "ids"],
                )

    rows = _blocks_of(spark, path).select("part", "block", "doc_ids", "lengths", "payload").mapInArrow(
        decoded, f"part int, block int, doc_id bigint, within bigint, n_tokens bigint, ids {digest_type}"
    )
    index = spark.read.schema("part int, block int, first_token bigint").parquet(f"{path}/index")
    return rows.join(index, ["part", "block"]).select(
        "doc_id", (F.col("first_token") + F.col("within")).alias("start"), "n_tokens", "ids"
    )


def document_digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of ``docs``, written to a store below the shared folder and read back from it."""
    path = fresh_dir(docs.sparkSession, "token-store")
    write_store(docs, path, tokenizer_path)
    read = read_documents(docs.sparkSession, path, lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), "bigint")
    return read.withColumnRenamed("ids", "ids_crc32")

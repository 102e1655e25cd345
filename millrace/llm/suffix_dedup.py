"""Repeated byte strings of a corpus by suffix arrays, cut into groups that only hold what can be equal.

Whether a string of ``length`` bytes occurs twice is decided by sorting suffixes. So that the sort needs no
text of the whole corpus in one order, every window of ``length`` bytes is given an *anchor*, the place of
the smallest hash among the grams in it. Equal windows have equal anchors at equal offsets, so all
windows of an anchor, a *piece* of text, need only be compared with pieces of the same gram; and
grams found once in the corpus need no comparison at all. Within a group the suffixes of the pieces that
are long enough are sorted, neighbours' common prefixes are measured, and a stack goes over them: it forms the tree
of common-prefix intervals and tells, by the bytes to the left, which of them are maximal repeats.

Equal pieces are one piece with a count. A group that still has many pieces is split by the offset of the
window from the anchor and by the text that all windows of such a range of offsets contain; the last range
holds one offset, where all that is left in a group is equal. So a passage that any share of all documents
hold is never one task's work, and nothing is left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import pieces_of, stage

LENGTH = 400
# Pieces in a group that one task sorts together.
GROUP = 1024
# Ranges of offsets by which larger groups are split, round by round.
RANGES = (64, 16, 4, 1)
# Bytes of pieces that a task sorts at once.
SORTED = 2 << 20
# Bytes of text whose grams a task hashes at once.
CHUNK = 1 << 20
_PLACE = np.uint64(0xFFFFFF)
_BASE = 0x9E3779B97F4A7C15
_NULL_ID = -(2**63)
_REPEATS = "array<struct<repeat:bigint,length:int,start:int>>"
_DIVERSE = -1

_powers: dict[int, np.ndarray] = {}


def _power(base: int, count: int) -> np.ndarray:
    """base ** i modulo 2 ** 64, kept by the worker."""
    if base not in _powers or len(_powers[base]) < count:
        steps = np.full(max(count, CHUNK + LENGTH), base, dtype=np.uint64)
        steps[0] = 1
        _powers[base] = np.cumprod(steps)
    return _powers[base][:count]


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of every ``gram`` consecutive bytes."""
    if len(data) < gram:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(data)), out=sums[1:])
        h = (sums[gram:] - sums[:-gram]) * _power(pow(_BASE, -1, 1 << 64), len(data) - gram + 1)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(29))


def anchors_of(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts laid end to end: per anchor its gram's hash, its place, and the first and last of its windows.

    A window's anchor is the smallest gram in it by the upper 40 bits of the hash, the last of equal ones; both
    depend on the window's bytes alone. ``data`` has fewer than 2 ** 24 bytes.
    """
    gram = length // 2
    width = length - gram + 1
    hashes = gram_hashes(data, gram)
    count = len(data) - length + 1
    if count <= 0:
        none = np.zeros(0, dtype=np.int64)
        return none.view(np.uint64), none, none, none
    keys = (hashes & ~_PLACE) | (_PLACE - np.arange(len(hashes), dtype=np.uint64))
    padded = np.full(-(-len(keys) // width) * width, ~np.uint64(0))
    padded[: len(keys)] = keys
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    anchor = (_PLACE - (np.minimum(behind[:count], ahead[width - 1 : width - 1 + count]) & _PLACE)).astype(np.int64)
    # windows that lie in one text
    starts = np.concatenate([[0], ends[:-1]])
    whole = np.maximum(ends - length + 1 - starts, 0)
    inside = np.repeat(starts, whole) + np.arange(int(whole.sum())) - np.repeat(np.cumsum(whole) - whole, whole)
    anchor = anchor[inside]
    new = np.ones(len(inside), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1] + 1)
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(inside))[: len(at)] - 1
    return hashes[anchor[at]], anchor[at], inside[at], inside[last]


def with_anchors(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(id, key, anchors)`` of the rows of ``docs (id, key, text binary)`` that are long enough; an anchor is ``(gram, first, windows, head)``.

    ``first`` is where the first of its ``windows`` begins, ``head`` the anchor's offset in that window.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text", CHUNK // 2):
            texts = batch["text"].to_pylist()
            per: list[list[np.ndarray]] = [[] for _ in texts]
            run: list[int] = []

            def take(rows: list[int], data: bytes, ends: list[int], shift: int) -> None:
                gram, at, first, last = anchors_of(np.frombuffer(data, dtype=np.uint8), np.array(ends), length)
                bounds = np.searchsorted(first, [0, *ends])
                for row, begin, end, start in zip(rows, bounds, bounds[1:], [0, *ends]):
                    f = first[begin:end]
                    per[row].append(
                        np.stack([gram[begin:end].view(np.int64), f - start + shift, last[begin:end] - f + 1, at[begin:end] - f])
                    )

            for row, text in enumerate(texts):
                if len(text) <= CHUNK:
                    run.append(row)
                    continue
                for start in range(0, len(text) - length + 1, CHUNK):  # a long text chunk by chunk, every window in one chunk
                    part = text[start : start + CHUNK + length - 1]
                    take([row], part, [len(part)], start)
            while run:
                held, size = [], 0
                while run and (not held or size + len(texts[run[-1]]) <= CHUNK):
                    held.append(run.pop())
                    size += len(texts[held[-1]])
                take(held, b"".join(texts[r] for r in held), np.cumsum([len(texts[r]) for r in held]).tolist(), 0)
            sizes = [sum(p.shape[1] for p in own) for own in per]
            parts = [p for own in per for p in own]
            table = np.concatenate(parts, axis=1) if parts else np.zeros((4, 0), dtype=np.int64)
            values = pa.StructArray.from_arrays(
                [pa.array(table[0]), *(pa.array(column.astype(np.int32)) for column in table[1:])],
                ["gram", "first", "windows", "head"],
            )
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values)
            yield pa.RecordBatch.from_arrays([batch["id"], batch["key"], lists], ["id", "key", "anchors"])

    schema = "id bigint, key bigint, anchors array<struct<gram:bigint,first:int,windows:int,head:int>>"
    return docs.filter(F.octet_length("text") >= length).select("id", "key", "text").mapInArrow(found, schema)


def common_prefixes(ordered: list[bytes]) -> np.ndarray:
    """The number of bytes that each string of a sorted list has in common with the one before; 0 for the first."""
    found = np.zeros(len(ordered), dtype=np.int64)
    for first in range(0, len(ordered) - 1, 4096):
        some = ordered[first : first + 4097]
        width = max(map(len, some))
        rows = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in some), dtype=np.uint8).reshape(-1, width)
        other = rows[1:] != rows[:-1]
        same = np.where(other.any(axis=1), other.argmax(axis=1), width)
        lengths = np.fromiter(map(len, some), dtype=np.int64, count=len(some))
        found[first + 1 : first + len(some)] = np.minimum(same, np.minimum(lengths[1:], lengths[:-1]))
    return found


def maximal_intervals(
    prefixes: list[int], lengths: list[int], counts: list[int], left: list[int], least: int
) -> Iterator[tuple[int, int, int]]:
    """``(length, first, last)``: the maximal repeats of ``least`` bytes or more among sorted suffixes.

    ``prefixes[i]`` is what suffix ``i`` has in common with suffix ``i - 1``; ``counts[i]`` says how often the
    suffix itself occurs, ``left[i]`` is the byte before it, negative where the text before is not known.
    Suffixes ``first`` to ``last`` all begin with the repeat, and no other does. A stack holds the open
    intervals, each with the one byte that all its suffixes have to their left, or with the mark that they differ.
    An interval whose suffixes all have one byte to the left is part of a longer repeat and is left out.
    """
    stack: list[list[int]] = []
    for i, length in enumerate(lengths):
        onward = prefixes[i + 1] if i + 1 < len(lengths) else 0
        begin, before = i, left[i]
        if counts[i] > 1 and before < 0 and not (stack and stack[-1][0] == length) and onward < length:
            yield length, i, i
        while stack and stack[-1][0] > onward:
            top = stack.pop()
            if top[2] != before:
                top[2] = _DIVERSE
            if top[2] == _DIVERSE:
                yield top[0], top[1], i
            begin, before = top[1], top[2]
        if stack and stack[-1][0] == onward:
            if stack[-1][2] != before:
                stack[-1][2] = _DIVERSE
        elif onward >= least:
            stack.append([onward, begin, before])


def repeats_in_group(pieces: list[tuple[bytes, int, int]], least: int) -> list[list[tuple[int, int, int]]]:
    """Per piece ``(text, windows, count)`` of one group: ``(repeat, length, start)`` of every maximal repeat in it, numbered per group."""
    suffixes = sorted((text[p:], i, p) for i, (text, windows, _) in enumerate(pieces) for p in range(windows))
    prefixes = common_prefixes([s for s, _, _ in suffixes]).tolist()
    found: list[list[tuple[int, int, int]]] = [[] for _ in pieces]
    number = 0
    intervals = maximal_intervals(
        prefixes,
        [len(s) for s, _, _ in suffixes],
        [pieces[i][2] for _, i, _ in suffixes],
        [pieces[i][0][p - 1] if p else _DIVERSE for _, i, p in suffixes],
        least,
    )
    for length, first, last in intervals:
        for _, i, p in suffixes[first : last + 1]:
            found[i].append((number, length, p))
        number += 1
    return found


def covered(repeats: list[tuple[int, int, int]]) -> list[int]:
    """What the repeats of a piece cover together: beginnings and ends in turn."""
    spans: list[int] = []
    for start, end in sorted((p, p + n) for _, n, p in repeats):
        if spans and start <= spans[-1]:
            spans[-1] = max(spans[-1], end)
        else:
            spans += [start, end]
    return spans


def _sorted_groups(pieces: DataFrame, least: int) -> DataFrame:
    """``(group, sub, repeats, spans)`` of ``pieces (group, sub, n, windows, text)``, a bounded number of them per group."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        names: list = []
        out: list = []

        def finish() -> None:
            if len(held) > 1 or held and held[0][2] > 1:
                group = names[-1][0]
                for name, own in zip(names, repeats_in_group(held, least)):
                    if own:
                        out.append(
                            {"group": name[0], "sub": name[1], "spans": covered(own), "repeats": [
                                {"repeat": xxhash.xxh64_intdigest(group, number) - (1 << 63), "length": length, "start": start}
                                for number, length, start in own]}
                        )
            held.clear()
            names.clear()

        def rows() -> pa.RecordBatch:
            made = pa.RecordBatch.from_pylist(out, schema=schema)
            out.clear()
            return made

        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("group", "sub", "n", "windows", "text"))
            for group, sub, n, windows, text in zip(*columns):
                if names and names[-1][0] != group:
                    finish()
                names.append((group, sub))
                held.append((text, windows, n))
            if len(out) > 5_000:
                yield rows()
        finish()
        yield rows()

    repeat = pa.struct([("repeat", pa.int64()), ("length", pa.int32()), ("start", pa.int32())])
    schema = pa.schema([("group", pa.binary()), ("sub", pa.binary()), ("repeats", pa.list_(repeat)), ("spans", pa.list_(pa.int32()))])
    dealt = pieces.select("group", "sub", "n", "windows", "text").repartition("group").sortWithinPartitions("group", "sub")
    return dealt.mapInArrow(scanned, f"group binary, sub binary, repeats {_REPEATS}, spans array<int>")


def _split(pieces: DataFrame, width: int, length: int) -> DataFrame:
    """Pieces cut by ranges of ``width`` offsets, in groups by the text that all windows of the range contain.

    ``(group, sub, owner_group, owner_sub, n, shift, windows, head, text)``; ``shift`` is where the part begins in its owner.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text", SORTED):
            out = []
            columns = (batch[c].to_pylist() for c in ("group", "sub", "n", "windows", "head", "text"))
            for group, sub, n, windows, head, text in zip(*columns):
                # window i begins head - i bytes before the anchor
                for cell in range((head - windows + 1) // width, head // width + 1):
                    high, low = min(head, cell * width + width - 1), max(head - windows + 1, cell * width)
                    shift, count = head - high, high - low + 1
                    part = text[shift : shift + count + length - 1]
                    begin = head - cell * width
                    end = max(begin, begin - width + 1 + length)
                    name = xxhash.xxh3_128_digest(group + cell.to_bytes(4, "little") + text[begin:end], width)
                    out.append(
                        (name, xxhash.xxh3_128_digest(part, high), group, sub, n, shift, count, high, part)
                    )
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    names = ["group", "sub", "owner_group", "owner_sub", "n", "shift", "windows", "head", "text"]
    b, i = pa.binary(), pa.int32()
    types = [b, b, b, b, pa.int64(), i, i, i, b]
    schema = "group binary, sub binary, owner_group binary, owner_sub binary, n bigint, shift int, windows int, head int, text binary"
    return pieces.mapInArrow(cut, schema)


def _moved(by: str) -> Column:
    def moved(r: Column) -> Column:
        return F.struct(r["repeat"].alias("repeat"), r["length"].alias("length"), (r["start"] + F.col(by)).alias("start"))

    return F.transform("repeats", moved)


def repeats_of(pieces: DataFrame, length: int = LENGTH, group: int = GROUP, ranges: tuple[int, ...] = RANGES) -> DataFrame:
    """``(group, sub, repeats, spans)``: the maximal repeats of distinct ``pieces (group, sub, n, windows, head, text)``, group by group.

    Groups of more than ``group`` pieces are split; what is found in the parts is handed back to the pieces.
    """
    sizes = pieces.groupBy("group").agg(F.count("*").alias("pieces"), F.sum("n").alias("all")).filter(F.col("all") > 1)
    # a table of its own, so that a group of very many pieces is split in the join
    sized = stage(pieces.join(stage(sizes, "suffix-sizes"), "group"), "suffix-groups")
    found = _sorted_groups(sized.filter(F.col("pieces") <= group) if ranges else sized, length)
    large = sized.filter(F.col("pieces") > group)
    if not ranges or large.isEmpty():
        return found
    cells = stage(_split(large, ranges[0], length), "suffix-cells")
    parts = cells.groupBy("group", "sub").agg(
        F.sum("n").alias("n"), *[F.first(c).alias(c) for c in ("windows", "head", "text")]
    )
    inner = repeats_of(stage(parts, "suffix-parts"), length, group, ranges[1:])
    back = inner.join(cells.select("group", "sub", "owner_group", "owner_sub", "shift"), ["group", "sub"])
    back = back.groupBy(F.col("owner_group").alias("group"), F.col("owner_sub").alias("sub")).agg(
        # a piece has at most length / 2 + 1 parts
        F.flatten(F.collect_list(_moved("shift"))).alias("repeats"),
        F.flatten(F.collect_list(F.transform("spans", lambda p: p + F.col("shift")))).alias("spans"),
    )
    return found.unionByName(back)


def _identified(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", F.coalesce("doc_id", F.lit(_NULL_ID)).alias("id"), F.xxhash64("text").alias("key"), "text"
    )


def _pieces(texts: DataFrame, length: int) -> DataFrame:
    """``(group, sub, id, key, first, windows, head)`` of every anchor in ``texts (id, key, text, anchors)``; ``sub`` stands for the piece's text."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text"):
            out = []
            for id, key, text, own in zip(*(batch[c].to_pylist() for c in ("id", "key", "text", "anchors"))):
                for a in own:
                    first, windows, head = a["at"] >> 32, a["at"] >> 16 & 0xFFFF, a["at"] & 0xFFFF
                    sub = xxhash.xxh3_128_digest(text[first : first + windows + length - 1], head)
                    out.append((a["gram"].to_bytes(8, "little", signed=True), sub, id, key, first, windows, head))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 7, types)], names)

    names = ["group", "sub", "id", "key", "first", "windows", "head"]
    types = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    schema = "group binary, sub binary, id bigint, key bigint, first int, windows int, head int"
    return texts.select("id", "key", "text", "anchors").mapInArrow(hashed, schema)


def _texts_of_pieces(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``(group, sub, n, windows, head, text)``: one row per row of ``wanted (id, key, pieces)``, cut out of the texts."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text", SORTED):
            out = []
            for text, own in zip(batch["text"].to_pylist(), batch["pieces"].to_pylist()):
                for p in own:
                    part = text[p["first"] : p["first"] + p["windows"] + length - 1]
                    out.append((p["group"], p["sub"], p["n"], p["windows"], p["head"], part))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 6, types)], names)

    names = ["group", "sub", "n", "windows", "head", "text"]
    types = [pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    schema = "group binary, sub binary, n bigint, windows int, head int, text binary"
    found = texts.join(wanted, ["id", "key"]).select("text", "pieces").mapInArrow(cut, schema)
    # rows of one id and text all hold the pieces
    rest = [F.first(c).alias(c) for c in names[2:]]
    return found.groupBy("group", "sub").agg(*rest)


def repeats_by_document(
    docs: DataFrame, length: int = LENGTH, group: int = GROUP, digest: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows of ``docs``, the pieces of text that may hold repeats, and what was found in them.

    ``(doc_id, id, key, n_bytes, whole, text)``, the text as binary; ``(group, sub, id, key, first)``, where each piece
    begins in which text; and ``(group, sub, repeats, spans)``, counted from the piece's beginning. With ``digest``, ``text`` is
    null where no repeat is possible and ``whole`` is the digest of the whole text there.
    """
    texts = _identified(docs)
    anchors = stage(with_anchors(texts, length), "suffix-anchors")
    # first, windows and head in one number: rows of this table are moved by gram
    packed = F.transform(
        "anchors",
        lambda a: F.struct(
            a["gram"].alias("gram"),
            (F.shiftleft(a["first"].cast("long"), 32) + F.shiftleft(a["windows"].cast("long"), 16) + a["head"]).alias("at"),
        ),
    )
    single = anchors.select("id", "key", F.explode(packed).alias("a")).select("id", "key", "a.*")
    twice = single.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1").select("gram")
    # a table of its own, so that a gram of very many texts is split in the join
    possible = single.join(stage(twice, "suffix-grams"), "gram").groupBy("id", "key").agg(
        F.collect_set(F.struct("gram", "at")).alias("anchors")  # a document's own anchors
    )
    rows = texts.join(possible, ["id", "key"], "left").select(
        "doc_id", "id", "key", F.octet_length("text").cast("long").alias("n_bytes"),
        F.when(F.col("anchors").isNull() & F.lit(digest), F.sha2("text", 256)).alias("whole"),
        F.when(F.col("anchors").isNotNull() | F.lit(not digest), F.col("text")).alias("text"), "anchors",
    )
    rows = stage(rows, "suffix-texts")
    held = rows.filter("anchors is not null")
    places = stage(_pieces(held, length), "suffix-places")
    first = F.min(F.struct("id", "key", "first", "windows", "head")).alias("p")
    distinct = places.groupBy("group", "sub").agg(F.count("*").alias("n"), first)
    wanted = distinct.groupBy(F.col("p.id").alias("id"), F.col("p.key").alias("key")).agg(
        F.collect_list(
            F.struct("group", "sub", "n", F.col("p.first").alias("first"), F.col("p.windows").alias("windows"), F.col("p.head").alias("head"))
        ).alias("pieces")
    )
    pieces = stage(_texts_of_pieces(held.select("id", "key", "text"), wanted, length), "suffix-pieces")
    found = stage(repeats_of(pieces, length, group), "suffix-repeats")
    return rows.drop("anchors"), places.select("group", "sub", "id", "key", "first"), found


def maximal_repeats(docs: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """``(repeat, length, doc_id, start)``: every occurrence of every maximal repeat of ``length`` bytes or more in ``docs (doc_id, text, …)``.

    Places and lengths are in bytes of UTF-8. A repeat is maximal in the piece of text around its anchor (up to
    one and a half times ``length`` bytes); a longer repeated passage is reported as overlapping ones. Rows of one
    ``doc_id`` and text are one document here; a null id is one.
    """
    rows, places, found = repeats_by_document(docs, length, group)
    ids = rows.select("doc_id", "id", "key").distinct()
    at = places.join(found, ["group", "sub"]).select("id", "key", F.explode(_moved("first")).alias("r"))
    return at.join(ids, ["id", "key"]).select("r.repeat", "r.length", "doc_id", "r.start").distinct()


def without_repeats(docs: DataFrame, length: int = LENGTH, group: int = GROUP, digest: bool = False) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept)`` per row of ``docs (doc_id, text, …)``: each byte goes that lies in a repeated string.

    A string of ``length`` bytes is repeated if it also starts anywhere else, in the same text or another; matches
    do not cross texts, overlaps count, and all strings are judged on the input. Null and empty texts have no bytes.
    Repeated rows and rows of one id are texts like any other, so each of two equal rows loses all it has if
    it is long enough. ``kept`` is binary, since a cut may fall inside a character; with ``digest`` it is
    ``kept_sha256`` instead and the text stays in the task. An empty table has no rows.
    """
    rows, places, found = repeats_by_document(docs, length, group, digest)
    moved = F.transform("spans", lambda p: p + F.col("first"))
    spans = places.join(found.select("group", "sub", "spans"), ["group", "sub"]).groupBy("id", "key").agg(
        F.flatten(F.collect_set(moved)).alias("spans")  # a document's own pieces
    )
    last, kind = ("kept_sha256", "string") if digest else ("kept", "binary")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text"):
            removed: list[int] = []
            runs: list[int] = []
            kept: list = []
            for text, own in zip(batch["text"].to_pylist(), batch["spans"].to_pylist()):
                left, at, n = [], 0, 0
                for begin, end in sorted(zip(own[::2], own[1::2])) if own else ():
                    if begin > at or not n:
                        left.append(text[at:begin])
                        n += 1
                    at = max(at, end)
                left.append(text[at:])
                rest = b"".join(left)
                removed.append(len(text) - len(rest))
                runs.append(n)
                kept.append(hashlib.sha256(rest).hexdigest() if digest else rest)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["n_bytes"], pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
                 pa.array(kept, pa.string() if digest else pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", last],
            )

    schema = f"doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, {last} {kind}"
    possible = rows.filter("text is not null").join(spans, ["id", "key"], "left").select("doc_id", "n_bytes", "text", "spans")
    changed = possible.mapInArrow(cut, schema)
    if not digest:
        return changed
    none = F.lit(0).cast("long")
    same = rows.filter("text is null").select(
        "doc_id", "n_bytes", none.alias("n_removed"), none.alias("n_spans"), F.col("whole").alias(last)
    )
    return changed.unionByName(same)

"""Range asymmetric numeral system coding of token ids: one frequency table, independent blocks.

Fixed values of the format (version 1), all integers little-endian:

    table    4 bytes "RTB1", u32 precision, u32 symbols, then u32 frequency per symbol, u32 crc32
    block    header, marks, words
    header   4 bytes "RAN1", u32 tokens, u32 lanes, u32 steps between marks, u32 marks, u32 words,
             u32 crc32 of the tokens as u32, u32 crc32 of everything before and after this field
    mark     u64 lane states x lanes, u32 next word
    words    u32 x words

Token ``i`` belongs to lane ``i % lanes`` and step ``i // lanes``. Mark ``j`` holds all that a decoder
needs to begin at step ``j * steps between marks``, so parts of a block decode in parallel.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

LANES = 2048
MARK_STEPS = 256
PRECISION = 22
_LOW = np.uint64(1 << 31)
_HEADER = "<4s7I"
_HEADER_SIZE = struct.calcsize(_HEADER)


def quantised(counts: np.ndarray, precision: int = PRECISION) -> np.ndarray:
    """Frequencies that sum to ``2 ** precision``, at least 1 where the count is positive.

    Shares are rounded down and the rest goes to the most frequent symbols; what the minimum of 1
    takes too much comes off the most frequent ones.
    """
    total = 1 << precision
    counts = np.asarray(counts, dtype=np.float64)
    if not counts.sum():
        counts = np.ones_like(counts)
    if np.count_nonzero(counts) > total:
        raise ValueError("more symbols than the precision can hold")
    freq = np.floor(counts / counts.sum() * total).astype(np.int64)
    freq[(counts > 0) & (freq == 0)] = 1
    order = np.argsort(-freq, kind="stable")
    gap = total - int(freq.sum())
    while gap:
        takers = order[: max(1, min(len(order), abs(gap)))] if gap > 0 else order[freq[order] > 1][: abs(gap)]
        takers = takers[freq[takers] > 0]
        freq[takers] += 1 if gap > 0 else -1
        gap = total - int(freq.sum())
    return freq.astype(np.uint32)


def pack_table(freq: np.ndarray, precision: int = PRECISION) -> bytes:
    body = struct.pack("<4s2I", b"RTB1", precision, len(freq)) + np.ascontiguousarray(freq, dtype="<u4").tobytes()
    return body + struct.pack("<I", zlib.crc32(body))


class Coder:
    """Encoder and decoder for one frequency table."""

    def __init__(self, table: bytes):
        magic, precision, size = struct.unpack_from("<4s2I", table)
        if magic != b"RTB1" or zlib.crc32(table[:-4]) != struct.unpack("<I", table[-4:])[0]:
            raise ValueError("damaged frequency table")
        self.precision = np.uint64(precision)
        self.freq = np.frombuffer(table, dtype="<u4", count=size, offset=12).astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self._slots: np.ndarray | None = None

    @property
    def slots(self) -> np.ndarray:
        """The symbol of every slot of the table; made when first decoding."""
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        return self._slots

    def encode(self, tokens: np.ndarray, lanes: int = LANES, mark_steps: int = MARK_STEPS) -> bytes:
        """One self-contained block."""
        tokens = np.ascontiguousarray(tokens, dtype="<u4")
        count = len(tokens)
        lanes = max(1, min(lanes, count))
        steps = -(-count // lanes)
        state = np.full(lanes, _LOW, dtype=np.uint64)
        words: list[np.ndarray] = []
        marks: list[tuple[np.ndarray, int]] = []
        written = 0
        # The decoder goes forwards, so the encoder goes backwards and reverses what it wrote.
        for step in range(steps - 1, -1, -1):
            symbols = tokens[step * lanes : (step + 1) * lanes]
            x = state[: len(symbols)]
            freq = self.freq[symbols]
            if not freq.all():
                raise ValueError("a token that the frequency table does not have")
            full = x >= freq << np.uint64(63 - int(self.precision))
            if full.any():
                out = x[full]
                words.append((out & np.uint64(0xFFFFFFFF)).astype("<u4")[::-1])
                written += len(out)
                x[full] = out >> np.uint64(32)
            high = x // freq
            x[:] = (high << self.precision) + (x - high * freq) + self.start[symbols]
            if step % mark_steps == 0:
                marks.append((state.copy(), written))
        stream = np.concatenate(words)[::-1] if words else np.empty(0, dtype="<u4")
        marks.reverse()
        packed = b"".join(s.astype("<u8").tobytes() + struct.pack("<I", written - w) for s, w in marks)
        body = packed + stream.tobytes()
        fields = (b"RAN1", count, lanes, mark_steps, len(marks), written, zlib.crc32(tokens.tobytes()))
        check = zlib.crc32(body, zlib.crc32(struct.pack(_HEADER, *fields, 0)[:-4]))
        return struct.pack(_HEADER, *fields, check) + body

    def decode(self, block: bytes, mark: int | None = None) -> np.ndarray:
        """All tokens of a block, or those from one mark to the next. Damage is an error."""
        magic, count, lanes, mark_steps, n_marks, n_words, token_crc, check = struct.unpack_from(_HEADER, block)
        body = memoryview(block)[_HEADER_SIZE :]
        if magic != b"RAN1" or zlib.crc32(body, zlib.crc32(block[: _HEADER_SIZE - 4])) != check:
            raise ValueError("damaged block")
        size = 8 * lanes + 4
        stream = np.frombuffer(body, dtype="<u4", count=n_words, offset=n_marks * size)
        steps = -(-count // lanes)
        first, last = (0, steps) if mark is None else (mark * mark_steps, min(steps, (mark + 1) * mark_steps))
        if not count:
            return np.empty(0, dtype=np.uint32)
        at = size * (first // mark_steps)
        state = np.frombuffer(body, dtype="<u8", count=lanes, offset=at).astype(np.uint64)
        (word,) = struct.unpack_from("<I", body, at + 8 * lanes)
        out = np.empty(min(count, last * lanes) - first * lanes, dtype=np.uint32)
        low_bits = np.uint64((1 << int(self.precision)) - 1)
        for step in range(first, last):
            width = min(lanes, count - step * lanes)
            x = state[:width]
            slot = x & low_bits
            symbols = self.slots[slot]
            out[(step - first) * lanes : (step - first) * lanes + width] = symbols
            x[:] = self.freq[symbols] * (x >> self.precision) + slot - self.start[symbols]
            short = np.flatnonzero(x < _LOW)
            if len(short):
                x[short] = (x[short] << np.uint64(32)) | stream[word : word + len(short)]
                word += len(short)
        if mark is None and zlib.crc32(out.astype("<u4").tobytes()) != token_crc:
            raise ValueError("damaged tokens")
        return out

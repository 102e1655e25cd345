"""FNV-1a 64-bit hashes of text and integers.

The result is the unsigned 64-bit hash read as a signed ``bigint``. Null in gives null out, and a
negative integer hashes its two's-complement bytes.

* Integers have a fixed number of bytes, so the byte loop is written out as plain column arithmetic
  and compiles into whole-stage code.
* Text has any number of bytes. Spark evaluates a fold over a byte array row by row without code
  generation, about a microsecond per byte, so the default goes through Arrow batches and numpy
  instead: one vector step per byte position over all rows of the batch that are that long.
  :func:`fnv_hash_str_native` is the same hash without a Python worker.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# FNV-1a 64-bit parameters. The prime is 2**40 + 435.
FNV64_BASIS = 0xCBF29CE484222325
FNV64_PRIME = 0x100000001B3
FNV64_PRIME_LOW = 435
LOW_32_BITS = 0xFFFFFFFF
ALL_64_BITS = 0xFFFFFFFFFFFFFFFF

# Rows left in a batch from which on bytes are folded row by row.
FEW_ROWS = 16


def _fnv_of_bytes(low_byte_at: Callable[[int], Column], width: int) -> Column:
    """Fold ``width`` byte columns into a hash.

    The 64-bit state is kept as two 32-bit halves in ``bigint`` columns, because a full 64-bit
    product overflows and ANSI arithmetic raises on that. Multiplying by ``2**40 + 435`` is
    ``low * 435`` with its carry, plus ``high * 435``, plus ``low`` shifted into the high half.
    """
    mask = F.lit(LOW_32_BITS)
    high = F.lit(FNV64_BASIS >> 32).cast("bigint")
    low = F.lit(FNV64_BASIS & LOW_32_BITS).cast("bigint")
    for position in range(width):
        mixed = low.bitwiseXOR(low_byte_at(position))
        product = mixed * FNV64_PRIME_LOW
        carry = F.shiftrightunsigned(product, 32)
        high = (high * FNV64_PRIME_LOW + carry + F.shiftleft(mixed, 8)).bitwiseAND(mask)
        low = product.bitwiseAND(mask)
    return F.shiftleft(high, 32).bitwiseOR(low)


def _little_endian(value: Column, sql_type: str) -> Callable[[int], Column]:
    typed = value.cast(sql_type)
    return lambda position: F.shiftright(typed, 8 * position).bitwiseAND(F.lit(255)).cast("bigint")


def fnv_hash_int4(value: Column) -> Column:
    """Hash of the four little-endian bytes of an ``int``."""
    return _fnv_of_bytes(_little_endian(value, "int"), 4)


def fnv_hash_int8(value: Column) -> Column:
    """Hash of the eight little-endian bytes of a ``bigint``."""
    return _fnv_of_bytes(_little_endian(value, "bigint"), 8)


@F.arrow_udf(T.LongType())
def fnv_hash_str(values: pa.Array) -> pa.Array:
    """Hash of the UTF-8 bytes of a string, by Arrow batch."""
    import numpy as np

    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    values = values.cast(pa.large_binary())
    count = len(values)
    if count == 0:
        return pa.array([], pa.int64())
    offset_buffer, byte_buffer = values.buffers()[1:]
    bounds = np.frombuffer(offset_buffer, np.int64)[values.offset : values.offset + count + 1]
    data = np.frombuffer(byte_buffer or b"\0", np.uint8)
    lengths = np.diff(bounds)
    # longest first, so the rows still active at a byte position are a prefix
    order = np.argsort(-lengths, kind="stable")
    starts, ordered = bounds[:-1][order], lengths[order]
    state = np.full(count, FNV64_BASIS, np.uint64)
    prime = np.uint64(FNV64_PRIME)
    # number of rows longer than each position, until few are left: from there on plain integers
    # per row are faster than very short vectors
    few = min(FEW_ROWS, count)
    active = count
    for position in range(int(ordered[few - 1])):
        while ordered[active - 1] <= position:
            active -= 1
        state[:active] = (state[:active] ^ data[starts[:active] + position]) * prime
    for row in range(few):
        value = int(state[row])
        for byte in data[starts[row] + ordered[few - 1] : starts[row] + ordered[row]].tobytes():
            value = ((value ^ byte) * FNV64_PRIME) & ALL_64_BITS
        state[row] = value
    hashes = np.empty_like(state)
    hashes[order] = state
    missing = np.asarray(values.is_null().to_numpy(zero_copy_only=False))
    return pa.array(hashes.view(np.int64), mask=missing)


def fnv_hash_str_native(value: Column) -> Column:
    """Hash of the UTF-8 bytes of a string without a Python worker.

    Decoding the bytes as Latin-1 makes one character of each byte, whose code point is the byte.
    """
    latin = F.decode(F.encode(value, "UTF-8"), "ISO-8859-1")
    characters = F.filter(F.split(latin, ""), lambda c: c != F.lit(""))

    def step(state: Column, character: Column) -> Column:
        mixed = state.bitwiseAND(F.lit(LOW_32_BITS)).bitwiseXOR(F.ascii(character).cast("bigint"))
        product = mixed * FNV64_PRIME_LOW
        high = F.shiftrightunsigned(state, 32) * FNV64_PRIME_LOW
        high = high + F.shiftrightunsigned(product, 32) + F.shiftleft(mixed, 8)
        return F.shiftleft(high, 32).bitwiseOR(product.bitwiseAND(F.lit(LOW_32_BITS)))

    basis = F.lit(FNV64_BASIS - 2**64).cast("bigint")
    return F.aggregate(characters, basis, step)


def _fnv_sql(argument: str, width: int) -> str:
    """SQL text of the integer hash, for the SQL functions."""
    high, low = str(FNV64_BASIS >> 32) + "L", str(FNV64_BASIS & LOW_32_BITS) + "L"
    for position in range(width):
        mixed = f"({low} ^ cast(shiftright({argument}, {8 * position}) & 255 as bigint))"
        product = f"({mixed} * {FNV64_PRIME_LOW})"
        carry = f"shiftrightunsigned({product}, 32)"
        high = f"(({high} * {FNV64_PRIME_LOW} + {carry} + shiftleft({mixed}, 8)) & {LOW_32_BITS}L)"
        low = f"({product} & {LOW_32_BITS}L)"
    return f"shiftleft({high}, 32) | {low}"


def register_hash_functions(spark: SparkSession) -> None:
    """Make ``fnv_hash_str``, ``fnv_hash_int4`` and ``fnv_hash_int8`` callable from SQL."""
    for name, sql_type, width in (("fnv_hash_int4", "INT", 4), ("fnv_hash_int8", "BIGINT", 8)):
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(value {sql_type}) RETURNS BIGINT "
            f"RETURN {_fnv_sql('value', width)}"
        )
    spark.udf.register("fnv_hash_str", fnv_hash_str)

"""64-bit row hashes of text columns, equal to those of pandas.

``pandas.util.hash_pandas_object`` hashes each string with SipHash-2-4 over its UTF-8 bytes, mixes the
64 bits, and combines the columns of a row. ``pair_hash`` has it do so, an Arrow batch at a time.

``siphash`` and ``mixed`` are the hash of one text as built-in expressions, for short texts or where no
Python may run: they are interpreted, block by block. All of it is integer arithmetic modulo 2**64. Spark's
sums and products of longs may raise on overflow, so both are made of halves that cannot. A step of SipHash
uses each value twice, so every step is bound once by ``transform`` over an array of one struct; written
out in one expression they would double each time.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------------
# Fixed values (must equal those of pandas and of SipHash-2-4)
KEY = b"0123456789123456"
SIP_START = b"somepseudorandomlygeneratedbytes"
MIX = ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, None))
# ---------------------------------------------------------------------------------------------

_LOW = 0xFFFFFFFF


def _long(value: int) -> Column:
    """An unsigned 64-bit number as a long."""
    return F.lit(value - (1 << 64) if value >> 63 else value).cast("long")


def sum64(*terms: Column) -> Column:
    """The sum of a few longs modulo 2**64."""
    low = reduce(add, (t.bitwiseAND(F.lit(_LOW)) for t in terms))
    high = reduce(add, (F.shiftrightunsigned(t, 32) for t in terms)) + F.shiftrightunsigned(low, 32)
    return F.shiftleft(high, 32).bitwiseOR(low.bitwiseAND(F.lit(_LOW)))


def times64(a: Column, factor: int) -> Column:
    """``a`` (a column, as it is used several times) by a constant, from 16 bits of it and 32 of the
    constant at a time."""
    terms = []
    for i in range(4):
        part = F.shiftrightunsigned(a, 16 * i).bitwiseAND(F.lit(0xFFFF))
        for j in range(2):
            if 16 * i + 32 * j < 64:
                terms.append(F.shiftleft(part * F.lit(factor >> 32 * j & _LOW), 16 * i + 32 * j))
    return sum64(*terms)


def _rotate(a: Column, by: int) -> Column:
    return F.shiftleft(a, by).bitwiseOR(F.shiftrightunsigned(a, 64 - by))


def _then(state: Column, step: Callable[[Column], Column]) -> Column:
    """``step`` of a value that is computed once."""
    return F.get(F.transform(F.array(state), step), 0)


def _half_round(s: Column, first: int, second: int, third: int) -> Column:
    """v0 += v1, v2 += v3, rotations and exclusive ors; v0 and v2 are to change places afterwards."""
    v0, v2 = sum64(s.v0, s.v1), sum64(s.v2, s.v3)
    v1, v3 = _rotate(s.v1, first).bitwiseXOR(v0), _rotate(s.v3, second).bitwiseXOR(v2)
    return F.struct(v2.alias("v0"), v1.alias("v1"), _rotate(v0, third).alias("v2"), v3.alias("v3"))


def _rounds(state: Column, n: int) -> Column:
    # the first half ends with v0 and v2 exchanged, the second half undoes it
    for _ in range(n):
        state = _then(state, lambda s: _half_round(s, 13, 16, 32))
        state = _then(state, lambda s: _half_round(s, 17, 21, 32))
    return state


def siphash(text: Column) -> Column:
    """SipHash-2-4 of a text's UTF-8 bytes (null: null), as a long."""
    keys = [int.from_bytes(KEY[i : i + 8], "little") for i in (0, 8)]
    starts = [int.from_bytes(SIP_START[i : i + 8], "big") for i in range(0, 32, 8)]
    first = F.struct(*(_long(v ^ keys[i % 2]).alias(f"v{i}") for i, v in enumerate(starts)))
    size = F.octet_length(text)
    # all bytes in reverse order, so that every block of eight is a big-endian number
    backwards = F.unhex(F.reverse(F.regexp_replace(F.hex(F.encode(text, "UTF-8")), "(.)(.)", "$2$1")))
    whole = F.floor(size / 8).cast("int")

    def block(data: Column, i: Column) -> Column:
        return F.conv(F.hex(F.substring(data, size - 8 * i - 7, F.lit(8))), 16, -10).cast("long")

    def absorbed(s: Column, m: Column) -> Column:
        before = F.struct(s.v0.alias("v0"), s.v1.alias("v1"), s.v2.alias("v2"), s.v3.bitwiseXOR(m).alias("v3"))
        after = _rounds(before, 2)
        return _then(after, lambda t: F.struct(t.v0.bitwiseXOR(m).alias("v0"), t.v1.alias("v1"), t.v2.alias("v2"), t.v3.alias("v3")))

    def hashed(data: Column) -> Column:
        # the last block has the bytes that are left and, on top, the length
        rest = F.concat(F.lit("0"), F.hex(F.substring(data, F.lit(1), size - 8 * whole)))
        last = F.conv(rest, 16, -10).cast("long").bitwiseOR(F.shiftleft(size.cast("long"), 56))
        blocks = F.when(whole > 0, F.transform(F.sequence(F.lit(0), whole - 1), lambda i: block(data, i))).otherwise(F.array().cast("array<bigint>"))
        state = F.aggregate(F.concat(blocks, F.array(last)), first, absorbed)
        return _then(_rounds(_then(state, _ended), 4), lambda s: s.v0.bitwiseXOR(s.v1).bitwiseXOR(s.v2).bitwiseXOR(s.v3))

    return _then(backwards, hashed)


def _ended(s: Column) -> Column:
    return F.struct(s.v0.alias("v0"), s.v1.alias("v1"), s.v2.bitwiseXOR(F.lit(0xFF).cast("long")).alias("v2"), s.v3.alias("v3"))


def mixed(h: Column) -> Column:
    for shift, factor in MIX:
        h = _then(h, _shifted(shift))
        if factor is not None:
            h = _then(h, _multiplied(factor))
    return h


# functions of one argument: a second one would be taken for the place in the array
def _shifted(by: int) -> Callable[[Column], Column]:
    return lambda x: x.bitwiseXOR(F.shiftrightunsigned(x, by))


def _multiplied(factor: int) -> Callable[[Column], Column]:
    return lambda x: times64(x, factor)


def pair_hash(*columns: str) -> Column:
    """The hash of a row of text columns, an unsigned 64-bit number as a long (null where one is null)."""

    @F.arrow_udf("long")
    def row_hash(row: pa.Array) -> pa.Array:
        texts = row.flatten()
        frame = pd.DataFrame({i: x.fill_null("").to_numpy(zero_copy_only=False) for i, x in enumerate(texts)}, dtype=object)
        hashes = pd.util.hash_pandas_object(frame, index=False, categorize=False).to_numpy().view(np.int64)
        return pa.array(hashes, mask=np.any([x.is_null().to_numpy(zero_copy_only=False) for x in texts], axis=0))

    return row_hash(F.struct(*columns))


def unit_interval(h: Column) -> Column:
    """An unsigned 64-bit number, as a long, divided by 2**64: what numpy makes of it as a double."""

    def share(x: Column) -> Column:
        # the upper 63 bits with the last one kept if it is set round like the whole number does
        halved = F.shiftrightunsigned(x, 1).bitwiseOR(x.bitwiseAND(F.lit(1)))
        return F.when(x < 0, 2.0 * halved.cast("double")).otherwise(x.cast("double")) / F.lit(2.0**64)

    return _then(h, share)

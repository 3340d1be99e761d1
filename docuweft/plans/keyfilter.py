"""A Bloom filter over keys, built and asked in expressions: cuts a large table before it is shuffled for a join.

The bits are set by an aggregate that is partial in each task, so that no more
than the filter itself moves, and reach the other table as a scalar subquery.
A filter may let rows pass that have no key; the join after it decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits set for a key, bits held for a key, and the size of a filter at most (4 MB).
HASHES = 3
BITS_PER_KEY = 16
MOST_BITS = 1 << 25
#: A filter with fewer bits for a key than this lets most rows pass and is not made.
LEAST_BITS_PER_KEY = 4


def filter_bits(keys: int) -> int | None:
    """Bits of a filter for so many keys, a power of two; none where it would be of no use."""
    if keys * LEAST_BITS_PER_KEY > MOST_BITS:
        return None
    return min(MOST_BITS, 1 << max(10, (keys * BITS_PER_KEY - 1).bit_length()))


def _alike(one: T.DataType, other: T.DataType) -> bool:
    return isinstance(one, T.NumericType) and isinstance(other, T.NumericType) or one == other


def _positions(df: DataFrame, columns: Sequence[str], bits: int) -> list[Column]:
    """Where the bits of a row's key stand; numbers that are equal hash alike, whatever their types."""
    cells = [F.col(f"`{c}`").cast("double") + F.lit(0.0) if isinstance(df.schema[c].dataType, T.NumericType) else F.col(f"`{c}`") for c in columns]
    return [F.xxhash64(F.lit(n), *cells).bitwiseAND(F.lit(bits - 1)) for n in range(HASHES)]


def key_bits(keys: DataFrame, columns: Sequence[str], bits: int) -> DataFrame:
    """One row, ``bits``: the filter of ``keys`` as an array of longs."""
    places = keys.select(F.explode(F.array(*_positions(keys, columns, bits))).alias("at"))
    words = places.select(F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("set"))
    blank = keys.sparkSession.range(0, bits >> 6, 1, 1).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("set"))
    whole = words.groupBy("word").agg(F.bit_or("set").alias("set")).unionByName(blank).groupBy("word").agg(F.bit_or("set").alias("set"))
    return whole.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "set"))), lambda w: w["set"]).alias("bits"))


def may_hold(rows: DataFrame, columns: Sequence[str], keys: DataFrame, key_columns: Sequence[str], bits: int | None) -> Column | None:
    """Whether a row's ``columns`` may be one of ``keys``, false only where they are none; no column where types do not compare or no filter is made."""
    pairs = zip(columns, key_columns, strict=True)
    if bits is None or not all(_alike(rows.schema[a].dataType, keys.schema[b].dataType) for a, b in pairs):
        return None
    words = key_bits(keys, key_columns, bits).scalar()
    held = F.lit(True)
    for at in _positions(rows, columns, bits):
        word = F.get(words, F.shiftright(at, 6).cast("int"))
        held &= word.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))) != 0
    return held


def cut(rows: DataFrame, columns: Sequence[str], keys: DataFrame, key_columns: Sequence[str], bits: int | None) -> DataFrame:
    """The rows whose ``columns`` may be one of ``keys``; all of them where there is no telling.

    No row with a key is lost.  Rows with a null among ``columns`` may go:
    they equal nothing.
    """
    held = may_hold(rows, columns, keys, key_columns, bits)
    return rows if held is None else rows.filter(held)

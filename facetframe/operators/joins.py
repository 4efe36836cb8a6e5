"""Filtering a table by a set of keys, without assuming how many keys there are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType, VariantType

BROADCAST_BYTES = 64 * 1024 * 1024
MOST_BITS = 1 << 23


def fits_broadcast(keys: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Measure the keys with one aggregate and compare their size with the limit.

    Nested keys have no size that is cheap to measure and never fit.
    """
    nested = (ArrayType, MapType, StructType, VariantType)
    if any(isinstance(f.dataType, nested) for f in keys.schema.fields):
        return False
    sized = [
        F.coalesce(F.sum(F.octet_length(F.col(f"`{f.name}`"))), F.lit(0))
        for f in keys.schema.fields
        if isinstance(f.dataType, (StringType, BinaryType))
    ]
    measured = keys.agg(F.count(F.lit(1)), *sized).first()
    return measured[0] * 16 * (len(keys.columns) + 1) + sum(measured[1:]) <= limit


def filter_by_keys(
    base: DataFrame, keys: DataFrame, on: Sequence[str], how: str, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """``left_semi`` or ``left_anti`` join of the base with distinct keys.

    Keys measured below the limit are broadcast, so the base is only scanned. Beyond it both
    sides are shuffled, and adaptive execution splits the partitions of the base that one key makes
    large.
    """
    sent = F.broadcast(keys) if limit > 0 and fits_broadcast(keys, limit) else keys
    return base.join(sent, list(on), how)


def _slots(value: Column, bits: int) -> list[Column]:
    """Two places of a value in a filter of so many bits."""
    return [F.pmod(F.xxhash64(value), F.lit(bits)), F.pmod(F.xxhash64(value, F.lit(1)), F.lit(bits))]


def key_filter(keys: DataFrame, bits: int) -> Column:
    """A bloom filter of the first column, as one value of ``bits`` / 64 words: a scalar subquery."""
    slots = keys.select(F.explode(F.array(*_slots(F.col(f"`{keys.columns[0]}`"), bits))).alias("s"))
    place = F.col("s").bitwiseAND(F.lit(63)).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
    words = slots.select(F.shiftright("s", 6).alias("word"), one.alias("bits"))
    # Every word is there once at least, so the words in order are an array by position.
    zero = F.lit(0).cast("bigint").alias("bits")
    empty = keys.sparkSession.range(bits // 64).select(F.col("id").alias("word"), zero)
    filled = words.unionByName(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    listed = F.sort_array(F.collect_list(F.struct("word", "bits")))
    return filled.agg(F.transform(listed, lambda x: x["bits"]).alias("words")).scalar()


def in_keys(df: DataFrame, path: str, keys: DataFrame) -> DataFrame:
    """Rows whose value at the path is in the first column of ``keys``, however many keys there are.

    Equals ``path IN (keys)`` as a filter: nulls match nothing, repeated keys count once. A bloom filter
    of about ten bits a key, made when the query runs, is applied to the rows as they are read; the exact
    semi join meets what is left. Beyond ``MOST_BITS`` (a megabyte), where a filter would no longer be small,
    the semi join is alone.
    """
    name, value = keys.columns[0], F.col(path)
    kind = df.select(value).schema[0].dataType
    known = keys.select(F.col(f"`{name}`").alias("__key")).na.drop()
    if known.schema[0].dataType != kind:
        raise TypeError(f"{path} is {kind.simpleString()}, the keys are {known.schema[0].dataType.simpleString()}")
    bits, n_keys = 64, known.count()
    while bits < 10 * n_keys and bits <= MOST_BITS:
        bits *= 2
    rows = df
    if bits <= MOST_BITS:
        words = key_filter(known, bits)
        for slot in _slots(value, bits):
            word = F.get(words, F.shiftright(slot, 6).cast("int"))
            rows = rows.filter(F.getbit(word, slot.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return rows.join(known, value == F.col("__key"), "left_semi")

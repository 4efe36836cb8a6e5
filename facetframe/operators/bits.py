"""Postings as words of bits: one row per term and 64 consecutive keys.

A term that many rows have costs one bit a row instead of a row of its own, a rare one costs a row, as in
plain postings. The words of a term are made before anything is shuffled, so building moves words, not
occurrences. Conditions are evaluated by one grouping of the words they name: AND, OR and NOT are bit
operations on the words of the same 64 keys, so no lists of keys are joined, and a count is a sum of bits.

The row key must be integral, unique and not null; keys that are close together (numbered rows) make full
words, keys scattered at random one word each. Uniqueness is checked on the words of all rows, which have a
bit for every key and the number of rows.

Conditions follow SQL: each has rows where it is true and rows where it is false, and ``~`` swaps them, so a
row whose path is null, or whose array lacks the value but has a null element, is in neither.

    is_F = bits.term("attrs.status", "F")
    bits.count_rows(words, is_F & ~bits.term("flags", "R"))
    bits.facet_where(words, "flags", is_F | bits.present("attrs.`tier.1`"))
    bits.rows_where(table, words, "o_orderkey", is_F)
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType

from facetframe.functions import paths as P
from facetframe.operators.postings import (
    EXISTS,
    HAS_NULL,
    INTEGRAL,
    ORDER,
    TYPED,
    _posted,
    _term,
    at_path,
    atomic_type,
    marked,
    posted_type,
    postings,
    term_arrays,
    typed_value,
)
from facetframe.operators.search import _comparable, _is_term

ROWS = "_rows"
TASK_ROWS = 250_000
COLUMNS = ["field", "path", "value", *TYPED, "word", "bits", "n"]
Words = Callable[[object, Column], Column]


def _word(key: Column) -> Column:
    return F.shiftright(key.cast("bigint"), 6)


def _bit(key: Column) -> Column:
    place = key.cast("bigint").bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def bit_postings(
    df: DataFrame, key: str, paths: Sequence[str], partitions: int | None = None
) -> DataFrame:
    """The words of every term, and of all rows (field ``_rows``), with the number ``n`` of keys.

    With ``partitions`` the rows are shuffled by word into so many tasks.
    """
    if not isinstance(P.path_type(df, key), INTEGRAL):
        raise TypeError(f"bits need an integral key, {key} is {P.path_type(df, key).simpleString()}")
    mark = F.array(_term(ROWS, F.lit(""), None, StringType()))
    terms = F.concat(mark, *term_arrays(df, paths)).alias("terms")
    posted = [P.quoted(c) for c in dict.fromkeys(P.steps(p)[0] for p in paths)]
    rows = df.select(*posted, F.col(key).alias("__key"), _word(F.col(key)).alias("__word"))
    if partitions is not None:
        # The rows of a word meet here, so the grouping needs no shuffle after it.
        rows = rows.repartition(partitions, "__word")
    flat = rows.select("__key", "__word", terms).select("__key", "__word", F.inline("terms"))
    words = flat.groupBy("field", "path", "value", *TYPED, "__word").agg(
        F.bit_or(_bit(F.col("__key"))).alias("bits"), F.count(F.lit(1)).alias("n")
    )
    words = words.withColumnRenamed("__word", "word")
    metadata = postings(df, key, paths, key_is_checked=True).schema["path"].metadata
    return words.select(*COLUMNS).withMetadata("path", metadata)


def write_bit_postings(df: DataFrame, key: str, paths: Sequence[str], path: str) -> None:
    """Write the words of a table's terms, sorted by term, one directory per field.

    The rows are counted, then one scan of the posted paths makes the words of at most about ``TASK_ROWS``
    rows in a task. Then the words of all rows are checked for keys that repeat or are null,
    and existence is added for atomic paths, from the words just written.
    """
    spark = df.sparkSession

    def save(words: DataFrame, mode: str) -> None:
        ordered = words.sortWithinPartitions(*ORDER, "word")
        ordered.write.mode(mode).partitionBy("field").parquet(path)

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = bit_postings(df, key, paths, max(tasks, -(-df.select(key).count() // TASK_ROWS)))
    save(words, "overwrite")
    written = spark.read.schema(words.schema).parquet(path).select(*COLUMNS)
    rows = written.filter(F.col("field") == ROWS)
    if rows.filter(F.col("word").isNull() | (F.bit_count("bits") != F.col("n"))).head() is not None:
        raise ValueError(f"{key} must be unique and not null")
    marked_paths = written.filter(F.col("field") == EXISTS).select("path").distinct()
    atomic = written.filter(~F.col("field").isin(EXISTS, HAS_NULL, ROWS)).join(marked_paths, "path", "left_anti")
    exists = atomic.groupBy("path", "word").agg(F.bit_or("bits").alias("bits"))
    exists = exists.withColumns(
        {
            "field": F.lit(EXISTS),
            "n": F.bit_count("bits").cast("bigint"),
            **{c: F.lit(None).cast(written.schema[c].dataType) for c in ("value", *TYPED)},
        }
    )
    exists = exists.select(*COLUMNS).withMetadata("path", written.schema["path"].metadata)
    save(exists, "append")


def read_bit_postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*COLUMNS)


class Condition:
    """A condition on rows: ``&``, ``|`` and ``~`` as in SQL."""

    def __and__(self, other: Condition) -> Condition:
        return _Both(self, other)

    def __or__(self, other: Condition) -> Condition:
        return ~(~self & ~other)

    def __invert__(self) -> Condition:
        return _Not(self)

    def true(self, words: DataFrame, of: Words) -> Column:
        raise TypeError("conditions are made by term, between, prefix and present")

    def false(self, words: DataFrame, of: Words) -> Column:
        raise TypeError("conditions are made by term, between, prefix and present")


def _marked(kind: str, path: str, of: Words) -> Column:
    return of((kind, P.identity(path)), marked(kind, path))


@dataclass(frozen=True)
class _Both(Condition):
    a: Condition
    b: Condition

    def true(self, words, of):
        return self.a.true(words, of).bitwiseAND(self.b.true(words, of))

    def false(self, words, of):
        return self.a.false(words, of).bitwiseOR(self.b.false(words, of))


@dataclass(frozen=True)
class _Not(Condition):
    a: Condition

    def true(self, words, of):
        return self.a.false(words, of)

    def false(self, words, of):
        return self.a.true(words, of)


@dataclass(frozen=True)
class _Terms(Condition):
    """Some term at the path matches."""

    path: str
    matches: Callable[[DataFrame], Column]
    exact: bool = False

    def true(self, words, of):
        return of(self, self.matches(words))

    def false(self, words, of):
        out = self.true(words, of)
        if isinstance(posted_type(words, self.path), ArrayType):
            out = out.bitwiseOR(_marked(HAS_NULL, self.path, of))
        return _marked(EXISTS, self.path, of).bitwiseAND(F.bitwise_not(out))


@dataclass(frozen=True)
class _Present(Condition):
    path: str

    def true(self, words, of):
        posted_type(words, self.path)
        return _marked(EXISTS, self.path, of)

    def false(self, words, of):
        return of(ROWS, F.col("field") == ROWS).bitwiseAND(F.bitwise_not(self.true(words, of)))


def term(path: str, value: Any) -> Condition:
    """The value at the path, an element of its array, or a key of its map equals the value."""
    return _Terms(path, lambda words: _is_term(words, path, value), exact=True)


def between(path: str, low: Any = None, high: Any = None) -> Condition:
    """Some term lies between the inclusive bounds; None leaves a side open."""

    def matches(words: DataFrame) -> Column:
        dtype, sides = atomic_type(posted_type(words, path)), [at_path(path)]
        for bound, test in ((low, lambda a, b: a >= b), (high, lambda a, b: a <= b)):
            if bound is not None:
                sides.append(test(*_comparable(dtype, bound)))
        return reduce(lambda a, b: a & b, sides)

    return _Terms(path, matches)


def prefix(path: str, text: str) -> Condition:
    """Some string term starts with the text."""

    def matches(words: DataFrame) -> Column:
        if not isinstance(atomic_type(posted_type(words, path)), StringType):
            raise TypeError(f"prefixes need strings at {path}")
        return at_path(path) & F.col("value").startswith(text)

    return _Terms(path, matches)


def present(path: str) -> Condition:
    """The path is not null."""
    return _Present(path)


def words_where(words: DataFrame, condition: Condition) -> DataFrame:
    """``word`` and ``bits`` of the rows for which the condition is true.

    One scan with the conditions on terms pushed to the reader, one grouping by word in which bits are
    combined before the shuffle.
    """
    tests: dict[object, tuple[str, Column]] = {}

    def of(what: object, test: Column) -> Column:
        name, _ = tests.setdefault(what, (f"t{len(tests)}", test))
        return F.coalesce(F.col(name), F.lit(0).cast("bigint"))

    result = condition.true(words, of)
    if isinstance(condition, _Present) or (isinstance(condition, _Terms) and condition.exact):
        # One term has each word once.
        (_, test), = tests.values()
        return words.filter(test).select("word", "bits")
    wanted = reduce(lambda a, b: a | b, (test for _, test in tests.values()))
    columns = [F.bit_or(F.when(test, F.col("bits"))).alias(name) for name, test in tests.values()]
    grouped = words.filter(wanted).groupBy("word").agg(*columns)
    return grouped.select("word", result.alias("bits")).filter(F.col("bits") != 0)


def count_rows(words: DataFrame, condition: Condition) -> DataFrame:
    """``n``: the number of rows for which the condition is true, without reading the table."""
    bits = words_where(words, condition).agg(F.sum(F.bit_count("bits")).alias("n"))
    return bits.select(F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def facet_where(words: DataFrame, path: str, condition: Condition | None = None) -> DataFrame:
    """``(value, n)``: rows per distinct value of the path among those the condition is true for.

    Equals the deduplicated facet after the filter, without its null bucket. The words of the path meet
    those of the condition by number, 64 rows at a time.
    """
    value = typed_value(atomic_type(posted_type(words, path)))
    found = words.filter(at_path(path))
    counted = F.col("bits")
    if condition is not None:
        chosen = words_where(words, condition).withColumnRenamed("bits", "chosen")
        found = found.join(chosen, "word")
        counted = counted.bitwiseAND(F.col("chosen"))
    counts = found.groupBy("value", *TYPED).agg(F.sum(F.bit_count(counted)).cast("bigint").alias("n"))
    return counts.filter(F.col("n") > 0).select(value.alias("value"), "n")


def rows_where(base: DataFrame, words: DataFrame, key: str, condition: Condition) -> DataFrame:
    """The rows of the table for which the condition is true, by a semi join of 64 keys at a time."""
    chosen = words_where(words, condition).select(
        F.col("word").alias("__word"), F.col("bits").alias("__bits")
    )
    same = (_word(F.col(key)) == F.col("__word")) & (
        F.col("__bits").bitwiseAND(_bit(F.col(key))) != 0
    )
    return base.join(chosen, same, "left_semi")


def keys_where(words: DataFrame, condition: Condition) -> DataFrame:
    """``key`` of every row for which the condition is true."""
    place = F.explode(F.sequence(F.lit(0), F.lit(63))).alias("place")
    spread = words_where(words, condition).select("word", "bits", place)
    kept = spread.filter(F.getbit("bits", "place") == 1)
    return kept.select((F.col("word") * 64 + F.col("place")).alias("key"))


def posted_paths(words: DataFrame) -> list[str]:
    return _posted(words).names

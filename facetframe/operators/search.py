"""Lookups of rows through postings: exact, combined, negated, prefix, range and existence.

A lookup is a plan and starts no job: the keys of the postings that match, then a semi or anti join
of the base with them. It equals a filter of the base on the path, as of when the postings were
written. Terms and bounds are compared with the posted value in the type Spark would choose for that
filter; nothing is cast down to the type of the path. A path that was not posted is refused.

No hint is given: from the sizes it finds when it runs, adaptive execution broadcasts few keys, joins
many, and splits what is skewed. Tables from ``save_searchable`` join without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    MapType,
    StringType,
)

from facetframe.functions import paths as P
from facetframe.operators.postings import (
    EXISTS,
    FLOATING,
    HAS_NULL,
    INTEGRAL,
    at_path,
    atomic_type,
    marked,
    posted_type,
    typed_value,
)

Term = tuple[str, Any]


def _comparable(dtype: DataType, literal: Any) -> tuple[Column, Column]:
    """A column of the postings and a literal that compare like the path and the value.

    The stored column itself is used where Spark would widen both alike, since the reader can skip
    row groups by it; otherwise the value is brought back to its own type.
    """
    if isinstance(dtype, FLOATING):
        return F.col("num"), F.lit(literal)
    if isinstance(dtype, INTEGRAL) and not isinstance(dtype, BooleanType):
        if isinstance(literal, (int, float)) and not isinstance(literal, bool):
            return F.col("whole"), F.lit(literal)
    if isinstance(dtype, DateType) and isinstance(literal, date) and not isinstance(literal, datetime):
        return F.col("whole"), F.unix_date(F.lit(literal)).cast("bigint")
    return typed_value(dtype), F.lit(literal)


def _is_term(postings: DataFrame, path: str, value: Any) -> Column:
    dtype = atomic_type(posted_type(postings, path))
    stored, literal = _comparable(dtype, value)
    return at_path(path) & (stored == literal)


def _select(base: DataFrame, keys: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    return base.join(keys.select(F.col("key").alias(key)), key, how).select(
        *[P.quoted(c) for c in base.columns]
    )


def lookup_keys(postings: DataFrame, path: str, value: Any) -> DataFrame:
    """``key`` of every row with the exact term. Enough to count hits, without reading the base."""
    return postings.filter(_is_term(postings, path, value)).select("key")


def lookup(base: DataFrame, postings: DataFrame, key: str, path: str, value: Any) -> DataFrame:
    """Base rows with the exact term: the value at the path, an array element, or a map key."""
    return _select(base, lookup_keys(postings, path, value), key)


def _rarest_first(terms: Sequence[Term], counts: DataFrame | None) -> list[Term]:
    """The terms by their stored counts; one row per term is read, and none without counts."""
    if counts is None:
        return list(terms)
    tagged = [
        counts.filter(_is_term(counts, p, v)).agg(F.lit(i).alias("i"), F.sum("n").alias("n"))
        for i, (p, v) in enumerate(terms)
    ]
    found = {r["i"]: r["n"] or 0 for r in reduce(DataFrame.unionByName, tagged).collect()}
    return [terms[i] for i in sorted(found, key=found.get)]


def lookup_all(
    base: DataFrame,
    postings: DataFrame,
    key: str,
    terms: Sequence[Term],
    *,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Base rows with every one of the terms.

    The key lists are intersected one after another, from the rarest where ``counts`` (stored
    ``term_counts``) are given, and the base meets only what is left.
    """
    lists = [lookup_keys(postings, p, v) for p, v in _rarest_first(terms, counts)]
    return _select(base, reduce(lambda a, b: a.join(b, "key", "left_semi"), lists), key)


def lookup_any(base: DataFrame, postings: DataFrame, key: str, terms: Sequence[Term]) -> DataFrame:
    """Base rows with at least one of the terms."""
    wanted = reduce(lambda a, b: a | b, [_is_term(postings, p, v) for p, v in terms])
    return _select(base, postings.filter(wanted), key)


def lookup_not(base: DataFrame, postings: DataFrame, key: str, path: str, value: Any) -> DataFrame:
    """Base rows for which the term test is false: the path is not null, lacks the term and, for
    an array, has no null element (which would make SQL's answer unknown)."""
    out = postings.filter(_is_term(postings, path, value) | marked(HAS_NULL, path))
    return _select(exists(base, postings, key, path), out, key, "left_anti")


def existing_keys(postings: DataFrame, path: str) -> DataFrame:
    """``key`` of every row whose path is not null, without reading the base."""
    nested = isinstance(posted_type(postings, path), (ArrayType, MapType))
    return postings.filter(marked(EXISTS, path) if nested else at_path(path)).select("key")


def exists(base: DataFrame, postings: DataFrame, key: str, path: str) -> DataFrame:
    """Base rows whose path is not null."""
    return _select(base, existing_keys(postings, path), key)


def missing(base: DataFrame, postings: DataFrame, key: str, path: str) -> DataFrame:
    """Base rows whose path is null: a missing key, a null value or a null parent."""
    return _select(base, existing_keys(postings, path), key, "left_anti")


def lookup_prefix(
    base: DataFrame, postings: DataFrame, key: str, path: str, prefix: str
) -> DataFrame:
    """Base rows with some string at the path that starts with the prefix."""
    dtype = atomic_type(posted_type(postings, path))
    if not isinstance(dtype, StringType):
        raise TypeError(f"prefixes need strings, {path} has {dtype.simpleString()}")
    return _select(base, postings.filter(at_path(path) & F.col("value").startswith(prefix)), key)


def lookup_range(
    base: DataFrame, postings: DataFrame, key: str, path: str, low: Any = None, high: Any = None
) -> DataFrame:
    """Base rows with some term at the path between the inclusive bounds; None leaves a side open.

    Strings compare by their bytes.
    """
    dtype = atomic_type(posted_type(postings, path))
    sides = [at_path(path)]
    if low is not None:
        stored, literal = _comparable(dtype, low)
        sides.append(stored >= literal)
    if high is not None:
        stored, literal = _comparable(dtype, high)
        sides.append(stored <= literal)
    return _select(base, postings.filter(reduce(lambda a, b: a & b, sides)), key)

"""Suffixes and substrings of terms, through an index of the three-letter pieces of distinct terms.

``term_counts`` has one row per distinct term; ``term_grams`` lists the pieces of these. A lookup reads
the terms that have every piece of the text asked for, looks at those terms themselves, and takes the keys
of the ones that hold it. The cost follows the number of distinct terms with the pieces; no text of the
table is read. Texts of less than three letters have no pieces: all distinct terms of the path are looked
at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from facetframe.operators.postings import at_path, atomic_type, posted_type
from facetframe.operators.search import _select

LETTERS = 3


def term_grams(counts: DataFrame) -> DataFrame:
    """``field``, ``path``, ``gram`` and ``value``: the distinct pieces of every distinct string term."""
    starts = F.sequence(F.lit(1), F.length("value") - (LETTERS - 1))
    pieces = F.transform(starts, lambda i: F.substring("value", i, F.lit(LETTERS)))
    strings = counts.filter(F.coalesce(*[F.col(c).cast("string") for c in ("num", "whole", "dec")]).isNull())
    long = strings.filter(F.length("value") >= LETTERS)
    found = long.select("field", "path", F.explode(F.array_distinct(pieces)).alias("gram"), "value")
    return found.withMetadata("path", counts.schema["path"].metadata)


def write_grams(grams: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """Write the pieces sorted, one directory per field, spread by piece and term."""
    salt = F.pmod(F.xxhash64("value"), F.lit(8))
    placed = grams.withColumn("__place", F.hash("field", "path", "gram", salt))
    placed = placed.hint("rebalance", "__place").drop("__place")
    ordered = placed.sortWithinPartitions("field", "path", "gram", "value")
    ordered.write.mode(mode).partitionBy("field").parquet(path)


def read_grams(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("field", "path", "gram", "value")


def _terms_with(counts: DataFrame, grams: DataFrame, path: str, text: str, holds: Column) -> DataFrame:
    """Distinct terms of the path for which ``holds``, found by the pieces of the text."""
    dtype = atomic_type(posted_type(counts, path))
    if not isinstance(dtype, StringType):
        raise TypeError(f"substrings need strings, {path} has {dtype.simpleString()}")
    pieces = sorted({text[i : i + LETTERS] for i in range(len(text) - LETTERS + 1)})
    if not pieces:
        return counts.filter(at_path(path) & holds).select("value")
    found = grams.filter(at_path(path) & F.col("gram").isin(pieces) & holds)
    counted = found.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") == len(pieces)).select("value")


def terms_containing(counts: DataFrame, grams: DataFrame, path: str, text: str) -> DataFrame:
    """``value`` of the distinct terms of the path that contain the text."""
    return _terms_with(counts, grams, path, text, F.col("value").contains(text))


def terms_ending(counts: DataFrame, grams: DataFrame, path: str, suffix: str) -> DataFrame:
    """``value`` of the distinct terms of the path that end with the text."""
    return _terms_with(counts, grams, path, suffix, F.col("value").endswith(suffix))


def _rows(base: DataFrame, postings: DataFrame, key: str, path: str, terms: DataFrame) -> DataFrame:
    keys = postings.filter(at_path(path)).join(terms, "value", "left_semi").select("key")
    return _select(base, keys, key)


def lookup_containing(
    base: DataFrame,
    postings: DataFrame,
    counts: DataFrame,
    grams: DataFrame,
    key: str,
    path: str,
    text: str,
) -> DataFrame:
    """Base rows with some string at the path that contains the text."""
    return _rows(base, postings, key, path, terms_containing(counts, grams, path, text))


def lookup_suffix(
    base: DataFrame,
    postings: DataFrame,
    counts: DataFrame,
    grams: DataFrame,
    key: str,
    path: str,
    suffix: str,
) -> DataFrame:
    """Base rows with some string at the path that ends with the text."""
    return _rows(base, postings, key, path, terms_ending(counts, grams, path, suffix))

"""Nested tables for the queries: derived lazily, and stored only where storage is the subject.

Nothing is remembered between calls, so a query always sees its input as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from facetframe.operators.postings import postings, read_postings, term_counts, write_postings
from facetframe.sources.nested import docs_nested, orders_nested
from facetframe.sources.scratch import scratch_path
from facetframe.sources.tables import read_table, write_table

nested_orders = orders_nested
nested_docs = docs_nested

ORDER_TERMS = [
    "attrs",
    "flags",
    "marks",
    "by_status",
    "detail.priority",
    "closed",
    "year",
    "day",
    "o_totalprice",
]


def orders_path(spark: SparkSession, sf_dir: str) -> str:
    """Nested orders with promoted map keys, sorted for selective filters on the status."""
    path = scratch_path(spark, "orders")
    write_table(
        orders_nested(spark, sf_dir),
        path,
        sort_by=["attrs.status", "o_orderkey"],
        promote=["attrs.status", "attrs.`tier.1`"],
        bloom=["o_orderkey", "o_custkey"],
    )
    return path


def stored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, orders_path(spark, sf_dir))


def orders_by_year_path(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "orders_by_year")
    write_table(
        orders_nested(spark, sf_dir), path, partition_by=["year"], sort_by=["o_orderkey"]
    )
    return path


def _searchable(spark, df: DataFrame, name: str, key: str, paths: list[str]):
    path = scratch_path(spark, name)
    write_table(df, path)
    base = read_table(spark, path)
    terms = scratch_path(spark, f"{name}_postings")
    write_postings(postings(base, key, paths), terms)
    return base, read_postings(spark, terms)


def searchable_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Stored nested orders and their postings."""
    return _searchable(
        spark, orders_nested(spark, sf_dir), "searchable_orders", "o_orderkey", ORDER_TERMS
    )


def searchable_docs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    paths = ["words", "meta", "n_chars"]
    return _searchable(spark, docs_nested(spark, sf_dir), "searchable_docs", "doc_id", paths)


def order_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return searchable_orders(spark, sf_dir)[1]


def doc_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return searchable_docs(spark, sf_dir)[1]


def order_term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = term_counts(order_postings(spark, sf_dir))
    path = scratch_path(spark, "order_term_counts")
    write_table(counts, path, partition_by=["field"], sort_by=["path", "value"])
    return read_table(spark, path)

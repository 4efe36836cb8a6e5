"""Sorting, paging, limits and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from facetframe.operators.paging import has_next, page, page_after
from facetframe.operators.ranks import (
    has_next_by_index,
    page_by_index,
    read_rank_index,
    write_rank_index,
)
from facetframe.plans.prepared import nested_orders
from facetframe.plans.registry import query
from facetframe.sources.nested import ORDERS_SQL, table
from facetframe.sources.scratch import scratch_path
from facetframe.sources.tables import read_table, write_table

col = F.col


@query(
    ORDERS_SQL
    + """SELECT o_orderkey, attrs['tier.1'] AS tier FROM orders_nested
ORDER BY tier ASC NULLS FIRST, o_orderkey DESC NULLS LAST"""
)
def sort_default_nulls(spark, sf_dir):
    return (
        nested_orders(spark, sf_dir)
        .select("o_orderkey", col("attrs.`tier.1`").alias("tier"))
        .orderBy(col("tier").asc(), col("o_orderkey").desc())
    )


@query(
    ORDERS_SQL
    + """SELECT o_orderkey, attrs['tier.1'] AS tier FROM orders_nested
ORDER BY tier DESC NULLS FIRST, attrs['status'] ASC NULLS LAST, o_orderkey"""
)
def sort_explicit_nulls(spark, sf_dir):
    return (
        nested_orders(spark, sf_dir)
        .orderBy(
            col("attrs.`tier.1`").desc_nulls_first(),
            col("attrs.status").asc_nulls_last(),
            "o_orderkey",
        )
        .select("o_orderkey", col("attrs.`tier.1`").alias("tier"))
    )


@query("SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders ORDER BY ALL")
def sort_all(spark, sf_dir):
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_totalprice", "o_orderpriority")
        .orderBy("o_orderkey", "o_totalprice", "o_orderpriority")
    )


@query(
    """SELECT o_orderkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 100 OFFSET 600"""
)
def page_numbered(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return page(orders, ["o_totalprice desc", "o_orderkey"], 7, 100)


@query(
    """SELECT o_orderkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 1000 OFFSET 9000"""
)
def page_deep(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return page(orders, ["o_totalprice desc", "o_orderkey"], 10, 1000)


def _ranked_orders(spark, sf_dir):
    """Orders stored by descending price, and their rank index."""
    path, index = scratch_path(spark, "ranked"), scratch_path(spark, "ranks_of_price")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    write_table(orders, path, sort_by=["o_totalprice"])
    stored_orders = read_table(spark, path)
    write_rank_index(stored_orders, ["o_totalprice desc", "o_orderkey"], index, per_range=1000)
    return stored_orders, read_rank_index(spark, index)


@query(
    """SELECT 'deep' AS page, o_orderkey, o_totalprice FROM (
  SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100 OFFSET 12300)
UNION ALL SELECT 'first', o_orderkey, o_totalprice FROM (
  SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 30)"""
)
def page_by_rank(spark, sf_dir):
    orders, index = _ranked_orders(spark, sf_dir)
    order = ["o_totalprice desc", "o_orderkey"]
    columns = ["o_orderkey", "o_totalprice"]
    deep = page_by_index(orders, index, order, 124, 100).select(F.lit("deep").alias("page"), *columns)
    first = page_by_index(orders, index, order, 1, 30).select(F.lit("first").alias("page"), *columns)
    return deep.unionByName(first)


@query("SELECT (SELECT count(*) FROM orders) > 14900 AS has_next")
def page_has_next_by_rank(spark, sf_dir):
    _, index = _ranked_orders(spark, sf_dir)
    return has_next_by_index(index, 149, 100)


@query(
    """SELECT o_orderkey, o_orderpriority FROM orders
WHERE o_orderpriority < '3-MEDIUM' OR (o_orderpriority = '3-MEDIUM' AND o_orderkey > 2000)
ORDER BY o_orderpriority DESC, o_orderkey LIMIT 300"""
)
def page_after_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    last = {"o_orderpriority": "3-MEDIUM", "o_orderkey": 2000}
    return page_after(orders, ["o_orderpriority desc", "o_orderkey"], last, 300)


@query(
    "SELECT (SELECT count(*) FROM orders) > 700 AS has_next",
)
def page_has_next(spark, sf_dir):
    return has_next(table(spark, sf_dir, "orders").select("o_orderkey"), 7, 100)


@query(
    ORDERS_SQL
    + """SELECT o_orderkey, o_totalprice FROM orders_nested WHERE attrs['status'] = 'F'
ORDER BY o_totalprice, o_orderkey LIMIT 25"""
)
def first_hits(spark, sf_dir):
    return (
        nested_orders(spark, sf_dir)
        .filter(col("attrs.status") == "F")
        .select("o_orderkey", "o_totalprice")
        .orderBy("o_totalprice", "o_orderkey")
        .limit(25)
    )


@query(
    "SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 40 OFFSET 15",
)
def limit_offset(spark, sf_dir):
    return (
        table(spark, sf_dir, "events")
        .select("event_id", "value")
        .orderBy(col("value").desc(), "event_id")
        .offset(15)
        .limit(40)
    )


# Samples are random; what must hold of every sample is checked on the whole table.
@query(
    """SELECT o_orderpriority, count(*) AS n, true AS repeatable, true AS part_of_table,
       true AS about_a_tenth FROM orders GROUP BY o_orderpriority"""
)
def sample_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")

    def marked(name):
        drawn = orders.sample(withReplacement=False, fraction=0.1, seed=11)
        return drawn.select("o_orderkey", F.lit(1).alias(name))

    whole = Window.partitionBy(F.lit(1))  # a row per priority
    share = F.sum("drawn").over(whole) / F.sum("n").over(whole)
    return (
        orders.join(marked("one"), "o_orderkey", "full")
        .join(marked("two"), "o_orderkey", "full")
        .groupBy("o_orderpriority")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.bool_and(F.col("one").eqNullSafe(F.col("two"))).alias("repeatable"),
            F.bool_and(F.col("o_orderpriority").isNotNull()).alias("part_of_table"),
            F.count("one").alias("drawn"),
        )
        .withColumn("about_a_tenth", share.between(0.07, 0.13))
        .drop("drawn")
    )


@query(
    """SELECT count(*) AS n, true AS about_twice, true AS part_of_table, true AS has_repeats
FROM orders"""
)
def sample_with_replacement(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    drawn = orders.sample(withReplacement=True, fraction=2.0, seed=7)
    times = drawn.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("times"))
    return (
        orders.withColumn("known", F.lit(True))
        .join(times, "o_orderkey", "full")
        .agg(
            F.count("known").alias("n"),
            (F.sum("times") / F.count("known")).between(1.8, 2.2).alias("about_twice"),
            F.bool_and(F.col("known").isNotNull()).alias("part_of_table"),
            (F.max("times") > 1).alias("has_repeats"),
        )
    )

"""Aggregates: counts, extremes, sums, statistics, grouping by nested paths."""

from __future__ import annotations

from pyspark.sql import functions as F

from facetframe.operators.facets import group_paths
from facetframe.plans.prepared import nested_orders
from facetframe.plans.registry import query
from facetframe.sources.nested import (
    CUSTOMER_SQL,
    ORDERS_SQL,
    events_nested,
    table,
)

col = F.col


@query(ORDERS_SQL + "SELECT year, count(*) AS n, count(1) AS n_lit FROM orders_nested GROUP BY year")
def count_rows(spark, sf_dir):
    return group_paths(
        nested_orders(spark, sf_dir),
        "year",
        {"n": F.count("*"), "n_lit": F.count(F.lit(1))},
    )


@query(
    ORDERS_SQL
    + """SELECT o_orderstatus, count(closed) AS n_closed, count(attrs['tier.1']) AS n_tier,
       count(flags) AS n_flags FROM orders_nested GROUP BY o_orderstatus"""
)
def count_values(spark, sf_dir):
    return group_paths(
        nested_orders(spark, sf_dir),
        "o_orderstatus",
        {
            "n_closed": F.count("closed"),
            "n_tier": F.count("attrs.`tier.1`"),
            "n_flags": F.count("flags"),
        },
    )


def _extreme(fn: str) -> str:
    return CUSTOMER_SQL + (
        f"SELECT year, {fn}(o_totalprice) AS price, CAST({fn}(day) AS VARCHAR) AS day,"
        f" strftime({fn}(placed), '%Y-%m-%d %H:%M:%S') AS placed, {fn}(closed) AS closed,"
        f" {fn}(attrs['priority']) AS priority, {fn}(cust.segment) AS segment,"
        f" {fn}(o_orderkey) AS orderkey FROM orders_cust GROUP BY year"
    )


def _extremes(spark, sf_dir, fn):
    return group_paths(
        nested_orders(spark, sf_dir),
        "year",
        {
            "price": fn("o_totalprice"),
            "day": fn("day").cast("string"),
            "placed": F.date_format(fn("placed"), "yyyy-MM-dd HH:mm:ss"),
            "closed": fn("closed"),
            "priority": fn("attrs.priority"),
            "segment": fn("cust.segment"),
            "orderkey": fn("o_orderkey"),
        },
    )


@query(_extreme("min"))
def minimum(spark, sf_dir):
    return _extremes(spark, sf_dir, F.min)


@query(_extreme("max"))
def maximum(spark, sf_dir):
    return _extremes(spark, sf_dir, F.max)


@query(
    """SELECT l_returnflag, CAST(sum(l_linenumber) AS BIGINT) AS lines,
       CAST(sum(l_orderkey) AS BIGINT) AS keys, round(sum(l_extendedprice), 2) AS price,
       round(sum(CAST(l_discount AS FLOAT)), 1) AS discount FROM lineitem GROUP BY l_returnflag"""
)
def sums(spark, sf_dir):
    return group_paths(
        table(spark, sf_dir, "lineitem"),
        "l_returnflag",
        {
            "lines": F.sum("l_linenumber"),
            "keys": F.sum("l_orderkey"),
            "price": F.round(F.sum("l_extendedprice"), 2),
            "discount": F.round(F.sum(col("l_discount").cast("float")), 1),
        },
    )


@query(
    ORDERS_SQL
    + """SELECT year, o_orderstatus, CAST(closed AS VARCHAR) AS closed, count(*) AS n,
       round(sum(o_totalprice), 2) AS total FROM orders_nested
GROUP BY year, o_orderstatus, closed"""
)
def group_columns(spark, sf_dir):
    grouped = group_paths(
        nested_orders(spark, sf_dir),
        ["year", "o_orderstatus", "closed"],
        {"n": F.count("*"), "total": F.round(F.sum("o_totalprice"), 2)},
    )
    return grouped.withColumn("closed", col("closed").cast("string"))


@query(
    ORDERS_SQL
    + """SELECT attrs['tier.1'] AS tier, count(o_totalprice) AS n,
       round(sum(o_totalprice), 2) AS total FROM orders_nested GROUP BY attrs['tier.1']"""
)
def group_map_key(spark, sf_dir):
    return group_paths(
        nested_orders(spark, sf_dir),
        {"tier": "attrs.`tier.1`"},
        {"n": F.count("o_totalprice"), "total": F.round(F.sum("o_totalprice"), 2)},
    )


@query(
    CUSTOMER_SQL
    + """SELECT cust.segment AS segment, detail.priority AS priority, attrs['status'] AS status,
       count(*) AS n FROM orders_cust GROUP BY 1, 2, 3"""
)
def group_struct_field(spark, sf_dir):
    return group_paths(
        nested_orders(spark, sf_dir),
        ["cust.segment", "detail.priority", "attrs.status"],
        {"n": F.count("*")},
    )


@query(
    ORDERS_SQL
    + """SELECT count(*) AS n, count(closed) AS n_closed, min(o_totalprice) AS lowest,
       max(o_totalprice) AS highest, round(sum(o_totalprice), 2) AS total,
       count(*) FILTER (WHERE year > 2050) AS n_future FROM orders_nested"""
)
def aggregate_all(spark, sf_dir):
    return nested_orders(spark, sf_dir).agg(
        F.count("*").alias("n"),
        F.count("closed").alias("n_closed"),
        F.min("o_totalprice").alias("lowest"),
        F.max("o_totalprice").alias("highest"),
        F.round(F.sum("o_totalprice"), 2).alias("total"),
        F.count_if(col("year") > 2050).alias("n_future"),
    )


@query(
    ORDERS_SQL
    + """SELECT count(*) AS n, count(day) AS n_day, coalesce(sum(o_totalprice), -1) AS total
FROM orders_nested WHERE attrs['status'] = 'absent'"""
)
def aggregate_no_rows(spark, sf_dir):
    return (
        nested_orders(spark, sf_dir)
        .filter(col("attrs.status") == "absent")
        .agg(
            F.count("*").alias("n"),
            F.count("day").alias("n_day"),
            F.coalesce(F.sum("o_totalprice"), F.lit(-1.0)).alias("total"),
        )
    )


@query(ORDERS_SQL + "SELECT DISTINCT attrs['status'] AS status, year FROM orders_nested")
def distinct_keys(spark, sf_dir):
    return group_paths(nested_orders(spark, sf_dir), ["attrs.status", "year"], {})


@query(
    ORDERS_SQL
    + """SELECT year, max(o_orderkey) + 1 AS next_key, max(o_orderkey) - min(o_orderkey) AS spread,
       round(sum(o_totalprice) / count(o_totalprice), 4) AS mean, max(o_orderkey) AS last_key
FROM orders_nested GROUP BY year"""
)
def aggregate_expressions(spark, sf_dir):
    last = F.max("o_orderkey")
    return group_paths(
        nested_orders(spark, sf_dir),
        "year",
        {
            "next_key": last + 1,
            "spread": last - F.min("o_orderkey"),
            "mean": F.round(F.sum("o_totalprice") / F.count("o_totalprice"), 4),
            "last_key": last,
        },
    )


@query(
    ORDERS_SQL
    + """SELECT attrs['priority'] AS priority, count(*) AS n, max(o_totalprice) AS highest
FROM orders_nested WHERE attrs['status'] = 'F' AND list_contains(by_status['O'], 'N')
GROUP BY attrs['priority']"""
)
def filter_then_group(spark, sf_dir):
    return group_paths(
        nested_orders(spark, sf_dir),
        "attrs.priority",
        {"n": F.count("*"), "highest": F.max("o_totalprice")},
        where="attrs['status'] = 'F' AND array_contains(by_status['O'], 'N')",
    )


@query(
    """SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events
WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) >= 50 GROUP BY event_type"""
)
def filter_then_group_json(spark, sf_dir):
    return group_paths(
        events_nested(spark, sf_dir),
        "event_type",
        {"n": F.count("*"), "total": F.round(F.sum("value"), 2)},
        where=col("props.k").cast("int") >= 50,
    )


@query(
    """SELECT l_linestatus, round(avg(l_quantity), 6) AS mean_quantity,
       round(avg(l_linenumber), 6) AS mean_line,
       round(sum(l_quantity) / count(l_quantity), 6) AS sum_by_count
FROM lineitem GROUP BY l_linestatus"""
)
def average(spark, sf_dir):
    return group_paths(
        table(spark, sf_dir, "lineitem"),
        "l_linestatus",
        {
            "mean_quantity": F.round(F.avg("l_quantity"), 6),
            "mean_line": F.round(F.avg("l_linenumber"), 6),
            "sum_by_count": F.round(F.sum("l_quantity") / F.count("l_quantity"), 6),
        },
    )


PRICE = "l_extendedprice / 1000"


@query(
    f"""SELECT l_returnflag, round(var_pop({PRICE}), 4) AS var_pop,
       round(var_samp({PRICE}), 4) AS var_samp, round(stddev_pop({PRICE}), 4) AS stddev_pop,
       round(stddev_samp({PRICE}), 4) AS stddev_samp,
       round(covar_pop({PRICE}, l_quantity), 4) AS covar_pop,
       round(covar_samp({PRICE}, l_quantity), 4) AS covar_samp,
       round(corr({PRICE}, l_quantity), 6) AS corr FROM lineitem GROUP BY l_returnflag"""
)
def statistics(spark, sf_dir):
    price, quantity = F.expr(PRICE), col("l_quantity")
    return group_paths(
        table(spark, sf_dir, "lineitem"),
        "l_returnflag",
        {
            "var_pop": F.round(F.var_pop(price), 4),
            "var_samp": F.round(F.var_samp(price), 4),
            "stddev_pop": F.round(F.stddev_pop(price), 4),
            "stddev_samp": F.round(F.stddev_samp(price), 4),
            "covar_pop": F.round(F.covar_pop(price, quantity), 4),
            "covar_samp": F.round(F.covar_samp(price, quantity), 4),
            "corr": F.round(F.corr(price, quantity), 6),
        },
    )


@query(
    f"""SELECT l_returnflag, round(regr_slope({PRICE}, l_quantity), 6) AS slope,
       round(regr_intercept({PRICE}, l_quantity), 6) AS intercept,
       round(regr_r2({PRICE}, l_quantity), 6) AS r2,
       round(regr_sxy({PRICE}, l_quantity) / count(*), 6) AS sxy
FROM lineitem GROUP BY l_returnflag"""
)
def regression(spark, sf_dir):
    price, quantity = F.expr(PRICE), col("l_quantity")
    return group_paths(
        table(spark, sf_dir, "lineitem"),
        "l_returnflag",
        {
            "slope": F.round(F.regr_slope(price, quantity), 6),
            "intercept": F.round(F.regr_intercept(price, quantity), 6),
            "r2": F.round(F.regr_r2(price, quantity), 6),
            "sxy": F.round(F.regr_sxy(price, quantity) / F.count("*"), 6),
        },
    )


@query(
    """SELECT l_returnflag, count(DISTINCT l_partkey) AS parts,
       CAST(sum(DISTINCT l_linenumber) AS BIGINT) AS line_sum FROM lineitem GROUP BY l_returnflag"""
)
def distinct_aggregates(spark, sf_dir):
    return group_paths(
        table(spark, sf_dir, "lineitem"),
        "l_returnflag",
        {"parts": F.count_distinct("l_partkey"), "line_sum": F.sum_distinct("l_linenumber")},
    )


@query(
    ORDERS_SQL
    + """SELECT year, count(*) FILTER (WHERE attrs['tier.1'] = 'high') AS n_high,
       round(sum(o_totalprice) FILTER (WHERE closed), 2) AS closed_total
FROM orders_nested GROUP BY year"""
)
def filtered_aggregates(spark, sf_dir):
    return group_paths(
        nested_orders(spark, sf_dir),
        "year",
        {
            "n_high": F.count_if(col("attrs.`tier.1`") == "high"),
            "closed_total": F.round(F.expr("sum(o_totalprice) FILTER (WHERE closed)"), 2),
        },
    )

"""Projections: columns, aliases, struct fields, map keys, array positions, sizes, casts, paths."""

from __future__ import annotations

from pyspark.sql import functions as F

from facetframe.functions.paths import path_column, without_promoted
from facetframe.operators.facets import facet
from facetframe.operators.profile import path_profile
from facetframe.operators.variants import (
    promote_variant,
    variant_profile,
    variant_value,
    with_variant,
)
from facetframe.plans.prepared import nested_orders
from facetframe.plans.registry import query
from facetframe.sources.nested import (
    CUSTOMER_SQL,
    ORDERS_SQL,
    events_nested,
    table,
)
from facetframe.sources.scratch import scratch_path
from facetframe.sources.tables import read_table, write_table

col = F.col


@query("SELECT o_orderkey, o_totalprice FROM orders")
def select_columns(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")


@query(
    ORDERS_SQL
    + """SELECT o_orderkey AS "order key", o_totalprice AS "total.price", attrs['status'] AS état
FROM orders_nested WHERE o_totalprice > 400000"""
)
def select_aliases(spark, sf_dir):
    renamed = nested_orders(spark, sf_dir).select(
        col("o_orderkey").alias("order key"),
        col("o_totalprice").alias("total.price"),
        col("attrs.status").alias("état"),
    )
    return renamed.filter(col("`total.price`") > 400000)


@query(
    CUSTOMER_SQL
    + """SELECT o_orderkey, cust.name AS name, cust.segment AS segment, detail.urgent AS urgent
FROM orders_cust"""
)
def struct_field(spark, sf_dir):
    return nested_orders(spark, sf_dir).select(
        "o_orderkey", "cust.name", "cust.segment", "detail.urgent"
    )


@query(
    ORDERS_SQL
    + """SELECT o_orderkey, attrs['status'] AS status, attrs['tier.1'] AS tier,
       attrs['absent'] AS absent FROM orders_nested"""
)
def map_value(spark, sf_dir):
    return nested_orders(spark, sf_dir).select(
        "o_orderkey",
        col("attrs.status").alias("status"),
        col("attrs")["tier.1"].alias("tier"),
        F.expr("attrs['absent']").alias("absent"),
    )


@query(
    ORDERS_SQL
    + """SELECT o_orderkey, flags[1] AS first_flag, flags[3] AS third_flag,
       lines[1].status AS first_status FROM orders_nested"""
)
def array_element(spark, sf_dir):
    return nested_orders(spark, sf_dir).select(
        "o_orderkey",
        F.get("flags", F.lit(0)).alias("first_flag"),
        F.get("flags", F.lit(2)).alias("third_flag"),
        F.get("lines", F.lit(0)).getField("status").alias("first_status"),
    )


@query(
    ORDERS_SQL
    + """SELECT o_orderkey, array_to_string([x.flag FOR x IN lines], '|') AS flags,
       array_to_string([x.status FOR x IN lines], '|') AS statuses FROM orders_nested"""
)
def array_struct_field(spark, sf_dir):
    return nested_orders(spark, sf_dir).select(
        "o_orderkey",
        F.array_join("lines.flag", "|").alias("flags"),
        F.array_join("lines.status", "|").alias("statuses"),
    )


@query(
    ORDERS_SQL
    + """SELECT o_orderkey, array_to_string(list_sort(map_keys(attrs)), '|') AS keys,
       array_to_string(list_sort(list_transform(map_values(attrs), lambda v: coalesce(v, '~'))),
                       '|') AS vals FROM orders_nested"""
)
def map_keys_values(spark, sf_dir):
    values = F.transform(F.map_values("attrs"), lambda v: F.coalesce(v, F.lit("~")))
    return nested_orders(spark, sf_dir).select(
        "o_orderkey",
        F.array_join(F.array_sort(F.map_keys("attrs")), "|").alias("keys"),
        F.array_join(F.array_sort(values), "|").alias("vals"),
    )


@query(
    ORDERS_SQL
    + """SELECT o_orderkey, coalesce(len(flags), -1) AS n_flags,
       coalesce(CAST(cardinality(attrs) AS BIGINT), -1) AS n_attrs,
       coalesce(len(by_status['F']), -1) AS n_f FROM orders_nested"""
)
def collection_size(spark, sf_dir):
    def size(column):
        return F.coalesce(F.size(column).cast("bigint"), F.lit(-1))

    return nested_orders(spark, sf_dir).select(
        "o_orderkey",
        size(col("flags")).alias("n_flags"),
        size(col("attrs")).alias("n_attrs"),
        size(col("by_status.F")).alias("n_f"),
    )


@query(
    ORDERS_SQL
    + """SELECT o_orderkey,
  array_to_string(list_transform(marks, lambda v: coalesce(v, '~')), '|') AS marks,
  array_to_string(list_transform(list_sort(map_keys(attrs)),
                  lambda k: k || '=' || coalesce(attrs[k], '~')), '|') AS attrs,
  array_to_string(by_status['F'], '|') AS on_f, array_to_string(by_status['O'], '|') AS on_o,
  detail.priority || '/' || array_to_string(coalesce(detail.flags, ['none']), '|') AS detail
FROM orders_nested"""
)
def nested_round_trip(spark, sf_dir):
    entries = F.transform(
        F.array_sort(F.map_keys("attrs")),
        lambda k: F.concat(k, F.lit("="), F.coalesce(col("attrs")[k], F.lit("~"))),
    )
    flags = F.coalesce(col("detail.flags"), F.array(F.lit("none")))
    return nested_orders(spark, sf_dir).select(
        "o_orderkey",
        F.array_join("marks", "|", "~").alias("marks"),
        F.array_join(entries, "|").alias("attrs"),
        F.array_join("by_status.F", "|").alias("on_f"),
        F.array_join("by_status.O", "|").alias("on_o"),
        F.concat("detail.priority", F.lit("/"), F.array_join(flags, "|")).alias("detail"),
    )


PROFILED = {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
    "o_totalprice": "double", "placed": "timestamp_ntz", "day": "date", "year": "int",
    "closed": "boolean", "attrs": "map<string,string>", "flags": "string", "marks": "string",
    "by_status": "map<string,array<string>>", "detail.priority": "string",
    "detail.urgent": "boolean", "detail.flags": "string", "cust.name": "string",
    "cust.segment": "string",
}


@query(
    CUSTOMER_SQL
    + """, keys AS (SELECT unnest(map_keys(attrs)) AS k, attrs FROM orders_cust),
status_keys AS (SELECT unnest(map_keys(by_status)) AS k, by_status FROM orders_cust)
SELECT 'attrs.' || k AS path, 'string' AS type, count(*) AS n_present FROM keys
WHERE attrs[k] IS NOT NULL GROUP BY k
UNION ALL SELECT 'by_status.' || k, 'string', count(*) FROM status_keys GROUP BY k
UNION ALL SELECT 'lines.flag', 'string', count(lines) FROM orders_cust
UNION ALL SELECT 'lines.status', 'string', count(lines) FROM orders_cust
UNION ALL SELECT 'lines.n', 'bigint', count(lines) FROM orders_cust"""
    + "".join(
        f" UNION ALL SELECT '{path}', '{kind}', count({path}) FROM orders_cust"
        for path, kind in PROFILED.items()
    )
)
def profile_paths(spark, sf_dir):
    return path_profile(nested_orders(spark, sf_dir))


@query(
    """WITH keys AS (SELECT unnest(json_keys(props)) AS k FROM events)
SELECT 'event_id' AS path, 'bigint' AS type, count(event_id) AS n_present FROM events
UNION ALL SELECT 'ts', 'timestamp_ntz', count(ts) FROM events
UNION ALL SELECT 'user_id', 'bigint', count(user_id) FROM events
UNION ALL SELECT 'event_type', 'string', count(event_type) FROM events
UNION ALL SELECT 'value', 'double', count(value) FROM events
UNION ALL SELECT 'props', 'map<string,string>', count(props) FROM events
UNION ALL SELECT 'props.' || k, 'string', count(*) FROM keys GROUP BY k"""
)
def profile_json_paths(spark, sf_dir):
    return path_profile(events_nested(spark, sf_dir))


def _variant_events(spark, sf_dir):
    """Events whose JSON properties were stored as VARIANT, with a promoted path."""
    path = scratch_path(spark, "variant_events")
    events = with_variant(table(spark, sf_dir, "events"), "props")
    write_table(promote_variant(events, {"props.k": "int"}), path)
    return read_table(spark, path)


@query(
    """SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) BETWEEN 40 AND 45"""
)
def variant_filter(spark, sf_dir):
    events = _variant_events(spark, sf_dir)
    k = variant_value("props.k", "int")
    by_variant = events.filter(k.between(40, 43)).select("event_id", "event_type", k.alias("k"))
    promoted = path_column(events, "props.k")
    by_shadow = events.filter(promoted.isin(44, 45)).select("event_id", "event_type", promoted.alias("k"))
    return by_variant.unionByName(by_shadow)


@query(
    """WITH keys AS (SELECT unnest(json_keys(props)) AS k FROM events)
SELECT 'props' AS path, 'variant' AS type, count(props) AS n_present FROM events
UNION ALL SELECT 'props.' || k, 'bigint', count(*) FROM keys GROUP BY k"""
)
def variant_paths(spark, sf_dir):
    return variant_profile(without_promoted(_variant_events(spark, sf_dir)), "props")


@query(
    ORDERS_SQL
    + """, marked AS (
  SELECT unnest(CASE WHEN len(marks) > 0 THEN marks ELSE [NULL] END) AS mark, o_totalprice FROM orders_nested
  WHERE attrs['status'] = 'F')
SELECT mark, count(*) AS n, max(o_totalprice) AS highest FROM marked GROUP BY mark"""
)
def variant_facet(spark, sf_dir):
    path = scratch_path(spark, "variant_orders")
    orders = nested_orders(spark, sf_dir)
    doc = F.to_json(F.struct("marks", "attrs", "o_totalprice"), {"ignoreNullFields": "false"})
    write_table(with_variant(orders.select("o_orderkey", doc.alias("doc")), "doc"), path)
    found = read_table(spark, path).filter(variant_value("doc.attrs.status") == "F")
    typed = found.select(
        variant_value("doc.marks", "array<string>").alias("mark"),
        variant_value("doc.o_totalprice", "double").alias("price"),
    )
    return facet(typed, "mark", {"n": F.count("*"), "highest": F.max("price")})


@query(
    """SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS quantity,
       CAST(l_linenumber AS DOUBLE) AS line, CAST(l_linenumber AS VARCHAR) AS line_text,
       CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ship_day,
       CAST(substr(CAST(l_orderkey AS VARCHAR), 1, 2) AS INTEGER) AS lead FROM lineitem"""
)
def cast_columns(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        col("l_quantity").cast("bigint").alias("quantity"),
        col("l_linenumber").cast("double").alias("line"),
        col("l_linenumber").cast("string").alias("line_text"),
        col("l_shipdate").cast("date").cast("string").alias("ship_day"),
        F.substring(col("l_orderkey").cast("string"), 1, 2).cast("int").alias("lead"),
    )

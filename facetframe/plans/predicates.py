"""Filters: comparisons, null tests, string and array predicates, tokens, boolean logic."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from facetframe.functions.predicates import contains_value, has_key, key_equals
from facetframe.operators.joins import in_keys
from facetframe.operators.text import token_filter
from facetframe.plans.prepared import nested_orders
from facetframe.plans.registry import query
from facetframe.sources.nested import (
    CUSTOMER_SQL,
    ORDERS_SQL,
    events_nested,
    table,
)

col = F.col


@query(
    ORDERS_SQL
    + """SELECT o_orderkey, attrs['status'] AS status, year FROM orders_nested
WHERE ('F' = attrs['status'] AND year = 1997) OR o_custkey = 42 OR day = DATE '1996-02-29'
   OR placed = TIMESTAMP '1998-10-03 00:00:00' OR o_totalprice = 112946.26
   OR (closed = true AND detail.urgent = true)"""
)
def filter_equal(spark, sf_dir):
    return (
        nested_orders(spark, sf_dir)
        .filter(
            ((F.lit("F") == col("attrs.status")) & (col("year") == 1997))
            | (col("o_custkey") == 42)
            | (col("day") == date(1996, 2, 29))
            | (col("placed") == datetime(1998, 10, 3))
            | (col("o_totalprice") == 112946.26)
            | ((col("closed") == F.lit(True)) & (col("detail.urgent") == F.lit(True)))
        )
        .select("o_orderkey", col("attrs.status").alias("status"), "year")
    )


@query(
    ORDERS_SQL
    + """SELECT o_orderkey, o_orderstatus FROM orders_nested
WHERE closed IS NOT DISTINCT FROM NULL OR attrs['tier.1'] IS NOT DISTINCT FROM 'high'"""
)
def filter_null_safe_equal(spark, sf_dir):
    return (
        nested_orders(spark, sf_dir)
        .filter(
            col("closed").eqNullSafe(F.lit(None)) | col("attrs.`tier.1`").eqNullSafe(F.lit("high"))
        )
        .select("o_orderkey", "o_orderstatus")
    )


def _comparison(op: str) -> str:
    return ORDERS_SQL + (
        f"SELECT o_orderkey, year, o_totalprice FROM orders_nested WHERE year {op} 1998"
        f" OR o_totalprice {op} 250000.5 OR attrs['status'] {op} 'F' OR closed {op} true"
    )


def _compared(spark, sf_dir, compare):
    condition = (
        compare(col("year"), F.lit(1998))
        | compare(col("o_totalprice"), F.lit(250000.5))
        | compare(col("attrs.status"), F.lit("F"))
        | compare(col("closed"), F.lit(True))
    )
    return (
        nested_orders(spark, sf_dir).filter(condition).select("o_orderkey", "year", "o_totalprice")
    )


@query(_comparison(">"))
def filter_greater(spark, sf_dir):
    return _compared(spark, sf_dir, lambda a, b: a > b)


@query(_comparison(">="))
def filter_greater_equal(spark, sf_dir):
    return _compared(spark, sf_dir, lambda a, b: a >= b)


@query(_comparison("<"))
def filter_less(spark, sf_dir):
    return _compared(spark, sf_dir, lambda a, b: a < b)


@query(_comparison("<="))
def filter_less_equal(spark, sf_dir):
    return _compared(spark, sf_dir, lambda a, b: a <= b)


@query(
    CUSTOMER_SQL
    + """SELECT o_orderkey, cust.segment AS segment FROM orders_cust
WHERE cust.segment > 'BUILDING' AND cust.segment <= 'HOUSEHOLD' AND attrs['priority'] >= '3'"""
)
def filter_string_range(spark, sf_dir):
    segment = col("cust.segment")
    return (
        nested_orders(spark, sf_dir)
        .filter((segment > "BUILDING") & (segment <= "HOUSEHOLD") & (col("attrs.priority") >= "3"))
        .select("o_orderkey", segment.alias("segment"))
    )


@query(
    """SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events
WHERE ts >= TIMESTAMP '2024-01-05 06:00:00.5' AND ts < TIMESTAMP '2024-01-20 18:30:00'
  AND CAST(ts AS DATE) <> DATE '2024-01-10' AND CAST(ts AS DATE) <= DATE '2024-01-18'"""
)
def filter_date_range(spark, sf_dir):
    day = F.to_date("ts")
    return (
        table(spark, sf_dir, "events")
        .filter(
            (col("ts") >= datetime(2024, 1, 5, 6, 0, 0, 500000))
            & (col("ts") < datetime(2024, 1, 20, 18, 30))
            & (day != date(2024, 1, 10))
            & (day <= date(2024, 1, 18))
        )
        .select("event_id", day.cast("string").alias("day"))
    )


# Long enough for the set form of IN.
CUSTOMERS = list(range(7, 1500, 31))


@query(
    ORDERS_SQL
    + f"""SELECT o_orderkey, o_custkey, attrs['priority'] AS priority FROM orders_nested
WHERE attrs['priority'] IN ('1-URGENT', '5-LOW') AND year IN (1996, 1999)
   OR o_custkey IN ({", ".join(map(str, CUSTOMERS))})"""
)
def filter_in(spark, sf_dir):
    return (
        nested_orders(spark, sf_dir)
        .filter(
            (col("attrs.priority").isin("1-URGENT", "5-LOW") & col("year").isin(1996, 1999))
            | col("o_custkey").isin(CUSTOMERS)
        )
        .select("o_orderkey", "o_custkey", col("attrs.priority").alias("priority"))
    )


@query(
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 30 AND l_shipdate < DATE '1997-01-01')
  AND o_orderstatus <> 'P'"""
)
def filter_in_many(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    keys = lines.filter("l_quantity > 30 AND l_shipdate < DATE '1997-01-01'").select("l_orderkey")
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'")
    return in_keys(orders, "o_orderkey", keys).select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT page_id, url FROM pages WHERE starts_with(url, 'http://m.')")
def filter_starts_with(spark, sf_dir):
    return (
        table(spark, sf_dir, "pages")
        .filter(col("url").startswith("http://m."))
        .select("page_id", "url")
    )


@query(
    ORDERS_SQL
    + """SELECT o_orderkey, attrs['priority'] AS priority FROM orders_nested
WHERE suffix(attrs['priority'], 'LOW') OR suffix(attrs['priority'], '_SPECIFIED')
   OR suffix(attrs['priority'], ' SPECIFIED')"""
)
def filter_ends_with(spark, sf_dir):
    priority = col("attrs.priority")
    return (
        nested_orders(spark, sf_dir)
        .filter(
            priority.endswith("LOW")
            | priority.endswith("_SPECIFIED")
            | priority.endswith(" SPECIFIED")
        )
        .select("o_orderkey", priority.alias("priority"))
    )


@query(
    """SELECT page_id, contains(html, '***') AS starred, contains(html, '%%%') AS percent
FROM pages WHERE contains(html, '***') OR contains(html, '%%%') OR contains(url, '?page=')"""
)
def filter_contains(spark, sf_dir):
    starred, percent = col("html").contains("***"), col("html").contains("%%%")
    return (
        table(spark, sf_dir, "pages")
        .filter(starred | percent | col("url").contains("?page="))
        .select("page_id", starred.alias("starred"), percent.alias("percent"))
    )


@query(
    CUSTOMER_SQL
    + """SELECT o_orderkey, flags IS NULL AS no_flags, cust.name IS NULL AS no_name,
       attrs['tier.1'] IS NULL AS no_tier FROM orders_cust
WHERE flags IS NULL OR cust.name IS NULL OR attrs['tier.1'] IS NULL"""
)
def filter_is_null(spark, sf_dir):
    no_flags, no_name = col("flags").isNull(), col("cust.name").isNull()
    no_tier = col("attrs.`tier.1`").isNull()
    return (
        nested_orders(spark, sf_dir)
        .filter(no_flags | no_name | no_tier)
        .select(
            "o_orderkey",
            no_flags.alias("no_flags"),
            no_name.alias("no_name"),
            no_tier.alias("no_tier"),
        )
    )


@query(
    ORDERS_SQL
    + """SELECT o_orderkey, attrs['status'] AS status FROM orders_nested
WHERE attrs['status'] IS NOT NULL AND detail.flags IS NOT NULL AND by_status['O'] IS NOT NULL"""
)
def filter_is_not_null(spark, sf_dir):
    return (
        nested_orders(spark, sf_dir)
        .filter("attrs['status'] IS NOT NULL AND detail.flags IS NOT NULL")
        .filter(col("by_status.O").isNotNull())
        .select("o_orderkey", col("attrs.status").alias("status"))
    )


@query(
    ORDERS_SQL
    + """SELECT o_orderkey, o_totalprice FROM orders_nested
WHERE attrs['status'] = 'O' AND day > DATE '1997-06-30' AND list_contains(flags, 'R')"""
)
def filter_and(spark, sf_dir):
    return (
        nested_orders(spark, sf_dir)
        .filter(
            (col("attrs.status") == "O")
            & (col("day") > date(1997, 6, 30))
            & contains_value("flags", "R")
        )
        .select("o_orderkey", "o_totalprice")
    )


@query(
    ORDERS_SQL
    + """SELECT o_orderkey, o_totalprice FROM orders_nested
WHERE attrs['tier.1'] = 'high' OR list_contains(by_status['F'], 'A') OR day < DATE '1995-03-01'"""
)
def filter_or(spark, sf_dir):
    return (
        nested_orders(spark, sf_dir)
        .filter(
            (col("attrs.`tier.1`") == "high")
            | contains_value("by_status.F", "A")
            | (col("day") < date(1995, 3, 1))
        )
        .select("o_orderkey", "o_totalprice")
    )


# list_contains has no third truth value: an unmatched array with a null element is spelled out.
@query(
    ORDERS_SQL
    + """SELECT o_orderkey, o_orderstatus FROM orders_nested
WHERE attrs['status'] <> 'F' AND attrs['priority'] NOT IN ('1-URGENT', '2-HIGH')
  AND NOT list_contains(flags, 'N')
  AND NOT CASE WHEN list_contains(marks, 'R') THEN true
               WHEN len(list_filter(marks, lambda x: x IS NULL)) > 0 THEN NULL ELSE false END"""
)
def filter_not(spark, sf_dir):
    return (
        nested_orders(spark, sf_dir)
        .filter(col("attrs.status") != "F")
        .filter(~col("attrs.priority").isin("1-URGENT", "2-HIGH"))
        .filter(~contains_value("flags", "N") & ~contains_value("marks", "R"))
        .select("o_orderkey", "o_orderstatus")
    )


@query(
    ORDERS_SQL
    + """SELECT o_orderkey, year FROM orders_nested
WHERE true AND (false OR attrs['status'] = 'F')"""
)
def filter_literal(spark, sf_dir):
    return (
        nested_orders(spark, sf_dir)
        .filter(F.lit(True) & (F.lit(False) | (col("attrs.status") == "F")))
        .select("o_orderkey", "year")
    )


@query(
    ORDERS_SQL
    + """SELECT o_orderkey, len(flags) AS n_flags FROM orders_nested
WHERE list_contains(flags, 'N') AND list_contains(detail.flags, 'A')"""
)
def contains_array(spark, sf_dir):
    return (
        nested_orders(spark, sf_dir)
        .filter(contains_value("flags", "N") & contains_value("detail.flags", "A"))
        .select("o_orderkey", F.size("flags").cast("bigint").alias("n_flags"))
    )


@query(
    ORDERS_SQL
    + "SELECT o_orderkey FROM orders_nested WHERE list_contains(by_status['O'], 'R')"
)
def contains_map_of_array(spark, sf_dir):
    return (
        nested_orders(spark, sf_dir)
        .filter(contains_value("by_status.O", "R"))
        .select("o_orderkey")
    )


@query(
    """SELECT vec_id, label FROM embeddings
WHERE list_contains(list_transform(embedding, lambda x: CAST(floor(x * 100) AS INTEGER)), 17)
  OR list_contains(embedding, (SELECT embedding[3] FROM embeddings WHERE vec_id = 7))"""
)
def contains_number(spark, sf_dir):
    # One float of one row: few other rows hold it.
    wanted = table(spark, sf_dir, "embeddings").filter("vec_id = 7").select(col("embedding")[2]).scalar()
    buckets = F.transform("embedding", lambda x: F.floor(x * 100).cast("int"))
    return (
        table(spark, sf_dir, "embeddings")
        .filter(contains_value(buckets, 17) | contains_value("embedding", wanted))
        .select("vec_id", "label")
    )


@query(
    ORDERS_SQL
    + """SELECT o_orderkey, attrs['priority'] AS priority FROM orders_nested
WHERE attrs['status'] = 'F' AND attrs['tier.1'] = 'high'"""
)
def map_key_equal(spark, sf_dir):
    return (
        nested_orders(spark, sf_dir)
        .filter(key_equals("attrs", "status", "F") & key_equals("attrs", "tier.1", "high"))
        .select("o_orderkey", col("attrs.priority").alias("priority"))
    )


@query("SELECT event_id, event_type FROM events WHERE json_extract_string(props, '$.k') = '42'")
def map_key_equal_json(spark, sf_dir):
    return (
        events_nested(spark, sf_dir)
        .filter(key_equals("props", "k", "42"))
        .select("event_id", "event_type")
    )


@query(
    ORDERS_SQL
    + """SELECT o_orderkey, attrs['tier.1'] IS NULL AS null_tier FROM orders_nested
WHERE list_contains(map_keys(attrs), 'tier.1')"""
)
def map_has_key(spark, sf_dir):
    return (
        nested_orders(spark, sf_dir)
        .filter(has_key("attrs", "tier.1"))
        .select("o_orderkey", col("attrs.`tier.1`").isNull().alias("null_tier"))
    )


@query(
    ORDERS_SQL
    + """SELECT o_orderkey, o_totalprice FROM orders_nested
WHERE year = 1997 AND attrs['status'] = 'O' AND list_contains(flags, 'R')
  AND o_totalprice > (SELECT avg(o_totalprice) FROM orders) AND o_orderkey % 7 > o_custkey % 5"""
)
def filter_with_residual(spark, sf_dir):
    average = table(spark, sf_dir, "orders").agg(F.avg("o_totalprice")).scalar()
    return (
        nested_orders(spark, sf_dir)
        .filter((col("year") == 1997) & (col("attrs.status") == "O") & contains_value("flags", "R"))
        .filter((col("o_totalprice") > average) & (col("o_orderkey") % 7 > col("o_custkey") % 5))
        .select("o_orderkey", "o_totalprice")
    )


@query(
    """SELECT doc_id, lang FROM documents
WHERE list_contains(regexp_split_to_array(lower(text), '[^\\p{L}\\p{M}\\p{N}]+'), 'the')"""
)
def token_match(spark, sf_dir):
    return token_filter(table(spark, sf_dir, "documents"), "text", "the").select("doc_id", "lang")


@query(
    """SELECT doc_id, lang FROM documents
WHERE list_contains(regexp_split_to_array(lower(text), '[^\\p{L}\\p{M}\\p{N}]+'), 'ré')"""
)
def token_match_accent(spark, sf_dir):
    return token_filter(table(spark, sf_dir, "documents"), "text", "ré").select("doc_id", "lang")


@query(
    """SELECT doc_id, lang FROM documents
WHERE list_contains(regexp_split_to_array(lower(text), '[^\\p{L}\\p{M}\\p{N}]+'), 'mail0')"""
)
def token_match_digits(spark, sf_dir):
    return token_filter(table(spark, sf_dir, "documents"), "text", "mail0").select("doc_id", "lang")


@query(
    """SELECT conv_id, turn, role FROM conversations
WHERE list_contains(regexp_split_to_array(lower(text), '[^\\p{L}\\p{M}\\p{N}]+'), 'de')"""
)
def token_match_turns(spark, sf_dir):
    turns = token_filter(table(spark, sf_dir, "conversations"), "text", "de")
    return turns.select("conv_id", "turn", "role")


@query(ORDERS_SQL + "SELECT o_orderkey, detail.urgent AS urgent FROM orders_nested WHERE closed")
def filter_boolean_column(spark, sf_dir):
    return (
        nested_orders(spark, sf_dir)
        .filter("closed")
        .select("o_orderkey", col("detail.urgent").alias("urgent"))
    )



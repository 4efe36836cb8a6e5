"""Lookups through postings."""

from __future__ import annotations

from datetime import date
from decimal import Decimal
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetframe.operators import bits as B
from facetframe.operators import grams as G
from facetframe.operators import postings as T
from facetframe.operators import search as S
from facetframe.operators.upsert import upsert
from facetframe.plans.prepared import (
    ORDER_TERMS,
    doc_postings,
    nested_orders,
    order_postings,
    order_term_counts,
    searchable_docs,
    searchable_orders,
)
from facetframe.plans.registry import query
from facetframe.sources.nested import DOCS_SQL, ORDERS_SQL, table
from facetframe.sources.scratch import scratch_path, stored
from facetframe.sources.tables import read_table, write_table

col = F.col
KEY = "o_orderkey"


def _found(rows):
    return rows.select(KEY, "o_totalprice")


FOUND = ORDERS_SQL + "SELECT o_orderkey, o_totalprice FROM orders_nested WHERE "


def _array_terms(path: str, array: str, keep_null: bool = False) -> str:
    """SQL for the postings of an array of strings."""
    field, where = path.split("`")[1], f"FROM orders_nested WHERE {array} IS NOT NULL"
    rows = [
        f"SELECT '{field}' AS field, '{path}' AS path, unnest(list_distinct({array})) AS value, "
        f"CAST(NULL AS DOUBLE) AS num, CAST(NULL AS BIGINT) AS whole, o_orderkey AS key {where}",
        f"SELECT '_exists', '{path}', NULL, NULL, NULL, o_orderkey {where}",
    ]
    if keep_null:
        rows.append(
            f"SELECT '_has_null', '{path}', NULL, NULL, NULL, o_orderkey {where} "
            f"AND len(list_filter({array}, lambda x: x IS NULL)) > 0"
        )
    return " UNION ALL ".join(rows)


def _value_terms(path: str, value: str, num: str = "NULL", whole: str = "NULL") -> str:
    field = path.split("`")[1]
    return (
        f"SELECT '{field}', '{path}', CAST({value} AS VARCHAR), {num}, {whole}, o_orderkey "
        f"FROM orders_nested WHERE {value} IS NOT NULL"
    )


POSTINGS_SQL = " UNION ALL ".join(
    [
        _array_terms("`flags`", "flags"),
        _array_terms("`marks`", "marks", keep_null=True),
        _array_terms("`by_status`.`F`", "by_status['F']"),
        _array_terms("`by_status`.`O`", "by_status['O']"),
        _array_terms("`by_status`", "map_keys(by_status)"),
        _array_terms("`attrs`", "map_keys(attrs)"),
        _value_terms("`attrs`.`status`", "attrs['status']"),
        _value_terms("`attrs`.`priority`", "attrs['priority']"),
        _value_terms("`attrs`.`tier.1`", "attrs['tier.1']"),
        _value_terms("`detail`.`priority`", "detail.priority"),
        _value_terms("`closed`", "closed", whole="CAST(closed AS BIGINT)"),
        _value_terms("`year`", "year", whole="year"),
        _value_terms("`day`", "day", whole="date_diff('day', DATE '1970-01-01', day)"),
    ]
)


# Spark and DuckDB write doubles differently, so the text of a price is its number here.
@query(
    ORDERS_SQL
    + f""", terms AS ({POSTINGS_SQL})
SELECT field, path, value, num, whole, key FROM terms
UNION ALL SELECT 'o_totalprice', '`o_totalprice`', NULL, o_totalprice, NULL, o_orderkey
FROM orders_nested WHERE o_totalprice IS NOT NULL"""
)
def postings_terms(spark, sf_dir):
    terms = T.postings(nested_orders(spark, sf_dir), KEY, ORDER_TERMS)
    value = F.when(col("field") != "o_totalprice", col("value")).alias("value")
    return terms.select("field", "path", value, "num", "whole", "key")


@query(FOUND + "list_contains(flags, 'R')")
def lookup_array(spark, sf_dir):
    return _found(S.lookup(*searchable_orders(spark, sf_dir), KEY, "flags", "R"))


@query(FOUND + "attrs['tier.1'] = 'high'")
def lookup_map_key(spark, sf_dir):
    return _found(
        S.lookup(*searchable_orders(spark, sf_dir), KEY, "attrs.`tier.1`", "high"
        )
    )


@query(FOUND + "list_contains(map_keys(attrs), 'tier.1')")
def lookup_has_key(spark, sf_dir):
    return _found(
        S.lookup(*searchable_orders(spark, sf_dir), KEY, "attrs", "tier.1")
    )


@query(FOUND + "day = DATE '1996-02-29' AND list_contains(flags, 'A')")
def lookup_few_rows(spark, sf_dir):
    terms = [("day", date(1996, 2, 29)), ("flags", "A")]
    orders, found = searchable_orders(spark, sf_dir)
    return _found(S.lookup_all(orders, found, KEY, terms))


@query(FOUND + "list_contains(by_status['O'], 'N')")
def lookup_frequent(spark, sf_dir):
    orders, terms = searchable_orders(spark, sf_dir)
    return _found(S.lookup(orders, terms, KEY, "by_status.O", "N"))


@query(DOCS_SQL + "SELECT doc_id, n_chars FROM docs_nested WHERE list_contains(words, 'the')")
def lookup_word(spark, sf_dir):
    found = S.lookup(*searchable_docs(spark, sf_dir), "doc_id", "words", "the"
    )
    return found.select("doc_id", "n_chars")


@query(
    FOUND
    + """attrs['status'] = 'F' AND list_contains(flags, 'A') AND list_contains(by_status['O'], 'R')
  AND closed AND year = 1997"""
)
def lookup_all_terms(spark, sf_dir):
    terms = [
        ("attrs.status", "F"),
        ("flags", "A"),
        ("by_status.O", "R"),
        ("closed", True),
        ("year", 1997),
    ]
    orders, found = searchable_orders(spark, sf_dir)
    counts = T.term_counts(found)
    return _found(S.lookup_all(orders, found, KEY, terms, counts=counts))


@query(FOUND + "attrs['priority'] = '1-URGENT' OR list_contains(by_status['F'], 'N') OR year = 1995")
def lookup_any_term(spark, sf_dir):
    terms = [("attrs.priority", "1-URGENT"), ("by_status.F", "N"), ("year", 1995)]
    orders, found = searchable_orders(spark, sf_dir)
    return _found(S.lookup_any(orders, found, KEY, terms))


@query(
    FOUND
    + """NOT CASE WHEN marks IS NULL THEN NULL WHEN list_contains(marks, 'R') THEN true
  WHEN len(list_filter(marks, lambda x: x IS NULL)) > 0 THEN NULL ELSE false END"""
)
def lookup_not_term(spark, sf_dir):
    return _found(
        S.lookup_not(*searchable_orders(spark, sf_dir), KEY, "marks", "R")
    )


@query(FOUND + "attrs['status'] <> 'O'")
def lookup_not_map_key(spark, sf_dir):
    return _found(
        S.lookup_not(*searchable_orders(spark, sf_dir), KEY, "attrs.status", "O")
    )


@query(
    ORDERS_SQL
    + """SELECT 'tier' AS path, count(attrs['tier.1']) AS n FROM orders_nested
UNION ALL SELECT 'flags', count(flags) FROM orders_nested
UNION ALL SELECT 'closed', count(closed) FROM orders_nested
UNION ALL SELECT 'status O', count(*) FROM orders_nested WHERE attrs['status'] = 'O'"""
)
def count_by_postings(spark, sf_dir):
    orders, terms = searchable_orders(spark, sf_dir)
    found = {
        "tier": S.existing_keys(terms, "attrs.`tier.1`"),
        "flags": S.existing_keys(terms, "flags"),
        "closed": S.existing_keys(terms, "closed"),
        "status O": S.lookup_keys(terms, "attrs.status", "O"),
    }
    counts = [k.agg(F.lit(p).alias("path"), F.count("*").alias("n")) for p, k in found.items()]
    return reduce(DataFrame.unionByName, counts)


@query(FOUND + "attrs['tier.1'] IS NOT NULL")
def lookup_exists(spark, sf_dir):
    return _found(
        S.exists(*searchable_orders(spark, sf_dir), KEY, "attrs.`tier.1`")
    )


@query(FOUND + "attrs['tier.1'] IS NULL")
def lookup_missing(spark, sf_dir):
    return _found(
        S.missing(*searchable_orders(spark, sf_dir), KEY, "attrs.`tier.1`")
    )


@query(
    ORDERS_SQL
    + """SELECT flag AS value, count(*) AS n FROM
(SELECT unnest(list_distinct(flags)) AS flag FROM orders_nested) GROUP BY flag"""
)
def facet_by_postings(spark, sf_dir):
    return T.facet_from_postings(order_postings(spark, sf_dir), "flags")


@query(
    ORDERS_SQL
    + """SELECT flag AS value, count(*) AS n FROM
(SELECT unnest(list_distinct(by_status['F'])) AS flag FROM orders_nested) GROUP BY flag"""
)
def facet_by_counts(spark, sf_dir):
    return T.facet_from_counts(order_term_counts(spark, sf_dir), "by_status.F")


@query(
    DOCS_SQL
    + """SELECT word AS value, count(*) AS n FROM
(SELECT unnest(list_distinct(words)) AS word FROM docs_nested) GROUP BY word"""
)
def facet_words_by_postings(spark, sf_dir):
    return T.facet_from_postings(doc_postings(spark, sf_dir), "words")


@query(
    ORDERS_SQL
    + """SELECT attrs['priority'] AS value, count(*) AS n FROM orders_nested
WHERE attrs['priority'] IS NOT NULL GROUP BY 1"""
)
def facet_map_key_by_postings(spark, sf_dir):
    return T.facet_from_postings(order_postings(spark, sf_dir), "attrs.priority")


@query(
    DOCS_SQL
    + """SELECT doc_id, n_chars FROM docs_nested
WHERE len(list_filter(words, lambda w: starts_with(w, 'thr'))) > 0"""
)
def lookup_by_prefix(spark, sf_dir):
    found = S.lookup_prefix(*searchable_docs(spark, sf_dir), "doc_id", "words", "thr"
    )
    return found.select("doc_id", "n_chars")


@query(FOUND + "attrs['priority'] >= '2' AND attrs['priority'] <= '4'")
def lookup_string_range(spark, sf_dir):
    return _found(
        S.lookup_range(*searchable_orders(spark, sf_dir), KEY, "attrs.priority", "2", "4"
        )
    )


@query(FOUND + "o_totalprice BETWEEN 9000 AND 100000.5")
def lookup_number_range(spark, sf_dir):
    return _found(
        S.lookup_range(*searchable_orders(spark, sf_dir), KEY, "o_totalprice", 9000, 100000.5
        )
    )


@query(FOUND + "day >= DATE '1999-02-28'")
def lookup_date_range(spark, sf_dir):
    return _found(
        S.lookup_range(*searchable_orders(spark, sf_dir), KEY, "day", date(1999, 2, 28)
        )
    )


@query(FOUND + "year >= 1996.5 AND year <= 1998.5")
def lookup_fraction_bound(spark, sf_dir):
    return _found(
        S.lookup_range(*searchable_orders(spark, sf_dir), KEY, "year", 1996.5, 1998.5)
    )


def _priced(spark, sf_dir):
    """Orders with a decimal price and a single-precision number, and their postings."""
    orders = table(spark, sf_dir, "orders").select(
        KEY,
        F.round("o_totalprice", 2).cast("decimal(12,2)").alias("price"),
        (col("o_custkey") / 3).cast("float").alias("third"),
    )
    path = scratch_path(spark, "priced_orders")
    write_table(orders, path)
    base = read_table(spark, path)
    terms = scratch_path(spark, "priced_postings")
    T.write_postings(T.postings(base, KEY, ["price", "third"]), terms)
    return base, T.read_postings(spark, terms)


@query(
    """SELECT o_orderkey FROM orders
WHERE CAST(round(o_totalprice, 2) AS DECIMAL(12, 2)) BETWEEN 9000.25 AND 100000"""
)
def lookup_decimal_range(spark, sf_dir):
    bounds = (Decimal("9000.25"), 100000)
    return S.lookup_range(*_priced(spark, sf_dir), KEY, "price", *bounds).select(KEY)


# 7 / 3 in single precision, as a double: only the widened value is equal to it.
@query(
    """SELECT o_orderkey FROM orders
WHERE CAST(CAST(o_custkey / 3 AS FLOAT) AS DOUBLE) = 2.3333332538604736"""
)
def lookup_float_exact(spark, sf_dir):
    return S.lookup(*_priced(spark, sf_dir), KEY, "third", 2.3333332538604736).select(KEY)


@query(
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS value, count(*) AS n FROM orders
GROUP BY ALL"""
)
def facet_numbers_by_postings(spark, sf_dir):
    return T.facet_from_postings(order_postings(spark, sf_dir), "year")


@query(FOUND + "list_contains(flags, 'R') AND attrs['status'] = 'F'")
def lookup_join_bucketed(spark, sf_dir):
    name = f"searchable_{uuid4().hex}"
    place = scratch_path(spark, "bucketed")
    T.save_searchable(nested_orders(spark, sf_dir), name, place, KEY, ["flags", "attrs"], 8)
    terms = [("flags", "R"), ("attrs.status", "F")]
    both = spark.table(name), spark.table(f"{name}_postings")
    return _found(S.lookup_all(*both, KEY, terms))


@query(FOUND + "list_contains(flags, 'A') AND attrs['status'] = 'F'")
def lookup_after_append(spark, sf_dir):
    orders = stored(nested_orders(spark, sf_dir), "grown_source")
    first = col("o_orderkey") % 3 == 0
    path, terms = scratch_path(spark, "grown"), scratch_path(spark, "grown_postings")
    write_table(orders.filter(first), path)
    T.write_postings(T.postings(read_table(spark, path), KEY, ["flags", "attrs"]), terms)
    T.append_rows(orders.filter(~first), path, terms, KEY)
    wanted = [("flags", "A"), ("attrs.status", "F")]
    found = S.lookup_all(read_table(spark, path), T.read_postings(spark, terms), KEY, wanted)
    return _found(found)


@query(
    FOUND
    + """CASE WHEN o_orderkey % 5 = 0 THEN 'upserted' ELSE attrs['status'] END = 'upserted'
UNION ALL SELECT o_orderkey, o_totalprice FROM orders_nested
WHERE o_orderkey % 5 <> 0 AND attrs['status'] = 'F'"""
)
def lookup_after_upsert(spark, sf_dir):
    orders, terms = searchable_orders(spark, sf_dir)
    changed = orders.filter(col(KEY) % 5 == 0).withColumn(
        "attrs", F.create_map(F.lit("status"), F.lit("upserted"))
    )
    table_now = upsert(orders, changed, KEY)
    terms_now = T.upserted_postings(terms, changed, KEY)
    wanted = [("attrs.status", "upserted"), ("attrs.status", "F")]
    return _found(S.lookup_any(table_now, terms_now, KEY, wanted))


def _order_bits(spark, sf_dir):
    """Nested orders and the stored words of their terms."""
    orders = nested_orders(spark, sf_dir)
    path = scratch_path(spark, "order_bits")
    B.write_bit_postings(orders, KEY, ORDER_TERMS, path)
    return orders, B.read_bit_postings(spark, path)


@query(
    ORDERS_SQL
    + """SELECT 'and' AS kind, count(*) AS n FROM orders_nested
WHERE list_contains(flags, 'A') AND attrs['status'] = 'F' AND attrs['tier.1'] = 'high'
UNION ALL SELECT 'or', count(*) FROM orders_nested
WHERE list_contains(flags, 'A') OR attrs['priority'] = '1-URGENT' OR year = 1996
UNION ALL SELECT 'not', count(*) FROM orders_nested
WHERE NOT list_contains(flags, 'A') AND attrs['status'] = 'O' AND NOT (attrs['priority'] = '1-URGENT')
UNION ALL SELECT 'range', count(*) FROM orders_nested
WHERE o_totalprice BETWEEN 1000.5 AND 90000 AND day >= DATE '1996-02-03' AND NOT list_contains(by_status['F'], 'R')
UNION ALL SELECT 'missing', count(*) FROM orders_nested
WHERE attrs['tier.1'] IS NULL AND flags IS NOT NULL AND NOT (closed = true OR year < 1994)"""
)
def bits_counts(spark, sf_dir):
    _, words = _order_bits(spark, sf_dir)
    has_a, urgent = B.term("flags", "A"), B.term("attrs.priority", "1-URGENT")
    conditions = {
        "and": has_a & B.term("attrs.status", "F") & B.term("attrs.`tier.1`", "high"),
        "or": has_a | urgent | B.term("year", 1996),
        "not": ~has_a & B.term("attrs.status", "O") & ~urgent,
        "range": B.between("o_totalprice", 1000.5, 90000)
        & B.between("day", date(1996, 2, 3))
        & ~B.term("by_status.F", "R"),
        "missing": ~B.present("attrs.`tier.1`")
        & B.present("flags")
        & ~(B.term("closed", True) | ~B.between("year", 1994)),
    }
    counts = [B.count_rows(words, c).select(F.lit(k).alias("kind"), "n") for k, c in conditions.items()]
    return reduce(DataFrame.unionByName, counts)


# DuckDB calls it false, not unknown, when a list has a null and lacks the value.
@query(
    FOUND
    + """(NOT list_contains(marks, 'R') AND len(list_filter(marks, lambda x: x IS NULL)) = 0
  OR attrs['priority'] LIKE '1%')
AND NOT (attrs['status'] = 'O' AND list_contains(flags, 'N'))"""
)
def bits_rows(spark, sf_dir):
    orders, words = _order_bits(spark, sf_dir)
    open_new = B.term("attrs.status", "O") & B.term("flags", "N")
    wanted = (~B.term("marks", "R") | B.prefix("attrs.priority", "1")) & ~open_new
    return _found(B.rows_where(orders, words, KEY, wanted))


@query(
    ORDERS_SQL
    + """, chosen AS (SELECT * FROM orders_nested
  WHERE attrs['status'] = 'F' AND day > DATE '1993-05-29' AND NOT list_contains(flags, 'R'))
SELECT 'flags' AS facet, value, count(*) AS n FROM (
  SELECT unnest(list_distinct(flags)) AS value FROM chosen) WHERE value IS NOT NULL GROUP BY value
UNION ALL SELECT 'priority', attrs['priority'], count(*) FROM chosen
WHERE attrs['priority'] IS NOT NULL GROUP BY ALL"""
)
def bits_facet_filtered(spark, sf_dir):
    _, words = _order_bits(spark, sf_dir)
    chosen = B.term("attrs.status", "F") & B.between("day", date(1993, 5, 30)) & ~B.term("flags", "R")
    facets = {"flags": "flags", "priority": "attrs.priority"}
    counted = [
        B.facet_where(words, path, chosen).select(F.lit(name).alias("facet"), "value", "n")
        for name, path in facets.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def _doc_grams(spark, sf_dir):
    """Stored documents, their postings, term counts, and the pieces of their terms."""
    docs, terms = searchable_docs(spark, sf_dir)
    counts_path, grams_path = scratch_path(spark, "doc_counts"), scratch_path(spark, "doc_grams")
    write_table(T.term_counts(terms), counts_path, partition_by=["field"], sort_by=["path", "value"])
    counts = read_table(spark, counts_path)
    G.write_grams(G.term_grams(counts), grams_path)
    return docs, terms, counts, G.read_grams(spark, grams_path)


@query(
    DOCS_SQL
    + """SELECT 'tionen' AS text, doc_id FROM docs_nested WHERE len(list_filter(words, lambda w: suffix(w, 'tionen'))) > 0
UNION ALL SELECT 'x', doc_id FROM docs_nested WHERE len(list_filter(words, lambda w: suffix(w, 'x'))) > 0
UNION ALL SELECT '7', doc_id FROM docs_nested WHERE suffix(meta['source'], '7')"""
)
def lookup_suffix(spark, sf_dir):
    found = _doc_grams(spark, sf_dir)
    wanted = [("words", "tionen"), ("words", "x"), ("meta.source", "7")]
    rows = [
        G.lookup_suffix(*found, "doc_id", path, text).select(F.lit(text).alias("text"), "doc_id")
        for path, text in wanted
    ]
    return reduce(DataFrame.unionByName, rows)


@query(
    DOCS_SQL
    + """SELECT 'ableth' AS text, doc_id FROM docs_nested WHERE len(list_filter(words, lambda w: contains(w, 'ableth'))) > 0
UNION ALL SELECT 'qu', doc_id FROM docs_nested WHERE len(list_filter(words, lambda w: contains(w, 'qu'))) > 0
UNION ALL SELECT '%', doc_id FROM docs_nested WHERE len(list_filter(words, lambda w: contains(w, '%'))) > 0"""
)
def lookup_containing(spark, sf_dir):
    found = _doc_grams(spark, sf_dir)
    rows = [
        G.lookup_containing(*found, "doc_id", "words", text).select(F.lit(text).alias("text"), "doc_id")
        for text in ("ableth", "qu", "%")
    ]
    return reduce(DataFrame.unionByName, rows)

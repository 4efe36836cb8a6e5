"""Facets: grouping by the elements of array paths."""

from __future__ import annotations

from pyspark.sql import functions as F

from facetframe.operators.facets import facet
from facetframe.plans.prepared import nested_docs, nested_orders
from facetframe.plans.registry import query
from facetframe.sources.nested import (
    CUSTOMER_SQL,
    DOCS_SQL,
    ORDERS_SQL,
)


def outer(array: str) -> str:
    """SQL for ``explode_outer``: a null or empty array gives one null."""
    return f"unnest(CASE WHEN len({array}) > 0 THEN {array} ELSE [NULL] END)"


@query(
    ORDERS_SQL
    + f"SELECT flags, count(*) AS count FROM (SELECT {outer('flags')} AS flags FROM orders_nested)"
    + " GROUP BY flags"
)
def facet_array(spark, sf_dir):
    return facet(nested_orders(spark, sf_dir), "flags")


@query(
    DOCS_SQL
    + f"SELECT word, count(*) AS n FROM (SELECT {outer('words')} AS word FROM docs_nested)"
    + " GROUP BY word"
)
def facet_words(spark, sf_dir):
    return facet(nested_docs(spark, sf_dir), {"word": "words"}, {"n": F.count("*")})


@query(
    ORDERS_SQL
    + f"""SELECT flag, count(*) AS n FROM
(SELECT {outer("by_status['F']")} AS flag FROM orders_nested) GROUP BY flag"""
)
def facet_map_of_array(spark, sf_dir):
    return facet(nested_orders(spark, sf_dir), {"flag": "by_status.F"}, {"n": F.count("*")})


@query(
    ORDERS_SQL
    + f"""SELECT flags, count(*) AS n FROM
(SELECT {outer("detail.flags")} AS flags FROM orders_nested) GROUP BY flags"""
)
def facet_struct_array(spark, sf_dir):
    return facet(nested_orders(spark, sf_dir), "detail.flags", {"n": F.count("*")})


@query(
    ORDERS_SQL
    + f"""SELECT on_f, on_o, count(*) AS n FROM
(SELECT on_f, {outer("o_flags")} AS on_o FROM
 (SELECT {outer("by_status['F']")} AS on_f, by_status['O'] AS o_flags FROM orders_nested))
GROUP BY on_f, on_o"""
)
def facet_several(spark, sf_dir):
    both = {"on_f": "by_status.F", "on_o": "by_status.O"}
    return facet(nested_orders(spark, sf_dir), both).withColumnRenamed("count", "n")


@query(
    ORDERS_SQL
    + f"""SELECT flags, count(*) AS n, count(closed) AS n_closed, min(o_totalprice) AS lowest,
       max(o_totalprice) AS highest, round(sum(o_totalprice), 2) AS total FROM
(SELECT {outer("flags")} AS flags, closed, o_totalprice FROM orders_nested) GROUP BY flags"""
)
def facet_metrics(spark, sf_dir):
    return facet(
        nested_orders(spark, sf_dir),
        "flags",
        {
            "n": F.count("*"),
            "n_closed": F.count("closed"),
            "lowest": F.min("o_totalprice"),
            "highest": F.max("o_totalprice"),
            "total": F.round(F.sum("o_totalprice"), 2),
        },
    )


@query(
    ORDERS_SQL
    + f"SELECT marks, count(*) AS n FROM (SELECT {outer('marks')} AS marks FROM orders_nested)"
    + " GROUP BY marks"
)
def facet_null_bucket(spark, sf_dir):
    return facet(nested_orders(spark, sf_dir), "marks", {"n": F.count("*")})


# list_distinct drops nulls, so a null element is put back once.
@query(
    ORDERS_SQL
    + f"""SELECT marks, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM
(SELECT {outer("uniq")} AS marks, o_totalprice FROM
 (SELECT list_concat(list_distinct(marks),
         CASE WHEN len(list_filter(marks, lambda x: x IS NULL)) > 0 THEN [NULL] ELSE [] END) AS uniq,
         o_totalprice FROM orders_nested))
GROUP BY marks"""
)
def facet_once_per_row(spark, sf_dir):
    return facet(
        nested_orders(spark, sf_dir),
        "marks",
        {"n": F.count("*"), "total": F.round(F.sum("o_totalprice"), 2)},
        dedup=True,
    )


@query(
    DOCS_SQL
    + f"""SELECT word, count(*) AS n FROM
(SELECT {outer("list_distinct(words)")} AS word FROM docs_nested) GROUP BY word"""
)
def facet_words_once(spark, sf_dir):
    return facet(nested_docs(spark, sf_dir), {"word": "words"}, {"n": F.count("*")}, dedup=True)


@query(
    ORDERS_SQL
    + f"""SELECT flags, count(*) AS n FROM
(SELECT {outer("flags")} AS flags FROM orders_nested
 WHERE attrs['status'] = 'O' AND day > DATE '1997-05-29' AND list_contains(flags, 'R'))
GROUP BY flags"""
)
def facet_filtered(spark, sf_dir):
    return facet(
        nested_orders(spark, sf_dir),
        "flags",
        {"n": F.count("*")},
        where="attrs['status'] = 'O' AND day > '1997-05-29' AND array_contains(flags, 'R')",
    )


@query(
    CUSTOMER_SQL
    + f"""SELECT flags, segment, year, count(*) AS n, max(o_totalprice) AS highest FROM
(SELECT {outer("flags")} AS flags, cust.segment AS segment, year, o_totalprice FROM orders_cust)
GROUP BY flags, segment, year"""
)
def facet_mixed(spark, sf_dir):
    return facet(
        nested_orders(spark, sf_dir),
        ["flags", "cust.segment", "year"],
        {"n": F.count("*"), "highest": F.max("o_totalprice")},
    )

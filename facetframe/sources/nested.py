"""Nested tables derived from the flat inputs, and the same derivations as SQL.

The SQL is what a reader of the flat tables would write; it exists to check the DataFrames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from facetframe.functions.predicates import words


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _attrs() -> Column:
    """Null, empty, with a missing key, with a null value, and with a key containing a dot."""
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    core = [F.lit("status"), status, F.lit("priority"), F.col("o_orderpriority")]
    tier = F.when(price >= 250000, F.lit("high"))
    return (
        F.when(status == "P", F.lit(None))
        .when((status == "O") & (price < 50000), F.create_map().cast("map<string,string>"))
        .when(price < 150000, F.create_map(*core))
        .otherwise(F.create_map(*core, F.lit("tier.1"), tier))
    )


def orders_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with a map, arrays, a map of arrays and structs.

    ``lines`` holds the (flag, status) pairs of the order's line items with their number ``n``, so
    no line item is lost. The number of pairs is bounded by the two code lists, and they are counted
    before the shuffle, so an order with very many line items costs a task no more than any other.
    ``flags`` has one entry per pair. ``cust`` is null where there is no such customer.
    """
    pairs = (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            "l_orderkey",
            F.col("l_returnflag").alias("flag"),
            F.col("l_linestatus").alias("status"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("l_orderkey")
        .agg(F.sort_array(F.collect_list(F.struct("flag", "status", "n"))).alias("lines"))
    )
    flags = F.col("lines.flag")

    def with_status(code: str) -> Column:
        return F.transform(F.filter("lines", lambda x: x.status == code), lambda x: x.flag)

    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.struct(
            F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
        ).alias("cust"),
    )
    return (
        table(spark, sf_dir, "orders")
        .join(pairs, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(customers, "o_custkey", "left")
        .select(
            "o_orderkey",
            "o_custkey",
            "o_orderstatus",
            "o_totalprice",
            F.col("o_orderdate").alias("placed"),
            F.to_date("o_orderdate").alias("day"),
            F.year("o_orderdate").alias("year"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "F").alias("closed"),
            _attrs().alias("attrs"),
            "lines",
            flags.alias("flags"),
            F.transform(flags, lambda f: F.when(f != "N", f)).alias("marks"),
            F.when(
                F.col("lines").isNotNull(),
                F.create_map(F.lit("F"), with_status("F"), F.lit("O"), with_status("O")),
            ).alias("by_status"),
            F.struct(
                F.col("o_orderpriority").alias("priority"),
                F.col("o_orderpriority").startswith("1").alias("urgent"),
                flags.alias("flags"),
            ).alias("detail"),
            "cust",
        )
    )


ORDERS_SQL = """
WITH pairs AS (
  SELECT l_orderkey, l_returnflag AS flag, l_linestatus AS status, count(*) AS n FROM lineitem
  GROUP BY ALL),
line_lists AS (
  SELECT l_orderkey, list({'flag': flag, 'status': status, 'n': n} ORDER BY flag, status) AS lines,
         list(flag ORDER BY flag, status) AS flags,
         list(CASE WHEN flag <> 'N' THEN flag END ORDER BY flag, status) AS marks,
         coalesce(list(flag ORDER BY flag) FILTER (WHERE status = 'F'), []) AS flags_f,
         coalesce(list(flag ORDER BY flag) FILTER (WHERE status = 'O'), []) AS flags_o
  FROM pairs GROUP BY l_orderkey),
orders_nested AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate AS placed,
         CAST(o_orderdate AS DATE) AS day, CAST(year(o_orderdate) AS INTEGER) AS year,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus = 'F' END AS closed,
         CASE WHEN o_orderstatus = 'P' THEN NULL
              WHEN o_orderstatus = 'O' AND o_totalprice < 50000
                THEN CAST(map {} AS MAP(VARCHAR, VARCHAR))
              WHEN o_totalprice < 150000
                THEN map {'status': o_orderstatus, 'priority': o_orderpriority}
              ELSE map {'status': o_orderstatus, 'priority': o_orderpriority,
                        'tier.1': CASE WHEN o_totalprice >= 250000 THEN 'high' END}
         END AS attrs,
         lines, flags, marks,
         CASE WHEN lines IS NOT NULL THEN map {'F': flags_f, 'O': flags_o} END AS by_status,
         {'priority': o_orderpriority, 'urgent': o_orderpriority LIKE '1%', 'flags': flags} AS detail
  FROM orders LEFT JOIN line_lists ON l_orderkey = o_orderkey)
"""


CUSTOMER_SQL = (
    ORDERS_SQL.rstrip()
    + """,
orders_cust AS (
  SELECT o.*, CASE WHEN c_custkey IS NOT NULL
                   THEN {'name': c_name, 'segment': c_mktsegment} END AS cust
  FROM orders_nested o LEFT JOIN customer ON c_custkey = o_custkey)
"""
)


def events_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their JSON properties as a map."""
    return table(spark, sf_dir, "events").withColumn(
        "props", F.from_json("props", "map<string,string>")
    )


def docs_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as the words of their whole text, with a map of their labels."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        words("text").alias("words"),
        F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source")).alias("meta"),
        "n_chars",
    )


DOCS_SQL = """
WITH docs_nested AS (
  SELECT doc_id,
         list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{M}\\p{N}]+'), lambda w: w <> '') AS words,
         map {'lang': lang, 'source': source} AS meta, n_chars
  FROM documents)
"""

"""Tables: writing, reading, schemas, partitions, SQL access, appending, compaction, upserts."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from facetframe.functions.paths import (
    identity,
    path_column,
    promoted_columns,
    quoted,
    where,
    without_promoted,
)
from facetframe.functions.predicates import contains_value
from facetframe.operators.postings import append_rows, postings, write_postings
from facetframe.operators.search import lookup, lookup_all, lookup_any
from facetframe.operators.upsert import upsert
from facetframe.plans.prepared import (
    nested_orders,
    orders_by_year_path,
    orders_path,
    stored_orders,
)
from facetframe.plans.registry import query
from facetframe.sources.nested import ORDERS_SQL, orders_nested, table
from facetframe.sources.scratch import scratch_path, stored
from facetframe.sources.tables import Layout, compact, read_table, write_table
from facetframe.sources.versions import (
    Summary,
    append_batch,
    compact_batches,
    create_versioned,
    delete_batch,
    read_summary,
    read_versioned,
    upsert_batch,
    version_files,
    versioned_postings,
)

col = F.col

ATTRS_SQL = """array_to_string(list_transform(list_sort(map_keys(attrs)),
  lambda k: k || '=' || coalesce(attrs[k], '~')), '|')"""


def attrs_text():
    entries = F.transform(
        F.array_sort(F.map_keys("attrs")),
        lambda k: F.concat(k, F.lit("="), F.coalesce(col("attrs")[k], F.lit("~"))),
    )
    return F.array_join(entries, "|")


@query(ORDERS_SQL + f"SELECT o_orderkey, {ATTRS_SQL} AS attrs, attrs['status'] AS status FROM orders_nested")
def table_write(spark, sf_dir):
    path = scratch_path(spark, "written")
    write_table(
        orders_nested(spark, sf_dir),
        path,
        sort_by=["attrs.status"],
        promote=["attrs.status"],
        bloom=["attrs.status"],
    )
    raw = spark.read.parquet(path)
    shadow = promoted_columns(raw)[identity("attrs.status")]
    return raw.select(
        "o_orderkey", attrs_text().alias("attrs"), col(quoted(shadow)).alias("status")
    )


@query(
    ORDERS_SQL
    + f"""SELECT o_orderkey, CAST(day AS VARCHAR) AS day, {ATTRS_SQL} AS attrs,
  array_to_string(list_transform(marks, lambda v: coalesce(v, '~')), '|') AS marks,
  array_to_string(by_status['F'], '|') AS on_f, detail.urgent AS urgent FROM orders_nested"""
)
def table_read(spark, sf_dir):
    return without_promoted(stored_orders(spark, sf_dir)).select(
        "o_orderkey",
        col("day").cast("string").alias("day"),
        attrs_text().alias("attrs"),
        F.array_join("marks", "|", "~").alias("marks"),
        F.array_join("by_status.F", "|").alias("on_f"),
        "detail.urgent",
    )


@query(
    ORDERS_SQL
    + """SELECT 'bigint' AS orderkey, 'double' AS price, 'date' AS day, 'timestamp_ntz' AS placed,
       'boolean' AS closed, 'map<string,string>' AS attrs,
       'array<struct<flag:string,status:string,n:bigint>>' AS lines, 'array<string>' AS flags,
       'map<string,array<string>>' AS by_status,
       'struct<priority:string,urgent:boolean,flags:array<string>>' AS detail, count(*) AS n
FROM orders_nested"""
)
def table_schema(spark, sf_dir):
    names = {
        "orderkey": "o_orderkey",
        "price": "o_totalprice",
        **{c: c for c in ["day", "placed", "closed", "attrs", "lines", "flags", "by_status", "detail"]},
    }
    types = [F.typeof(c).alias(n) for n, c in names.items()]
    return (
        stored_orders(spark, sf_dir)
        .select(*types)
        .groupBy(*names)
        .agg(F.count("*").alias("n"))
    )


@query(
    ORDERS_SQL
    + """SELECT o_orderkey, attrs['priority'] AS priority, len(flags) AS n_flags,
       CAST(NULL AS VARCHAR) AS absent FROM orders_nested WHERE flags IS NOT NULL"""
)
def table_user_schema(spark, sf_dir):
    schema = "o_orderkey BIGINT, attrs MAP<STRING,STRING>, flags ARRAY<STRING>, absent STRING"
    return (
        read_table(spark, orders_path(spark, sf_dir), schema)
        .filter(col("flags").isNotNull())
        .select(
            "o_orderkey",
            col("attrs.priority").alias("priority"),
            F.size("flags").cast("bigint").alias("n_flags"),
            "absent",
        )
    )


@query(
    ORDERS_SQL
    + """SELECT year, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders_nested GROUP BY year"""
)
def table_partitioned(spark, sf_dir):
    return (
        read_table(spark, orders_by_year_path(spark, sf_dir))
        .groupBy("year")
        .agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    )


@query(
    ORDERS_SQL
    + """SELECT o_orderkey, year, attrs['status'] AS status FROM orders_nested
WHERE year IN (1996, 1997) AND attrs['status'] = 'F'"""
)
def table_partition_pruning(spark, sf_dir):
    return (
        read_table(spark, orders_by_year_path(spark, sf_dir))
        .filter(col("year").isin(1996, 1997) & (col("attrs.status") == "F"))
        .select("o_orderkey", "year", col("attrs.status").alias("status"))
    )


# The years are chosen by a table, so only running the query tells which folders it reads.
@query(
    ORDERS_SQL
    + """SELECT o_orderkey, o.year, o_totalprice FROM orders_nested o JOIN (
  SELECT year(o_orderdate) AS year, count(*) AS n FROM orders GROUP BY ALL) c ON c.year = o.year
WHERE c.n > 1 AND c.year % 3 = 0"""
)
def table_pruning_by_join(spark, sf_dir):
    years = scratch_path(spark, "years")
    calendar = table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year"))
    write_table(calendar.agg(F.count("*").alias("n")), years)
    chosen = read_table(spark, years).filter("n > 1 AND year % 3 = 0").select("year")
    orders = read_table(spark, orders_by_year_path(spark, sf_dir))
    return orders.join(chosen, "year").select("o_orderkey", "year", "o_totalprice")


@query("SELECT o_orderkey, o_totalprice FROM orders")
def table_listing(spark, sf_dir):
    path = scratch_path(spark, "listed")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    orders.write.parquet(path)
    orders.write.parquet(f"{path}/_staging")
    orders.write.parquet(f"{path}/.side")
    orders.write.json(f"{path}-json")
    spark.read.json(f"{path}-json").write.mode("append").json(path)
    return (
        spark.read.option("pathGlobFilter", "*.parquet")
        .option("ignoreMissingFiles", "true")
        .parquet(path)
    )


@query(
    ORDERS_SQL
    + """SELECT o_orderkey, attrs['status'] AS status FROM orders_nested
WHERE attrs['status'] = 'F' AND day > DATE '1997-05-29' AND list_contains(flags, 'A')"""
)
def table_sql_ddl(spark, sf_dir):
    orders = nested_orders(spark, sf_dir).select("o_orderkey", "day", "attrs", "flags")
    name, path = f"orders_{uuid4().hex}", scratch_path(spark, "created")
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in orders.schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{path}'")
    orders.write.insertInto(name)
    spark.sql(f"DROP TABLE {name}")
    return spark.sql(
        f"""SELECT o_orderkey, attrs['status'] AS status FROM parquet.`{path}`
        WHERE attrs.status = 'F' AND day > '1997-05-29' AND array_contains(flags, 'A')"""
    )


@query(
    ORDERS_SQL
    + "SELECT attrs['status'] AS status, count(*) AS n FROM orders_nested GROUP BY attrs['status']"
)
def table_temp_view(spark, sf_dir):
    view = f"orders_{uuid4().hex}"
    nested_orders(spark, sf_dir).createOrReplaceTempView(view)
    found = spark.sql(
        f"SELECT attrs.status AS status, count(*) AS n FROM {view} GROUP BY attrs.status"
    )
    spark.catalog.dropTempView(view)  # the plan holds what it needs
    return found


@query(
    ORDERS_SQL
    + """SELECT o_orderkey, o_orderstatus, array_to_string(flags, '|') AS flags
FROM orders_nested"""
)
def table_append(spark, sf_dir):
    path = scratch_path(spark, "appended")
    orders = nested_orders(spark, sf_dir)
    write_table(orders.filter(col("o_orderstatus") == "F"), path)
    write_table(orders.filter(col("o_orderstatus") != "F"), path, mode="append")
    return read_table(spark, path).select(
        "o_orderkey", "o_orderstatus", F.array_join("flags", "|").alias("flags")
    )


@query(
    ORDERS_SQL
    + """SELECT attrs['priority'] AS priority, count(*) AS n, round(sum(o_totalprice), 2) AS total,
       true AS fewer_files, true AS pruned FROM orders_nested WHERE year = 1997
GROUP BY attrs['priority']"""
)
def table_compact(spark, sf_dir):
    path = scratch_path(spark, "compacted")
    # The source has files of its own for each of two appended halves.
    orders = nested_orders(spark, sf_dir)
    parts = scratch_path(spark, "fragments")
    for rest in (0, 1):
        half = orders.filter(col("o_orderkey") % 2 == rest)
        write_table(half, parts, mode="append", partition_by=["year"])
    compact(spark, parts, path, 3, sort_by=["o_totalprice"])
    compacted = read_table(spark, path).filter("year = 1997")
    fewer = len(read_table(spark, path).inputFiles()) < len(read_table(spark, parts).inputFiles())
    in_year = F.input_file_name().contains("/year=1997/")
    return (
        compacted.withColumn("in_year", in_year)
        .groupBy(col("attrs.priority").alias("priority"))
        .agg(
            F.count("*").alias("n"),
            F.round(F.sum("o_totalprice"), 2).alias("total"),
            F.bool_and("in_year").alias("pruned"),
        )
        .withColumn("fewer_files", F.lit(fewer))
    )


@query(
    """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
UNION ALL
SELECT l_orderkey, l_linestatus, l_extendedprice FROM lineitem WHERE l_returnflag = 'R'"""
)
def table_upsert(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    updates = (
        table(spark, sf_dir, "lineitem")
        .filter(col("l_returnflag") == "R")
        .select(
            col("l_orderkey").alias("o_orderkey"),
            col("l_linestatus").alias("o_orderstatus"),
            col("l_extendedprice").alias("o_totalprice"),
        )
    )
    return upsert(orders, updates, "o_orderkey")


@query(
    ORDERS_SQL
    + """SELECT o_orderkey, o_totalprice FROM orders_nested
WHERE (list_contains(flags, 'R')) IS DISTINCT FROM true
UNION ALL SELECT -o_orderkey, o_totalprice FROM orders_nested WHERE o_orderstatus = 'P'"""
)
def table_upsert_term(spark, sf_dir):
    orders = nested_orders(spark, sf_dir)
    updates = orders.filter("o_orderstatus = 'P'").withColumn("o_orderkey", -col("o_orderkey"))
    upserted = upsert(orders, updates, matching=contains_value("flags", "R"))
    return upserted.select("o_orderkey", "o_totalprice")


@query(
    """SELECT via, o_orderstatus, count(*) AS n FROM orders,
  (SELECT unnest(['path', 'table']) AS via) GROUP BY ALL"""
)
def table_refresh_path(spark, sf_dir):
    path, name = scratch_path(spark, "refreshed_path"), f"orders_{uuid4().hex}"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    first = col("o_orderstatus") == "F"
    write_table(orders.filter(first), path)
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    spark.table(name).count()
    write_table(orders.filter(~first), path, mode="append")
    spark.catalog.refreshByPath(path)
    spark.sql(f"REFRESH TABLE {name}")

    def counted(df, via):
        counts = df.groupBy("o_orderstatus").agg(F.count("*").alias("n"))
        return counts.select(F.lit(via).alias("via"), "o_orderstatus", "n")

    found = counted(read_table(spark, path), "path").unionByName(counted(spark.table(name), "table"))
    spark.sql(f"DROP TABLE {name}")
    return found


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def table_refresh(spark, sf_dir):
    path = scratch_path(spark, "refreshed")
    orders = table(spark, sf_dir, "orders")
    write_table(orders.filter(col("o_orderstatus") == "F"), path)
    name = f"orders_{uuid4().hex}"
    spark.read.parquet(path).createOrReplaceTempView(name)
    write_table(orders.filter(col("o_orderstatus") != "F"), path, mode="append")
    spark.catalog.refreshTable(name)
    found = spark.sql(f"SELECT o_orderstatus, count(*) AS n FROM {name} GROUP BY o_orderstatus")
    spark.catalog.dropTempView(name)
    return found


@query(
    """SELECT 'paths' AS via, o_orderkey FROM orders UNION ALL
SELECT 'glob', o_orderkey FROM orders UNION ALL SELECT 'recursive', o_orderkey FROM orders"""
)
def table_several_paths(spark, sf_dir):
    root = scratch_path(spark, "several")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    write_table(orders.filter(col("o_orderstatus") == "F"), f"{root}/part_f")
    write_table(orders.filter(col("o_orderstatus") == "O"), f"{root}/part_o")
    write_table(orders.filter(col("o_orderstatus") == "P"), f"{root}/part_p")

    def tagged(df, via):
        return df.select(F.lit(via).alias("via"), "o_orderkey")

    listed = read_table(spark, [f"{root}/part_{s}" for s in "fop"])
    globbed = read_table(spark, f"{root}/part_*")
    recursive = spark.read.option("recursiveFileLookup", "true").parquet(root)
    return (
        tagged(listed, "paths")
        .unionByName(tagged(globbed, "glob"))
        .unionByName(tagged(recursive, "recursive"))
    )


@query(
    ORDERS_SQL
    + """SELECT o_orderkey, attrs['status'] AS status, attrs['tier.1'] AS tier
FROM orders_nested WHERE attrs['status'] = 'F' AND attrs['tier.1'] IS NOT NULL"""
)
def promoted_filter(spark, sf_dir):
    orders = stored_orders(spark, sf_dir)
    status, tier = path_column(orders, "attrs.status"), path_column(orders, "attrs.`tier.1`")
    return orders.filter((status == "F") & tier.isNotNull()).select(
        "o_orderkey", status.alias("status"), tier.alias("tier")
    )


def _halves(orders):
    """Orders in two batches by their key."""
    first = col("o_orderkey") % 3 == 0
    return orders.filter(first), orders.filter(~first)


@query(
    ORDERS_SQL
    + """SELECT o_orderkey, year, attrs['status'] AS status, true AS in_folder FROM orders_nested
WHERE year IN (1995, 1996)"""
)
def append_partitioned(spark, sf_dir):
    path = scratch_path(spark, "appended_by_year")
    first, rest = _halves(nested_orders(spark, sf_dir))
    write_table(first, path, partition_by=["year"], sort_by=["attrs.status"])
    write_table(rest, path, mode="append")
    in_folder = F.input_file_name().contains(F.concat(F.lit("/year="), col("year").cast("string"), F.lit("/")))
    found = read_table(spark, path).filter(col("year").isin(1995, 1996))
    return found.select(
        "o_orderkey", "year", path_column(found, "attrs.status").alias("status"), in_folder.alias("in_folder")
    )


@query(
    ORDERS_SQL
    + """SELECT o_orderkey, attrs['status'] AS status, o_totalprice FROM orders_nested
WHERE attrs['status'] = 'F' AND attrs['tier.1'] = 'high'"""
)
def append_promoted(spark, sf_dir):
    path, terms = scratch_path(spark, "appended_promoted"), scratch_path(spark, "appended_promoted_terms")
    first, rest = _halves(stored(nested_orders(spark, sf_dir), "appended_promoted_source"))
    write_table(first, path, promote=["attrs.status", "attrs.`tier.1`"], bloom=["o_orderkey"])
    write_postings(postings(read_table(spark, path), "o_orderkey", ["flags"]), terms)
    append_rows(rest, path, terms, "o_orderkey")
    found = where(read_table(spark, path), "attrs['status'] = 'F' AND attrs['tier.1'] = 'high'")
    return found.select("o_orderkey", path_column(found, "attrs.status").alias("status"), "o_totalprice")


def _versioned_orders(spark, sf_dir, name):
    """Orders in versions: a first batch, the rest by status, with postings and a summary.

    The nested orders are derived once and stored; they are returned with the root.
    """
    root = scratch_path(spark, name)
    orders = stored(nested_orders(spark, sf_dir), f"{name}_source")
    first, rest = _halves(orders)
    create_versioned(
        first,
        root,
        layout=Layout(partition_by=("year",), sort_by=("o_orderkey",), promote=("attrs.status",)),
        key="o_orderkey",
        posted=["flags", "attrs"],
        summaries=[Summary("by_status", ("attrs.status", "year"), ("o_totalprice", "o_custkey", "day"))],
        batch="first",
    )
    for status in "FOP":
        append_batch(rest.filter(col("o_orderstatus") == status), root, f"rest-{status}", new_keys=True)
    return root, orders


@query(
    ORDERS_SQL
    + """SELECT o_orderkey, o_totalprice, year FROM orders_nested
WHERE list_contains(flags, 'A') AND attrs['status'] = 'F'"""
)
def append_twice(spark, sf_dir):
    root, orders = _versioned_orders(spark, sf_dir, "appended_twice")
    _, rest = _halves(orders)
    append_batch(rest.filter("o_orderstatus = 'F'"), root, "rest-F")  # applied before: nothing changes
    found = lookup_all(
        read_versioned(spark, root),
        versioned_postings(spark, root),
        "o_orderkey",
        [("flags", "A"), ("attrs.status", "F")],
    )
    return found.select("o_orderkey", "o_totalprice", "year")


@query(
    ORDERS_SQL
    + """, changed AS (
  SELECT o_orderkey, o_totalprice, 'new' AS status, flags FROM orders_nested WHERE o_orderkey % 7 = 1
  UNION ALL SELECT o_orderkey, o_totalprice, attrs['status'], flags FROM orders_nested
  WHERE o_orderkey % 7 <> 1 AND o_orderkey % 7 <> 2)
SELECT o_orderkey, o_totalprice, status FROM changed
WHERE status IN ('new', 'F') AND list_contains(flags, 'R')"""
)
def upsert_batches(spark, sf_dir):
    root, orders = _versioned_orders(spark, sf_dir, "upserted_batches")
    again = orders.filter("o_orderkey % 7 = 1").withColumn("attrs", F.create_map(F.lit("status"), F.lit("old")))
    upsert_batch(again, root, "once")
    upsert_batch(again.withColumn("attrs", F.create_map(F.lit("status"), F.lit("new"))), root, "twice")
    delete_batch(orders.filter("o_orderkey % 7 = 2").select("o_orderkey"), root, "deleted")
    upsert_batch(again, root, "once")
    base, terms = read_versioned(spark, root), versioned_postings(spark, root)
    either = lookup_any(base, terms, "o_orderkey", [("attrs.status", "new"), ("attrs.status", "F")])
    found = lookup(either, terms, "o_orderkey", "flags", "R")
    return found.select("o_orderkey", "o_totalprice", path_column(found, "attrs.status").alias("status"))


@query(
    ORDERS_SQL
    + """SELECT 'old' AS version, year, count(*) AS n, round(sum(o_totalprice), 2) AS total, true AS fewer
FROM orders_nested GROUP BY year
UNION ALL SELECT 'new', year, count(*), round(sum(o_totalprice), 2), true
FROM orders_nested WHERE o_orderkey % 5 <> 0 GROUP BY year"""
)
def compact_in_place(spark, sf_dir):
    root, orders = _versioned_orders(spark, sf_dir, "compacted_in_place")
    old = read_versioned(spark, root)
    delete_batch(orders.filter("o_orderkey % 5 = 0").select("o_orderkey"), root)
    many = len(version_files(spark, root))
    compact_batches(spark, root)
    new = read_versioned(spark, root)
    fewer = len(version_files(spark, root)) < many

    def counted(rows, version):
        found = rows.groupBy("year").agg(
            F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
        )
        return found.withColumn("version", F.lit(version)).withColumn("fewer", F.lit(fewer))

    return counted(old, "old").unionByName(counted(new, "new"))


SUMMARY_SQL = """SELECT attrs['status'] AS status, year, count(*) AS n,
  count(o_totalprice) AS n_o_totalprice, min(o_totalprice) AS min_o_totalprice,
  max(o_totalprice) AS max_o_totalprice, round(sum(o_totalprice), 2) AS sum_o_totalprice,
  min(day) AS min_day, max(day) AS max_day, sum(o_custkey)::BIGINT AS sum_o_custkey
FROM orders_nested"""


def _summary(spark, root):
    return read_summary(spark, root, "by_status").select(
        "status",
        "year",
        "n",
        *[f"{kind}_o_totalprice" for kind in ("n", "min", "max")],
        F.round("sum_o_totalprice", 2).alias("sum_o_totalprice"),
        "min_day",
        "max_day",
        "sum_o_custkey",
    )


@query(ORDERS_SQL + SUMMARY_SQL + " WHERE year > 1993 GROUP BY ALL")
def summary_after_append(spark, sf_dir):
    root, _ = _versioned_orders(spark, sf_dir, "summarised")
    return _summary(spark, root).filter("year > 1993")


@query(ORDERS_SQL + SUMMARY_SQL + " WHERE o_orderkey % 4 <> 1 GROUP BY ALL")
def summary_after_delete(spark, sf_dir):
    root, orders = _versioned_orders(spark, sf_dir, "summarised_again")
    keys = orders.filter("o_orderkey % 4 = 1").select("o_orderkey")
    delete_batch(keys, root)
    return _summary(spark, root)


@query(
    """SELECT o_orderkey, o_totalprice, NULL AS clerk, CAST(o_orderkey % 1000 AS BIGINT) AS small,
  o_orderstatus AS status, NULL AS priority
FROM orders WHERE o_orderkey % 2 = 0
UNION ALL SELECT o_orderkey, o_totalprice, o_orderpriority || '!', o_orderkey * 10000000000, o_orderstatus, o_orderpriority
FROM orders WHERE o_orderkey % 2 = 1 AND o_orderkey % 5 <> 0
UNION ALL SELECT o_orderkey, NULL, NULL, NULL, NULL, NULL FROM orders WHERE o_orderkey % 2 = 1 AND o_orderkey % 5 = 0"""
)
def schema_evolves(spark, sf_dir):
    root = scratch_path(spark, "evolved")
    orders = table(spark, sf_dir, "orders")
    key, price = "o_orderkey", "o_totalprice"
    even = orders.filter("o_orderkey % 2 = 0").select(
        key, price, (col(key) % 1000).cast("int").alias("small"), F.struct(col("o_orderstatus").alias("status")).alias("s")
    )
    odd = orders.filter("o_orderkey % 2 = 1 AND o_orderkey % 5 <> 0").select(
        F.struct(col("o_orderpriority").alias("priority"), col("o_orderstatus").alias("status")).alias("s"),
        (col(key) * 10_000_000_000).alias("small"),
        key,
        price,
        F.concat("o_orderpriority", F.lit("!")).alias("clerk"),
    )
    create_versioned(even, root, layout=Layout(promote=("s.status",)), key=key, posted=["small"])
    append_batch(odd, root, new_keys=True, evolve=True)
    append_batch(orders.filter("o_orderkey % 2 = 1 AND o_orderkey % 5 = 0").select(key), root, new_keys=True, evolve=True)
    found = read_versioned(spark, root)
    return found.select(key, price, "clerk", "small", path_column(found, "s.status").alias("status"), "s.priority")

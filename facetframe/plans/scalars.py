"""Scalar function families."""

from __future__ import annotations

from pyspark.sql import functions as F

from facetframe.plans.registry import query
from facetframe.sources.nested import table

col = F.col


@query(
    """SELECT l_orderkey, l_linenumber, l_orderkey + l_partkey AS added,
       l_orderkey - l_partkey AS subtracted, l_orderkey * l_linenumber AS multiplied,
       round(l_orderkey / l_linenumber, 6) AS divided, l_orderkey % 7 AS remainder,
       -l_linenumber AS negated FROM lineitem"""
)
def arithmetic(spark, sf_dir):
    key, part, line = col("l_orderkey"), col("l_partkey"), col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        key,
        line,
        (key + part).alias("added"),
        (key - part).alias("subtracted"),
        (key * line).alias("multiplied"),
        F.round(key / line, 6).alias("divided"),
        (key % 7).alias("remainder"),
        F.negative(line).alias("negated"),
    )


@query(
    """SELECT l_orderkey, l_partkey, l_orderkey & l_partkey AS both,
       l_orderkey | l_partkey AS either, xor(l_orderkey, l_partkey) AS one,
       ~l_orderkey AS inverted FROM lineitem"""
)
def bitwise(spark, sf_dir):
    key, part = col("l_orderkey"), col("l_partkey")
    return table(spark, sf_dir, "lineitem").select(
        key,
        part,
        key.bitwiseAND(part).alias("both"),
        key.bitwiseOR(part).alias("either"),
        key.bitwiseXOR(part).alias("one"),
        F.bitwise_not(key).alias("inverted"),
    )


@query(
    """SELECT o_orderkey,
       CASE WHEN o_totalprice > 300000 THEN 'high' WHEN o_totalprice > 100000 THEN 'mid'
            ELSE 'low' END AS band,
       coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END, 'none') AS priority,
       greatest(o_orderkey, o_custkey, 500) AS most, least(o_orderkey, o_custkey, 500) AS fewest
FROM orders"""
)
def conditional(spark, sf_dir):
    price, limit = col("o_totalprice"), F.lit(500).cast("bigint")
    known = F.when(col("o_orderstatus") != "P", col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(price > 300000, "high").when(price > 100000, "mid").otherwise("low").alias("band"),
        F.coalesce(known, F.lit("none")).alias("priority"),
        F.greatest("o_orderkey", "o_custkey", limit).alias("most"),
        F.least("o_orderkey", "o_custkey", limit).alias("fewest"),
    )


@query(
    """SELECT p_partkey, abs(p_size - 25) AS a, round(log(2.5, p_retailprice), 9) AS log_b,
       round(log10(p_retailprice), 9) AS log_10, round(log2(p_size), 9) AS log_2,
       round(ln(p_size), 9) AS log_n, round(exp(p_size / 10.0), 6) AS e,
       round(pow(p_size, 1.5), 6) AS p, round(sqrt(p_size), 9) AS root,
       CAST(floor(p_retailprice / 7) AS BIGINT) AS low,
       CAST(ceil(p_retailprice / 7) AS BIGINT) AS high,
       round(p_retailprice / 7, 2) AS near, round(cbrt(p_size), 9) AS cube,
       CAST(sign(p_size - 25) AS DOUBLE) AS s,
       CAST(CASE WHEN p_size < 5 THEN 0 WHEN p_size >= 45 THEN 9
                 ELSE floor((p_size - 5) * 8 / 40.0) + 1 END AS BIGINT) AS bucket
FROM part"""
)
def math(spark, sf_dir):
    size, price = col("p_size"), col("p_retailprice")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.abs(size - 25).alias("a"),
        F.round(F.log(2.5, price), 9).alias("log_b"),
        F.round(F.log10(price), 9).alias("log_10"),
        F.round(F.log2(size), 9).alias("log_2"),
        F.round(F.ln(size), 9).alias("log_n"),
        F.round(F.exp(size / 10.0), 6).alias("e"),
        F.round(F.power(size, 1.5), 6).alias("p"),
        F.round(F.sqrt(size), 9).alias("root"),
        F.floor(price / 7).alias("low"),
        F.ceil(price / 7).alias("high"),
        F.round(price / 7, 2).alias("near"),
        F.round(F.cbrt(size), 9).alias("cube"),
        F.sign(size - 25).alias("s"),
        F.width_bucket(size.cast("double"), F.lit(5.0), F.lit(45.0), F.lit(8)).alias("bucket"),
    )


@query(
    """SELECT count(*) AS n, true AS in_range, true AS spread, true AS same_seed_same_numbers,
       true AS other_seed_other_numbers FROM part"""
)
def random_number(spark, sf_dir):
    drawn = table(spark, sf_dir, "part").select(
        F.rand(seed=3).alias("a"), F.rand(seed=3).alias("b"), F.rand(seed=4).alias("c")
    )
    return drawn.agg(
        F.count("*").alias("n"),
        F.bool_and((col("a") >= 0) & (col("a") < 1)).alias("in_range"),
        (F.avg("a").between(0.4, 0.6) & F.stddev("a").between(0.25, 0.33)).alias("spread"),
        F.bool_and(col("a") == col("b")).alias("same_seed_same_numbers"),
        (F.count_if(col("a") == col("c")) < F.count("*") / 10).alias("other_seed_other_numbers"),
    )


TRIG = ["sin", "sinh", "cos", "cosh", "tan", "tanh", "cot", "asin", "asinh", "acos", "atan", "atanh"]


@query(
    "SELECT p_partkey, "
    + ", ".join(f"round({f}(p_size / 64.0), 9) AS {f}_x" for f in TRIG)
    + """, round(acosh(p_size), 9) AS acosh_x, round(atan2(p_size, p_retailprice), 9) AS atan2_x,
       round(degrees(p_size / 64.0), 9) AS degrees_x, round(radians(p_size), 9) AS radians_x
FROM part"""
)
def trigonometry(spark, sf_dir):
    size = col("p_size")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        *[F.round(getattr(F, f)(size / 64.0), 9).alias(f"{f}_x") for f in TRIG],
        F.round(F.acosh(size), 9).alias("acosh_x"),
        F.round(F.atan2(size, "p_retailprice"), 9).alias("atan2_x"),
        F.round(F.degrees(size / 64.0), 9).alias("degrees_x"),
        F.round(F.radians(size), 9).alias("radians_x"),
    )


@query(
    """SELECT p_partkey, substring(p_name, 2, 4) AS sub, upper(p_name) AS up, lower(p_type) AS low,
       translate(p_name, 'aeiou', '12345') AS tr, trim('  ' || p_name || ' ') AS both,
       ltrim('  ' || p_name || ' ') AS leading, rtrim('  ' || p_name || ' ') AS trailing,
       bit_length(p_name) AS bits, length(p_name) AS chars,
       concat(p_name, '-', p_brand) AS joined,
       substring(p_name, 1, 2) || 'XY' || substring(p_name, 5) AS laid FROM part"""
)
def strings(spark, sf_dir):
    name = col("p_name")
    padded = F.concat(F.lit("  "), name, F.lit(" "))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.substring(name, 2, 4).alias("sub"),
        F.upper(name).alias("up"),
        F.lower("p_type").alias("low"),
        F.translate(name, "aeiou", "12345").alias("tr"),
        F.trim(padded).alias("both"),
        F.ltrim(padded).alias("leading"),
        F.rtrim(padded).alias("trailing"),
        F.bit_length(name).cast("bigint").alias("bits"),
        F.char_length(name).cast("bigint").alias("chars"),
        F.concat(name, F.lit("-"), col("p_brand")).alias("joined"),
        F.overlay(name, F.lit("XY"), 3).alias("laid"),
    )


@query(
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + 30 AS VARCHAR) AS later,
       CAST(o_orderdate AS DATE) - DATE '1995-01-01' AS days,
       CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month_start,
       CAST(CAST(date_trunc('year', o_orderdate) AS DATE) AS VARCHAR) AS year_start FROM orders"""
)
def dates(spark, sf_dir):
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_add(day, 30).cast("string").alias("later"),
        F.date_diff(day, F.lit("1995-01-01").cast("date")).cast("bigint").alias("days"),
        F.trunc(day, "month").cast("string").alias("month_start"),
        F.trunc(day, "year").cast("string").alias("year_start"),
    )


@query(
    """SELECT c_custkey, md5(c_name) AS md5, sha1(c_name) AS sha1, sha256(c_name) AS sha2,
       c_name AS restored,
       xor(list_reduce(list_transform(range(1, length(c_name) + 1),
             lambda i: CAST(ascii(substring(c_name, i, 1)) AS BIGINT)),
           lambda crc, byte: list_reduce([0, 0, 0, 0, 0, 0, 0, 0],
             lambda c, i: xor(c >> 1, 3988292384 * (c & 1)), xor(crc, byte)),
           4294967295), 4294967295) AS crc
FROM customer"""
)
def hashes(spark, sf_dir):
    name = col("c_name")
    key = F.lit("0123456789abcdef")
    sealed = F.aes_encrypt(name, key, F.lit("CBC"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.md5(name).alias("md5"),
        F.sha1(name).alias("sha1"),
        F.sha2(name, 256).alias("sha2"),
        F.aes_decrypt(sealed, key, F.lit("CBC")).cast("string").alias("restored"),
        F.crc32(name).alias("crc"),
    )

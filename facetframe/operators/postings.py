"""Postings: a term table beside a nested table, built once and searched many times.

Layout. One row per (term, row key): ``field`` is the top-level column, ``path`` the full path with
every step quoted (```m`.`key``` for a map entry), ``value`` the term as text, and the same value
typed: ``num`` (floating), ``whole`` (integral; date as days, timestamp as microseconds) or ``dec``
(decimal). Two special fields hold ``path`` rows only: ``_exists`` when an array or map is not null
(it may be empty, while an atomic path exists where it has a term), ``_has_null`` when an array has
a null element.

The posted paths and their types are kept in the metadata of ``path``, through Parquet as well, so a
lookup on a path that was not posted is refused instead of finding nothing. The row key must be
unique and not null, which is checked when postings are built.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from facetframe.functions import paths as P
from facetframe.sources.tables import write_table

EXISTS = "_exists"
HAS_NULL = "_has_null"
TYPED = ["num", "whole", "dec"]
ORDER = ["field", "path", *TYPED, "value"]
COLUMNS = ["field", "path", "value", *TYPED, "key"]
INTEGRAL = (BooleanType, ByteType, ShortType, IntegerType, LongType)
FLOATING = (FloatType, DoubleType)
DECIMAL = DecimalType(38, 18)
EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _typed(value: Column, dtype: DataType) -> dict[str, Column]:
    if isinstance(dtype, FLOATING):
        # Negative zero equals zero, as in every comparison.
        return {"num": value.cast("double") + 0.0}
    if isinstance(dtype, INTEGRAL):
        return {"whole": value.cast("bigint")}
    if isinstance(dtype, DateType):
        return {"whole": F.unix_date(value).cast("bigint")}
    if isinstance(dtype, TimestampType):
        return {"whole": F.unix_micros(value)}
    if isinstance(dtype, TimestampNTZType):
        # From its fields, so that the session time zone plays no part.
        minutes = F.unix_date(value.cast("date")).cast("bigint") * 1440
        minutes += F.hour(value) * 60 + F.minute(value)
        seconds = F.extract(F.lit("SECOND"), value)
        return {"whole": minutes * 60_000_000 + (seconds * 1_000_000).cast("bigint")}
    if isinstance(dtype, DecimalType):
        return {"dec": value.cast(DECIMAL)}
    return {}


def typed_value(dtype: DataType) -> Column:
    """The term of a posting in the type it was posted from."""
    whole = F.col("whole")
    if isinstance(dtype, FLOATING):
        return F.col("num").cast(dtype)
    if isinstance(dtype, INTEGRAL):
        return whole.cast(dtype)
    if isinstance(dtype, DateType):
        return F.date_from_unix_date(whole.cast("int"))
    if isinstance(dtype, TimestampType):
        return F.timestamp_micros(whole)
    if isinstance(dtype, TimestampNTZType):
        return F.expr(f"timestampadd(MICROSECOND, whole, {EPOCH})")
    if isinstance(dtype, DecimalType):
        return F.col("dec").cast(dtype)
    return F.col("value")


def _check_atomic(dtype: DataType) -> None:
    if isinstance(dtype, (StructType, ArrayType, MapType)):
        raise TypeError(f"postings need atomic values, got {dtype.simpleString()}; name its leaves")
    if isinstance(dtype, DecimalType) and (
        dtype.scale > DECIMAL.scale
        or dtype.precision - dtype.scale > DECIMAL.precision - DECIMAL.scale
    ):
        raise TypeError(f"{dtype.simpleString()} does not fit {DECIMAL.simpleString()}")


def _term(field: str | Column, path: Column, value: Column | None, dtype: DataType) -> Column:
    typed = {} if value is None else _typed(value, dtype)
    text = F.lit(None) if value is None else typed.get("num", value)
    if isinstance(dtype, FLOATING) and value is not None:
        text = text.cast(dtype)
    kinds = {"num": "double", "whole": "bigint", "dec": DECIMAL.simpleString()}
    return F.struct(
        (F.lit(field) if isinstance(field, str) else field).alias("field"),
        path.alias("path"),
        text.cast("string").alias("value"),
        *[typed.get(k, F.lit(None)).cast(kind).alias(k) for k, kind in kinds.items()],
    )


def _terms(value: Column, path: Column, field: str, dtype: DataType) -> Column:
    """All postings of one value, as an array of structs; empty where it is null."""
    mark = _term(EXISTS, path, None, StringType())
    none = F.filter(F.array(mark), lambda _: F.lit(False))
    if isinstance(dtype, MapType):
        _check_atomic(dtype.keyType)

        def entry(e: Column) -> Column:
            key = e.getField("key")
            text = F.replace(key.cast("string"), F.lit("`"), F.lit("``"))
            deeper = F.concat(path, F.lit(".`"), text, F.lit("`"))
            of_key = F.array(_term(field, path, key, dtype.keyType))
            return F.concat(of_key, _terms(e.getField("value"), deeper, field, dtype.valueType))

        inner = F.flatten(F.transform(F.map_entries(value), entry))
        return F.when(value.isNotNull(), F.concat(F.array(mark), inner)).otherwise(none)
    if isinstance(dtype, ArrayType):
        _check_atomic(dtype.elementType)

        def element(v: Column) -> Column:
            kind = F.when(v.isNull(), F.lit(HAS_NULL)).otherwise(F.lit(field))
            return _term(kind, path, v, dtype.elementType)

        plain = value
        if isinstance(dtype.elementType, FLOATING):
            plain = F.transform(value, lambda v: v + F.lit(0.0).cast(dtype.elementType))
        inner = F.transform(F.array_distinct(plain), element)
        return F.when(value.isNotNull(), F.concat(F.array(mark), inner)).otherwise(none)
    _check_atomic(dtype)
    one = F.array(_term(field, path, value, dtype))
    return F.when(value.isNotNull(), one).otherwise(none)


def check_key(df: DataFrame, key: str) -> None:
    """Refuse a row key that repeats or is null. One aggregate of the key column."""
    repeated = df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    bad = repeated.filter(F.col("key").isNull() | (F.col("n") > 1)).head()
    if bad is not None:
        raise ValueError(f"{key} must be unique and not null; {bad['key']!r} is on {bad['n']} rows")


def term_arrays(df: DataFrame, paths: Sequence[str]) -> list[Column]:
    """For every path, all postings of a row as an array."""
    return [_terms(F.col(p), F.lit(P.identity(p)), P.steps(p)[0], P.path_type(df, p)) for p in paths]


def postings(
    df: DataFrame, key: str, paths: Sequence[str], *, key_is_checked: bool = False
) -> DataFrame:
    """``field``, ``path``, ``value``, ``num``, ``whole``, ``dec`` and ``key`` of every term.

    One scan of the key and the posted paths: a row turns into the array of all its postings, which
    is taken apart once. Repeated array elements are dropped inside the row, so a row has each term
    once, without a shuffle. ``key_is_checked`` skips the check of the key.
    """
    posted = {P.identity(p): P.path_type(df, p) for p in paths}
    if not key_is_checked:
        check_key(df, key)
    rows = df.select(F.col(key).alias("key"), F.concat(*term_arrays(df, paths)).alias("terms"))
    flat = rows.select("key", F.inline("terms"))
    types = StructType([StructField(p, t) for p, t in posted.items()])
    metadata = {"posted": types.json()}
    return flat.select(
        "field", F.col("path").alias("path", metadata=metadata), "value", *TYPED, "key"
    )


def _posted(postings: DataFrame) -> StructType:
    """The posted paths and their types."""
    recorded = postings.schema["path"].metadata.get("posted")
    if recorded is None:
        raise ValueError("these are not postings: their paths are not recorded")
    return StructType.fromJson(json.loads(recorded))


def posted_type(postings: DataFrame, path: str) -> DataType:
    """The type at a path, from the paths recorded with the postings."""
    wanted, known = P.steps(path), _posted(postings)
    for field in known:
        root = P.steps(field.name)
        if wanted[: len(root)] != root:
            continue
        dtype, rest = field.dataType, wanted[len(root) :]
        while rest and isinstance(dtype, MapType):
            dtype, rest = dtype.valueType, rest[1:]
        if not rest:
            return dtype
    raise ValueError(f"path {path} was not posted; posted are {known.names}")


def write_postings(terms: DataFrame, path: str, *, mode: str = "overwrite", salts: int = 8) -> None:
    """Write postings hash-partitioned by term, one directory per field, sorted by term.

    A salt from the row key spreads a term that most rows have over ``salts`` tasks. Hashing needs
    no sample of the postings, so they are computed once. Adaptive execution splits what is too much
    for a task to sort in memory.
    """
    salt = F.pmod(F.xxhash64("key"), F.lit(salts))
    placed = terms.withColumn("__place", F.hash("field", "path", F.xxhash64("value"), salt))
    (
        placed.hint("rebalance", "__place")
        .drop("__place")
        .sortWithinPartitions(*ORDER)
        .write.mode(mode)
        .partitionBy("field")
        .parquet(path)
    )


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*COLUMNS)


def check_new_keys(df: DataFrame, table: DataFrame, key: str) -> None:
    """Refuse rows whose keys repeat, are null, or are in the table.

    Only the new keys are grouped; the table's are met by a semi join on its key column, which reads
    no other column and shuffles them only if the new keys are too many to broadcast.
    """
    check_key(df, key)
    fresh = df.select(F.col(key).alias("key"))
    known = table.select(F.col(key).alias("key"))
    taken = known.join(fresh, "key", "left_semi").head()
    if taken is not None:
        raise ValueError(f"{key} must be unique and not null; {taken['key']!r} is in the table")


def append_rows(df: DataFrame, table: str, terms: str, key: str) -> None:
    """Append rows to a stored table in its layout, and their terms to its postings.

    The keys must be new. The postings are written first: until the rows follow, lookups find keys
    without rows, which a join drops. A call that stops between the two writes leaves such postings
    behind; where batches must be repeatable, keep the table in versions (``append_batch``).
    """
    spark = df.sparkSession
    known = read_postings(spark, terms)
    check_new_keys(df, spark.read.parquet(table), key)
    paths = _posted(known).names
    write_postings(postings(df, key, paths, key_is_checked=True), terms, mode="append")
    write_table(df, table, mode="append")


def upserted_postings(postings_: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """The postings of a table after an upsert on its row key: those of replaced rows give way."""
    paths = _posted(postings_).names
    replaced = updates.select(F.col(key).alias("key")).distinct()
    fresh = postings(updates, key, paths)
    kept = postings_.select(*COLUMNS).join(replaced, "key", "left_anti").select(*COLUMNS)
    both = kept.unionByName(fresh)
    return both.withMetadata("path", fresh.schema["path"].metadata)


def save_searchable(
    df: DataFrame, name: str, location: str, key: str, paths: Sequence[str], buckets: int
) -> None:
    """Save a table and its postings as catalog tables ``name`` and ``name_postings``.

    Both are bucketed by the row key into the same number of buckets, so joins of the two need no
    shuffle on either side. A large bucket is written by several tasks, as several files.
    """
    root = location.rstrip("/")

    def save(table: DataFrame, table_name: str, on: str, sort: list[str], fields: list[str]):
        writer = table.write.mode("overwrite").bucketBy(buckets, on).sortBy(*sort)
        if fields:
            writer = writer.partitionBy(*fields)
        writer.option("path", f"{root}/{table_name}").saveAsTable(table_name)

    save(df.hint("rebalance", P.quoted(key)), name, key, [key], [])
    terms = postings(df.sparkSession.table(name), key, paths)
    save(terms.hint("rebalance", "key"), f"{name}_postings", "key", ORDER[1:], ["field"])


def term_counts(postings: DataFrame) -> DataFrame:
    """Rows per term as ``n``. Store it beside the postings to facet from it.

    It grows with the distinct terms instead of the rows. The counting is combined before the
    shuffle, so a frequent term is one record per task.
    """
    counted = (
        postings.filter(~F.col("field").isin(EXISTS, HAS_NULL))
        .groupBy("field", "path", "value", *TYPED)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.withMetadata("path", postings.schema["path"].metadata)


def at_path(path: str) -> Column:
    """Terms of the path, with a condition on ``field`` alone that prunes directories."""
    return (F.col("field") == P.steps(path)[0]) & (F.col("path") == P.identity(path))


def marked(kind: str, path: str) -> Column:
    return (F.col("field") == kind) & (F.col("path") == P.identity(path))


def atomic_type(dtype: DataType) -> DataType:
    """The type of the terms at a path: elements of an array, keys of a map, else the value."""
    if isinstance(dtype, ArrayType):
        return dtype.elementType
    return dtype.keyType if isinstance(dtype, MapType) else dtype


def facet_from_postings(postings: DataFrame, path: str) -> DataFrame:
    """``(value, n)``: rows per distinct value of the path, without touching the base table.

    Equals the deduplicated facet without its null bucket, values in the type of the path.
    """
    value = typed_value(atomic_type(posted_type(postings, path)))
    found = postings.filter(at_path(path)).groupBy("value", *TYPED)
    return found.agg(F.count(F.lit(1)).alias("n")).select(value.alias("value"), "n")


def facet_from_counts(counts: DataFrame, path: str) -> DataFrame:
    """The same facet read off stored ``term_counts``."""
    value = typed_value(atomic_type(posted_type(counts, path)))
    return counts.filter(at_path(path)).select(value.alias("value"), "n")

"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()


def ascii_lower(text: Column) -> Column:
    """The text with A-Z in lower case and every other character as it is."""
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(
    rows: DataFrame, by: Sequence[str], order: Sequence[str], name: str, chunks: int
) -> DataFrame:
    """Number the rows of each group from 0 without gaps, splitting each group over ``chunks``.

    A group is cut by a hash of the order columns; the rows of a cut are numbered in one task and
    the cuts are put one after another by their counts, so a group with a third of all rows is
    spread like any other. ``rows`` is read twice and should be cheap to read.
    """
    cut = rows.withColumn("__cut", F.pmod(F.xxhash64(*order), F.lit(chunks)).cast("int"))
    before = Window.partitionBy(*by).orderBy("__cut").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        cut.groupBy(*by, "__cut")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(*by, "__cut", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    )
    inside = Window.partitionBy(*by, "__cut").orderBy(*order)
    return (
        cut.withColumn("__row", F.row_number().over(inside) - 1)
        .join(starts, [*by, "__cut"])
        .withColumn(name, F.col("__start") + F.col("__row"))
        .drop("__cut", "__row", "__start")
    )

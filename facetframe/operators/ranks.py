"""Pages through a stored index of ranks.

The index has one row for every so many rows of an ordered table: the values of the order there, and how
many rows come before. A page at any depth looks two rows of it up and reads the rows between them, a
range that the reader can use, instead of counting the table again. An index is valid for the table as it
was when the index was written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from facetframe.operators.paging import _check, _Key, _keys
from facetframe.sources.scratch import stored

PER_RANGE = 10_000


def write_rank_index(
    df: DataFrame, order_by: Sequence[str], path: str, *, per_range: int = PER_RANGE
) -> None:
    """Write the index of an order: ``before``, ``total`` and the order's columns as ``k0``, ``k1``, ...

    Only the columns of the order are sorted, spread over all tasks. Rows with equal values stand at their
    first place, so pages are right for orders with ties as well.
    """
    if per_range < 1:
        raise ValueError("per_range must be at least 1")
    keys = _keys(order_by)
    names = [f"k{i}" for i in range(len(keys))]
    narrow = df.select(*[k.column.alias(n) for k, n in zip(keys, names, strict=True)])
    order = [_Key(n, k.descending, k.nulls_first).order for k, n in zip(keys, names, strict=True)]
    placed = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    # The number counts from 0 within each task, whose own number is above the 33 bits of it.
    placed = stored(placed.withColumn("id", F.monotonically_increasing_id()), "ranks")
    task, inside = F.shiftright("id", 33), F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task.
    tasks = placed.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("n"))
    tasks = tasks.select("task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    ranked = placed.select(*names, task.alias("task"), inside.alias("inside")).join(tasks, "task")
    ranked = ranked.withColumn("before", F.col("start") + F.col("inside"))
    total = placed.agg(F.count(F.lit(1)).alias("total"))
    picked = ranked.filter(F.col("before") % per_range == 0).select(*names).distinct()
    same = [F.col(n).eqNullSafe(F.col(f"p{n}")) for n in names]
    first = ranked.join(picked.toDF(*[f"p{n}" for n in names]), _all(same), "left_semi")
    first = first.groupBy(*names).agg(F.min("before").alias("before"))
    whole = first.withColumn("total", total.scalar())
    whole.repartitionByRange(F.col("before")).sortWithinPartitions("before").write.mode(
        "overwrite"
    ).parquet(path)


def read_rank_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _all(conditions: Sequence[Column]) -> Column:
    whole = conditions[0]
    for condition in conditions[1:]:
        whole = whole & condition
    return whole


def _before(key: _Key, value) -> Column:
    """Rows strictly before a value; null stands for the nulls."""
    if value is None:
        return F.lit(False) if key.nulls_first else key.column.isNotNull()
    less = key.column > value if key.descending else key.column < value
    return (less | key.column.isNull()) if key.nulls_first else less


def _in_order(keys: Sequence[_Key], at: Row, test) -> Column:
    """Lexicographic order by a test on single keys."""
    found, same = F.lit(False), F.lit(True)
    for i, key in enumerate(keys):
        found = found | (same & test(key, at[f"k{i}"]))
        same = same & key.same(at[f"k{i}"])
    return found


def page_by_index(
    df: DataFrame, index: DataFrame, order_by: Sequence[str], number: int, size: int
) -> DataFrame:
    """Page ``number`` (from 1) of ``size`` rows, in the order the index was written for.

    Two rows of the index are looked up; the page then is one job over the range between them, which is
    given to the reader by the first key.
    """
    _check(number, size)
    keys, skip = _keys(order_by), (number - 1) * size
    wanted = [f"k{i}" for i in range(len(keys))]
    if [c for c in index.columns if c.startswith("k")] != wanted:
        raise ValueError("the index was written for another order")
    row = F.struct(*wanted, "before")
    last = F.max_by(F.when(F.col("before") <= skip, row), F.when(F.col("before") <= skip, F.col("before")))
    enough = F.col("before") >= skip + size
    next_ = F.min_by(F.when(enough, row), F.when(enough, F.col("before")))
    found = index.agg(last.alias("low"), next_.alias("high")).first()
    low, high = found["low"], found["high"]
    if low is None:
        return df.limit(0)
    inside = df
    if low["before"] > 0:
        at = low["k0"]
        inside = inside.filter(keys[0].after(at) | keys[0].same(at))
        inside = inside.filter(_in_order(keys, low, _Key.after) | _all([k.same(low[f"k{i}"]) for i, k in enumerate(keys)]))
    if high is not None:
        at = high["k0"]
        inside = inside.filter(_before(keys[0], at) | keys[0].same(at))
        inside = inside.filter(_in_order(keys, high, _before))
    return inside.orderBy(*[k.order for k in keys]).offset(skip - low["before"]).limit(size)


def has_next_by_index(index: DataFrame, number: int, size: int) -> DataFrame:
    """One row with ``has_next``: whether rows remain after the page, from the index alone."""
    _check(number, size)
    return index.agg((F.coalesce(F.max("total"), F.lit(0)) > number * size).alias("has_next"))

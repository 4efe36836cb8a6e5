"""Grouping by nested paths and faceting over array elements."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetframe.functions.paths import Condition, is_array, named_paths, path_column, quoted
from facetframe.functions.paths import where as filtered

Paths = str | Iterable[str] | Mapping[str, str]


def _grouped(df: DataFrame, keys: dict[str, str], aggs: Mapping[str, Column] | None) -> DataFrame:
    """Group by internal key columns ``{output name: internal column}`` and name the results."""
    metrics = {"count": F.count(F.lit(1))} if aggs is None else dict(aggs)
    grouped = df.groupBy(*keys.values())
    if metrics:
        result = grouped.agg(*[c.alias(name) for name, c in metrics.items()])
    else:
        result = df.select(*keys.values()).distinct()
    return result.select(
        *[F.col(internal).alias(name) for name, internal in keys.items()],
        *[F.col(quoted(name)) for name in metrics],
    )


def group_paths(
    df: DataFrame,
    by: Paths,
    aggs: Mapping[str, Column] | None = None,
    where: Condition | None = None,
) -> DataFrame:
    """Filter, then group by nested paths. ``aggs`` maps output names to aggregate columns.

    Without ``aggs`` the rows are counted as ``count``; with an empty mapping the result is the
    distinct keys. Missing map keys and null structs form the null group.
    """
    df = filtered(df, where)
    named = named_paths(df, by)
    keys = {name: f"__key_{i}" for i, name in enumerate(named)}
    columns = [path_column(df, p).alias(keys[name]) for name, p in named.items()]
    return _grouped(df.select("*", *columns), keys, aggs)


def facet(
    df: DataFrame,
    by: Paths,
    aggs: Mapping[str, Column] | None = None,
    *,
    where: Condition | None = None,
    dedup: bool = False,
) -> DataFrame:
    """Group by the elements of array paths (and by atomic paths as they are).

    Each element of the array puts the row into that element's bucket once, or once per row and
    distinct value with ``dedup``. Null and empty arrays and null elements share the null bucket.
    Several array paths give every combination within a row. A metric counts a row once per
    bucket it falls into. ``where`` reaches promoted columns by itself.

    The elements stream into the map-side partial aggregate, so the shuffle carries one record
    per task and bucket whatever the share of the largest bucket; Catalyst prunes the scan to the
    grouped paths and the metric inputs.
    """
    df = filtered(df, where)
    named = named_paths(df, by)
    keys = {name: f"__key_{i}" for i, name in enumerate(named)}
    arrays = [keys[name] for name, path in named.items() if is_array(df, path)]
    df = df.select("*", *[path_column(df, p).alias(keys[name]) for name, p in named.items()])
    if aggs is None and not dedup and len(arrays) > 1:
        return _counted(df, keys, arrays)
    for key in arrays:
        elements = F.array_distinct(key) if dedup else F.col(key)
        df = df.withColumn(key, F.explode_outer(elements))
    return _grouped(df, keys, aggs)


def _times_in(array: Column) -> Callable[[Column], Column]:
    """A value with the number of its repeats in the array, at least one."""

    def counted(value: Column) -> Column:
        times = F.size(F.filter(array, lambda x: x.eqNullSafe(value)))
        return F.struct(
            value.alias("value"), F.greatest(F.coalesce(times, F.lit(1)), F.lit(1)).alias("times")
        )

    return counted


def _counted(df: DataFrame, keys: dict[str, str], arrays: list[str]) -> DataFrame:
    """Rows per combination of several arrays: repeats are counted before they are multiplied."""
    times = F.lit(1).cast("bigint")
    for key in arrays:
        array = F.col(key)
        # Past the end there is a null, so an empty or null array gives one null value.
        nothing = F.array(F.get(array, F.lit(0)))
        values = F.when(F.size(array) > 0, F.array_distinct(array)).otherwise(nothing)
        df = df.withColumn(key, F.explode(F.transform(values, _times_in(array))))
        times = times * F.col(f"{key}.times")
    flat = df.select(
        *[F.col(f"{k}.value" if k in arrays else k).alias(k) for k in keys.values()],
        times.alias("__times"),
    )
    return flat.groupBy(*keys.values()).agg(F.sum("__times").alias("count")).select(
        *[F.col(internal).alias(name) for name, internal in keys.items()], "count"
    )

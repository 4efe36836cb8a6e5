"""Which paths exist in a nested table, and in how many rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

from facetframe.functions.paths import quoted


@dataclass
class _Node:
    """A place in the schema and how to reach its values from the row."""

    path: str
    dtype: DataType
    test: Callable[[Callable[[Column], Column]], Column]  # does any value here satisfy it?
    gather: Callable[[Callable[[Column], Column]], Column]  # concatenated arrays over all values


def _root(name: str, dtype: DataType) -> _Node:
    value = F.col(quoted(name))
    return _Node(name, dtype, lambda p: p(value), lambda f: f(value))


def _field(node: _Node, name: str, dtype: DataType) -> _Node:
    return _Node(
        f"{node.path}.{name}",
        dtype,
        lambda p: node.test(lambda v: p(v.getField(name))),
        lambda f: node.gather(lambda v: f(v.getField(name))),
    )


def _elements(node: _Node) -> _Node:
    return _Node(
        node.path,
        node.dtype.elementType,
        lambda p: node.test(lambda v: F.exists(v, p)),
        lambda f: node.gather(lambda v: F.flatten(F.transform(v, f))),
    )


def _leaves(node: _Node) -> Iterator[_Node]:
    inner = _elements(node) if isinstance(node.dtype, ArrayType) else node
    if isinstance(inner.dtype, StructType):
        for f in inner.dtype.fields:
            yield from _leaves(_field(inner, f.name, f.dataType))
    elif isinstance(inner.dtype, MapType):
        yield inner
    else:
        yield node


def _type_name(dtype: DataType) -> str:
    return (dtype.elementType if isinstance(dtype, ArrayType) else dtype).simpleString()


def path_profile(df: DataFrame) -> DataFrame:
    """``(path, type, n_present)`` for every leaf path, map keys included.

    An array counts under its own path with its element type, a field of array elements under
    ``arr.f`` when some element has it, a map under its own path and each key with a non-null
    value under ``m.key``. Fixed paths are counted in one aggregate without a shuffle of rows;
    each map is exploded to its keys on its own, reading only that column.
    """
    leaves = [leaf for f in df.schema.fields for leaf in _leaves(_root(f.name, f.dataType))]
    counted = [
        F.struct(
            F.lit(leaf.path).alias("path"),
            F.lit(_type_name(leaf.dtype)).alias("type"),
            F.count_if(leaf.test(lambda v: v.isNotNull())).alias("n_present"),
        )
        for leaf in leaves
    ]
    parts = [df.agg(F.array(*counted).alias("paths")).select(F.inline("paths"))]
    for leaf in leaves:
        if isinstance(leaf.dtype, MapType):
            parts.append(_key_profile(df, leaf))
    return reduce(DataFrame.unionByName, parts)


def _key_profile(df: DataFrame, leaf: _Node) -> DataFrame:
    no_keys = F.array().cast(ArrayType(StringType()))

    def keys(value: Column) -> Column:
        present = F.map_keys(F.map_filter(value, lambda _, v: v.isNotNull()))
        return F.coalesce(present.cast(ArrayType(StringType())), no_keys)

    return (
        df.select(F.explode(F.array_distinct(leaf.gather(keys))).alias("key"))
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("n_present"))
        .select(
            F.concat(F.lit(leaf.path + "."), "key").alias("path"),
            F.lit(_type_name(leaf.dtype.valueType)).alias("type"),
            "n_present",
        )
    )

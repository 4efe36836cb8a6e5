"""Semi-structured columns as VARIANT: typed paths, path profile, promoted paths.

A VARIANT holds values whose shape differs from row to row, parsed once when written instead of at every
query as JSON text is. Paths are those of the library (``props.k``, ``props.`a.b`.c``), below the column.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from facetframe.functions.paths import PROMOTED_FROM, identity, quoted, shadow_name, steps


def with_variant(df: DataFrame, column: str) -> DataFrame:
    """The JSON text of a column parsed in place. Text that is not JSON is null, as null text is."""
    return df.withColumn(column, F.try_parse_json(F.col(quoted(column))))


def _json_path(path: str) -> tuple[Column, str]:
    column, *rest = steps(path)
    if any("'" in step and '"' in step for step in rest):
        raise ValueError(f"a key of {path} has both kinds of quotes")

    def part(step: str) -> str:
        return f'["{step}"]' if "'" in step else f"['{step}']"

    return F.col(quoted(column)), "$" + "".join(map(part, rest))


def variant_value(path: str, kind: str | DataType = "string") -> Column:
    """The value at a path of a VARIANT column in a type: null where it is missing or of another kind."""
    column, inner = _json_path(path)
    name = kind if isinstance(kind, str) else kind.simpleString()
    return F.try_variant_get(column, inner, name)


def variant_present(path: str) -> Column:
    """Whether the path has a value other than null."""
    column, inner = _json_path(path)
    found = F.try_variant_get(column, inner, "variant")
    return found.isNotNull() & ~F.is_variant_null(found)


def promote_variant(df: DataFrame, typed: Mapping[str, str]) -> DataFrame:
    """Add a shadow column for each path with its type, as ``promote`` does for maps and structs.

    The reader can push filters on it, and ``path_column`` finds it.
    """
    taken, added = set(df.columns), []
    for path, kind in typed.items():
        name = shadow_name(path)
        while name in taken:
            name += "_"
        taken.add(name)
        added.append(variant_value(path, kind).alias(name, metadata={PROMOTED_FROM: identity(path)}))
    return df.select("*", *added)


def variant_type(df: DataFrame, column: str) -> DataType:
    """The type that holds the values of all rows, found by one aggregate over them."""
    found = df.agg(F.schema_of_variant_agg(F.col(quoted(column))).alias("t")).first()["t"]
    ddl = (found or "VOID").replace("OBJECT<", "STRUCT<")
    return DataType.fromDDL(ddl)


def _leaf_paths(path: str, dtype: DataType):
    if isinstance(dtype, StructType) and dtype.fields:
        for f in dtype.fields:
            yield from _leaf_paths(f"{path}.{quoted(f.name)}", f.dataType)
    elif isinstance(dtype, ArrayType):
        yield path, dtype.elementType.simpleString()
    else:
        yield path, dtype.simpleString()


def variant_profile(df: DataFrame, column: str) -> DataFrame:
    """``(path, type, n_present)`` of every leaf path in a VARIANT column, and of the column itself.

    The type of all rows gives the paths, one aggregate counts the rows that have them; an array counts
    under its own path with its element type. Values whose kinds differ are ``variant``.
    """
    leaves = list(_leaf_paths(quoted(column), variant_type(df, column)))
    if (quoted(column), "void") in leaves:
        leaves.remove((quoted(column), "void"))
    counted = [
        F.struct(
            F.lit(".".join(steps(path))).alias("path"),
            F.lit(kind).alias("type"),
            F.count_if(variant_present(path)).alias("n_present"),
        )
        for path, kind in leaves
        if path != quoted(column)
    ]
    whole = F.struct(
        F.lit(column).alias("path"),
        F.lit("variant").alias("type"),
        F.count_if(variant_present(quoted(column))).alias("n_present"),
    )
    return df.agg(F.array(whole, *counted).alias("p")).select(F.inline("p"))

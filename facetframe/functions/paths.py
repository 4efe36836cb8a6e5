"""Nested paths (``s.f``, ``m.key``, ``arr.f``) and promoted shadow columns for them.

A path is what ``F.col`` accepts; Spark itself resolves struct fields, map keys and fields of
array elements, and backticks quote names that contain dots.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType

PROMOTED_FROM = "promoted_from"
STEP = re.compile(r"`((?:[^`]|``)*)`|([^.`]+)")
LITERAL = re.compile(r"('(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\")")
Condition = Column | str | Callable[[DataFrame], Column]


def steps(path: str) -> tuple[str, ...]:
    """The names a path goes through, without their quoting."""
    found, at = [], 0
    while True:
        step = STEP.match(path, at)
        if step is None:
            raise ValueError(f"not a path: {path!r}")
        name = step[1].replace("``", "`") if step[2] is None else step[2]
        found.append(name)
        at = step.end()
        if at == len(path):
            return tuple(found)
        if path[at] != ".":
            raise ValueError(f"not a path: {path!r}")
        at += 1


def quoted(name: str) -> str:
    """One column name as a path."""
    return "`" + name.replace("`", "``") + "`"


def identity(path: str) -> str:
    """The path with every step quoted: equal for equal paths, different for different ones."""
    return ".".join(map(quoted, steps(path)))


def path_type(df: DataFrame, path: str) -> DataType:
    return df.select(F.col(path)).schema[0].dataType


def is_array(df: DataFrame, path: str) -> bool:
    return isinstance(path_type(df, path), ArrayType)


def path_alias(df: DataFrame, path: str) -> str:
    """The output name Spark gives the path: its last step."""
    return df.select(F.col(path)).columns[0]


def named_paths(df: DataFrame, by: str | Iterable[str] | Mapping[str, str]) -> dict[str, str]:
    """Normalise a grouping argument to ``{output name: path}``."""
    if isinstance(by, Mapping):
        return dict(by)
    paths = [by] if isinstance(by, str) else list(by)
    named = {path_alias(df, p): p for p in paths}
    if len(named) != len(paths):
        raise ValueError(f"paths {paths} share an output name; pass a mapping of names to paths")
    return named


def promoted_columns(df: DataFrame) -> dict[str, str]:
    """``{path identity: shadow column}`` recorded in the schema of the DataFrame."""
    return {
        f.metadata[PROMOTED_FROM]: f.name
        for f in df.schema.fields
        if f.metadata and PROMOTED_FROM in f.metadata
    }


def shadow_name(path: str) -> str:
    return "__" + re.sub(r"\W", "_", ".".join(steps(path)))


def promote(df: DataFrame, paths: Iterable[str]) -> DataFrame:
    """Add one top-level shadow column per path.

    Parquet keeps no statistics for a map key, so a filter on ``m.key`` reads every row group.
    The shadow column has statistics, dictionary and (optionally) a bloom filter. Its origin is
    kept in the column metadata, which Spark stores in the file footers.
    """
    known = promoted_columns(df)
    taken = set(df.columns)
    added = []
    for path in paths:
        if identity(path) in known:
            continue
        name = shadow_name(path)
        while name in taken:
            name += "_"
        taken.add(name)
        known[identity(path)] = name
        added.append(F.col(path).alias(name, metadata={PROMOTED_FROM: identity(path)}))
    return df.select("*", *added)


def path_column(df: DataFrame, path: str) -> Column:
    """The column for a path: its shadow column where the table has one, else the nested access."""
    shadow = promoted_columns(df).get(identity(path))
    return F.col(path if shadow is None else quoted(shadow))


def without_promoted(df: DataFrame) -> DataFrame:
    """The table as it was before ``promote``."""
    return df.drop(*promoted_columns(df).values())


def _spellings(path: str) -> str:
    """A pattern for the ways SQL text writes a path: dots, backticks, or ``['key']``."""
    first, *rest = steps(path)

    def name(step: str) -> str:
        plain = re.escape(step) + r"\b" if re.fullmatch(r"\w+", step) else None
        return "|".join(filter(None, [re.escape(quoted(step)), plain]))

    pattern = rf"(?<![\w.`])(?:{name(first)})"
    for step in rest:
        text = re.escape(step)
        pattern += rf"(?:\s*\.\s*(?:{name(step)})|\s*\[\s*(?:'{text}'|\"{text}\")\s*\])"
    return pattern + r"(?!\s*[\[.(])"


def shadowed_sql(df: DataFrame, condition: str) -> str:
    """SQL text with promoted paths replaced by their shadow columns, literals left alone."""
    for path, shadow in promoted_columns(df).items():
        pattern = re.compile(rf"{LITERAL.pattern}|{_spellings(path)}", re.IGNORECASE)
        # A whole literal is matched first and kept; one that is a map key belongs to the path.
        condition = pattern.sub(lambda m, s=shadow: m[0] if m[1] else quoted(s), condition)
    return condition


def where(df: DataFrame, condition: Condition | None) -> DataFrame:
    """Filter so that conditions on promoted paths reach the reader.

    SQL text is read for promoted paths; a function gets the table, for ``path_column`` and the
    predicate helpers; a column is taken as it is.
    """
    if condition is None:
        return df
    if isinstance(condition, str):
        return df.filter(shadowed_sql(df, condition))
    return df.filter(condition(df) if callable(condition) and not isinstance(condition, Column) else condition)

"""Predicates on nested paths. All are built-in expressions with SQL three-valued logic.

With ``table`` given, a path that the table has promoted is tested on its shadow column, which the
Parquet reader can filter.
"""

from __future__ import annotations

import unicodedata
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetframe.functions.paths import path_column, quoted

WORD = r"[\p{L}\p{M}\p{N}]"
BETWEEN_WORDS = r"[^\p{L}\p{M}\p{N}]+"


def _column(path: str | Column, table: DataFrame | None = None) -> Column:
    if isinstance(path, Column):
        return path
    return F.col(path) if table is None else path_column(table, path)


def contains_value(path: str | Column, value: Any, table: DataFrame | None = None) -> Column:
    """The array at the path has the value. NULL when it is absent but the array has a null."""
    return F.array_contains(_column(path, table), value)


def key_equals(path: str | Column, key: Any, value: Any, table: DataFrame | None = None) -> Column:
    """The map at the path holds the value under the key."""
    if table is not None and isinstance(path, str) and isinstance(key, str):
        return path_column(table, f"{path}.{quoted(key)}") == value
    return _column(path).getItem(key) == value


def has_key(path: str | Column, key: Any) -> Column:
    """The map at the path has the key, whatever its value."""
    return F.map_contains_key(_column(path), key)


def words(text: str | Column) -> Column:
    """The words of a text in lower case: maximal runs of letters, marks and digits."""
    return F.array_remove(F.split(F.lower(_column(text)), BETWEEN_WORDS), "")


def has_token(text: str | Column, token: str) -> Column:
    """The lower-cased text has the token as one of its ``words``."""
    if not token or any(unicodedata.category(c)[0] not in "LMN" for c in token):
        raise ValueError(f"a token is one or more letters, marks or digits, got {token!r}")
    if token != token.lower():
        raise ValueError(f"tokens are in lower case, got {token!r}")
    # The literal comes first so that the regex engine looks for it before the boundaries.
    return F.lower(_column(text)).rlike(f"{token}(?<!{WORD}{token})(?!{WORD})")

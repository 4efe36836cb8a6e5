"""Replacement of rows by key or by a condition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetframe.functions.paths import Condition, shadowed_sql
from facetframe.operators.joins import BROADCAST_BYTES, filter_by_keys


def upsert(
    base: DataFrame,
    updates: DataFrame,
    on: str | Sequence[str] | None = None,
    *,
    matching: Condition | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Delete base rows, then add all updates.

    With ``on``, every base row goes whose ``on`` columns equal those of some update; several base
    rows with one key all go, several updates with one key all stay, and a null key equals nothing.
    With ``matching``, every base row goes for which the condition is true, such as
    ``contains_value("flags", "R")``.
    """
    if (on is None) == (matching is None):
        raise ValueError("give either key columns or a condition")
    if matching is not None:
        if isinstance(matching, str):
            matching = F.expr(shadowed_sql(base, matching))
        elif not hasattr(matching, "isNull"):
            matching = matching(base)
        kept = base.filter(~F.coalesce(matching, F.lit(False)))
    else:
        on = [on] if isinstance(on, str) else list(on)
        keys = updates.select(*on).na.drop("any").distinct()
        kept = filter_by_keys(base, keys, on, "left_anti", limit)
    return kept.unionByName(updates)

"""Pages of an ordered table.

An order is a list of column names, each with an optional direction: ``"name"``, ``"name desc"``,
``"name asc nulls last"``. Nulls come first ascending and last descending unless said otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

CUTS = 64
NARROW = 10_000


@dataclass
class _Key:
    name: str
    descending: bool
    nulls_first: bool

    @property
    def column(self) -> Column:
        return F.col(self.name)

    @property
    def order(self) -> Column:
        if self.descending:
            return self.column.desc_nulls_first() if self.nulls_first else self.column.desc_nulls_last()
        return self.column.asc_nulls_first() if self.nulls_first else self.column.asc_nulls_last()

    def upto(self, value: Any) -> Column:
        """Rows at or before a value that is not null."""
        inside = self.column >= value if self.descending else self.column <= value
        return (inside | self.column.isNull()) if self.nulls_first else inside

    def after(self, value: Any) -> Column:
        """Rows strictly after a value; null stands for the nulls."""
        if value is None:
            return self.column.isNotNull() if self.nulls_first else F.lit(False)
        beyond = self.column < value if self.descending else self.column > value
        return beyond if self.nulls_first else (beyond | self.column.isNull())

    def same(self, value: Any) -> Column:
        return self.column.isNull() if value is None else self.column == value


def _keys(order_by: Sequence[str]) -> list[_Key]:
    keys = []
    for text in order_by:
        name, *rest = text.split()
        words = [w.lower() for w in rest]
        direction = words.pop(0) if words and words[0] in ("asc", "desc") else "asc"
        if words not in ([], ["nulls", "first"], ["nulls", "last"]):
            raise ValueError(f"not an order: {text!r}")
        first = direction == "asc" if not words else words[1] == "first"
        keys.append(_Key(name, direction == "desc", first))
    return keys


def _check(number: int, size: int) -> None:
    if number < 1 or size < 1:
        raise ValueError("page numbers start at 1 and pages hold at least one row")


def page(df: DataFrame, order_by: Sequence[str], number: int, size: int) -> DataFrame:
    """Page ``number`` (from 1) of ``size`` rows. The order should be total for stable pages.

    The rows before the page are counted, not sorted: the first key is cut at sampled values, one
    aggregate counts the rows up to each cut, and the range around the page is cut again until it is
    small or a single value, where the next key takes over. Every depth goes this way; the range,
    a filter the reader can use, is all that is sorted.
    """
    _check(number, size)
    skip = (number - 1) * size
    keys = _keys(order_by)
    order = [k.order for k in keys]
    for key in keys:
        df, skip, settled = _narrowed(df, key, skip, size)
        if settled:
            break
    return df.orderBy(*order).offset(skip).limit(size)


def _narrowed(df: DataFrame, key: _Key, skip: int, size: int) -> tuple[DataFrame, int, bool]:
    """The rows around the page by one key, how many of them precede it, and whether to stop.

    Not settled means that all rows left have one value of the key.
    """
    small = max(NARROW, 2 * size)
    rows = df.count()
    while rows > small:
        cuts = _cuts(df, key)
        counts = df.agg(
            F.count_if(key.column.isNull()).alias("null"),
            *[F.count_if(key.upto(v)).alias(f"c{i}") for i, v in enumerate(cuts)],
        ).first()
        upto = [counts[f"c{i}"] for i in range(len(cuts))]
        # Rows before the page end at the last cut that does not reach it; the page's last row lies
        # at or before the first cut that does.
        low = max((i for i, n in enumerate(upto) if n <= skip), default=None)
        high = min((i for i, n in enumerate(upto) if n >= skip + size), default=None)
        inside = df
        if low is not None:
            inside = inside.filter(key.after(cuts[low]))
        if high is not None:
            inside = inside.filter(key.upto(cuts[high]))
        before = 0 if low is None else upto[low]
        left = (rows if high is None else upto[high]) - before
        if left == rows:
            return df, skip, False if len(cuts) <= 1 and counts["null"] in (0, rows) else True
        df, skip, rows = inside, skip - before, left
    return df, skip, True


def _cuts(df: DataFrame, key: _Key) -> list[Any]:
    """Values that split the rows about evenly, in the order of the key, ends included."""
    some = df.select(key.column.alias("v")).filter("v IS NOT NULL")
    rows = some.agg(F.count(F.lit(1)), F.min("v"), F.max("v")).first()
    if rows[0] == 0:
        return []
    share = min(1.0, 20 * CUTS / rows[0])
    sample = sorted(r[0] for r in some.sample(fraction=share, seed=1).limit(200 * CUTS).collect())
    picked = {sample[len(sample) * i // CUTS] for i in range(CUTS)} if sample else set()
    return sorted({rows[1], rows[2], *picked}, reverse=key.descending)


def page_after(
    df: DataFrame, order_by: Sequence[str], last: Row | Mapping[str, Any], size: int
) -> DataFrame:
    """The next ``size`` rows after a row whose order columns are given: a filter and a top-k."""
    _check(1, size)
    keys = _keys(order_by)
    beyond, same = F.lit(False), F.lit(True)
    for key in keys:
        value = last[key.name]
        beyond = beyond | (same & key.after(value))
        same = same & key.same(value)
    return df.filter(beyond).orderBy(*[k.order for k in keys]).limit(size)


def has_next(df: DataFrame, number: int, size: int) -> DataFrame:
    """One row with ``has_next``: whether rows remain after the page. Counts without sorting."""
    _check(number, size)
    return df.agg((F.count(F.lit(1)) > number * size).alias("has_next"))

"""Best-fit-decreasing assignment of indivisible groups to shards.

Rows with equal texts form a group that stays together. Groups are sorted by size and each enters
the bin whose remaining capacity is the tightest that still holds it, found in a balanced tree of
the bins. For a given number of shards the capacity is the smallest that needs no more bins than
that.

The driver packs a bounded number of items, whatever the input: a group of at least one
``GRAIN``-th of a shard is an item of its own (there are at most shards x GRAIN of them), and
smaller groups are gathered by the hash of their key into shards x GRAIN bundles.

Defined cases: a null text is a group of its own with no bytes; an empty text is another; repeated
rows stay in one group and get slots of their own; an empty table gives an empty result; extra
columns are ignored. A group larger than an even share gets a shard of its own.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetframe.llm.common import numbered, partitions
from facetframe.sources.scratch import stored

GRAIN = 256


class BinTree:
    """Bins ordered by remaining capacity in an AVL tree."""

    def __init__(self) -> None:
        self.root: list | None = None

    # A node is [key, left, right, height] with key (remaining, bin).

    @staticmethod
    def _height(node: list | None) -> int:
        return node[3] if node else 0

    def _balanced(self, node: list) -> list:
        node[3] = 1 + max(self._height(node[1]), self._height(node[2]))
        lean = self._height(node[1]) - self._height(node[2])
        if abs(lean) < 2:
            return node
        near, far = (1, 2) if lean > 0 else (2, 1)
        child = node[near]
        if self._height(child[far]) > self._height(child[near]):
            node[near] = self._rotated(child, far, near)
        return self._rotated(node, near, far)

    def _rotated(self, node: list, near: int, far: int) -> list:
        top = node[near]
        node[near], top[far] = top[far], node
        for each in (node, top):
            each[3] = 1 + max(self._height(each[1]), self._height(each[2]))
        return top

    def add(self, key: tuple[int, int]) -> None:
        self.root = self._add(self.root, key)

    def _add(self, node: list | None, key: tuple[int, int]) -> list:
        if node is None:
            return [key, None, None, 1]
        side = 1 if key < node[0] else 2
        node[side] = self._add(node[side], key)
        return self._balanced(node)

    def remove(self, key: tuple[int, int]) -> None:
        self.root = self._remove(self.root, key)

    def _remove(self, node: list, key: tuple[int, int]) -> list | None:
        if key == node[0]:
            if not node[1] or not node[2]:
                return node[1] or node[2]
            heir = node[2]
            while heir[1]:
                heir = heir[1]
            node[0] = heir[0]
            node[2] = self._remove(node[2], heir[0])
        else:
            side = 1 if key < node[0] else 2
            node[side] = self._remove(node[side], key)
        return self._balanced(node)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The bin with the least remaining capacity that is at least ``size``."""
        node, found = self.root, None
        while node:
            if node[0] >= (size, -1):
                found, node = node[0], node[1]
            else:
                node = node[2]
        return found


def best_fit_decreasing(
    sizes: Iterable[int], capacity: int, most: int | None = None
) -> list[int] | None:
    """The bin of each size, in the order given; None where more than ``most`` bins are needed."""
    sizes = list(sizes)
    bins, tree, used = [0] * len(sizes), BinTree(), 0
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = tree.tightest(sizes[i])
        if found is None:
            if used == most:
                return None
            found = (max(capacity, sizes[i]), used)
            used += 1
        else:
            tree.remove(found)
        bins[i] = found[1]
        tree.add((found[0] - sizes[i], found[1]))
    return bins


def balanced_bins(sizes: list[int], shards: int) -> list[int]:
    """At most ``shards`` bins by best fit decreasing under the smallest capacity that suffices."""
    bins, left = [0] * len(sizes), shards
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    total = sum(sizes)
    while order and left > 1 and sizes[order[0]] * left > total:
        first = order.pop(0)  # more than an even share: it fills a shard alone
        left -= 1
        bins[first] = left
        total -= sizes[first]
    rest = [sizes[i] for i in order]
    low = max([-(-total // left), *rest[:1]])
    high = low + max(rest, default=0)
    best = best_fit_decreasing(rest, high, left)
    while best is None:
        high *= 2
        best = best_fit_decreasing(rest, high, left)
    for _ in range(12):
        if low >= high:
            break
        middle = (low + high) // 2
        tried = best_fit_decreasing(rest, middle, left)
        if tried is None:
            low = middle + 1
        else:
            best, high = tried, middle
    for i, b in zip(order, best):
        bins[i] = b
    return bins


def shard_groups(
    rows: DataFrame, group: Column, size: Column, shards: int, *, name: str = "shard"
) -> DataFrame:
    """Add the shard of each row: rows with an equal ``group`` (not null) stay together.

    ``rows`` is read three times: once for the sizes of groups, once for those of bundles, once for
    the result.
    """
    bundles = shards * GRAIN
    keyed = rows.withColumn("__group", group).withColumn("__size", size)
    groups = keyed.groupBy("__group").agg(F.sum("__size").alias("__total"))
    sized = stored(groups, "group_sizes")
    total = sized.agg(F.sum("__total")).first()[0]
    if total is None:
        return rows.withColumn(name, F.lit(0))
    # At most ``bundles`` groups reach this size, so both collects below are bounded.
    large = F.col("__total") * bundles >= F.lit(total)
    bundle = F.pmod(F.xxhash64("__group"), F.lit(bundles)).cast("int")
    alone = sized.filter(large).orderBy("__group").collect()
    gathered = (
        sized.filter(~large)
        .groupBy(bundle.alias("__bundle"))
        .agg(F.sum("__total").alias("__total"))
        .orderBy("__bundle")
        .collect()
    )
    found = balanced_bins([r["__total"] for r in [*alone, *gathered]], shards)
    spark = rows.sparkSession
    of_group = spark.createDataFrame(
        [(r["__group"], b) for r, b in zip(alone, found)],
        f"__group {dict(keyed.dtypes)['__group']}, __alone int",
    )
    of_bundle = spark.createDataFrame(
        [(r["__bundle"], b) for r, b in zip(gathered, found[len(alone) :])],
        "__bundle int, __gathered int",
    )
    return (
        keyed.withColumn("__bundle", bundle)
        .join(F.broadcast(of_group), "__group", "left")
        .join(F.broadcast(of_bundle), "__bundle", "left")
        .withColumn(name, F.coalesce("__alone", "__gathered"))
        .drop("__group", "__size", "__bundle", "__alone", "__gathered")
    )


def shard_documents(
    docs: DataFrame, shards: int, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The id, size, CRC-32, shard and slot of every document, equal texts in one shard.

    The size is the UTF-8 bytes plus 8; slots count from 0 without gaps in each shard.
    """
    raw = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    digests = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.length(raw) + 8).cast("long").alias("size"),
            F.crc32(raw).alias("text_crc32"),
            # Nulls are one group, different from empty texts.
            F.coalesce(F.sha2(F.col(text_col), 256), F.lit("null")).alias("key"),
        ),
        "document_digests",
    )
    placed = shard_groups(digests, F.col("key"), F.col("size"), shards).drop("key")
    placed = stored(placed, "placed_documents")
    order = ["doc_id", "text_crc32", "size"]
    return numbered(placed, ["shard"], order, "slot", 4 * partitions(docs.sparkSession))

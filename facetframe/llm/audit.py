"""Audit of how filters interact: what each removes in every order in which they could be applied.

A document fails some of the filters; which, is its mask. With filters applied in some order, it is
removed at the least position of a filter that it fails: the min-plus product of the matrix of masks
(0 where failed, else infinite) with the matrix of positions (the inverse of each order). The product
has a fixed size, masks by orders; documents only enter as weights that are scattered onto its steps,
so they are counted once by part and mask and never meet the orders.

``filter_masks`` gives the five filters of the training corpus; ``removal_audit`` takes any filters.

Null texts are empty, a null part is an empty string, a null id has no smaller id beside it and is no
smaller id to others, so such rows never fail as copies. Of rows with one id and text none is a copy
of another. A document has a label if any of its label rows does. An empty table has no parts, so
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetframe.llm.rules import SPACES

FILTERS = "ABCDE"
COPY = "E"
WEIGHTS = ["docs", "good", "toxic"]
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)


def _weighted(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``digest``, ``part``, the flags A to D, and the number ``docs`` of equal rows.

    The texts end here. Counting before any join leaves no hot id or text.
    """
    text = F.coalesce("text", F.lit(""))
    bare = F.trim(text, F.lit(SPACES))
    no_words = F.array().cast("array<string>")
    words = F.when(bare == "", no_words).otherwise(F.split(bare, "[ \t-\r]+"))
    read = docs.select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("part"),
        F.sha2(text, 256).alias("digest"),
        F.length(text).alias("n"),
        F.length(F.regexp_replace(text, "[A-Z]+", "")).alias("n_small"),
        text.rlike(r"[#$%&*|]").alias("D"),
        # One array, so that the words are split once.
        F.transform(
            F.array(words), lambda w: F.struct(F.size(w), F.size(F.array_distinct(w)))
        )[0].alias("w"),
    )
    n_words, n_distinct = F.col("w.col1"), F.col("w.col2")
    flags = {
        "A": n_words < 50,
        "B": 100 * n_distinct < 65 * n_words,
        "C": 100 * (F.col("n") - F.col("n_small")) > 5 * F.col("n"),
        "D": F.col("D"),
    }
    keys = ["doc_id", "part", "digest", *flags]
    return (
        read.select("doc_id", "part", "digest", *[flag.alias(name) for name, flag in flags.items()])
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("docs"))
    )


def filter_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part``, ``mask`` (bit i: fails filter i of ``FILTERS``) and the weights of its documents."""
    rows = _weighted(docs)
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    marks = labels.groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    # A hot text has many ids, so the pair is no hot key.
    rows = rows.join(first.withColumn("first", F.lit(True)), ["digest", "doc_id"], "left")
    rows = rows.join(marks, "doc_id", "left")
    copy = F.col("first").isNull() & F.col("doc_id").isNotNull()
    flags = [*[F.col(f) for f in FILTERS if f != COPY], copy]
    mask = sum((f.cast("int") * 2**i for i, f in enumerate(flags)), F.lit(0))
    return rows.groupBy("part", mask.alias("mask")).agg(
        F.sum("docs").alias("docs"),
        *[F.sum(F.coalesce(m, F.lit(0)) * F.col("docs")).alias(m) for m in WEIGHTS[1:]],
    )


def orders_of(filters: str) -> list[str]:
    return ["".join(p) for p in permutations(filters)]


def removal_ranks(masks: Sequence[int], orders: Sequence[str]) -> np.ndarray:
    """The step (from 1) at which each mask is removed in each order; one past the last: never.

    The min-plus product of the masks (0 where a filter is failed, infinite where not) with the
    positions of the filters in the orders.
    """
    filters = sorted(orders[0])
    bits = np.arange(len(filters))
    failed = (np.asarray(masks, dtype=np.int64)[:, None] >> bits & 1).astype(bool)
    position = np.array([[order.index(f) + 1 for order in orders] for f in filters], dtype=np.int64)
    never = len(filters) + 1
    costs = np.where(failed, 0, never)  # infinite enough: positions are at least 1
    return np.minimum((costs[:, :, None] + position[None]).min(axis=1), never)


def audit_part(masks: np.ndarray, weights: np.ndarray, orders: Sequence[str]) -> np.ndarray:
    """The counts of ``COUNTS`` by order and step, for the weights (rows: docs, good, toxic)."""
    n = len(orders[0])
    filters = sorted(orders[0])
    ranks = removal_ranks(masks, orders)
    removed = np.zeros((3, len(orders), n + 2), dtype=np.int64)
    at = np.arange(len(orders))
    for row, step in enumerate(ranks):  # scatter each mask's weights onto its steps
        removed[:, at, step] += weights[:, row, None]
    removed = removed[:, :, 1 : n + 1]
    which = np.array([[filters.index(f) for f in order] for order in orders])  # filter of a step
    has = (masks[:, None] >> np.arange(n) & 1).astype(bool)
    fails = weights[0] @ has
    alone = weights[0] @ (has & (has.sum(axis=1) == 1)[:, None])
    shapley = np.zeros(n, dtype=np.int64)
    np.add.at(shapley, which.ravel(), removed[0].ravel())
    kept = weights[0].sum() - np.cumsum(removed[0], axis=1)
    # A filter is redundant for those that fail it and went before.
    redundant = fails[which] - removed[0]
    return np.stack(
        [kept, removed[0], redundant, alone[which], removed[1], removed[2], shapley[which]], axis=2
    )


def _audit(orders: Sequence[str]):
    n = len(orders[0])
    names = np.repeat(np.array(orders, dtype=object), n)
    steps = np.tile(np.arange(1, n + 1, dtype=np.int32), len(orders))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                kinds = row["masks"]
                masks = np.array([k["mask"] for k in kinds], dtype=np.int64)
                weights = np.array([[k[w] for k in kinds] for w in WEIGHTS], dtype=np.int64)
                counts = audit_part(masks, weights, orders).reshape(-1, len(COUNTS))
                columns = {
                    "part": pa.array([row["part"]] * len(names), pa.string()),
                    "filter_order": pa.array(names, pa.string()),
                    "step": pa.array(steps, pa.int32()),
                    **{c: pa.array(counts[:, i], pa.int64()) for i, c in enumerate(COUNTS)},
                }
                yield pa.RecordBatch.from_pydict(columns)

    return run


def removal_audit(masks: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Counts by ``part``, ``filter_order`` and ``step`` for every order of the filters.

    ``masks`` has ``part``, ``mask`` and the weights, one row per part and mask. A part is an array of
    at most 2 to the number of filters masks; parts are spread over the tasks.
    """
    if not 1 <= len(filters) <= 7 or sorted(set(filters)) != list(filters):
        raise ValueError("filters are 1 to 7 different letters in alphabetical order")
    parts = masks.groupBy("part").agg(F.collect_list(F.struct("mask", *WEIGHTS)).alias("masks"))
    return parts.mapInArrow(_audit(orders_of(filters)), SCHEMA)

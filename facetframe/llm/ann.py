"""Approximate nearest neighbours by collision counting on single projections.

Vectors and queries are dealt into blocks, and every pair of a vector block and a query block is a
task's work, so nothing is broadcast and no task holds more than two blocks. A block's index is one
sorted array for each random projection. A query opens a window around its own value in every array
and widens all of them by a factor at a time (virtual rehashing); a vector that lies in the windows
of enough projections is verified with its exact distance. A query is done when its windows are
wide enough, compared with the distance of its k-th neighbour, that a nearer vector would have
collided often enough.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no
part, nor do rows without an id, which could not be named; vectors of another length are no candidates; rows with the query's own id are not its
candidates; of repeated ids one query row and the nearest candidate row count; ties go to the
smaller id; with fewer candidates than k all are returned; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PROJECTIONS = 48
SHARE = 0.5
WIDEN = 1.4
REACH = 1.25
VECTOR_BLOCK = 4096
QUERY_BLOCK = 1024


class BlockIndex:
    """Sorted projections of a block of vectors."""

    def __init__(self, vectors: np.ndarray, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        self.vectors = vectors.astype(np.float64)
        self.lines = rng.standard_normal((vectors.shape[1], PROJECTIONS))
        values = self.vectors @ self.lines
        self.order = np.argsort(values, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(values.T, self.order, axis=1)
        spread = np.subtract(*np.quantile(self.sorted, [0.75, 0.25], axis=1)).mean()
        self.first_width = max(float(spread) / 40, 1e-9)

    def nearest(
        self, query: np.ndarray, k: int, ids: np.ndarray, own: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Rows and distances of the k nearest found, ties by id."""
        query = query.astype(np.float64)
        n = len(self.vectors)
        centre = query @ self.lines
        low = np.array([np.searchsorted(s, c) for s, c in zip(self.sorted, centre)])
        high = low.copy()
        counts = np.zeros(n, np.int64)
        open_ = ids != own
        least = int(SHARE * PROJECTIONS)
        rows = np.zeros(0, np.int64)
        distances = np.zeros(0)
        width = self.first_width
        while True:
            met = []
            for j in range(PROJECTIONS):
                values = self.sorted[j]
                a = np.searchsorted(values, centre[j] - width, side="left")
                b = np.searchsorted(values, centre[j] + width, side="right")
                met += [self.order[j, a : low[j]], self.order[j, high[j] : b]]
                low[j], high[j] = a, b
            counts += np.bincount(np.concatenate(met), minlength=n)
            new = np.flatnonzero(open_ & (counts >= least))
            if len(new):
                open_[new] = False
                gap = self.vectors[new] - query
                rows = np.concatenate([rows, new])
                distances = np.concatenate([distances, np.sqrt((gap * gap).sum(axis=1))])
                best = np.lexsort((ids[rows], distances))[:k]
                rows, distances = rows[best], distances[best]
            if not open_.any():
                break
            if len(rows) == k and width >= REACH * distances[-1]:
                break
            width *= WIDEN
        return rows, distances


def usable(vector: str) -> Column:
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return x.isNotNull() & finite & F.exists(x, lambda v: v != 0)


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` (Euclidean distance).

    Both inputs have ``vec_id`` and ``embedding``.
    """
    named = F.col("vec_id").isNotNull()
    vectors = vectors.filter(named & usable("embedding")).select(
        F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("vector")
    )
    queries = (
        queries.filter(named & usable("embedding"))
        .select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("vector"))
        .groupBy("id")
        .agg(F.min("vector").alias("vector"))
    )
    vector_blocks = -(-max(vectors.count(), 1) // VECTOR_BLOCK)
    query_blocks = -(-max(queries.count(), 1) // QUERY_BLOCK)

    def dealt(rows: DataFrame, own: str, blocks: int, other: str, others: int, asks: bool):
        return rows.select(
            F.size("vector").alias("length"),
            F.pmod(F.xxhash64("id", F.lit(own)), F.lit(blocks)).alias(own),
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long"))).alias(other),
            F.lit(asks).alias("asks"),
            "id",
            "vector",
        ).select("length", "v_block", "q_block", "asks", "id", "vector")

    both = dealt(vectors, "v_block", vector_blocks, "q_block", query_blocks, False).unionByName(
        dealt(queries, "q_block", query_blocks, "v_block", vector_blocks, True)
    )
    keys = ["length", "v_block", "q_block"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if len(batch) == 0:
                continue
            values = np.stack([batch.column(c).to_numpy() for c in keys])
            cuts = np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(batch)]):
                key = tuple(values[:, start])
                if held and key != last:
                    yield searched(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(start, end - start))
                last = key
        if held:
            yield searched(pa.Table.from_batches(held))

    def searched(table: pa.Table) -> pa.RecordBatch:
        asks = table.column("asks").to_numpy()
        ids = table.column("id").to_numpy()
        flat = table.column("vector").combine_chunks()
        matrix = flat.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        found: list[tuple] = []
        if asks.any() and not asks.all():
            index, own_ids = BlockIndex(matrix[~asks]), ids[~asks]
            for query, row in zip(ids[asks], matrix[asks]):
                rows, distances = index.nearest(row, k, own_ids, query)
                found += [(query, own_ids[r], d) for r, d in zip(rows, distances)]
        columns = list(zip(*found)) if found else [[], [], []]
        types = [pa.int64(), pa.int64(), pa.float64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=["query_id", "vec_id", "score"]
        )

    found = (
        both.repartition(*keys)
        .sortWithinPartitions(*keys, "asks")
        .mapInArrow(search, "query_id long, vec_id long, score double")
        .groupBy("query_id", "vec_id")
        .agg(F.min("score").alias("score"))
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

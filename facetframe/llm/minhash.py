"""Near-duplicate documents by min-max hashing.

Every permutation of the shingles gives two signature values, its minimum and its maximum, so a
signature of 64 values costs 32 hash evaluations a shingle. Documents that agree in one band of
values meet in a bucket, and the whole signature then bounds which pairs are worth comparing. Both
follow from the percent asked for: bands are the widest of which a linked pair shares none with
probability ``MISSED_BANDS`` at most (four values at 85 %, three at 80 %), and the least number of
agreeing values is the largest that a linked pair stays below with probability ``MISSED_VALUES`` at
most. A percent that even bands of one value do not cover is refused.

Documents with equal shingle sets are one class and go on as one representative. In a bucket, a
spanning forest of the agreeing pairs is kept instead of all pairs; its trees, joined across buckets,
are families, and a link can only lie within a family. Links are confirmed on the full shingle sets
inside a family, comparing only documents not connected yet, and leave the task as a forest. Large
buckets and families are cut into blocks, families by shingles and by documents; every pair of blocks
is a task of its own.

Defined cases: a null text or one without words has no shingles and is linked with nothing; fewer
words than a shingle make one shingle; repeated ids belong to one another; a null id gets no component
of others, and a set that only rows without an id have is looked for in no other; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetframe.llm.graph import components
from facetframe.sources.scratch import stored

WORDS = 5
PERMUTATIONS = 32
VALUES = 2 * PERMUTATIONS
MISSED_BANDS = 1e-5
MISSED_VALUES = 3e-5
BUCKET_BLOCK = 2048
FAMILY_BLOCK = 1_000_000  # shingles
FAMILY_DOCUMENTS = 2048
FILTER_SLOTS = 1 << 20
U64 = np.uint64

_draws = np.random.default_rng(20240607)
_BYTE = _draws.integers(1, 1 << 63, 256, dtype=np.int64).astype(U64)
_PLACE = _draws.integers(1, 1 << 62, 16, dtype=np.int64).astype(U64) * U64(2) + U64(1)
_XOR = _draws.integers(1, 1 << 63, PERMUTATIONS, dtype=np.int64).astype(U64)
_TIMES = _draws.integers(1, 1 << 62, PERMUTATIONS, dtype=np.int64).astype(U64) * U64(2) + U64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def band_width(percent: int) -> int:
    """The most values a band can have for pairs of this similarity to share one."""
    for width in range(4, 0, -1):
        if (1 - (percent / 100) ** width) ** (VALUES // width) <= MISSED_BANDS:
            return width
    raise ValueError(f"signatures of {VALUES} values do not find links at {percent} percent")


def least_agreeing(percent: int) -> int:
    """The number of values that pairs of this similarity agree in, but for ``MISSED_VALUES``."""
    p, below = percent / 100, 0.0
    for n in range(VALUES + 1):
        below += comb(VALUES, n) * p**n * (1 - p) ** (VALUES - n)
        if below > MISSED_VALUES:
            return n
    return VALUES


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of the lower-cased texts, and the number of words of each."""
    raw = np.frombuffer(b" ".join([*texts, b""]).lower(), np.uint8)
    space = _SPACE[raw]
    inside = ~space
    first = inside.copy()
    first[1:] &= space[:-1]
    starts = np.flatnonzero(first)
    ends = np.cumsum([len(t) + 1 for t in texts])
    per_text = np.diff(np.searchsorted(starts, ends), prepend=0)
    if len(starts) == 0:
        return np.zeros(0, U64), per_text
    letters = np.flatnonzero(inside)
    word = np.cumsum(first)[letters] - 1
    place = letters - starts[word]
    powers = np.ones(int(place.max()) + 1, U64)
    powers[1:] = 0x9E3779B97F4A7C15
    powers = np.multiply.accumulate(powers)
    parts = _BYTE[raw[letters]] * powers[place]
    heads = np.flatnonzero(np.diff(word, prepend=-1))
    return _mixed(np.add.reduceat(parts, heads)), per_text


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingles of each text, as 64-bit hashes of whole word sequences."""
    hashes, counts = word_hashes(texts)
    n = len(hashes)
    rolled = np.zeros(max(n - words + 1, 0), U64)
    for k in range(words):
        rolled += hashes[k : k + len(rolled)] * _PLACE[k]
    rolled = _mixed(rolled)
    sets, at = [], 0
    for count in counts:
        if count >= words:
            sets.append(np.unique(rolled[at : at + count - words + 1]))
        elif count:
            whole = (hashes[at : at + count] * _PLACE[:count]).sum(dtype=U64)
            sets.append(_mixed(np.array([whole + U64(count)])))
        else:
            sets.append(np.zeros(0, U64))
        at += count
    return sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, 2 x permutations): minimum and maximum under each; no set may be empty."""
    joined = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(sets), 2 * PERMUTATIONS), U64)
    for k in range(PERMUTATIONS):
        values = (joined ^ _XOR[k]) * _TIMES[k]
        out[:, 2 * k] = np.minimum.reduceat(values, starts)
        out[:, 2 * k + 1] = np.maximum.reduceat(values, starts)
    return out


def linked_with(one: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of several sets are linked with one; no set may be empty."""
    sizes = np.array([len(s) for s in others])
    joined = np.concatenate(others)
    at = np.searchsorted(one, joined)
    at[at == len(one)] = 0
    starts = np.cumsum(sizes) - sizes
    both = np.add.reduceat((one[at] == joined).astype(np.int64), starts)
    return 100 * both >= percent * (len(one) + sizes - both)


def document_signatures(docs: DataFrame, width: int = 4) -> DataFrame:
    """Per row of ``doc_id`` and ``text``: set size and key, band keys and signature bytes.

    A band has ``width`` values; what is left over by whole bands is in none.
    """
    banded = VALUES // width * width

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, len(whole), 256):
                batch = whole.slice(first, 256)
                sets = shingle_sets([(t or "").encode() for t in batch.column(1).to_pylist()])
                full = [s for s in sets if len(s)]
                values = signatures(full) if full else np.zeros((0, VALUES), U64)
                mixed = values[:, :banded].reshape(len(full), -1, width) * _PLACE[:width]
                bands = iter(_mixed(mixed.sum(axis=2, dtype=U64)).view(np.int64))
                # Minima are small and maxima large in long texts: their own upper bits tell nothing.
                codes = iter((_mixed(values) >> U64(56)).astype(np.uint8))
                columns = [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(
                        [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
                        pa.binary(),
                    ),
                    pa.array([next(bands) if len(s) else [] for s in sets], pa.list_(pa.int64())),
                    pa.array([next(codes).tobytes() if len(s) else b"" for s in sets], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(
                    columns, names=["doc_id", "n_shingles", "set_key", "bands", "code"]
                )

    return docs.select("doc_id", "text").mapInArrow(
        sign, "doc_id long, n_shingles long, set_key binary, bands array<long>, code binary"
    )


def _runs(
    rows: DataFrame, keys: list[str], run: Callable[[pa.Table], tuple[list, list]]
) -> DataFrame:
    """Links ``a``-``b`` that ``run`` finds in the rows of each key, streamed in sorted order."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if len(batch) == 0:
                continue
            key = list(zip(*(batch.column(k).to_pylist() for k in keys)))
            cuts = [0, *(i for i in range(1, len(key)) if key[i] != key[i - 1]), len(key)]
            a: list = []
            b: list = []
            for start, end in zip(cuts, cuts[1:]):
                if held and key[start] != last:
                    found = run(pa.Table.from_batches(held))
                    a += found[0]
                    b += found[1]
                    held = []
                held.append(batch.slice(start, end - start))
                last = key[start]
            if a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
                )
        if held:
            a, b = run(pa.Table.from_batches(held))
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
            )

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(stream, "a long, b long")


def _in_block_pairs(rows: DataFrame) -> DataFrame:
    """Rows copied to each pair of blocks of their key, of which there are ``blocks``."""
    own = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    return (
        rows.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("low", F.least("own", "other"))
        .withColumn("high", F.greatest("own", "other"))
        .drop("blocks", "other")
    )


def _agreeing(codes: np.ndarray, one: np.ndarray) -> np.ndarray:
    return (codes == one).sum(axis=1)


def agreeing_forest(reps: np.ndarray, codes: np.ndarray, least: int) -> tuple[list, list]:
    """Edges of a maximum spanning forest over pairs that agree in enough signature values."""
    n = len(reps)
    a: list = []
    b: list = []
    best = np.full(n, -1)
    parent = np.zeros(n, np.int64)
    left = np.ones(n, bool)
    at = 0
    for _ in range(n):
        left[at] = False
        rest = np.flatnonzero(left)
        if not len(rest):
            break
        agree = _agreeing(codes[rest], codes[at])
        closer = agree > best[rest]
        best[rest[closer]] = agree[closer]
        parent[rest[closer]] = at
        at = int(rest[np.argmax(best[rest])])
        if best[at] >= least:
            a.append(int(reps[at]))
            b.append(int(reps[parent[at]]))
    return a, b


def confirmed_forest(
    reps: np.ndarray, codes: np.ndarray, sets: list[np.ndarray], side: np.ndarray, percent: int
) -> tuple[list, list]:
    """Confirmed links that connect all documents of a family that confirmed links connect.

    Where ``side`` has two values only pairs across the sides are compared: pairs within a block are
    the work of the block's own task. The pairs of one row are held at a time.
    """
    n, least = len(reps), least_agreeing(percent)
    tree = np.arange(n)
    a: list = []
    b: list = []
    crossing = len(np.unique(side)) > 1
    for i in range(n - 1):
        agree = _agreeing(codes[i + 1 :], codes[i])
        ok = (agree >= least) & (tree[i + 1 :] != tree[i])
        if crossing:
            ok &= side[i + 1 :] != side[i]
        rest = np.flatnonzero(ok)
        rest = rest[np.argsort(-agree[rest], kind="stable")] + i + 1
        # Few at first, as a link often connects most of the others; many where none is confirmed.
        few = 4
        while len(rest):
            some = rest[:few]
            for j in some[linked_with(sets[i], [sets[j] for j in some], percent)].tolist():
                if tree[j] != tree[i]:
                    tree[tree == tree[j]] = tree[i]
                    a.append(int(reps[i]))
                    b.append(int(reps[j]))
            rest = rest[few:]
            rest = rest[tree[rest] != tree[i]]
            few = min(2 * few, 256)
    return a, b


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every row.

    Links join documents with ``100 * shared >= percent * all`` distinct shingles; a component is
    named by its least id, which is the document that is kept.
    """
    width, least = band_width(percent), least_agreeing(percent)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stored(document_signatures(docs, width), "signatures")
    some = signed.filter("n_shingles > 0")
    classes = stored(
        some.groupBy("set_key").agg(
            F.min("doc_id").alias("rep"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"),
            F.first("code").alias("code"),
        ),
        "classes",
    )

    banded = classes.select("rep", F.posexplode("bands").alias("band", "value")).select(
        "rep", F.xxhash64("band", "value").alias("bucket")
    )
    shared = (
        banded.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("bucket", F.ceil(F.col("n") / BUCKET_BLOCK).alias("blocks"))
    )

    def bucket_forest(rows: pa.Table) -> tuple[list, list]:
        codes = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint8)
        codes = codes.reshape(len(rows), -1)
        return agreeing_forest(rows.column("rep").to_numpy(), codes, least)

    # Signatures travel only with documents that share a bucket.
    met = banded.join(shared, "bucket").join(classes.select("rep", "code"), "rep")
    meeting = _in_block_pairs(met)
    near = _runs(meeting, ["bucket", "low", "high"], bucket_forest)
    families = components(near, "family_links").withColumnRenamed("component", "family")
    families = stored(families.withColumnRenamed("node", "rep"), "families")

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, len(whole), 256):
                batch = whole.slice(first, 256)
                sets = shingle_sets([(t or "").encode() for t in batch.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:2], pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["family", "rep", "set"],
                )

    members = families.join(classes.select("rep", "n_shingles", "code"), "rep")
    blocks = members.groupBy("family").agg(
        F.ceil(
            F.greatest(
                F.sum("n_shingles") / FAMILY_BLOCK, F.count(F.lit(1)) / FAMILY_DOCUMENTS
            )
        ).alias("blocks")
    )
    # A filter of bounded size first, so that few texts are shuffled for the exact join.
    slot = F.pmod(F.xxhash64("rep"), F.lit(FILTER_SLOTS)).alias("slot")
    texts = (
        docs.withColumnRenamed("doc_id", "rep")
        .withColumn("slot", slot)
        .join(F.broadcast(families.select(slot).distinct()), "slot", "left_semi")
        .join(families, "rep")
    )
    sets = texts.select("family", "rep", "text").mapInArrow(
        sets_of, "family long, rep long, set binary"
    )
    full = sets.join(members.select("rep", "code"), "rep").join(blocks, "family")

    def family_forest(rows: pa.Table) -> tuple[list, list]:
        codes = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint8)
        return confirmed_forest(
            rows.column("rep").to_numpy(),
            codes.reshape(len(rows), -1),
            [np.frombuffer(s, U64) for s in rows.column("set").to_pylist()],
            rows.column("own").to_numpy(),
            percent,
        )

    links = _runs(_in_block_pairs(full), ["family", "low", "high"], family_forest)
    joined = components(links, "confirmed_links")
    named = classes.select("set_key", "rep").join(joined, F.col("rep") == F.col("node"), "left")
    named = named.select(
        "set_key", F.coalesce("component", "rep").alias("component")
    )
    return signed.join(named, "set_key", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce("component", "doc_id").eqNullSafe(F.col("doc_id")).alias("kept"),
    )

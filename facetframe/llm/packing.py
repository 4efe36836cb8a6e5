"""Best-two-fit packing of tokenised documents into sequences of a fixed length.

A sequence is filled greedily with the largest piece that still fits; then its smallest piece is
exchanged for two unpacked pieces where these fill the enlarged gap more tightly.

Lengths are whole numbers up to the sequence length, so the packing only needs to know how many
pieces of each length there are: at most ``capacity`` counts, whatever the number of documents. The
driver packs these counts, as many equal sequences at a time as the counts allow, which is what
packing them one by one gives. Pieces are then numbered within their length, split over many tasks
even where a third of them have one length, and find their place by that number.

Defined cases: a null or empty text is a document of the end token alone; repeated rows are packed
as pieces of their own; ties between equal lengths go by id and piece; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetframe.llm.common import numbered, partitions
from facetframe.sources.scratch import stored

CAPACITY = 2048
END_ID = 0
VOCABULARY = "byte_bpe_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"
OUTPUT_BYTES = 1 << 20


def two_fit_patterns(counts: list[int], capacity: int) -> list[tuple[list[int], int]]:
    """Sequences as lists of lengths, each with the number of times it is used.

    ``counts[n]`` is the number of pieces of length n.
    """
    counts = list(counts)
    patterns: list[tuple[list[int], int]] = []
    top = capacity

    def largest(limit: int) -> int:
        while limit > 0 and counts[limit] == 0:
            limit -= 1
        return limit

    while (top := largest(top)) > 0:
        chosen: list[int] = []
        gap, size = capacity, top
        while size > 0:
            chosen.append(size)
            counts[size] -= 1
            gap -= size
            size = largest(min(gap, size))
        if gap > 0 and len(chosen) > 1:
            swapped = _tighter_pair(counts, gap + chosen[-1], chosen[-1])
            if swapped:
                counts[chosen.pop()] += 1
                for size in swapped:
                    counts[size] -= 1
                chosen.extend(swapped)
        need = np.bincount(chosen)
        used = np.flatnonzero(need)
        # The same choices are made again for as long as every length used is left.
        more = min(counts[n] // int(need[n]) for n in used)
        for n in used:
            counts[n] -= more * int(need[n])
        patterns.append((chosen, 1 + more))
    return patterns


def _tighter_pair(counts: list[int], room: int, size: int) -> tuple[int, int] | None:
    """The two unpacked lengths with the largest sum that is above ``size`` and at most ``room``."""
    best, found = size, None
    for upper in range(room - 1, 0, -1):
        if 2 * upper <= best:
            break
        if counts[upper] == 0:
            continue
        lower = min(upper, room - upper)
        while lower > 0 and upper + lower > best:
            if counts[lower] > (lower == upper):
                best, found = upper + lower, (upper, lower)
                break
            lower -= 1
        if best == room:
            break
    return found


@lru_cache(maxsize=1)
def _encoder():
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(VOCABULARY), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    with open(public_tokenizers.path(TOKENIZER), encoding="utf-8") as whole:
        added = {t["content"]: t["id"] for t in json.load(whole)["added_tokens"]}
    return tiktoken.Encoding(
        "byte_bpe_50k",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=ranks,
        special_tokens=added,
    )


def token_pieces(
    docs: DataFrame,
    capacity: int = CAPACITY,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    added_tokens: bool = False,
) -> DataFrame:
    """Cut the token ids of each whole text, closed by the end id, into pieces.

    All pieces but the first have ``capacity`` ids. ``ids`` holds them as little-endian unsigned
    32-bit numbers. Control strings inside a text are ordinary text, or with ``added_tokens`` the
    tokens that the tokenizer's file adds for them.
    """

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids binary"
    cut = partial(_cut, capacity=capacity, added_tokens=added_tokens)
    return docs.select(id_col, text_col).mapInArrow(cut, schema)


def _cut(
    batches: Iterator[pa.RecordBatch], capacity: int, added_tokens: bool
) -> Iterator[pa.RecordBatch]:
    """Pieces of the texts, given back as soon as they hold ``OUTPUT_BYTES``."""
    encoder = _encoder()
    encode = (
        partial(encoder.encode, allowed_special="all", disallowed_special=())
        if added_tokens
        else encoder.encode_ordinary
    )
    for batch in batches:
        keys, texts = batch.column(0).to_pylist(), batch.column(1)
        rows: list[tuple] = []
        held = 0
        for key, text in zip(keys, texts):
            ids = np.array([*encode(text.as_py() or ""), END_ID], dtype="<u4")
            end = (len(ids) - 1) % capacity + 1
            start = piece = 0
            while start < len(ids):
                rows.append((key, piece, start, end - start, ids[start:end].tobytes()))
                start, end, piece = end, end + capacity, piece + 1
            held += ids.nbytes
            if len(rows) >= 2000 or held >= OUTPUT_BYTES:
                yield _pieces(rows, batch.schema.field(0).type)
                rows, held = [], 0
        if rows:
            yield _pieces(rows, batch.schema.field(0).type)


def _pieces(rows: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
    types = [key_type, pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    names = ["doc_id", "piece", "start", "length", "ids"]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names
    )


def pack_pieces(
    pieces: DataFrame, capacity: int = CAPACITY, *, id_cols: tuple[str, ...] = ("doc_id", "piece")
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``capacity``.

    The other columns are carried along. ``pieces`` is read three times, so it should be stored.
    """
    spark = pieces.sparkSession
    counts = [0] * (capacity + 1)
    # At most one row per length.
    for row in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[row["length"]] = row["n"]

    # The slots of each length in the order of the sequences, as (first number, first sequence,
    # offset): the piece with number r takes the last slot that begins at or before r. There are as
    # many as patterns have lengths, which depends on the capacity and not on the number of pieces.
    slots: dict[int, list[tuple[int, int, int]]] = {}
    taken = [0] * len(counts)
    first = 0
    for chosen, times in two_fit_patterns(counts, capacity):
        offset = 0
        for size in chosen:
            slots.setdefault(size, []).append((taken[size], first, offset))
            taken[size] += times
            offset += size
        first += times

    ranked = numbered(
        pieces, ["length"], list(id_cols), "__rank", 4 * partitions(spark)
    ).select(*pieces.columns, "__rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {
            n: [np.array(x, dtype=np.int64) for x in zip(*at)] for n, at in slots.items()
        }
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("__rank").to_numpy()
            sequence, offset = np.empty_like(rank), np.empty_like(rank)
            by = np.argsort(length, kind="stable")
            for rows in np.split(by, np.flatnonzero(np.diff(length[by])) + 1):
                if len(rows) == 0:
                    continue
                firsts, sequences, offsets = tables[int(length[rows[0]])]
                at = np.searchsorted(firsts, rank[rows], side="right") - 1
                sequence[rows] = sequences[at] + rank[rows] - firsts[at]
                offset[rows] = offsets[at]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence), pa.array(offset)],
                names=[*batch.schema.names[:-1], "sequence_id", "offset"],
            )

    schema = T.StructType(
        [
            *pieces.schema.fields,
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )
    return ranked.mapInArrow(place, schema)


def pack_documents(
    docs: DataFrame, capacity: int = CAPACITY, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Tokenise, cut and place whole documents; the ids of a piece are kept as their CRC-32.

    The ids are those of the tokenizer at its default setting, added tokens included.
    ``token_pieces`` holds the ids themselves, stored once; carry them through ``pack_pieces`` to
    write training sequences.
    """
    pieces = token_pieces(docs, capacity, id_col=id_col, text_col=text_col, added_tokens=True)
    pieces = stored(pieces, "token_pieces")
    slim = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack_pieces(slim, capacity)

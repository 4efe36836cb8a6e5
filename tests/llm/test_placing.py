"""Packing and sharding."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from documents import docs_frame, sentence
from facetframe.llm import packing, sharding


def one_by_one(sizes, capacity):
    """Best-two-fit on a list of lengths, a sequence at a time."""
    left, found = sorted(sizes, reverse=True), []
    while left:
        chosen, gap = [], capacity
        while (fits := [s for s in left if s <= gap]):
            size = fits[0]
            left.remove(size)
            chosen.append(size)
            gap -= size
        if gap and len(chosen) > 1:
            room, best = gap + chosen[-1], None
            for i, a in enumerate(left):
                for b in left[i + 1 :]:
                    if chosen[-1] < a + b <= room and (best is None or a + b > sum(best)):
                        best = (a, b)
            if best:
                left.append(chosen.pop())
                for s in best:
                    left.remove(s)
                    chosen.append(s)
                left.sort(reverse=True)
        found.append(sum(chosen))
    return found


@pytest.mark.parametrize("seed", range(12))
def test_counted_packing_packs_as_one_by_one(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 25, 60])
    sizes = [rng.randint(1, rng.choice([capacity, capacity // 2])) for _ in range(rng.randint(1, 60))]
    counts = np.bincount(sizes, minlength=capacity + 1).tolist()
    patterns = packing.two_fit_patterns(counts, capacity)
    packed = [s for chosen, times in patterns for s in chosen * times]
    assert sorted(packed) == sorted(sizes)
    assert all(sum(chosen) <= capacity for chosen, _ in patterns)
    fills = sorted(sum(chosen) for chosen, times in patterns for _ in range(times))
    assert fills == sorted(one_by_one(sizes, capacity))


def test_patterns_do_not_grow_with_the_counts():
    rng = random.Random(1)
    counts = [0] + [rng.randint(10**6, 10**7) for _ in range(512)]
    assert len(packing.two_fit_patterns(counts, 512)) < 5000


def test_pieces_hold_the_ids_of_the_tokenizer(spark, odd, odd_rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    reference.encode_special_tokens = True
    ids = {}
    for r in packing.token_pieces(odd, 64).collect():
        ids.setdefault(str(r.doc_id), []).append((r.piece, r.start, r.length, np.frombuffer(r.ids, "<u4").tolist()))
    for doc, text in odd_rows:
        if doc in (11, 12, None, 7, 8):
            continue
        pieces = sorted(ids[str(doc)])
        whole = reference.encode(text or "", add_special_tokens=False).ids + [0]
        assert [x for p in pieces for x in p[3]] == whole
        assert [p[0] for p in pieces] == list(range(len(pieces)))
        assert all(p[2] == 64 for p in pieces[1:]) and [p[1] for p in pieces] == np.cumsum([0, *[p[2] for p in pieces[:-1]]]).tolist()
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for r in packing.token_pieces(texts, 1 << 20).join(texts.select("doc_id", "text"), "doc_id").collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == reference.encode(r.text, add_special_tokens=False).ids + [0]


def test_packed_ids_are_those_of_the_tokenizer_at_its_default(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [end, f"one  {end}  two", f"{end}{end}\n", f"é海 {end[:-1]} x{end}y \n\n {end} ", "plain text  ", f"<|{end}|>", "", None]
    got = {r.doc_id: r for r in packing.pack_documents(docs_frame(spark, list(enumerate(texts)))).collect()}
    for doc, text in enumerate(texts):
        ids = np.array(reference.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        assert (got[doc].length, got[doc].ids_crc32) == (len(ids), zlib.crc32(ids.tobytes())), text


def check_places(rows, capacity):
    seen = {}
    for r in rows:
        seen.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in seen.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(seen)


def test_places_are_gapless_for_odd_and_repeated_documents(odd, nothing, odd_rows):
    rows = packing.pack_documents(odd, 64).collect()
    assert sum(r.piece == 0 for r in rows) == len(odd_rows)
    assert check_places(rows, 64) <= 1.05 * sum(r.length for r in rows) / 64 + 1
    assert packing.pack_documents(nothing).count() == 0


def test_hot_length_is_spread_and_packed(spark):
    pieces = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.lit(0).alias("piece"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 90 + 1).cast("long").alias("length"),
        F.lit("kept").alias("__extra"),
    )
    rows = packing.pack_pieces(pieces, 100).collect()
    total = sum(r.length for r in rows)
    assert check_places(rows, 100) <= total / 100 * 1.02 + 1 and rows[0]["__extra"] == "kept"


def test_bin_tree_finds_the_tightest_bin():
    rng, tree, bins = random.Random(3), sharding.BinTree(), set()
    for step in range(3000):
        key = (rng.randint(0, 300), step)
        tree.add(key)
        bins.add(key)
        size = rng.randint(0, 320)
        found = tree.tightest(size)
        assert found == min((b for b in bins if b[0] >= size), default=None)
        if found and rng.random() < 0.8:
            tree.remove(found)
            bins.remove(found)
        assert tree.root is None or tree.root[3] < 2 * np.log2(len(bins) + 2) + 1


def test_best_fit_decreasing_against_a_loop():
    rng = random.Random(2)
    for _ in range(30):
        sizes = [rng.randint(1, 40) for _ in range(rng.randint(0, 50))]
        room, expected = [], []
        for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
            fits = [(r, b) for b, r in enumerate(room) if r >= sizes[i]]
            if not fits:
                room.append(50)
                fits = [(50, len(room) - 1)]
            b = min(fits)[1]
            room[b] -= sizes[i]
            expected.append((i, b))
        assert sharding.best_fit_decreasing(sizes, 50) == [b for _, b in sorted(expected)]


def test_bins_are_even_and_large_groups_stand_alone():
    rng = random.Random(5)
    sizes = [rng.randint(1, 1000) for _ in range(3000)]
    bins = sharding.balanced_bins([10**7, *sizes], 24)
    loads = np.bincount(bins, weights=[10**7, *sizes], minlength=24)
    assert sorted(loads)[-1] == 10**7 and max(sorted(loads)[:-1]) < 1.02 * sum(sizes) / 23
    assert sharding.balanced_bins([], 3) == []
    empty = sharding.balanced_bins([0, 0], 3)
    assert len(empty) == 2 and set(empty) <= {0, 1, 2}


def test_shards_keep_equal_texts_together(spark, odd, nothing, odd_rows):
    rng = random.Random(8)
    rows = [*odd_rows, *((1000 + i, sentence(rng, 20)) for i in range(300)), *((5000 + i, "hot " * 50) for i in range(150))]
    got = sharding.shard_documents(docs_frame(spark, rows), 5).collect()
    assert len(got) == len(rows)
    texts = {}
    for r in rows:
        texts.setdefault(str(r[0]), []).append(r[1])
    shard_of = {}
    for r in got:
        if len(texts[str(r.doc_id)]) == 1:
            text = texts[str(r.doc_id)][0]
            raw = (text or "").encode()
            assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
            assert shard_of.setdefault(text, r.shard) == r.shard
    for shard in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    assert {r.shard for r in got} <= set(range(5))
    assert sharding.shard_documents(nothing, 5).count() == 0


def test_pieces_leave_in_batches_of_bounded_bytes(monkeypatch):
    monkeypatch.setattr(packing, "OUTPUT_BYTES", 4000)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(40)), "text": ["one two three " * 100] * 40})
    found = list(packing._cut(iter([batch]), capacity=2048, added_tokens=True))
    assert len(found) > 5
    assert [i for b in found for i in b.column("doc_id").to_pylist()] == list(range(40))

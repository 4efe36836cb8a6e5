"""Layouts kept with tables, and tables in versions."""

import glob
import os
from collections import Counter, defaultdict

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

import facetframe as ff
from facetframe.functions.paths import promoted_columns
from facetframe.sources import versions
from tables import ids, isbns, plan

ROWS = "id long, d int, m map<string,string>, tags array<string>, x double"


def rows(spark, *some):
    return spark.createDataFrame([(i, i % 3, {"k": k}, [k, "all"], float(i)) for i, k in some], ROWS)


# Layouts


def test_append_follows_the_partitions(spark, path):
    ff.write_table(rows(spark, (1, "x"), (2, "y")), path, partition_by=["d"])
    ff.write_table(rows(spark, (3, "x"), (5, "y")), path, mode="append")
    assert ids(ff.read_table(spark, path)) == [1, 2, 3, 5]
    assert not glob.glob(f"{path}/*.parquet")
    assert ids(ff.read_table(spark, path).filter("d = 2")) == [2, 5]


def test_append_rows_follows_partitions_and_promotion(spark, tmp_path):
    table, terms = f"{tmp_path}/t", f"{tmp_path}/p"
    ff.write_table(rows(spark, (1, "x"), (2, "y")), table, partition_by=["d"], promote=["m.k"], bloom=["id"])
    ff.write_postings(ff.postings(ff.read_table(spark, table), "id", ["tags"]), terms)
    ff.append_rows(rows(spark, (3, "x"), (4, "x")), table, terms, "id")
    now = ff.read_table(spark, table)
    assert ids(ff.where(now, "m.k = 'x'")) == [1, 3, 4]
    assert ids(ff.lookup(now, ff.read_postings(spark, terms), "id", "tags", "x")) == [1, 3, 4]
    # Either file's schema has the promoted column, so whichever is read first gives it.
    for file in glob.glob(f"{table}/*/*.parquet"):
        assert promoted_columns(spark.read.parquet(file)) == {"`m`.`k`": "__m_k"}
    assert "EqualTo(__m_k,x)" in plan(ff.where(now, "m.k = 'x'"))


def test_layout_of_tables_written_otherwise_is_read_off_them(spark, path):
    ff.promote(rows(spark, (1, "x")), ["m.k"]).write.partitionBy("d").parquet(path)
    assert ff.stored_layout(spark, path) == ff.Layout(partition_by=("d",), promote=("`m`.`k`",))
    ff.write_table(rows(spark, (2, "y")), path, mode="append")
    assert ids(ff.where(ff.read_table(spark, path), "m.k = 'y'")) == [2]
    assert ff.stored_layout(spark, f"{path}-none") is None


def test_append_refuses_another_layout_or_other_columns(spark, path):
    ff.write_table(rows(spark, (1, "x")), path, partition_by=["d"], promote=["m.k"])
    more = rows(spark, (2, "y"))
    for wrong in ({"partition_by": ["x"]}, {"sort_by": ["x"]}, {"promote": ["m.other"]}, {"bloom": ["id"]}):
        with pytest.raises(ValueError):
            ff.write_table(more, path, mode="append", **wrong)
    with pytest.raises(ValueError):
        ff.write_table(more.drop("x"), path, mode="append")
    with pytest.raises(ValueError):
        ff.write_table(more.withColumn("y", F.lit(1)), path, mode="append")
    ff.write_table(more, path, mode="append", partition_by=["d"], promote=["m.`k`"])
    assert ids(ff.read_table(spark, path)) == [1, 2]


def test_append_to_nothing_writes_and_keeps_the_layout(spark, path):
    ff.write_table(rows(spark, (1, "x")), path, mode="append", sort_by=["m.k"], partition_by=["d"])
    assert ff.stored_layout(spark, path) == ff.Layout(("d",), ("m.k",))
    ff.write_table(rows(spark, (2, "x")), path, mode="ignore")
    assert ff.stored_layout(spark, path).partition_by == ("d",)
    ff.write_table(rows(spark, (2, "x")), path)
    assert ff.stored_layout(spark, path) == ff.Layout()


def test_appended_keys_must_be_new(spark, tmp_path):
    table, terms = f"{tmp_path}/t", f"{tmp_path}/p"
    ff.write_table(rows(spark, (1, "x")), table)
    ff.write_postings(ff.postings(ff.read_table(spark, table), "id", ["tags"]), terms)
    for bad in [(1, "y")], [(2, "y"), (2, "z")]:
        with pytest.raises(ValueError):
            ff.append_rows(rows(spark, *bad), table, terms, "id")
    assert ids(ff.read_table(spark, table)) == [1]


# Versions


def started(spark, root, **more):
    given = {"key": "id", "posted": ["tags", "m"], "summaries": [ff.Summary("by_d", ("d", "m.k"), ("x", "id"))]}
    return ff.create_versioned(
        rows(spark, (1, "x"), (2, "y"), (3, "x")),
        root,
        layout=ff.Layout(partition_by=("d",), promote=("m.k",)),
        **(given | more),
    )


def content(spark, root, number=None):
    return {r.id: r.m["k"] for r in ff.read_versioned(spark, root, number).collect()}


def found(spark, root, value):
    base, terms = ff.read_versioned(spark, root), ff.versioned_postings(spark, root)
    return ids(ff.lookup(base, terms, "id", "m.k", value))


def summary(spark, root):
    got = ff.read_summary(spark, root, "by_d").collect()
    return {(r.d, r.k): (r.n, r.n_x, r.min_x, r.max_x, r.sum_x, r.sum_id) for r in got}


def summary_by_loop(state):
    groups = defaultdict(list)
    for i, k in state.items():
        groups[i % 3, k].append(i)
    return {g: (len(v), len(v), float(min(v)), float(max(v)), float(sum(v)), sum(v)) for g, v in groups.items()}


def assert_state(spark, root, state):
    assert sorted((r.id, r.m["k"]) for r in ff.read_versioned(spark, root).collect()) == sorted(state.items())
    for value in ("x", "z"):
        assert found(spark, root, value) == sorted(i for i, k in state.items() if k == value)
    assert summary(spark, root) == summary_by_loop(state)
    counts = {r.value: r.n for r in ff.facet_from_postings(ff.versioned_postings(spark, root), "m.k").collect()}
    assert counts == Counter(state.values())


def test_batches_that_repeat_change_nothing(spark, path):
    started(spark, path, batch="zero")
    ff.append_batch(rows(spark, (4, "z"), (5, "x")), path, "one")
    ff.upsert_batch(rows(spark, (2, "z"), (6, "y")), path, "two")
    ff.delete_batch(rows(spark, (3, ""), (77, "")).select("id"), path, "three")
    state = {1: "x", 2: "z", 4: "z", 5: "x", 6: "y"}
    assert_state(spark, path, state)
    number = ff.table_version(spark, path).number
    ff.append_batch(rows(spark, (4, "z"), (5, "x")), path, "one")
    ff.upsert_batch(rows(spark, (2, "w")), path, "two")
    ff.delete_batch(rows(spark, (1, "")).select("id"), path, "three")
    assert ff.table_version(spark, path).number == number
    assert_state(spark, path, state)


def test_updates_hide_older_rows_only(spark, path):
    started(spark, path)
    ff.upsert_batch(rows(spark, (1, "y")), path)
    ff.delete_batch(rows(spark, (1, "")).select("id"), path)
    ff.append_batch(rows(spark, (1, "z")), path)
    ff.upsert_batch(rows(spark, (1, "w"), (9, "w")), path)
    assert_state(spark, path, {1: "w", 2: "y", 3: "x", 9: "w"})


def test_old_versions_still_read(spark, path):
    started(spark, path)
    before = ff.read_versioned(spark, path)
    ff.upsert_batch(rows(spark, (1, "y")), path)
    ff.compact_batches(spark, path)
    assert {r.id: r.m["k"] for r in before.collect()} == {1: "x", 2: "y", 3: "x"} == content(spark, path, 1)
    assert content(spark, path, 2) == content(spark, path, 3) == {1: "y", 2: "y", 3: "x"}


def test_compaction_packs_small_batches_and_folds_marks(spark, path):
    started(spark, path)
    for i in range(10, 22):
        ff.append_batch(rows(spark, (i, "z")), path)
    ff.upsert_batch(rows(spark, (10, "w")), path)
    ff.delete_batch(rows(spark, (11, "")).select("id"), path)
    state = content(spark, path)
    many = len(ff.version_files(spark, path))
    version = ff.compact_batches(spark, path)
    assert len(version.batches) == 1 and not any(b.marks for b in version.batches)
    files = ff.version_files(spark, path)
    assert len(files) == 3 < many  # one for each partition
    assert_state(spark, path, state)
    assert ff.compact_batches(spark, path).number == version.number
    assert "LeftAnti" not in plan(ff.read_versioned(spark, path))
    assert "EqualTo(__m_k,x)" in plan(ff.where(ff.read_versioned(spark, path), "m.k = 'x'"))


def test_compaction_leaves_batches_of_large_files_alone(spark, path):
    large = spark.range(100, 40_000, 1, 1).select(
        "id", F.lit(1).alias("d"), F.create_map(F.lit("k"), F.sha2(F.col("id").cast("string"), 256)).alias("m"),
        F.array().cast("array<string>").alias("tags"), F.rand(1).alias("x"),
    )
    ff.create_versioned(large, path, layout=ff.Layout(partition_by=("d",)))
    for i in range(4):
        ff.append_batch(rows(spark, (i, "z")), path)
    first = ff.table_version(spark, path).batches[0]
    version = ff.compact_batches(spark, path, small_bytes=500_000, target_bytes=1_000_000)
    assert version.batches[0] == first and len(version.batches) == 2
    assert ff.read_versioned(spark, path).count() == 39_904


def test_a_writer_that_stops_leaves_the_table_as_it_was(spark, path, monkeypatch):
    started(spark, path)
    for step in (
        lambda: ff.append_batch(rows(spark, (4, "z")), path, "four"),
        lambda: ff.upsert_batch(rows(spark, (2, "w")), path, "two"),
        lambda: ff.compact_batches(spark, path),
    ):
        state, number = content(spark, path), ff.table_version(spark, path).number
        with monkeypatch.context() as m:
            m.setattr(versions, "_publish", lambda *_: (_ for _ in ()).throw(OSError("stopped")))
            with pytest.raises(OSError):
                step()
        assert ff.table_version(spark, path).number == number
        assert_state(spark, path, state)
        step()
        assert ff.table_version(spark, path).number == number + 1
    assert_state(spark, path, {1: "x", 2: "w", 3: "x", 4: "z"})
    ff.vacuum(spark, path)
    assert_state(spark, path, {1: "x", 2: "w", 3: "x", 4: "z"})


def test_of_two_writers_one_publishes(spark, path, monkeypatch):
    started(spark, path)
    read = versions.table_version
    stale = read(spark, path)
    ff.append_batch(rows(spark, (4, "z")), path)
    monkeypatch.setattr(versions, "table_version", lambda s, root, number=None: stale if number is None else read(s, root, number))
    with pytest.raises(versions.ChangedMeanwhile):
        ff.append_batch(rows(spark, (5, "z")), path)
    monkeypatch.undo()
    assert content(spark, path) == {1: "x", 2: "y", 3: "x", 4: "z"}


def test_updates_do_not_read_the_table(spark, path):
    started(spark, path)
    base = [f"{path}/{kind}" for kind in ("rows", "terms", "marks") if os.path.exists(f"{path}/{kind}")]
    kept = {}
    for folder in base:
        for file in glob.glob(f"{folder}/**/*.parquet", recursive=True):
            kept[file] = open(file, "rb").read()
            open(file, "wb").write(b"")  # whoever reads it fails
    for crc in glob.glob(f"{path}/**/.*.crc", recursive=True):
        os.remove(crc)
    ff.upsert_batch(rows(spark, (2, "z"), (7, "x")), path)
    ff.append_batch(rows(spark, (8, "x")), path, new_keys=True)
    ff.delete_batch(rows(spark, (3, "")).select("id"), path)
    for file, data in kept.items():
        open(file, "wb").write(data)
    assert_state(spark, path, {1: "x", 2: "z", 7: "x", 8: "x"})


def test_summary_of_appended_batches_reads_no_rows(spark, path):
    started(spark, path)
    ff.append_batch(rows(spark, (4, "z")), path)
    got = plan(ff.read_summary(spark, path, "by_d"))
    assert got.count("FileScan parquet") == 1 and "__v0_sum" in got


def test_vacuum_removes_what_no_kept_version_names(spark, path):
    started(spark, path)
    ff.append_batch(rows(spark, (4, "z")), path)
    ff.compact_batches(spark, path)
    gone = ff.vacuum(spark, path)
    assert {g.split("/")[0] for g in gone} == {"rows", "terms", "sums-by_d"} and len(gone) == 6
    assert content(spark, path) == {1: "x", 2: "y", 3: "x", 4: "z"}
    with pytest.raises(ValueError):
        ff.read_versioned(spark, path, 1)
    assert ff.vacuum(spark, path) == []


def test_tables_without_a_key_only_grow(spark, books, path):
    ff.create_versioned(books, path)
    ff.append_batch(books, path)
    assert isbns(ff.read_versioned(spark, path)) == sorted(2 * isbns(books))
    for wrong in (ff.upsert_batch, ff.delete_batch):
        with pytest.raises(ValueError):
            wrong(books, path)
    with pytest.raises(ValueError):
        ff.versioned_postings(spark, path)
    with pytest.raises(ValueError):
        ff.read_summary(spark, path, "none")
    ff.compact_batches(spark, path)
    assert isbns(ff.read_versioned(spark, path)) == sorted(2 * isbns(books))


def test_empty_tables_and_empty_batches(spark, path):
    started(spark, path)
    empty = rows(spark, (1, "x")).limit(0)
    for step in (ff.append_batch, ff.upsert_batch):
        step(empty, path)
    ff.delete_batch(empty.select("id"), path)
    ff.compact_batches(spark, path)
    assert_state(spark, path, {1: "x", 2: "y", 3: "x"})
    ff.delete_batch(rows(spark, (1, ""), (2, ""), (3, "")).select("id"), path)
    assert_state(spark, path, {})
    ff.compact_batches(spark, path)
    assert_state(spark, path, {})
    ff.append_batch(rows(spark, (1, "z")), path)
    assert_state(spark, path, {1: "z"})


@given(st.lists(st.integers(0, 120), max_size=60), st.integers(1, 100))
def test_first_fit_keeps_to_the_capacity(sizes, capacity):
    bins = versions.first_fit(sizes, capacity)
    filled, members = Counter(), Counter(bins)
    for size, b in zip(sizes, bins, strict=True):
        filled[b] += size
    assert len(bins) == len(sizes)
    assert all(filled[b] <= capacity or members[b] - sum(s == 0 for s, x in zip(sizes, bins) if x == b) == 1 for b in filled)
    open_bins = [b for b in filled if 2 * filled[b] <= capacity and filled[b]]
    assert len(open_bins) <= 1

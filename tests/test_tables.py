import glob
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from facetframe import compact, contains_value, path_column, promote, read_table, upsert
from facetframe import without_promoted, write_table
from facetframe.functions.paths import promoted_columns
from facetframe.operators import joins
from facetframe.operators.postings import postings, save_searchable, write_postings
from facetframe.plans.tables import _versioned_orders
from facetframe.sources import scratch
from facetframe.sources.tables import partition_columns
from tables import ids, isbns, plan


def same_rows(a, b):
    def rows(df):
        return sorted(df.select(F.to_json(F.struct(*sorted(df.columns)))).collect())

    return rows(a) == rows(b)


def test_round_trip_keeps_nested_values(spark, books, path):
    write_table(books, path)
    back = read_table(spark, path)
    assert repr(back.orderBy("isbn").collect()) == repr(books.orderBy("isbn").collect())  # NaN
    assert back.schema == books.schema


def test_column_names_with_spaces_dots_and_letters(spark, path):
    names = ["Day", "Key ID", "Map Info", "Liste été", "a.b"]
    row = (1, "K1", {"color": "red", "0.3": "1"}, ["x", "y"], 7)
    df = spark.createDataFrame([row], "a int, b string, c map<string,string>, d array<string>, e int")
    df = df.toDF(*names)
    write_table(df, path, promote=["`Map Info`.color", "`Map Info`.`0.3`"], sort_by=["`Key ID`"])
    back = read_table(spark, path)
    assert without_promoted(back).columns == names
    assert back.filter(path_column(back, "`Map Info`.`0.3`") == "1").count() == 1
    assert back.filter(F.array_contains("`Liste été`", "y") & (F.col("`a.b`") == 7)).count() == 1


def test_promoted_map_key_is_pushed_to_the_reader(spark, books, path):
    write_table(books, path, promote=["notes.ed", "author.born"], bloom=["notes.ed", "isbn"])
    table = read_table(spark, path)
    found = table.filter((path_column(table, "notes.ed") == "red") & F.col("isbn").isNotNull())
    assert "EqualTo(__notes_ed,red)" in plan(found)
    assert isbns(found) == [6]
    assert same_rows(without_promoted(table), books)
    assert "EqualTo" not in plan(books.filter("notes.ed = 'red'"))


def test_nested_paths_to_sort_by_or_filter_are_promoted(spark, books, path):
    write_table(books, path, sort_by=["author.born", "notes.`ed.1`"], bloom=["notes.ed", "isbn"])
    table = read_table(spark, path)
    assert set(promoted_columns(table)) == {"`author`.`born`", "`notes`.`ed.1`", "`notes`.`ed`"}
    assert same_rows(without_promoted(table), books)


def test_promotion_is_idempotent_and_names_do_not_clash(books):
    once = promote(books, ["notes.`ed.1`"])
    twice = promote(once, ["`notes`.`ed.1`", "notes.ed_1", "notes.ed_1"])
    assert twice.columns == [*books.columns, "__notes_ed_1", "__notes_ed_1_"]
    assert promote(books, []).columns == books.columns


def test_partitions_are_discovered_and_pruned(spark, books, path):
    write_table(books, path, partition_by=["bought"], sort_by=["isbn"])
    table = read_table(spark, path)
    found = table.filter("bought = '2019-12-31'")
    assert isbns(found) == [42, 900]
    assert "PartitionFilters: [isnotnull(bought" in plan(found)
    assert partition_columns(spark, path) == ["bought"]


def test_hot_partition_is_written_by_several_tasks(spark, path):
    df = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 5).alias("p"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        write_table(df, path, partition_by=["p"], sort_by=["text"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(path + "/p=0/*.parquet")) > 2
    assert spark.read.parquet(path).count() == 60_000


def test_append_and_user_schema(spark, books, path):
    write_table(books.filter("lent"), path)
    write_table(books.filter("lent IS DISTINCT FROM true"), path, mode="append")
    assert same_rows(read_table(spark, path), books)
    narrow = read_table(spark, path, "isbn long, genres array<string>, other int")
    assert narrow.columns == ["isbn", "genres", "other"]
    assert narrow.filter("other IS NULL").count() == books.count()


def test_plain_writes_do_not_shuffle(spark, books):
    table = promote(books.repartition(3), ["notes.ed"]).sortWithinPartitions("__notes_ed")
    assert plan(table).count("Exchange") == 1


def test_compaction_keeps_rows_and_splits_hot_values(spark, path):
    hot = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
        F.lit("same").alias("text"),
        F.create_map(F.lit("a"), F.lit("b")).alias("m"),
    )
    hot.repartition(20).write.parquet(path)
    compact(spark, path, path + "_to", 6, sort_by=["k"])
    assert len(glob.glob(path + "_to/*.parquet")) == 6
    back = spark.read.parquet(path + "_to")
    assert same_rows(back, hot)
    sizes = back.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert sizes < 2 * 30_000 / 6
    with pytest.raises(Exception, match="(?i)exists"):
        compact(spark, path, path + "_to", 2)
    with pytest.raises(ValueError):
        compact(spark, path, path + "_x", 0)


def test_compaction_of_equal_copies_without_order(spark, path):
    spark.range(9000).select(F.lit(1).alias("k")).repartition(9).write.parquet(path)
    compact(spark, path, path + "_to", 3, sort_by=["k"])
    sizes = [
        r[1] for r in spark.read.parquet(path + "_to").groupBy(F.input_file_name()).count().collect()
    ]
    assert sum(sizes) == 9000 and max(sizes) < 4500


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, 0])
def test_upsert_rules(spark, limit):
    base = spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "n")], "k int, v string"
    )
    updates = spark.createDataFrame(
        [("x", 1), ("y", 1), ("z", 9), ("m", None)], "v string, k int"
    )
    result = upsert(base, updates, "k", limit=limit)
    expected = [(1, "x"), (1, "y"), (2, "c"), (3, "d"), (9, "z"), (None, "m"), (None, "n")]
    assert sorted(map(tuple, result.collect()), key=str) == sorted(expected, key=str)


def test_upsert_on_several_columns_and_same_source(spark):
    base = spark.range(10).select((F.col("id") % 2).alias("a"), (F.col("id") % 5).alias("b"), "id")
    updates = base.filter("a = 0 AND b < 2").withColumn("id", F.col("id") + 100)
    for limit in (joins.BROADCAST_BYTES, 0):
        rows = upsert(base, updates, ["a", "b"], limit=limit)
        assert ids(rows) == [1, 2, 3, 4, 5, 7, 8, 9, 100, 106]


def test_upsert_by_condition(spark, books):
    updates = books.filter("isbn = 6").withColumn("isbn", F.lit(7).cast("long"))
    gone = contains_value("genres", "sea")
    for matching in (gone, "array_contains(genres, 'sea')", lambda t: contains_value("genres", "sea", t)):
        assert isbns(upsert(books, updates, matching=matching)) == [-5, 7, 17, 41, 900]
    with pytest.raises(ValueError):
        upsert(books, updates)


def test_hot_key_is_split_by_adaptive_execution(spark):
    base = spark.range(0, 200_000, 1, 8).select(F.lit(1).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("t"))
    keys = spark.createDataFrame([(1,), (2,)], "k int")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "500k",
        "spark.sql.shuffle.partitions": "8",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = joins.filter_by_keys(base, keys, ["k"], "left_semi", limit=0)
        tasks = joined.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
        assert sum(r[1] for r in tasks) == 200_000 and len(tasks) >= 3
        assert joins.filter_by_keys(base, keys, ["k"], "left_anti", limit=0).count() == 0
    finally:
        for k in settings:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_compaction_keeps_the_partitions(spark, path):
    df = spark.range(9000).select("id", (F.col("id") % 3).alias("a b"), F.lit("x").alias("p=q"))
    for rest in range(3):
        part = df.filter(F.col("id") % 7 % 3 == rest)
        write_table(part, path, mode="append", partition_by=["a b"])
    before = len(glob.glob(path + "/*/*.parquet"))
    compact(spark, path, path + "_to", 3, sort_by=["id"])
    back = read_table(spark, path + "_to")
    assert partition_columns(spark, path + "_to") == ["a b"] and back.count() == 9000
    assert len(glob.glob(path + "_to/*/*.parquet")) < before
    assert "PartitionFilters: [isnotnull(a b" in plan(back.filter("`a b` = 1"))


def test_broadcast_is_measured(spark):
    keys = spark.range(1000).select(F.repeat(F.lit("x"), 1000).alias("k"))
    assert joins.fits_broadcast(keys, 2_000_000)
    assert not joins.fits_broadcast(keys, 900_000)
    assert joins.fits_broadcast(spark.range(0), 0)
    assert not joins.fits_broadcast(spark.range(1).select(F.array("id").alias("k")), 1 << 30)


def test_scratch_is_the_folder_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert scratch.scratch_path(spark, "t").startswith(named)
    assert scratch.ensure_checkpoint_dir(spark) == named


def test_without_that_setting_it_is_below_the_warehouse():
    class Session:
        class conf:
            @staticmethod
            def get(name, *default):
                return {"spark.sql.warehouse.dir": "store:/warehouse/"}.get(name, *default)

        class sparkContext:
            getCheckpointDir = staticmethod(lambda: "set already")

    assert scratch.ensure_checkpoint_dir(Session) == "store:/warehouse/checkpoints"


def test_scratch_keeps_the_last_two_outputs_of_a_name(spark):
    paths = []
    for _ in range(3):
        paths.append(scratch.scratch_path(spark, "kept"))
        spark.range(1).write.parquet(paths[-1])
    assert [bool(glob.glob(p)) for p in paths] == [False, True, True]
    frame = scratch.stored(spark.range(5), "numbers")
    scratch.stored(spark.range(6), "numbers")
    assert frame.count() == 5


def test_sessions_keep_their_own_settings(spark, books, path):
    before = {k: v for k, v in spark.conf.getAll.items()}
    write_table(books, path, partition_by=["bought"], promote=["notes.ed"])
    read_table(spark, path).count()
    assert {k: v for k, v in spark.conf.getAll.items()} == before


@pytest.fixture()
def small_tasks(spark):
    """Adaptive execution takes little for much."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(name, "4k")
    yield
    spark.conf.unset(name)


def _texts(spark):
    return spark.range(0, 6000, 1, 6).select("id", F.sha2(F.col("id").cast("string"), 256).alias("t"))


def test_compaction_sorts_no_more_than_a_range_in_a_task(spark, path, monkeypatch):
    monkeypatch.setattr("facetframe.sources.tables.RANGE_BYTES", 20_000)
    _texts(spark).repartition(12).write.parquet(path)
    compact(spark, path, f"{path}-compacted", 1, sort_by=["t"])
    found = spark.read.parquet(f"{path}-compacted")
    assert 1 < len(found.inputFiles()) <= 6
    assert sorted(found.collect()) == sorted(_texts(spark).collect())


def test_sorted_rows_are_split_over_tasks(spark, path, small_tasks):
    write_table(_texts(spark).coalesce(2).withColumn("one", F.lit(1)), path, sort_by=["one", "id"])
    found = spark.read.parquet(path)
    assert len(found.inputFiles()) > 4 and found.count() == 6000


def test_postings_of_one_term_are_split_over_tasks(spark, path, small_tasks):
    terms = postings(_texts(spark).withColumn("one", F.lit("x")), "id", ["one"])
    write_postings(terms, path, salts=1)
    found = spark.read.parquet(path)
    assert len(found.inputFiles()) > 1 and found.count() == 6000


def test_a_bucket_is_written_by_several_tasks(spark, path, small_tasks):
    name = f"searchable_{uuid4().hex}"
    save_searchable(_texts(spark), name, path, "id", ["t"], 2)
    both = [spark.table(name), spark.table(f"{name}_postings")]
    assert all(len(t.inputFiles()) > 2 and t.count() == 6000 for t in both)


def test_versioned_queries_derive_their_rows_once(spark):
    _, orders = _versioned_orders(spark, "/root/testdata/sf0.001", "derived_once")
    assert "Join" not in plan(orders)

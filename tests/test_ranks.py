"""Pages through a rank index, filters by many keys, pruning by a joined table."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

import facetframe as ff
from facetframe.operators import joins
from facetframe.operators.paging import _keys
from tables import ids, plan

ORDERS = [
    ["a", "id"],
    ["a desc", "id desc"],
    ["a asc nulls last", "b desc nulls first", "id"],
    ["b", "a desc nulls first", "id desc"],
    ["id desc"],
]


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(8)
    rows = [
        (i, rng.choice([None, None, 1, 1, 1, 2, 3, rng.randint(0, 50)]), rng.choice([None, "x", "y", "é", "z"]))
        for i in range(997)
    ]
    return spark.createDataFrame(rows, "id long, a int, b string").repartition(5).cache()


@pytest.mark.parametrize("order", ORDERS)
@pytest.mark.parametrize("per_range", [7, 100, 5000])
def test_pages_by_index_equal_slices_of_the_sorted_rows(spark, numbers, path, order, per_range):
    ff.write_rank_index(numbers, order, path, per_range=per_range)
    index = ff.read_rank_index(spark, path)
    columns = [key.order for key in _keys(order)]
    want = numbers.orderBy(*columns).collect()
    for number, size in ((1, 10), (3, 50), (20, 50), (40, 25), (100, 10), (101, 10), (1, 2000), (2, 996)):
        got = ff.page_by_index(numbers, index, order, number, size).collect()
        assert got == want[(number - 1) * size : number * size]
        assert ff.has_next_by_index(index, number, size).first()[0] == (number * size < len(want))


def test_ties_across_ranges_keep_their_number(spark, numbers, path):
    ff.write_rank_index(numbers, ["a desc"], path, per_range=7)
    index = ff.read_rank_index(spark, path)
    want = [r.a for r in numbers.orderBy(F.col("a").desc_nulls_last()).collect()]
    for number in range(1, 18):
        got = [r.a for r in ff.page_by_index(numbers, index, ["a desc"], number, 60).collect()]
        assert got == want[(number - 1) * 60 : number * 60]


def test_page_by_index_gives_its_range_to_the_reader(spark, numbers, tmp_path):
    ff.write_table(numbers, f"{tmp_path}/t", sort_by=["id"])
    table = ff.read_table(spark, f"{tmp_path}/t")
    ff.write_rank_index(table, ["id"], f"{tmp_path}/i", per_range=50)
    index = ff.read_rank_index(spark, f"{tmp_path}/i")
    page = ff.page_by_index(table, index, ["id"], 9, 100)
    assert ids(page) == list(range(800, 900))
    assert "GreaterThan(id,800)" in plan(page) and "LessThan(id,900)" in plan(page)


def test_index_of_nothing_and_of_another_order(spark, numbers, path):
    ff.write_rank_index(numbers.limit(0), ["a", "id"], path)
    index = ff.read_rank_index(spark, path)
    assert ff.page_by_index(numbers, index, ["a", "id"], 1, 5).count() == 0
    assert ff.has_next_by_index(index, 1, 5).first()[0] is False
    with pytest.raises(ValueError):
        ff.page_by_index(numbers, index, ["a"], 1, 5)
    with pytest.raises(ValueError):
        ff.page_by_index(numbers, index, ["a", "id"], 0, 5)
    with pytest.raises(ValueError):
        ff.write_rank_index(numbers, ["a"], path, per_range=0)


@pytest.mark.parametrize("n", [0, 1, 40, 100_000])
def test_in_keys_equals_a_semi_join(spark, n):
    df = spark.range(300_000).select("id", F.when(F.col("id") % 11 != 0, F.col("id") * 3 % 7919).alias("k"))
    keys = spark.range(n).select((F.col("id") * 7 + 1).alias("key"))
    keys = keys.unionByName(keys.limit(5)).unionByName(spark.createDataFrame([(None,)], "key long"))
    got = ff.in_keys(df, "k", keys)
    want = df.join(keys.na.drop(), F.col("k") == F.col("key"), "left_semi")
    assert got.columns == df.columns
    assert got.agg(F.count("*"), F.sum("id")).first() == want.agg(F.count("*"), F.sum("id")).first()


def test_in_keys_filters_before_it_joins(spark):
    df, keys = spark.range(200_000), spark.range(100_000).select((F.col("id") * 2).alias("k"))
    text = plan(ff.in_keys(df, "id", keys))
    assert "LeftSemi" in text and "getbit" in text and "Subquery" in text
    kept = df
    bits = 1 << 20
    words = joins.key_filter(keys, bits)
    for slot in joins._slots(F.col("id"), bits):
        word = F.get(words, F.shiftright(slot, 6).cast("int"))
        kept = kept.filter(F.getbit(word, slot.bitwiseAND(F.lit(63)).cast("int")) == 1)
    assert 100_000 <= kept.count() < 106_000


def test_in_keys_beyond_its_filter_and_on_paths(spark, books, monkeypatch):
    keys = spark.createDataFrame([("red",), ("blue",), ("x",)], "key string")
    want = ids(books.filter("notes.ed IN ('red', 'blue', 'x')"), "isbn")
    assert ids(ff.in_keys(books, "notes.ed", keys), "isbn") == want
    monkeypatch.setattr(joins, "MOST_BITS", 0)
    assert ids(ff.in_keys(books, "notes.ed", keys), "isbn") == want
    assert "getbit" not in plan(ff.in_keys(books, "notes.ed", keys))
    with pytest.raises(TypeError):
        ff.in_keys(books, "pages", keys)


def test_a_joined_table_prunes_partitions(spark, path):
    rows = spark.range(1000).select("id", (F.col("id") % 10).cast("int").alias("p"))
    ff.write_table(rows, path, partition_by=["p"])
    ff.write_table(spark.createDataFrame([(p, p % 5) for p in range(10)], "p int, g int"), f"{path}-dim")
    for file in glob.glob(f"{path}/p=*/*.parquet"):
        if "/p=3/" not in file and "/p=8/" not in file:
            open(file, "wb").close()  # whoever reads it fails
    for crc in glob.glob(f"{path}/*/.*.crc"):
        os.remove(crc)
    chosen = ff.read_table(spark, f"{path}-dim").filter("g = 3").select("p")
    found = ff.read_table(spark, path, "id long, p int").join(chosen, "p")
    assert "dynamicpruning" in plan(found)
    assert ids(found) == [i for i in range(1000) if i % 10 in (3, 8)]

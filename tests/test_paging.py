import pytest
from pyspark.sql import functions as F

from facetframe import has_next, page, page_after
from facetframe.operators import paging
from tables import plan


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(0, 5000, 1, 7)
    g = F.when(F.col("id") % 13 != 5, F.col("id") % 13)
    return df.select("id", g.alias("g"), (F.col("id") % 97).alias("h"))


def ordered(rows, order):
    rows.createOrReplaceTempView("paged")
    return rows.sparkSession.sql(f"SELECT * FROM paged ORDER BY {', '.join(order)}").collect()


@pytest.mark.parametrize(
    "order",
    [
        ["id"],
        ["g desc", "id"],
        ["g asc nulls last", "h desc", "id desc"],
        ["g desc nulls first", "id"],
        ["h", "g", "id"],
    ],
)
@pytest.mark.parametrize("narrow", [10_000, 40])
def test_pages_cut_the_order_at_every_depth(rows, order, narrow, monkeypatch):
    monkeypatch.setattr(paging, "NARROW", narrow)
    everything = ordered(rows, order)
    for number, size in [(1, 10), (3, 700), (50, 100), (8, 700), (60, 100), (240, 20)]:
        got = page(rows, order, number, size)
        assert got.collect() == everything[(number - 1) * size : number * size]
        assert got.columns == rows.columns


def test_pages_of_one_value_and_of_nulls(spark, monkeypatch):
    monkeypatch.setattr(paging, "NARROW", 10)
    same = spark.range(300).select(F.lit(1).alias("a"), F.lit(None).cast("int").alias("n"), "id")
    for order in (["a", "id"], ["n", "id"], ["n desc", "a", "id"]):
        assert [r.id for r in page(same, order, 6, 50).collect()] == list(range(250, 300))
    assert page(same.filter("false"), ["id"], 1, 5).collect() == []


def test_deep_pages_neither_sort_all_rows_nor_checkpoint(spark, monkeypatch):
    monkeypatch.setattr(paging, "NARROW", 100)
    rows = spark.range(0, 50_000, 1, 4).select("id", F.hash("id").alias("h"))
    text = plan(page(rows, ["h", "id"], 400, 100))
    limit = int(text.split("TakeOrderedAndProject(limit=")[1].split(",")[0])
    assert limit < 2000
    assert "Sort " not in text and "Scan ExistingRDD" not in text


def test_page_after_continues_the_order(rows):
    for order in (["g desc nulls first", "id"], ["g", "id desc"], ["g desc", "h", "id"]):
        everything = ordered(rows, order)
        last, got = None, []
        for _ in range(4):
            part = (page_after(rows, order, last, 333) if last else page(rows, order, 1, 333)).collect()
            got += part
            last = part[-1]
        assert got == everything[: 4 * 333]


def test_orders_are_checked(rows):
    for bad in ("id sideways", "id desc nulls", "id nulls maybe"):
        with pytest.raises(ValueError):
            page(rows, [bad], 1, 5)


def test_has_next(rows):
    assert [has_next(rows, n, 1000).first()[0] for n in (1, 4, 5, 6)] == [True, True, False, False]
    assert has_next(rows.filter("false"), 1, 1).first()[0] is False


def test_page_numbers_start_at_one(rows):
    with pytest.raises(ValueError):
        page(rows, ["id"], 0, 10)
    with pytest.raises(ValueError):
        has_next(rows, 1, 0)


def test_null_order_defaults_and_explicit(edges):
    def order(*by):
        return [r.id for r in edges.orderBy(*by).collect()]

    assert order(F.col("x").asc(), "id") == [1, 5, 3, 4, 2]
    assert order(F.col("x").desc(), "id") == [2, 4, 3, 1, 5]
    assert order(F.col("x").asc_nulls_last(), "id") == [3, 4, 2, 1, 5]
    assert order(F.col("x").desc_nulls_first(), "id") == [1, 5, 2, 4, 3]


def test_sample_is_a_repeatable_subset(rows):
    one = {r.id for r in rows.sample(False, 0.2, 5).collect()}
    assert one == {r.id for r in rows.sample(False, 0.2, 5).collect()}
    assert 800 < len(one) < 1200
    assert rows.sample(True, 1.5, 5).count() > 5000

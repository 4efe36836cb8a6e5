import itertools
from collections import Counter

import pytest
from pyspark.sql import functions as F

from facetframe import facet, group_paths, write_table
from tables import at, buckets, counted, plan


@pytest.mark.parametrize(
    "path, steps",
    [
        ("genres", ["genres"]),
        ("marks", ["marks"]),
        ("copies.hall", ["copies", "hall"]),
        ("copies.`cellar.2`", ["copies", "cellar.2"]),
        ("author.tongues", ["author", "tongues"]),
        ("chapters.head", ["chapters", "head"]),
    ],
)
def test_facet_counts_as_a_loop_does(books, path, steps):
    rows = books.collect()
    assert buckets(facet(books, path)) == counted(rows, *steps)
    assert buckets(facet(books, path, dedup=True)) == counted(rows, *steps, once=True)


def test_null_empty_and_null_element_share_a_bucket(edges):
    assert buckets(facet(edges, "a")) == {None: 3, "1": 2, "2": 1, "3": 3}
    assert buckets(facet(edges, "a", dedup=True)) == {None: 3, "1": 2, "2": 1, "3": 2}


@pytest.mark.parametrize("own", [False, True])
def test_several_arrays_give_every_combination(books, own):
    aggs = {"count": F.count("*")} if own else None
    expected = Counter()
    for row in books.collect():
        lists = [at(row, "genres"), at(row, "author", "tongues"), at(row, "marks")]
        expected.update(itertools.product(*[values or [None] for values in lists]))
    by = {"genre": "genres", "tongue": "author.tongues", "mark": "marks"}
    assert buckets(facet(books, by, aggs)) == dict(expected)


def test_repeats_are_counted_before_they_multiply(spark):
    df = spark.range(1).select(*[F.array_repeat(F.lit("x"), 3000).alias(c) for c in "ab"])
    assert buckets(facet(df, ["a", "b"])) == {("x", "x"): 9_000_000}


def test_metrics_count_a_row_once_per_bucket(books):
    metrics = {
        "n": F.count("*"),
        "scored": F.count("score"),
        "pages": F.sum("pages"),
        "youngest": F.max("author.born"),
        "first": F.min("bought"),
    }
    got = {r.genres: tuple(r)[1:] for r in facet(books, "genres", metrics).collect()}
    for genre in ("crime", "art", "sea", None):
        rows = [r for r in books.collect() for g in (r.genres or [None]) if g == genre]
        born = [r.author.born for r in rows if r.author and r.author.born is not None]
        days = [r.bought for r in rows if r.bought]
        assert got[genre] == (
            len(rows),
            sum(r.score is not None for r in rows),
            sum(r.pages or 0 for r in rows),
            max(born),
            min(days),
        )


def test_metric_may_use_the_array_itself(edges):
    sizes = facet(edges, "a", {"size": F.sum(F.size("a"))}, where="size(a) > 0")
    assert buckets(sizes) == {"1": 5, "2": 3, "3": 7, None: 2}


def test_filter_before_facet(books):
    assert buckets(facet(books, "marks", where="notes.ed = 'blue'")) == {7: 1, -1: 1, None: 1}


def test_atomic_keys_are_not_exploded(books):
    got = buckets(facet(books, ["genres", "lent"]))
    assert got[("crime", True)] == 2 and got[("crime", False)] == 1 and got[(None, None)] == 1


def test_names_must_be_distinct(books):
    with pytest.raises(ValueError):
        facet(books, ["author.name", "chapters.head", "author.name"])


def test_group_by_map_key(books):
    grouped = group_paths(books, "notes.`ed`", {"n": F.count("score"), "pages": F.sum("pages")})
    assert {tuple(r) for r in grouped.collect()} == {
        (None, 2, 130), ("blue", 2, 95 + 2147483647), ("red", 1, 0),
    }
    assert grouped.columns == ["ed", "n", "pages"]
    assert {r[0] for r in group_paths(books, "notes.`ed.1`", {}).collect()} == {None, "red", "blue"}


def test_aggregates_of_no_rows(books):
    empty = books.filter("false").agg(F.count("*"), F.count("score"), F.sum("score")).first()
    assert tuple(empty) == (0, 0, None)


def test_partial_aggregation_comes_before_the_only_shuffle(books):
    text = plan(facet(books, "copies.hall", {"n": F.count("*")}))
    assert text.count("Exchange") == 1
    assert text.index("Exchange") < text.index("partial_count") < text.index("Generate")


def test_scan_reads_only_what_the_facet_needs(spark, books, path):
    books.write.parquet(path)
    text = plan(facet(spark.read.parquet(path), "author.tongues", {"n": F.count("pages")}))
    assert "ReadSchema: struct<pages:int,author:struct<tongues:array<string>>>" in text


def test_filters_reach_promoted_columns_by_themselves(spark, books, path):
    write_table(books, path, promote=["notes.ed", "notes.`ed.1`", "author.born"])
    table = spark.read.parquet(path)
    for where in ("notes['ed'] = 'blue'", "notes.ed = 'blue'", "`notes`.`ed` = 'blue'"):
        found = facet(table, "marks", where=where)
        assert "EqualTo(__notes_ed,blue)" in plan(found)
        assert buckets(found) == buckets(facet(books, "marks", where=where))
    grouped = group_paths(table, "lent", where="notes['ed.1'] = 'blue' AND author.born < 0")
    assert "EqualTo(__notes_ed_1,blue)" in plan(grouped)
    assert "LessThan(__au" in plan(grouped)
    assert buckets(grouped) == {True: 1}
    literal = facet(table, "marks", where="title = 'notes.ed' OR notes.ed = 'it''s'")
    assert buckets(literal) == {}

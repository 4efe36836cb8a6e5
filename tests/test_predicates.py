from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from facetframe import contains_value, has_key, has_token, key_equals, token_filter, where, words
from facetframe import write_table
from facetframe.functions import paths as P
from tables import at, ids, isbns, plan

col = F.col


def by_loop(books, test):
    return sorted(r.isbn for r in books.collect() if test(r))


def test_compound_filter_on_nested_paths(books):
    found = books.filter(
        "(notes.`ed` = 'red' OR notes.`ed.1` = 'red') AND bought < '2021-01-01'"
        " AND NOT array_contains(marks, -1)"
    )
    assert isbns(found) == [900]


def test_array_membership_has_three_truth_values(edges):
    assert ids(edges.filter(contains_value("a", "3"))) == [1, 5]
    assert ids(edges.filter(~contains_value("a", "3"))) == [3]
    assert ids(edges.filter(contains_value("a", "3").isNull())) == [2, 4]


@pytest.mark.parametrize(
    "path, steps, value",
    [
        ("copies.hall", ["copies", "hall"], "s"),
        ("author.tongues", ["author", "tongues"], "en"),
        ("chapters.head", ["chapters", "head"], "I"),
        ("marks", ["marks"], 7),
    ],
)
def test_array_membership_at_every_depth(books, path, steps, value):
    expected = by_loop(books, lambda r: value in (at(r, *steps) or []))
    assert expected and isbns(books.filter(contains_value(path, value))) == expected


def test_map_keys_missing_null_and_present(edges):
    assert ids(edges.filter(key_equals("m", "color", "red"))) == [3, 5]
    assert ids(edges.filter(col("m.color").isNull())) == [1, 2, 4]
    assert ids(edges.filter(col("m.color").isNotNull())) == [3, 5]
    assert ids(edges.filter(has_key("m", "color"))) == [3, 4, 5]
    assert ids(edges.filter(~has_key("m", "color"))) == [1]


def test_map_key_from_a_column(spark):
    df = spark.createDataFrame(
        [(1, {"x": "y"}, "x"), (2, {"x": "y"}, "z")], "id int, m map<string,string>, k string"
    )
    assert ids(df.filter(col("m")[col("k")] == "y")) == [1]


def test_or_and_null_safe_equality_and_literals_filter(edges):
    assert ids(edges.filter(col("x").eqNullSafe(1.5) | (col("id") == 1))) == [1, 3]
    assert ids(edges.filter(col("x").eqNullSafe(None))) == [1, 5]
    assert ids(edges.filter(F.lit(False))) == []
    assert ids(edges.filter(F.lit(True))) == [1, 2, 3, 4, 5]


def test_not_drops_unknown(edges):
    assert ids(edges.filter(~(col("m.color") == "blue"))) == [3, 5]
    assert ids(edges.filter(~col("x").isin(1.5, 2.5))) == [2]


def test_ranges_on_nested_paths(books):
    assert isbns(books.filter(col("author.born") <= 1950)) == by_loop(
        books, lambda r: r.author and r.author.born is not None and r.author.born <= 1950
    )
    assert isbns(books.filter(col("notes.ed") < "red")) == [-5, 42]
    assert isbns(books.filter(col("title") > "crime")) == [6, 42, 900]


def test_boolean_order(books):
    assert isbns(books.filter(col("lent") < F.lit(True))) == [41, 42]
    assert isbns(books.filter(col("lent") > F.lit(True))) == []
    assert isbns(books.filter("lent")) == [-5, 900]


@pytest.mark.parametrize(
    "method, value",
    [("startswith", "10% of_"), ("endswith", "_nothing?"), ("contains", "% of_no")],
)
def test_wildcard_characters_are_literal(books, method, value):
    assert isbns(books.filter(getattr(col("title"), method)(value))) == [41]
    assert isbns(books.filter(getattr(col("title"), method)("1__ of"))) == []
    assert isbns(books.filter(col("title").contains("\\"))) == [6]


def test_integer_extremes(spark):
    df = spark.createDataFrame(
        [(1, 2**31 - 1, 2**63 - 1), (2, -(2**31), -(2**63))], "id int, i int, b bigint"
    )
    assert ids(df.filter(col("i") > 2**31 - 1)) == []
    assert ids(df.filter(col("b") > 2**63 - 1)) == []
    assert ids(df.filter(col("i") < -(2**31))) == []
    assert ids(df.filter(col("b") >= 2**63 - 1)) == [1]


def test_dates_and_timestamps(books):
    assert isbns(books.filter(col("bought") >= date(2020, 1, 1))) == [6, 41]
    assert isbns(books.filter(col("seen") < datetime(1970, 1, 1))) == [42]


def test_words_are_runs_of_letters_marks_and_digits(spark):
    texts = [
        (1, "The cat."), (2, "Lathe"), (3, "bathe THE-end"), (4, "éthe"), (5, None), (6, "the_"),
        (7, ""), (8, "thethe"), (9, "the7"), (10, "ÜBER uns"), (11, "example3, 3"), (12, "éa"),
    ]
    df = spark.createDataFrame(texts, "id int, text string")
    for token in ("the", "über", "example3", "3", "éa", "éthe"):
        split = F.array_contains(words("text"), token)
        assert ids(token_filter(df, "text", token)) == ids(df.filter(split)) != []
    assert ids(token_filter(df, "text", "the")) == [1, 3, 6]
    for bad in ["", "The", "a b", "a|b"]:
        with pytest.raises(ValueError):
            has_token("text", bad)


def test_path_steps_and_identity():
    assert P.steps("a.`b.c`.`d``e`") == ("a", "b.c", "d`e")
    assert P.identity("m.a.`b.c`") != P.identity("m.`a.b`.c")
    assert P.identity("`m`.k") == P.identity("m.`k`") == "`m`.`k`"
    for bad in ("", "a.", ".a", "a`b`"):
        with pytest.raises(ValueError):
            P.steps(bad)


def test_predicates_use_promoted_columns(spark, books, path):
    write_table(books, path, promote=["notes.ed", "copies.hall"])
    table = spark.read.parquet(path)
    equal = table.filter(key_equals("notes", "ed", "red", table))
    assert "EqualTo(__notes_ed,red)" in plan(equal) and isbns(equal) == [6]
    held = where(table, lambda t: contains_value("copies.hall", "s", t))
    assert "__copies_hall" in plan(held) and isbns(held) == [42, 900]
    assert isbns(where(table, "notes.ed = 'red'")) == isbns(where(table, col("notes.ed") == "red"))
    assert isbns(where(table, None)) == isbns(table)

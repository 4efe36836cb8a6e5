"""Words of bits against filters of the table, and substring lookups through pieces of terms."""

import random

import pytest
from pyspark.sql import functions as F

import facetframe as ff
from facetframe import bits as B
from tables import books as make_books
from tables import isbns, plan

PATHS = ["genres", "marks", "notes", "copies", "author.name", "author.tongues", "pages", "lent", "bought", "price", "score"]


@pytest.fixture(scope="module")
def words(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bits") / "words")
    B.write_bit_postings(make_books(spark), "isbn", PATHS, path)
    return B.read_bit_postings(spark, path)


CASES = {
    "array_contains(genres, 'crime')": B.term("genres", "crime"),
    "NOT array_contains(genres, 'crime')": ~B.term("genres", "crime"),
    "NOT array_contains(genres, 'sea')": ~B.term("genres", "sea"),
    "array_contains(marks, 7) AND NOT lent": B.term("marks", 7) & ~B.term("lent", True),
    "notes.ed = 'red' OR pages < 100": B.term("notes.ed", "red") | B.between("pages", None, 99),
    "NOT (notes.ed = 'red' OR array_contains(marks, 0))": ~(B.term("notes.ed", "red") | B.term("marks", 0)),
    "NOT (NOT array_contains(genres, 'art'))": ~~B.term("genres", "art"),
    "notes.`ed.1` IS NULL": ~B.present("notes.`ed.1`"),
    "genres IS NOT NULL AND author.name IS NULL": B.present("genres") & ~B.present("author.name"),
    "map_contains_key(notes, 'ed')": B.term("notes", "ed"),
    "NOT map_contains_key(notes, 'ed')": ~B.term("notes", "ed"),
    "price BETWEEN 9.5 AND 100": B.between("price", 9.5, 100),
    "NOT (pages >= 95)": ~B.between("pages", 95),
    "author.name LIKE 'A%' OR score = 0": B.prefix("author.name", "A") | B.term("score", 0),
    "array_contains(copies.hall, 's') OR array_contains(author.tongues, 'en')": B.term("copies.hall", "s")
    | B.term("author.tongues", "en"),
    "array_contains(genres, 'none')": B.term("genres", "none"),
}


@pytest.mark.parametrize("text", CASES)
def test_conditions_equal_filters(words, books, text):
    want = isbns(books.filter(text))
    assert isbns(B.rows_where(books, words, "isbn", CASES[text])) == want
    assert sorted(r.key for r in B.keys_where(words, CASES[text]).collect()) == want
    assert B.count_rows(words, CASES[text]).first()[0] == len(want)


@pytest.mark.parametrize("path", ["genres", "marks", "notes.ed", "notes", "pages", "lent", "bought", "price", "copies.hall"])
@pytest.mark.parametrize("text", [None, "array_contains(genres, 'sea')", "NOT lent"])
def test_facets_equal_deduplicated_facets(words, books, path, text):
    condition = {None: None, "NOT lent": ~B.term("lent", True)}.get(text, B.term("genres", "sea"))
    by = {"value": path} if path != "notes" else None
    rows = books if text is None else books.filter(text)
    if by is None:
        rows, by = rows.withColumn("keys", F.map_keys("notes")), {"value": "keys"}
    want = {r[0]: r[1] for r in ff.facet(rows, by, dedup=True).collect() if r[0] is not None}
    assert {r.value: r.n for r in B.facet_where(words, path, condition).collect()} == want


def test_keys_over_many_words_with_negative_ones(spark, path):
    rng = random.Random(3)
    keys = sorted(set(range(-70, 200)) | {rng.randint(-(2**62), 2**62) for _ in range(50)} | {2**63 - 1, -(2**63)})
    rows = [(k, [rng.choice("abc") for _ in range(rng.randint(0, 3))] if rng.random() < 0.9 else None) for k in keys]
    df = spark.createDataFrame(rows, "k long, t array<string>").repartition(3)
    B.write_bit_postings(df, "k", ["t"], path)
    words = B.read_bit_postings(spark, path)
    wanted = (B.term("t", "a") & ~B.term("t", "b")) | ~B.present("t")
    want = [k for k, t in rows if t is None or ("a" in t and "b" not in t)]
    assert sorted(r.key for r in B.keys_where(words, wanted).collect()) == sorted(want)
    assert B.count_rows(words, wanted).first()[0] == len(want)


def test_frequent_terms_take_a_row_per_64_keys(spark, path):
    df = spark.range(64_000).select("id", F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("t"))
    B.write_bit_postings(df, "id", ["t"], path)
    assert B.read_bit_postings(spark, path).filter("field = 't'").count() == 2000


@pytest.mark.parametrize("keys", [[1, 2, 2], [1, None]])
def test_keys_that_repeat_or_are_null_are_refused(spark, path, keys):
    df = spark.createDataFrame([(k, "x") for k in keys], "k long, t string")
    with pytest.raises(ValueError):
        B.write_bit_postings(df, "k", ["t"], path)


def test_other_keys_and_paths_are_refused(spark, books, words, path):
    with pytest.raises(TypeError):
        B.write_bit_postings(books, "title", ["genres"], path)
    with pytest.raises(ValueError):
        B.count_rows(words, B.term("title", "x"))
    with pytest.raises(TypeError):
        B.count_rows(words, B.prefix("pages", "1"))
    with pytest.raises(TypeError):
        B.Condition().true(words, None)


def test_counting_joins_nothing_and_pushes_terms(words):
    text = plan(B.count_rows(words, B.term("genres", "sea") & ~B.term("notes.ed", "red") & B.term("marks", 7)))
    assert "Join" not in text and text.count("FileScan") == 1
    assert "PartitionFilters: [" in text and "PushedFilters: [Or(" in text and "title" not in text


def test_empty_table_of_bits(books):
    words = B.bit_postings(books.limit(0), "isbn", ["genres"])
    assert B.count_rows(words, B.term("genres", "sea")).first()[0] == 0


# Pieces of terms


@pytest.fixture(scope="module")
def pieces(spark, tmp_path_factory):
    base = make_books(spark)
    terms = ff.postings(base, "isbn", ["title", "genres", "notes", "author.name", "pages"]).cache()
    counts = ff.term_counts(terms).cache()
    path = str(tmp_path_factory.mktemp("grams") / "grams")
    ff.write_grams(ff.term_grams(counts), path)
    return base, terms, counts, ff.read_grams(spark, path)


@pytest.mark.parametrize("text", ["crime", "rim", "sea", "海", "e", "", "%", "ng?", "_no", "\\p", "notthere", "ea a", "anand"])
def test_substrings_and_suffixes_equal_filters(books, pieces, text):
    base, *found = pieces
    has, ends = F.col("title").contains(text), F.col("title").endswith(text)
    assert isbns(ff.lookup_containing(base, *found, "isbn", "title", text)) == isbns(books.filter(has))
    assert isbns(ff.lookup_suffix(base, *found, "isbn", "title", text)) == isbns(books.filter(ends))
    has = F.exists("genres", lambda g: F.coalesce(g.contains(text), F.lit(False)))
    assert isbns(ff.lookup_containing(base, *found, "isbn", "genres", text)) == isbns(books.filter(has))


def test_map_keys_and_values_by_pieces(books, pieces):
    base, *found = pieces
    assert isbns(ff.lookup_suffix(base, *found, "isbn", "notes.ed", "lue")) == [-5, 42]
    assert isbns(ff.lookup_containing(base, *found, "isbn", "notes", "d.1")) == [-5, 900]
    with pytest.raises(TypeError):
        ff.lookup_suffix(base, *found, "isbn", "pages", "0")
    with pytest.raises(ValueError):
        ff.lookup_suffix(base, *found, "isbn", "score", "0")


def test_substring_lookups_read_no_text_of_the_table(spark, pieces, books, path):
    books.write.parquet(path)
    base, *found = pieces
    text = plan(ff.lookup_containing(spark.read.parquet(path).select("isbn"), *found, "isbn", "title", "and sea"))
    assert "ReadSchema: struct<isbn:bigint>" in text and "title:string" not in text


def test_words_are_made_from_one_scan_and_one_shuffle(spark, path):
    spark.range(500).selectExpr("id", "id % 3 AS a", "array(id % 5) AS t").write.parquet(path)
    words = B.bit_postings(spark.read.parquet(path), "id", ["a", "t"], 4)
    text = plan(words)
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
    assert words.filter("field = '_rows'").selectExpr("sum(n)").head()[0] == 500

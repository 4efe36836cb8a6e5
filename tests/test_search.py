from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import facetframe as ff
from tables import buckets, ids, isbns, plan

PATHS = [
    "title", "pages", "price", "weight", "score", "lent", "bought", "seen", "genres", "marks",
    "notes", "copies", "author.born", "author.tongues", "chapters.head",
]


@pytest.fixture(scope="module")
def stored(spark, books, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("postings"))
    books.write.parquet(root + "/base")
    base = spark.read.parquet(root + "/base")
    ff.write_postings(ff.postings(base, "isbn", PATHS), root + "/terms")
    return base, ff.read_postings(spark, root + "/terms")


@pytest.fixture(scope="module")
def edge_terms(edges):
    return ff.postings(edges, "id", ["a", "m", "x"])


@pytest.mark.parametrize(
    "path, value, condition",
    [
        ("genres", "crime", "array_contains(genres, 'crime')"),
        ("marks", 7, "array_contains(marks, 7)"),
        ("marks", 7.5, "array_contains(marks, 7.5D)"),
        ("notes.ed", "blue", "notes.ed = 'blue'"),
        ("notes.`ed.1`", "red", "notes.`ed.1` = 'red'"),
        ("notes.```q```", "x", "notes['`q`'] = 'x'"),
        ("notes", "ed", "map_contains_key(notes, 'ed')"),
        ("copies.hall", "s", "array_contains(copies.hall, 's')"),
        ("copies.`cellar.2`", "w", "array_contains(copies.`cellar.2`, 'w')"),
        ("copies", "attic", "map_contains_key(copies, 'attic')"),
        ("author.tongues", "en", "array_contains(author.tongues, 'en')"),
        ("chapters.head", "I", "array_contains(chapters.head, 'I')"),
        ("lent", True, "lent = true"),
        ("bought", date(2019, 12, 31), "bought = DATE '2019-12-31'"),
        ("bought", "2019-12-31", "bought = '2019-12-31'"),
        ("bought", datetime(2019, 12, 31, 12), "bought = TIMESTAMP '2019-12-31 12:00:00'"),
        ("seen", datetime(2024, 2, 29, 12), "seen = TIMESTAMP '2024-02-29 12:00:00'"),
        ("pages", 95, "pages = 95"),
        ("pages", 95.5, "pages = 95.5D"),
        ("price", Decimal("10.00"), "price = 10.00"),
        ("price", Decimal("9.999"), "price = 9.999"),
        ("weight", 2000.02, "weight = 2000.02D"),
        ("weight", -1.5, "weight = -1.5D"),
        ("score", 0.0, "score = 0D"),
        ("title", "海 and sea", "title = '海 and sea'"),
        ("title", "absent", "title = 'absent'"),
    ],
)
def test_lookup_equals_the_filter(stored, path, value, condition):
    base, terms = stored
    found = ff.lookup(base, terms, "isbn", path, value)
    assert found.columns == base.columns
    assert isbns(found) == isbns(base.filter(condition))
    assert ids(ff.lookup_keys(terms, path, value), "key") == isbns(base.filter(condition))
    negative = ff.lookup_not(base, terms, "isbn", path, value)
    assert isbns(negative) == isbns(base.filter(f"NOT ({condition})"))


def test_existence(stored):
    base, terms = stored
    for path in ["lent", "score", "genres", "notes", "notes.ed", "notes.`ed.1`", "copies.hall",
                 "author.tongues", "title", "price"]:
        here, gone = base.filter(F.col(path).isNotNull()), base.filter(F.col(path).isNull())
        assert isbns(ff.exists(base, terms, "isbn", path)) == isbns(here)
        assert isbns(ff.missing(base, terms, "isbn", path)) == isbns(gone)
        assert ids(ff.existing_keys(terms, path), "key") == isbns(here)


def test_null_elements_and_null_values(edges, edge_terms):
    assert ids(ff.lookup(edges, edge_terms, "id", "a", "3")) == [1, 5]
    assert ids(ff.lookup_not(edges, edge_terms, "id", "a", "3")) == [3]
    assert ids(ff.exists(edges, edge_terms, "id", "a")) == [1, 2, 3, 5]
    assert ids(ff.exists(edges, edge_terms, "id", "m.color")) == [3, 5]
    assert ids(ff.lookup(edges, edge_terms, "id", "m", "color")) == [3, 4, 5]
    marks = edge_terms.filter("field = '_has_null'").select("path", "key").collect()
    assert [tuple(r) for r in marks] == [("`a`", 2)]


def test_terms_of_one_row_are_distinct(stored, edge_terms):
    for terms in (edge_terms, stored[1]):
        assert terms.count() == terms.distinct().count()


def test_all_and_any(stored):
    base, terms = stored
    wanted = [("genres", "crime"), ("lent", False), ("author.born", 1950)]
    condition = ["array_contains(genres, 'crime')", "lent = false", "author.born = 1950"]
    counts = ff.term_counts(terms)
    for given in (None, counts):
        every = ff.lookup_all(base, terms, "isbn", wanted, counts=given)
        assert isbns(every) == isbns(base.filter(" AND ".join(condition))) == [42]
    either = ff.lookup_any(base, terms, "isbn", wanted)
    assert isbns(either) == isbns(base.filter(" OR ".join(condition)))
    assert isbns(ff.lookup_any(base, terms, "isbn", [("marks", 3), ("marks", 7)])) == [42, 900]


@pytest.mark.parametrize(
    "path, low, high, condition",
    [
        ("author.born", 1950, 1999, "author.born BETWEEN 1950 AND 1999"),
        ("author.born", -30.5, 1950.5, "author.born BETWEEN -30.5D AND 1950.5D"),
        ("pages", 9.5, 95.5, "pages BETWEEN 9.5D AND 95.5D"),
        ("price", 9, 10, "price BETWEEN 9 AND 10"),
        ("price", Decimal("9.501"), None, "price >= 9.501"),
        ("weight", None, 0.1, "weight <= 0.1D"),
        ("score", 0, 9, "score BETWEEN 0 AND 9"),
        ("bought", date(2019, 12, 31), date(2020, 1, 1), "bought BETWEEN '2019-12-31' AND '2020-01-01'"),
        ("bought", datetime(2019, 12, 31, 12), None, "bought >= TIMESTAMP '2019-12-31 12:00:00'"),
        ("seen", datetime(2020, 3, 1), None, "seen >= TIMESTAMP '2020-03-01 00:00:00'"),
        ("genres", "b", "d", "exists(genres, g -> g BETWEEN 'b' AND 'd')"),
        ("title", "a", "z", "title BETWEEN 'a' AND 'z'"),
        ("lent", None, None, "lent IS NOT NULL"),
    ],
)
def test_ranges_equal_the_filter(stored, path, low, high, condition):
    base, terms = stored
    assert isbns(ff.lookup_range(base, terms, "isbn", path, low, high)) == isbns(base.filter(condition))


def test_prefixes(stored):
    base, terms = stored
    assert isbns(ff.lookup_prefix(base, terms, "isbn", "notes.ed", "b")) == [-5, 42]
    assert isbns(ff.lookup_prefix(base, terms, "isbn", "notes", "ed.")) == [-5, 900]
    assert isbns(ff.lookup_prefix(base, terms, "isbn", "title", "")) == [-5, 6, 41, 42, 900]
    with pytest.raises(TypeError):
        ff.lookup_prefix(base, terms, "isbn", "pages", "1")


def test_paths_that_were_not_posted_are_refused(stored, edges, edge_terms):
    base, terms = stored
    for path in ("author.name", "nowhere", "genres.x"):
        for use in (ff.lookup_keys, ff.lookup_range, ff.existing_keys, ff.facet_from_postings):
            with pytest.raises(ValueError, match="not posted"):
                args = {ff.lookup_keys: (terms, path, 1), ff.lookup_range: (base, terms, "isbn", path)}
                use(*args.get(use, (terms, path)))
    with pytest.raises(ValueError, match="not recorded"):
        ff.lookup_keys(edge_terms.withMetadata("path", {}), "a", "1")


def test_keys_must_be_unique_and_not_null(spark):
    for rows in ([(1, ["x"]), (1, ["y"])], [(None, ["x"])]):
        df = spark.createDataFrame(rows, "id int, a array<string>")
        with pytest.raises(ValueError, match="unique"):
            ff.postings(df, "id", ["a"])


def test_paths_with_the_same_letters_stay_apart(spark):
    rows = [(1, {"a": {"b.c": "x"}}), (2, {"a.b": {"c": "x"}})]
    df = spark.createDataFrame(rows, "id int, m map<string,map<string,string>>")
    terms = ff.postings(df, "id", ["m"])
    assert ids(ff.lookup(df, terms, "id", "m.a.`b.c`", "x")) == [1]
    assert ids(ff.lookup(df, terms, "id", "m.`a.b`.c", "x")) == [2]
    both = spark.createDataFrame([(1, {"k": "x"}, None), (2, {}, "x")], "id int, a map<string,string>, `a.k` string")
    terms = ff.postings(both, "id", ["a", "`a.k`"])
    assert ids(ff.lookup(both, terms, "id", "a.k", "x")) == [1]
    assert ids(ff.lookup(both, terms, "id", "`a.k`", "x")) == [2]


def test_decimals_that_do_not_fit_are_refused(spark):
    df = spark.range(1).select("id", F.lit(1).cast("decimal(38,0)").alias("x"))
    with pytest.raises(TypeError):
        ff.postings(df, "id", ["x"])


def test_floating_terms_compare_as_numbers(spark):
    rows = [(1, 0.0), (2, -0.0), (3, float("nan")), (4, 9.0), (5, 10.0), (6, 1e300)]
    df = spark.createDataFrame(rows, "id int, x double")
    terms = ff.postings(df, "id", ["x"])
    assert ids(ff.lookup(df, terms, "id", "x", 0.0)) == [1, 2]
    assert ids(ff.lookup(df, terms, "id", "x", float("nan"))) == [3]
    assert ids(ff.lookup_range(df, terms, "id", "x", 9, 10)) == [4, 5]


def test_timestamps_without_zone_ignore_the_session_zone(spark):
    rows = [(1, "2024-03-02 09:30:00.000001"), (2, "1969-12-31 23:59:59.5"), (3, "2024-03-10 02:30:00")]
    df = spark.createDataFrame(rows, "id int, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    whole = {r.key: r.whole for r in ff.postings(df, "id", ["t"]).collect()}
    assert whole[2] == -500_000
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert {r.key: r.whole for r in ff.postings(df, "id", ["t"]).collect()} == whole
        terms = ff.postings(df, "id", ["t"])
        for text in ("2024-03-10 02:30:00", "2024-03-02 09:30:00.000001"):
            wanted = F.col("t") >= F.lit(text).cast("timestamp_ntz")
            found = ff.lookup_range(df, terms, "id", "t", datetime.fromisoformat(text))
            assert ids(found) == ids(df.filter(wanted)) or ids(found)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_keys_of_other_types(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id int, a string")
    for cast in ("double", "decimal(10,2)", "timestamp_ntz", "timestamp", "string", "date"):
        source = F.date_add(F.lit("2024-01-01").cast("date"), F.col("id"))
        key = source.cast(cast) if "ti" in cast or cast == "date" else F.col("id").cast(cast)
        keyed = df.withColumn("id", key)
        found = ff.lookup(keyed, ff.postings(keyed, "id", ["a"]), "id", "a", "y")
        assert [r.a for r in found.collect()] == ["y"]


def test_long_terms_are_exact(spark):
    df = spark.createDataFrame([(1, 2**62), (2, 2**62 + 1)], "id int, x bigint")
    terms = ff.postings(df, "id", ["x"])
    assert ids(ff.lookup(df, terms, "id", "x", 2**62)) == [1]
    assert ids(ff.lookup_range(df, terms, "id", "x", 2**62 + 1)) == [2]


@pytest.mark.parametrize(
    "path", ["genres", "marks", "copies.hall", "author.tongues", "notes.ed", "score", "price", "bought", "lent"]
)
def test_facet_from_postings_equals_deduplicated_facet(stored, path):
    base, terms = stored
    expected = buckets(ff.facet(base, path, dedup=True))
    expected.pop(None, None)
    for found in (ff.facet_from_postings(terms, path), ff.facet_from_counts(ff.term_counts(terms), path)):
        assert buckets(found) == expected
        if path not in ("genres", "marks", "copies.hall", "author.tongues"):
            assert found.schema["value"].dataType == base.select(path).schema[0].dataType


def test_postings_are_one_scan_and_lookups_start_no_job(spark, stored):
    base, _ = stored
    text = plan(ff.postings(base, "isbn", PATHS, key_is_checked=True))
    assert text.count("FileScan") == 1 and "Exchange" not in text
    sc = spark.sparkContext
    sc.setJobGroup("quiet", "")
    terms = stored[1]
    ff.lookup(base, terms, "isbn", "genres", "sea")
    ff.lookup_all(base, terms, "isbn", [("genres", "sea"), ("lent", False)])
    ff.lookup_range(base, terms, "isbn", "pages", 1, 2)
    assert list(sc.statusTracker().getJobIdsForGroup("quiet")) == []
    sc.setJobGroup("", "")


def test_lookup_prunes_the_postings(stored):
    text = plan(ff.lookup_keys(stored[1], "genres", "sea"))
    assert "(field#" in text and "= genres)" in text.split("PartitionFilters")[1]
    assert "EqualTo(path,`genres`)" in text and "EqualTo(value,sea)" in text
    assert "Exchange" not in text
    assert "GreaterThanOrEqual(whole,5)" in plan(
        ff.lookup_range(*stored, "isbn", "pages", 5).select("isbn")
    )


def test_writing_keeps_every_posting(stored):
    base, terms = stored
    again = ff.postings(base, "isbn", PATHS)
    assert again.exceptAll(terms.select(again.columns)).count() == 0
    assert again.count() == terms.count()


def test_frequent_term_is_split_over_files(spark, path):
    df = spark.range(40_000).select("id", F.array(F.lit("hot")).alias("a"))
    # Adaptive execution would merge partitions as small as these.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ff.write_postings(ff.postings(df, "id", ["a"]), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = spark.read.parquet(path).filter("field = 'a'").groupBy(F.input_file_name()).count()
    assert files.count() > 1


def test_appended_and_upserted_rows_are_found(spark, books, tmp_path):
    base, terms = str(tmp_path / "base"), str(tmp_path / "terms")
    books.filter("lent").write.parquet(base)
    ff.write_postings(ff.postings(spark.read.parquet(base), "isbn", ["genres", "notes"]), terms)
    ff.append_rows(books.filter("lent IS DISTINCT FROM true"), base, terms, "isbn")
    table, now = spark.read.parquet(base), ff.read_postings(spark, terms)
    assert isbns(ff.lookup(table, now, "isbn", "genres", "sea")) == [6, 42]
    assert isbns(ff.missing(table, now, "isbn", "genres")) == [17]
    with pytest.raises(ValueError, match="unique"):
        ff.append_rows(books.limit(1), base, terms, "isbn")
    updates = table.filter("isbn = 42").withColumn("genres", F.array(F.lit("new")))
    changed = ff.upsert(table, updates, "isbn")
    found = ff.upserted_postings(now, updates, "isbn")
    assert isbns(ff.lookup(changed, found, "isbn", "genres", "sea")) == [6]
    assert isbns(ff.lookup(changed, found, "isbn", "genres", "new")) == [42]
    assert isbns(ff.lookup(changed, found, "isbn", "notes.ed", "blue")) == [-5, 42]


def test_bucketed_tables_join_without_a_shuffle(spark, books, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ff.save_searchable(books, "books_saved", str(tmp_path), "isbn", ["genres", "notes"], 4)
        base, terms = spark.table("books_saved"), spark.table("books_saved_postings")
        found = ff.lookup(base, terms, "isbn", "genres", "art")
        assert isbns(found) == [-5, 6]
        assert "Exchange" not in plan(found)
        wanted = [("genres", "sea"), ("notes.ed", "red")]
        both = ff.lookup_all(base, terms, "isbn", wanted)
        assert isbns(both) == [6]
        assert "Exchange" not in plan(both)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS books_saved")
        spark.sql("DROP TABLE IF EXISTS books_saved_postings")


def test_structs_need_their_leaves_named(books):
    with pytest.raises(TypeError):
        ff.postings(books, "isbn", ["author"])

"""VARIANT columns, and tables whose schema grows."""

import json

import pytest
from pyspark.sql.types import DataType

import facetframe as ff
from facetframe.functions.paths import path_column, promoted_columns
from facetframe.sources.versions import widened
from tables import ids, plan

TEXTS = [
    (1, '{"k": 1, "s": {"a.b": "x", "deep": {"n": 1.5}}, "tags": ["p", "q", null]}'),
    (2, '{"k": null, "tags": [], "it\'s": true}'),
    (3, '{"k": "seven", "s": null, "extra": {}}'),
    (4, "not json"),
    (5, None),
    (6, "[1, 2]"),
    (7, '{"k": 7, "s": {"a.b": "y"}, "tags": ["q"]}'),
    (8, "null"),
]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("variants") / "t")
    ff.write_table(ff.with_variant(spark.createDataFrame(TEXTS, "id int, v string"), "v"), path)
    return ff.read_table(spark, path)


def at(text, *steps):
    try:
        value = json.loads(text) if text is not None else None
    except ValueError:
        return None
    for step in steps:
        value = value.get(step) if isinstance(value, dict) else None
    return value


@pytest.mark.parametrize("path", ["v.k", "v.s", "v.s.`a.b`", "v.s.deep.n", "v.tags", "v.`it's`", "v.none", "v.extra"])
def test_presence_by_path(docs, path):
    names = {"v.k": ["k"], "v.s": ["s"], "v.s.`a.b`": ["s", "a.b"], "v.s.deep.n": ["s", "deep", "n"], "v.tags": ["tags"],
             "v.`it's`": ["it's"], "v.none": ["none"], "v.extra": ["extra"]}[path]
    want = [i for i, t in TEXTS if at(t, *names) is not None]
    assert ids(docs.filter(ff.variant_present(path))) == want


def test_typed_values_are_null_where_the_kind_differs(docs):
    got = {r.id: (r.k, r.t) for r in docs.select("id", ff.variant_value("v.k", "int").alias("k"), ff.variant_value("v.tags", "array<string>").alias("t")).collect()}
    assert {i: k for i, (k, _) in got.items() if k is not None} == {1: 1, 7: 7}
    assert {i: t for i, (_, t) in got.items() if t is not None} == {1: ["p", "q", None], 2: [], 7: ["q"]}
    assert ids(docs.filter("v IS NULL")) == [4, 5]


def test_profile_counts_rows_by_leaf_path(docs):
    got = {r.path: (r.type, r.n_present) for r in ff.variant_profile(docs.filter("id <> 6"), "v").collect()}
    assert got == {
        "v": ("variant", 4), "v.k": ("variant", 3), "v.s.a.b": ("string", 2), "v.s.deep.n": ("decimal(2,1)", 1),
        "v.tags": ("string", 3), "v.it's": ("boolean", 1), "v.extra": ("struct<>", 1),
    }
    assert [tuple(r) for r in ff.variant_profile(docs.filter("id = 5"), "v").collect()] == [("v", "variant", 0)]
    assert [tuple(r) for r in ff.variant_profile(docs.limit(0), "v").collect()] == [("v", "variant", 0)]


def test_promoted_paths_of_variants_are_pushed(spark, docs, path):
    ff.write_table(ff.promote_variant(docs, {"v.k": "int", "v.s.`a.b`": "string"}), path)
    table = ff.read_table(spark, path)
    assert promoted_columns(table) == {"`v`.`k`": "__v_k", "`v`.`s`.`a.b`": "__v_s_a_b"}
    found = table.filter(path_column(table, "v.s.`a.b`") == "y")
    assert ids(found) == [7] and "EqualTo(__v_s_a_b,y)" in plan(found)


def test_facets_over_variant_arrays(docs):
    tags = docs.select(ff.variant_value("v.tags", "array<string>").alias("tag"))
    assert {r[0]: r[1] for r in ff.facet(tags, "tag").collect()} == {"p": 1, "q": 2, None: 7}


def test_keys_with_both_quotes_are_refused():
    with pytest.raises(ValueError):
        ff.variant_value("v.`a'\"b`")


@pytest.mark.parametrize(
    ("a", "b", "both"),
    [
        ("int", "bigint", "bigint"),
        ("tinyint", "smallint", "smallint"),
        ("double", "float", "double"),
        ("decimal(5,2)", "decimal(9,2)", "decimal(9,2)"),
        ("struct<a:int,b:string>", "struct<c:date,a:bigint>", "struct<a:bigint,b:string,c:date>"),
        ("array<struct<a:int>>", "array<struct<b:int>>", "array<struct<a:int,b:int>>"),
        ("map<string,int>", "map<string,bigint>", "map<string,bigint>"),
        ("void", "date", "date"),
        ("int", "string", None),
        ("bigint", "double", None),
        ("decimal(5,2)", "decimal(5,3)", None),
        ("map<string,int>", "map<int,int>", None),
    ],
)
def test_widened_types(a, b, both):
    a, b = DataType.fromDDL(a), DataType.fromDDL(b)
    if both is None:
        with pytest.raises(TypeError):
            widened(a, b)
    else:
        assert widened(a, b).simpleString() == both
        assert set(widened(b, a).simpleString()) == set(both)


def test_batches_with_new_columns_and_wider_types(spark, path):
    first = spark.createDataFrame([(1, 5, 1.5, {"k": "x"}, ("a",))], "id long, n int, f float, m map<string,string>, s struct<a:string>")
    ff.create_versioned(
        first, path, key="id", layout=ff.Layout(promote=("m.k",)), posted=["n", "m"], summaries=[ff.Summary("all", (), ("n", "f"))]
    )
    more = spark.createDataFrame(
        [(("z", 9), {"k": "y"}, 2.25, 2**40, 2, "new")],
        "s struct<b:string,c:int>, m map<string,string>, f double, n long, id long, extra string",
    )
    with pytest.raises(ValueError):
        ff.append_batch(more, path)
    old = ff.read_versioned(spark, path)
    ff.append_batch(more, path, evolve=True)
    ff.append_batch(spark.createDataFrame([(3, "only")], "id long, extra string"), path, evolve=True)
    ff.upsert_batch(spark.createDataFrame([(4, 7)], "id int, n int"), path, evolve=True)

    def check():
        now = ff.read_versioned(spark, path)
        got = {r.id: (r.n, r.f, r.m, r.s and tuple(r.s), r.extra) for r in now.collect()}
        assert got == {
            1: (5, 1.5, {"k": "x"}, ("a", None, None), None),
            2: (2**40, 2.25, {"k": "y"}, (None, "z", 9), "new"),
            3: (None, None, None, None, "only"),
            4: (7, None, None, None, None),
        }
        assert now.schema["n"].dataType.simpleString() == "bigint"
        terms = ff.versioned_postings(spark, path)
        assert ids(ff.lookup(now, terms, "id", "n", 2**40)) == [2]
        assert ids(ff.lookup_range(now, terms, "id", "n", 5, 7)) == [1, 4]
        assert ids(ff.where(now, "m.k = 'x'")) == [1]
        r = ff.read_summary(spark, path, "all").first()
        assert (r.n, r.n_n, r.min_n, r.max_n, r.sum_n, r.max_f) == (4, 3, 5, 2**40, 2**40 + 12, 2.25)

    check()
    assert [r.n for r in old.collect()] == [5] and "extra" not in old.columns
    ff.compact_batches(spark, path)
    check()
    with pytest.raises(TypeError):
        ff.append_batch(spark.createDataFrame([(9, "x")], "id long, n string"), path, evolve=True)
    assert ff.table_version(spark, path).number == 5

from facetframe import path_profile
from tables import at, buckets


def test_profile_agrees_with_a_loop(books):
    got = {r.path: (r.type, r.n_present) for r in path_profile(books).collect()}
    rows = books.collect()
    types = {"isbn": "bigint", "price": "decimal(8,2)", "seen": "timestamp", "lent": "boolean"}
    for name, kind in types.items():
        assert got[name] == (kind, sum(r[name] is not None for r in rows))

    def some(*steps):
        def present(value):
            return any(v is not None for v in value) if isinstance(value, list) else value is not None

        return sum(present(at(r, *steps)) for r in rows)

    assert got["author.born"] == ("int", some("author", "born"))
    assert got["author.tongues"][1] == sum(at(r, "author", "tongues") is not None for r in rows)
    assert got["chapters.head"] == ("string", some("chapters", "head"))
    assert got["chapters.sheets"] == ("int", some("chapters", "sheets"))
    keys = {k for r in rows for k in (r.notes or {})}
    for key in keys:
        assert got[f"notes.{key}"] == ("string", sum((r.notes or {}).get(key) is not None for r in rows))
    assert got["copies.hall"][1] == some("copies", "hall")
    assert "copies" in got and "author" not in got and len(got) == 18 + len(keys) + 3


def test_null_values_are_not_present(edges):
    got = {r.path: r.n_present for r in path_profile(edges).collect()}
    assert got == {"id": 5, "a": 4, "m": 4, "m.color": 2, "m.k": 1, "x": 3}


def test_maps_and_structs_inside_arrays(spark):
    schema = "id int, a array<struct<m:map<int,string>,s:struct<v:int>>>"
    rows = [
        (1, [({1: "x", 2: None}, (5,)), ({1: "y"}, None)]),
        (2, [(None, (None,)), ({3: "z"}, None)]),
        (3, []),
        (4, None),
    ]
    df = spark.createDataFrame(rows, schema)
    got = {r.path: r.n_present for r in path_profile(df).collect()}
    assert got == {"id": 4, "a.m": 2, "a.m.1": 1, "a.m.3": 1, "a.s.v": 1}


def test_same_counts_as_a_loop(edges):
    got = buckets(path_profile(edges).select("path", "n_present"))
    rows = edges.collect()
    assert got["a"] == sum(r.a is not None for r in rows)
    assert got["m.k"] == sum((r.m or {}).get("k") is not None for r in rows)

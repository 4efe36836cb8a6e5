"""Small nested tables made for the cases they cover, and helpers for tests."""

from collections import Counter
from datetime import date, datetime
from decimal import Decimal

BOOKS = (
    "isbn long, title string, pages int, price decimal(8,2), weight float, score double, "
    "lent boolean, bought date, seen timestamp, genres array<string>, marks array<int>, "
    "notes map<string,string>, copies map<string,array<string>>, "
    "author struct<name:string,born:int,tongues:array<string>>, "
    "chapters array<struct<head:string,sheets:int>>"
)


def books(spark):
    """Null, empty, missing and repeated at every depth; dotted and quoted keys; other scripts."""
    rows = [
        (900, "Ärger im Öl", 120, Decimal("9.50"), 0.1, -0.0, True, date(2019, 12, 31),
         datetime(2020, 2, 29, 23, 59, 59, 5), ["crime", "crime", None], [3, 3, 7],
         {"ed.1": "red", "ed": None}, {"hall": ["n", "s", "n"], "attic": []},
         ("Ute", 1950, []), [("I", None), (None, 4)]),
        (17, None, None, None, None, None, None, None, None, None, None, None, None, None, None),
        (41, "10% of_nothing?", 10, Decimal("10.00"), 2000.02, 0.0, False, date(2020, 1, 1),
         datetime(2020, 3, 1), [], [None], {}, {"hall": None}, ("Aki", None, None), []),
        (42, "海 and sea", 95, Decimal("100.00"), float("nan"), 1e300, False, date(2019, 12, 31),
         datetime(1969, 12, 31, 23, 59, 58), ["sea", "crime"], [7, -1],
         {"ed": "blue", "`q`": "x"}, {"hall": ["s"], "cellar.2": ["w", None]},
         (None, 1950, ["jp", "en", "jp"]), [("I", 2), ("I", 3), ("II", None)]),
        (-5, "", 2147483647, Decimal("-0.01"), -1.5, 2.5, True, date(1970, 1, 1),
         datetime(1970, 1, 1), ["art"], [], {"ed.1": "blue", "ed": "blue"}, {"hall": ["e"]},
         ("Bo", -30, ["en"]), None),
        (6, "crime\\pays", 0, Decimal("9.99"), 0.1, 9.0, None, date(2024, 2, 29),
         datetime(2024, 2, 29, 12), ["art", "sea", "art", "sea"], [0],
         {"": "", "ed": "red"}, {}, ("Aki", 2001, ["en", None]), [(None, None)]),
    ]
    return spark.createDataFrame(rows, BOOKS)


EDGES = "id int, a array<string>, m map<string,string>, x double"


def edges(spark):
    rows = [
        (1, ["1", "2", "3"], {}, None),
        (2, ["1", None], None, 1350.05),
        (3, [], {"color": "red"}, 1.5),
        (4, None, {"color": None, "k": "v"}, 2.5),
        (5, ["3", "3"], {"color": "red"}, None),
    ]
    return spark.createDataFrame(rows, EDGES)


def at(row, *steps):
    """A value of a collected row by its steps; fields of array elements give an array."""
    for step in steps:
        if row is None:
            return None
        if isinstance(row, list):
            row = [None if x is None else x[step] for x in row]
        elif isinstance(row, dict):
            row = row.get(step)
        else:
            row = row[step]
    return row


def counted(rows, *steps, once=False):
    """Facet counts by a loop."""
    found = Counter()
    for row in rows:
        values = at(row, *steps) or [None]
        found.update(set(values) if once else values)
    return dict(found)


def ids(df, column="id"):
    return sorted(r[0] for r in df.select(column).collect())


def isbns(df):
    return ids(df, "isbn")


def buckets(df):
    return {tuple(r)[0] if len(r) == 2 else tuple(r)[:-1]: r[-1] for r in df.collect()}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()

"""WARC archives and their index."""

import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from facetframe.llm import warc

PAGES = "page_id long, url string, time string, html string, range int, bytes int"


def pages_frame(spark, rows):
    return spark.createDataFrame([(i, u, f"2024-01-0{1 + (i or 0) % 7}T00:00:00Z", h, 1, 2) for i, u, h in rows], PAGES)


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_base32_of_sha1(spark):
    texts = ["", "a", "é海😀", "x" * 1000]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r[0]: r[1] for r in df.select("t", warc.sha1_base32(F.col("t").cast("binary"))).collect()}
    assert got == {t: digest(t) for t in texts}


@pytest.mark.parametrize("least", [0, 5])
def test_records_come_back_and_revisits_refer_to_the_largest_id(spark, least, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 7)
    rng = random.Random(least)
    bodies = ["", "abc", "WARC/1.1\r\nContent-Length: 9\r\n\r\n", "é海\r\n\r\n", "x" * 20_000, None]
    rows = [(i, f"http://www.h{i % 5}.Example.com/p?{i % 3}#f", rng.choice(bodies)) for i in range(120)]
    rows += [(500, None, "own"), (501, "http://a/\r\nX: y", "own2"), (None, "http://n/", "own3"), (-4, "bad[url", "")]
    got = warc.archive_and_index(pages_frame(spark, rows).repartition(3), least).collect()
    assert len(got) == len(rows)
    largest = {}
    for i, _, html in rows:
        if i is not None:
            largest[html or ""] = max(largest.get(html or "", i), i)
    for r in got:
        html = next(h for i, _, h in rows if i == r.page_id)
        raw = (html or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(raw), digest(html))
        top = largest.get(html or "")
        other = len(raw) >= least and r.page_id is not None and top != r.page_id
        assert (r.record_type, r.refers_to) == (("revisit", top) if other else ("response", None))
    order = sorted(got, key=lambda r: (r.range, r.rank))
    keys = [(r.urlkey, r.time, r.page_id is not None, r.page_id or 0) for r in order]
    assert keys == sorted(keys)


def test_url_keys():
    assert warc.url_key("HTTPS://www.Shop.example.COM:443/A?b=1#x") == "com,example,shop)/a?b=1"
    assert warc.url_key("http://example.com:8080") == "com,example:8080)/"
    assert warc.url_key("http://[bad") == "http://[bad"


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 16, 31])
def test_loser_tree_merges_runs(k):
    rng = random.Random(k)

    def capture(run):
        return (rng.choice("abc"), str(rng.randint(0, 5)), rng.choice([None, 1, 2]), "response", 1, "d", None, f"f{run}", rng.randint(0, 9), 1)

    runs = [sorted((capture(r) for r in range(rng.randint(0, 12))), key=warc._order) for r in range(k)]
    merged = list(warc.LoserTree(runs))
    assert merged == sorted((c for run in runs for c in run), key=warc._order)


def test_hot_url_is_cut_into_ranges_and_no_pages_give_no_captures(spark):
    rows = [(i, "http://one/", str(i)) for i in range(400)]
    got = warc.archive_and_index(pages_frame(spark, rows)).collect()
    assert len({r.range for r in got}) > 2
    assert [r.page_id % 7 for r in sorted(got, key=lambda r: (r.range, r.rank))] == sorted(i % 7 for i in range(400))
    assert warc.archive_and_index(pages_frame(spark, [])).count() == 0


def test_damaged_archives_are_refused():
    with pytest.raises(ValueError):
        warc.parse_records(b"no record\r\n\r\n", "f")

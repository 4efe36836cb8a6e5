"""Near duplicates, components, and the pipeline."""

import random
from importlib.util import find_spec

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from documents import docs_frame, sentence
from facetframe.llm import graph, minhash
from facetframe.llm.queries import RUNS, SQL
from facetframe.sources.scratch import stored


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def closed(n, links):
    root = list(range(n))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    return [top(i) for i in range(n)]


def test_sets_are_those_of_the_words():
    rng = random.Random(1)
    texts = ["", " ", "a", "A  b\tc", "é É 海 x", *(sentence(rng, n, "ab") for n in range(1, 40))]
    for text, found in zip(texts, minhash.shingle_sets([t.encode() for t in texts])):
        assert len(found) == len(shingles(text)), text
        assert (np.diff(found.astype(object)) > 0).all()


def test_minimum_and_maximum_agree_as_often_as_sets_overlap():
    rng = np.random.default_rng(1)
    universe = rng.integers(0, 1 << 62, 4000).astype(np.uint64)
    a, b = np.unique(universe[:3000]), np.unique(universe[500:3500])
    agree = (minhash.signatures([a])[0] == minhash.signatures([b])[0]).mean()
    assert abs(agree - 2500 / 3500) < 0.2


@pytest.mark.parametrize("block", [2048, 6])
def test_components_against_all_pairs(spark, odd_rows, block, monkeypatch):
    monkeypatch.setattr(minhash, "BUCKET_BLOCK", block)
    monkeypatch.setattr(minhash, "FAMILY_BLOCK", block * 100)
    rng = random.Random(3)
    texts = [t for i, t in odd_rows if i in range(1, 11) or i in (13, 14)]
    for _ in range(12):
        words = sentence(rng, 120).split()
        for _ in range(rng.randint(1, 14)):
            copy = list(words)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = sentence(rng, 1)
            texts.append(rng.choice([" ", "\n"]).join(copy).upper() if rng.random() < 0.3 else " ".join(copy))
    sets = [shingles(t) for t in texts]
    links = [
        (i, j)
        for i, a in enumerate(sets)
        for j, b in enumerate(sets[:i])
        if a and b and 100 * len(a & b) >= 85 * len(a | b)
    ]
    assert len(links) > 20
    got = {r.doc_id: r for r in minhash.near_duplicates(docs_frame(spark, list(enumerate(texts)))).collect()}
    assert [got[i].n_shingles for i in range(len(texts))] == list(map(len, sets))
    assert [got[i].component_id for i in range(len(texts))] == closed(len(texts), links)
    assert all(r.kept == (r.component_id == r.doc_id) for r in got.values())


def test_bands_and_bound_follow_from_the_percent():
    assert (minhash.band_width(85), minhash.least_agreeing(85)) == (4, 42)
    assert minhash.band_width(80) == 3 and minhash.least_agreeing(80) < 42
    rng = np.random.default_rng(4)
    for percent in (85, 80, 75, 70, 50):
        width, least = minhash.band_width(percent), minhash.least_agreeing(percent)
        same = rng.random((200_000, minhash.VALUES)) < percent / 100
        bands = same[:, : minhash.VALUES // width * width].reshape(len(same), -1, width)
        assert (~bands.all(axis=2).any(axis=1) | (same.sum(axis=1) < least)).mean() < 1e-4
    with pytest.raises(ValueError):
        minhash.band_width(10)


def test_pipeline_drops_documents_at_eighty_percent(spark, tmp_path):
    rng = random.Random(8)
    rows, gone = [], set()
    for k in range(60):
        words = sentence(rng, 104).split()
        # Ten other words at the end leave 90 of 110 shingles shared.
        for n, tail in enumerate((0, 10)):
            copy = [*words[: 104 - tail], *sentence(rng, tail).split()]
            rows.append((10 * k + n, " ".join(copy)))
        gone.add(10 * k + 1)
    sets = {i: shingles(t) for i, t in rows}
    shares = [len(sets[10 * k] & sets[10 * k + 1]) / len(sets[10 * k] | sets[10 * k + 1]) for k in range(60)]
    assert 0.80 < min(shares) and max(shares) < 0.85
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs_frame(spark, rows), str(tmp_path)).collect()}
    assert kept == {i for i, _ in rows} - gone


def test_short_templated_texts_are_verified_in_bounded_memory(spark, monkeypatch):
    import tracemalloc

    texts = [f"w{i} " + " ".join(f"t{k}" for k in range(11)) for i in range(1500)]
    sets = minhash.shingle_sets([t.encode() for t in texts])
    codes = np.zeros((len(sets), minhash.VALUES), np.uint8)
    tracemalloc.start()
    found = minhash.confirmed_forest(np.arange(1500), codes, sets, np.zeros(1500), 85)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == ([], []) and most < 8_000_000
    rows_of = []
    monkeypatch.setattr(minhash, "FAMILY_DOCUMENTS", 20)
    blocks = minhash._in_block_pairs
    monkeypatch.setattr(minhash, "_in_block_pairs", lambda rows: rows_of.append(rows) or blocks(rows))
    near = [(i, f"{texts[0]} " + " ".join(f"u{k}" for k in range(60)) + f" x{i}") for i in range(100)]
    got = minhash.near_duplicates(docs_frame(spark, near)).collect()
    assert {r.component_id for r in got} == {0}
    assert {r.blocks for r in rows_of[1].select("blocks").distinct().collect()} == {5}


def test_odd_and_no_documents(odd, nothing, odd_rows):
    assert minhash.near_duplicates(odd).count() == len(odd_rows)
    assert minhash.near_duplicates(nothing).count() == 0


def test_components_of_chains_stars_and_rings(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200 + i, 200 + (i + 1) % 30) for i in range(30)]
    links += [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(60)] + [(7, 7), (500, 500)]
    rng.shuffle(links)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long"), "test_links").collect()}
    expected = closed(501, links)
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got == {n: expected[n] for n in nodes}
    assert graph.components(spark.createDataFrame([], "a long, b long"), "test_links").count() == 0


def test_pipeline_keeps_clean_documents_and_removes_the_rest(spark, tmp_path, odd_rows):
    rng = random.Random(5)
    passage = sentence(rng, 30)
    words = sentence(rng, 200).split()
    near = [*words[:100], "changed", *words[101:]]
    body = {i: "\n".join(sentence(rng, 25) for _ in range(4)) for i in range(100, 130)}
    planted = {200: " ".join(words), 201: " ".join(near), 202: body[100], 203: sentence(rng, 40) + " " + passage, 204: "12 %% 99",
               205: "\n".join([body[101].split("\n")[0], sentence(rng, 30)])}
    docs = docs_frame(spark, [(i, t, "en" if i is None or i % 2 else "fr") for i, t in [*odd_rows, *body.items(), *planted.items()]])
    spark.createDataFrame([(1, passage.upper())], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stored(stage(spark, docs, str(tmp_path)), f"test_{name}")
        if name != "packing":
            assert docs.columns == before.columns
            kept[name] = {r.doc_id: r.text for r in docs.collect()}
    assert {1, 2, 3, 10, 204}.isdisjoint(kept["language"]) and set(body) < set(kept["language"])
    assert 202 not in kept["lines"] and kept["lines"][205] == planted[205].split("\n")[1]
    assert 201 not in kept["near_duplicates"] and kept["near_duplicates"][200] == planted[200]
    assert 203 in kept["near_duplicates"] and 203 not in kept["decontamination"]
    assert {i: kept["decontamination"].get(i) for i in body} == body
    assert {r.doc_id for r in docs.collect()} == set(kept["decontamination"])


def test_pipeline_of_no_documents(spark, tmp_path):
    docs_frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_queries_are_registered_and_agree_with_their_sql(spark):
    from check import connect, spark_result, sql_result

    assert find_spec("facetframe.llm") and set(RUNS) <= set(entry.queries())
    assert {int(n[2:].split("_")[0]) for n in RUNS if n != "pipeline"} == set(range(1, 14))
    sf = "/root/testdata/sf0.001"
    for name, sql in SQL.items():
        assert spark_result(RUNS[name](spark, sf)) == sql_result(connect(sf), sql)


@pytest.mark.parametrize("words", [60, 5_000])
def test_codes_of_unrelated_texts_agree_in_few_values(spark, words):
    rng = random.Random(words)
    rows = [(i, sentence(rng, words, "abcdefghijklmnop")) for i in range(12)]
    signed = minhash.document_signatures(docs_frame(spark, rows)).collect()
    codes = [np.frombuffer(bytes(r.code), np.uint8) for r in signed]
    agree = [int((a == b).sum()) for i, a in enumerate(codes) for b in codes[i + 1 :]]
    assert max(agree) <= 6 < minhash.least_agreeing(80)


def test_long_linked_texts_are_found_through_their_codes(spark):
    rng = random.Random(77)
    rows = []
    for k in range(6):
        text = sentence(rng, 3_000, "abcdefghijklmnop").split()
        other = list(text)
        for at in rng.sample(range(3_000), 40):
            other[at] = "changed"
        rows += [(10 * k, " ".join(text)), (10 * k + 1, " ".join(other))]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs_frame(spark, rows), percent=85).collect()}
    sets = {d: set(minhash.shingle_sets([t.encode()])[0].tolist()) for d, t in rows}
    for k in range(6):
        a, b = sets[10 * k], sets[10 * k + 1]
        linked = 100 * len(a & b) >= 85 * len(a | b)
        assert got[10 * k + 1] == (10 * k if linked else 10 * k + 1)
    assert any(got[10 * k + 1] == 10 * k for k in range(6))

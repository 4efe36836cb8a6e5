"""Language identification, scoring and nearest neighbours."""

import random
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest
from pyspark.sql import functions as F

from documents import docs_frame, sentence
from facetframe.llm import ann, langid, lm


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(3)
    model = {k: v.astype(np.float64) for k, v in langid.new_model(3, 4, 1).items()}
    both = rng.integers(0, 5, (2, 6, 7)).astype(np.uint8)
    both[1] = both[0, ::-1]
    wanted, weight = rng.integers(0, 3, 7), np.ones(7)

    def loss(m):
        states = langid.run_states({k: v.astype(np.float32) for k, v in m.items()}, both)
        p = langid.position_probabilities(m, states, np.full(7, 6))
        return -np.log(p[:, wanted, np.arange(7)]).mean()

    grad = langid.gradients({k: v.astype(np.float32) for k, v in model.items()}, both, wanted, weight.astype(np.float32))
    for name in model:
        for at in [tuple(rng.integers(0, n) for n in model[name].shape) for _ in range(6)]:
            if name == "byte":
                at = (*at[:2], int(both[at[0], 2, 3]))
            ends = []
            for step in (1e-2, -1e-2):
                moved = {k: v.copy() for k, v in model.items()}
                moved[name][at] += step
                ends.append(loss(moved))
            assert abs((ends[0] - ends[1]) / 2e-2 - grad[name][at]) < 2e-3, (name, at)


def test_windows_cover_every_position_once():
    model = langid.train(np.full((8, langid.WINDOW), 97, np.uint8), np.arange(8) % 2, 2, steps=2)
    rng = random.Random(1)
    texts = [sentence(rng, n).encode()[:size] for n, size in ((1, 3), (40, 63), (40, 64), (40, 65), (80, 200), (900, 4000))]
    together = langid.pooled(model, texts)
    assert np.allclose(together.sum(axis=1), 1, atol=1e-4)
    for text, row in zip(texts, together):
        assert np.allclose(langid.pooled(model, [text])[0], row, atol=1e-6)


def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs = docs.withColumn("held", langid.held_out(F.col("doc_id")))
    found = langid.predict_languages(docs.filter("held"), docs.filter("NOT held"))
    right, n = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right > 0.97 and n > 250


def test_language_of_odd_rows(spark, odd, nothing, odd_rows):
    learn = docs_frame(spark, [(i, "das und der die " * 9, "de") for i in range(20)] + [(50 + i, "the and of to " * 9, "en") for i in range(20)] + [(90, None, "fr"), (91, "x", None)])
    extra = odd.withColumn("score", F.lit("old"))
    got = langid.predict_languages(extra, learn, per_language=30)
    assert got.count() == len(odd_rows) and set(got.columns) == {*odd.columns, "lang_pred", "score"}
    rows = {r.doc_id: r for r in got.collect()}
    for doc in (1, 2, 3, 10):
        assert (rows[doc].lang_pred, rows[doc].score) == ("und", 0.0)
    assert rows[9].lang_pred in ("de", "en") and rows[7].score == rows[8].score
    untrained = langid.predict_languages(odd, nothing).select("lang_pred").distinct().collect()
    assert [r[0] for r in untrained] == ["und"]
    assert langid.predict_languages(nothing, learn).count() == 0


@pytest.mark.parametrize("known", [0, 40, 200_000])
def test_scores_against_a_loop(spark, odd_rows, known, monkeypatch):
    monkeypatch.setattr(lm, "KNOWN_WORDS", known)
    monkeypatch.setattr(lm, "SHORTLIST", 20)
    rng = random.Random(6)
    rows = [*odd_rows, *((500 + i, sentence(rng, rng.randint(1, 60), "abc")) for i in range(60)), (999, "unseen Ünseen words")]
    docs = docs_frame(spark, rows).withColumn("held_out", lm.held_out(F.col("doc_id")))
    got = {}
    for r in lm.score_texts(docs, docs.filter("NOT held_out")).collect():
        got.setdefault(str(r.doc_id), []).append(r)
    counts = Counter()
    for doc, text in rows:
        if doc is not None and zlib.crc32(str(doc).encode()) % 10:
            counts.update(lm.tokens(text))
    n, v = sum(counts.values()), len(counts)
    for doc, text in rows:
        words = lm.tokens(text)
        base = sum(log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        expected = (len(words), sum(counts[w] > 0 for w in words), n, round(base, 6))
        assert expected in [(r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got[str(doc)]]
    assert sum(map(len, got.values())) == len(rows)
    assert all(r.score < 0 and np.isfinite(r.score) for rs in got.values() for r in rs)


def test_probabilities_add_up_and_learn_the_pairs():
    pairs = np.full((6, 6), 1.0)
    pairs[np.arange(6), (np.arange(6) + 1) % 6] = 1000
    table = lm.log10_probabilities(lm.train(pairs))
    assert np.allclose((10.0**table).sum(axis=1), 1)
    assert (table.argmax(axis=1) == (np.arange(6) + 1) % 6).all()
    assert (10.0 ** table.max(axis=1) > 0.9).all()


def test_scores_of_nothing_and_from_nothing(spark, odd, nothing, odd_rows):
    held = odd.withColumn("held_out", F.lit(True))
    assert lm.score_texts(held, nothing).count() == len(odd_rows)
    assert lm.score_texts(nothing.withColumn("held_out", F.lit(True)), odd).count() == 0


def vectors_frame(spark, rows):
    return spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, length int")


def exact(rows, query, vector, k):
    found = {}
    for i, v in rows:
        if i != query and v is not None and len(v) == len(vector):
            if all(x is not None and np.isfinite(x) for x in v) and any(v):
                gap = np.float32(v).astype(float) - np.float32(vector).astype(float)
                found[i] = min(found.get(i, np.inf), float(np.sqrt((gap * gap).sum())))
    return sorted((d, i) for i, d in found.items())[:k]


def test_neighbours_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ann, "VECTOR_BLOCK", 300)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((20, 24))
    rows = [(i, (centres[i % 20] + 0.3 * rng.standard_normal(24)).tolist()) for i in range(1500)]
    rows += [(2000 + i, rows[40][1]) for i in range(400)]
    frame = vectors_frame(spark, rows)
    got = ann.nearest_neighbours(frame, frame.filter("vec_id % 50 = 0"), 10).collect()
    hit = wanted = 0
    for query in {r.query_id for r in got}:
        mine = sorted((r["rank"], r.score, r.vec_id) for r in got if r.query_id == query)
        assert [m[0] for m in mine] == list(range(1, 11)) and [m[1:] for m in mine] == sorted(m[1:] for m in mine)
        best = exact(rows, query, dict(rows)[query], 10)
        hit += len({m[2] for m in mine} & {i for _, i in best})
        wanted += 10
        real = dict((i, d) for d, i in exact(rows, query, dict(rows)[query], len(rows)))
        assert all(abs(real[m[2]] - m[1]) < 1e-12 for m in mine)
    assert len({r.query_id for r in got}) == 30 + 8 and hit / wanted > 0.95


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.5]), (1, [1.0, 0.25]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0, 0.0, 0.0]), (9, [1.0, 0.0]), (0, [5.0, 5.0]), (10, [1.0, -0.25]), (None, [1.0, 0.0])]
    frame = vectors_frame(spark, rows)
    got = ann.nearest_neighbours(frame, frame.filter("vec_id IN (0, 2, 4, 5) OR vec_id IS NULL"), 5).orderBy("rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 9, 0.0), (0, 2, 1, 0.25), (0, 3, 10, 0.25)]
    assert ann.nearest_neighbours(frame.limit(0), frame, 5).count() == 0

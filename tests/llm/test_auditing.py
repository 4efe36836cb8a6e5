"""Weak supervision, filter audit and spelling groups against brute force."""

import math
import random
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from documents import docs_frame, sentence
from facetframe.llm import audit, rules, spelling
from tables import plan

SPACE = "[ \t-\r]+"


def split_words(text):
    return [w for w in re.split(SPACE, text or "") if w]


def base(text):
    text = text or ""
    words = split_words(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if split_words(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


def texts_with_repeats(rng):
    for n in (0, 1, 7, 8, 9, 15, 16, 17, 40, 200):
        yield " ".join(["again"] * n)
        yield "  " + sentence(rng, n) + "\x0b\f "
    part = sentence(rng, 11)
    yield f"{part} {sentence(rng, 3)} {part}\n{part}\n \n \n{part}"
    yield f"{sentence(rng, 9, 'ab')} " * 3 + "# $$ é|海 <>"
    yield " ".join(rng.choice("ab") for _ in range(300))
    yield "one line\r\none line\r\n\n\x1c   one line\r"
    yield sentence(rng, 20_000) + " " + part + " " + part


def test_rule_counts_against_a_loop(spark, odd_rows):
    rng = random.Random(11)
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(texts_with_repeats(rng))]
    got = rules.quality_verdicts(docs_frame(spark, rows)).collect()
    found = Counter((r.doc_id, *(r[c] for c in rules.COUNTS), r.base_failed) for r in got)
    want = Counter()
    for doc, text, *_ in rows:
        n = base(text)
        want[(doc, *n, n[0] < 20 or 100 * n[4] > 30 * n[0])] += 1
    assert found == want
    assert all(not (r.kept and r.base_failed) and 0 <= r.quality <= 1 for r in got)


def fitted(patterns, n_rules, rounds):
    """The estimation as a plain loop."""
    good, bad, share = [0.99] * n_rules, [0.4] * n_rules, 0.85
    total = sum(patterns.values())
    for _ in range(rounds):
        q = {}
        for v in patterns:
            x = math.log(share / (1 - share))
            for j, vote in enumerate(v):
                if vote is not None:
                    x += math.log(good[j] / (1 - bad[j])) if vote else math.log((1 - good[j]) / bad[j])
            q[v] = 1 / (1 + math.exp(-x))
        g = sum(n * q[v] for v, n in patterns.items())
        for j in range(n_rules):
            of = [(v[j], n * q[v], n * (1 - q[v])) for v, n in patterns.items() if v[j] is not None]
            w = 0.1 * total * 0.85 + 1
            good[j] = (0.99 * w + sum(x for vote, x, _ in of if vote)) / (w + sum(x for _, x, _ in of))
            w = 0.1 * total * 0.15 + 1
            bad[j] = (0.4 * w + sum(y for vote, _, y in of if not vote)) / (w + sum(y for *_, y in of))
        w = 0.1 * total + 1
        share = (0.85 * w + g) / (w + total)
    return share, good, bad


def planted_votes(rng, n):
    """Votes of five rules; returns the votes and which documents are good."""
    right_good, right_bad = [0.99, 0.97, 0.98, 0.95, 0.9], [0.6, 0.7, 0.5, 0.8, 0.4]
    for _ in range(n):
        is_good = rng.random() < 0.8
        votes = []
        for a, b in zip(right_good, right_bad, strict=True):
            right = rng.random() < (a if is_good else b)
            votes.append(None if rng.random() < 0.1 else int(right == is_good))
        yield tuple(votes), is_good


def test_estimation_against_a_loop_and_the_truth(spark):
    drawn = list(planted_votes(random.Random(5), 6000))
    frame = spark.createDataFrame([(list(v),) for v, _ in drawn], "votes array<int>")
    model = rules.fit_rules(frame, 5, rounds=25)
    share, good, bad = fitted(Counter(v for v, _ in drawn), 5, 25)
    assert model.good_share == pytest.approx(share)
    assert model.right_on_good == pytest.approx(good)
    assert model.right_on_bad == pytest.approx(bad)
    assert np.abs(np.array(model.right_on_good) - [0.99, 0.97, 0.98, 0.95, 0.9]).max() < 0.04
    assert np.abs(np.array(model.right_on_bad) - [0.6, 0.7, 0.5, 0.8, 0.4]).max() < 0.1
    judged = frame.select("votes", model.quality(F.col("votes")).alias("q")).collect()
    truth = dict(zip(range(len(drawn)), (g for _, g in drawn), strict=True))
    by_votes = {tuple(r.votes): r.q for r in judged}
    right = sum((by_votes[v] >= 0.5) == truth[i] for i, (v, _) in enumerate(drawn))
    assert right / len(drawn) > 0.93


def test_bad_documents_go_and_clean_ones_stay_though_no_label_is_seen(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = rules.quality_verdicts(documents).join(labels.withColumnRenamed("quality", "label"), "doc_id")
    rows = found.filter("NOT base_failed").groupBy("label", "kept").count().collect()
    n = {(r.label, r.kept): r["count"] for r in rows}
    assert n.get((0, False), 0) / (n.get((0, False), 0) + n.get((0, True), 0)) > 0.9
    assert n[1, True] / (n[1, True] + n.get((1, False), 0)) > 0.97


def test_no_documents_give_the_belief_and_no_rows(spark, nothing):
    assert rules.quality_verdicts(nothing).count() == 0
    model = rules.fit_rules(spark.createDataFrame([], "votes array<int>"), 3, rounds=3)
    assert model.good_share == pytest.approx(0.85)
    assert model.right_on_good == pytest.approx([0.99] * 3)


def test_kept_rows_have_the_columns_of_the_input(spark, odd):
    clash = odd.withColumn("votes", F.lit("v")).withColumn("n words", F.lit(1))
    kept = rules.without_low_quality(clash)
    assert kept.columns == clash.columns
    verdicts = rules.quality_verdicts(clash)
    assert kept.count() == verdicts.filter("kept").count() > 0


def test_weak_supervision_runs_no_python(spark, odd):
    text = plan(rules.quality_verdicts(odd)) + plan(rules.judge(odd))
    for node in ("Python", "Pandas", "InArrow"):
        assert node not in text


LABELS = "doc_id long, quality int, toxic int, part string"


def failed_filters(text, is_copy):
    words = split_words(text)
    capitals = sum("A" <= c <= "Z" for c in text)
    fails = {
        "A": len(words) < 50,
        "B": 100 * len(set(words)) < 65 * len(words),
        "C": 100 * capitals > 5 * len(text),
        "D": any(c in "#$%&*|" for c in text),
        "E": is_copy,
    }
    return {f for f, failed in fails.items() if failed}


def audited(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    docs = []
    for doc, text, source in rows:
        text = text or ""
        smaller = [d for d, t, _ in rows if (t or "") == text and d is not None and doc is not None and d < doc]
        docs.append((source or "", failed_filters(text, bool(smaller)), doc in good, doc in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        mine, shapley = [d for d in docs if d[0] == part], Counter()
        for order in map("".join, permutations("ABCDE")):
            left = list(range(len(mine)))
            for step, f in enumerate(order, 1):
                gone = [i for i in left if f in mine[i][1]]
                before = [i for i in range(len(mine)) if i not in left and f in mine[i][1]]
                left = [i for i in left if i not in gone]
                shapley[f] += len(gone)
                alone = sum(d[1] == {f} for d in mine)
                out[part, order, step] = [len(left), len(gone), len(before), alone,
                                          sum(mine[i][2] for i in gone), sum(mine[i][3] for i in gone)]
        for (p, order, step), counts in out.items():
            if p == part:
                counts.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def test_audit_against_removing_one_by_one(spark, odd_rows):
    rng = random.Random(12)
    pool = [sentence(rng, n) for n in (10, 60, 60, 200)] + [sentence(rng, 70).upper(), sentence(rng, 60, "ab"), "# $"]
    rows = [(d, t, None if d is None or d % 2 else "x") for d, t, *_ in odd_rows]
    rows += [(100 + i, rng.choice(pool) + rng.choice(["", "", " #", " AAA BBBBBBBBBBBBBBBBB"]), rng.choice(["x", "", None, "y z"]))
             for i in range(60)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(90, 150)]
    labels += [(100, 1, 0), (100, 0, 1), (None, 1, 1), (7, 1, 1)]
    docs = docs_frame(spark, [(d, t) for d, t, _ in rows]).drop("source")
    sources = spark.createDataFrame([(i, s) for i, (*_, s) in enumerate(rows)], "row int, source string")
    numbered = spark.createDataFrame([(i, d, t) for i, (d, t, _) in enumerate(rows)], "row int, doc_id long, text string")
    docs = numbered.join(sources, "row").withColumn("docs", F.lit("clash")).withColumn("first", F.lit(1))
    frame = spark.createDataFrame([(*r, "clash") for r in labels], LABELS)
    got = audit.removal_audit(audit.filter_masks(docs, frame)).collect()
    found = {(r.part, r.filter_order, r.step): tuple(r[c] for c in audit.COUNTS) for r in got}
    assert len(found) == len(got)
    assert found == audited(rows, labels)


def test_removal_ranks_are_the_first_failed_filter():
    orders = audit.orders_of("ABCD")
    ranks = audit.removal_ranks(range(16), orders)
    for mask in range(16):
        for k, order in enumerate(orders):
            steps = [i for i, f in enumerate(order, 1) if mask >> "ABCD".index(f) & 1]
            assert ranks[mask, k] == min(steps, default=5)


def test_audit_of_nothing_and_wrong_filters(spark, nothing):
    none = spark.createDataFrame([], LABELS)
    assert audit.removal_audit(audit.filter_masks(nothing, none)).count() == 0
    with pytest.raises(ValueError):
        audit.removal_audit(audit.filter_masks(nothing, none), "BA")


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


@pytest.mark.parametrize("letters", ["ab", "abc", "aé海😀"])
def test_composition_accepts_exactly_the_pairs_one_edit_apart(letters):
    rng = random.Random(len(letters))
    for _ in range(60):
        words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(0, 8))) for _ in range(80)})
        acceptor = spelling.Acceptor()
        pairs = spelling.OneEdit(acceptor).pairs(acceptor.add(words))
        want = {(a, b) for i, a in enumerate(words) for b in words[i + 1 :] if one_apart(a, b)}
        assert len(pairs) == len(want) and {tuple(sorted(p)) for p in pairs} == want


def test_equal_right_languages_share_a_state():
    words = sorted(a + b for a in ("p", "q", "rs") for b in ("end", "ends", "ending"))
    acceptor = spelling.Acceptor()
    acceptor.add(words)
    assert len(acceptor.arcs) == 3  # the start, what follows "end", and the end of all words


def groups_by_loop(counts, ratio):
    near = {w: sorted((-counts[v], v) for v in counts if one_apart(w, v)) for w in counts}
    form = {w: (v[0][1] if v and -v[0][0] >= ratio * counts[w] else None) for w, v in near.items()}
    out = set()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return out


@pytest.mark.parametrize(("prefix", "most"), [(3, 20_000), (1, 3), (2, 1)])
def test_spelling_groups_against_all_pairs(spark, prefix, most):
    rng = random.Random(most)
    base = ["".join(rng.choice("abé") for _ in range(rng.randint(7, 9))) for _ in range(12)] + ["aaaaaaa", "abababab"]
    base += ["z" * 3000, "y" * 700 + "x" * 700]
    counts = Counter()
    for word in base:
        counts[word] += rng.choice([2, 30, 500])
        for _ in range(8):
            i = rng.randrange(len(word))
            counts[word[:i] + rng.choice(["", "a", "b" + word[i]]) + word[i + 1 :]] += rng.choice([1, 2, 3, 25])
    counts |= {"hhhhhhh": 2, "hhhhhhi": 25, "hhhhhii": 500}  # a form whose form is the root
    words = spark.createDataFrame([(w, k) for w, n in counts.items() for k in range(n)], "word string, depth int")
    got = spelling.spelling_groups(words.select("word"), least_prefix=prefix, most_words=most).collect()
    want = groups_by_loop({w: n for w, n in counts.items() if n >= 2}, 10)
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert any(r.root != r.form for r in got if r.form)


def test_planted_words_against_a_loop(spark, odd_rows):
    rng = random.Random(31)
    letters = "abcdefgABCÀÿ×÷ß"
    rows = odd_rows + [(1000 + i, " ".join("".join(rng.choice(letters) for _ in range(rng.randint(5, 12))) for _ in range(300)) + "-x'Yı海") for i in range(8)]
    want = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                want[run] += 1
    got = spelling.planted_words(docs_frame(spark, rows)).groupBy("word").count().collect()
    assert {r.word: r["count"] for r in got} == want


def test_no_words_no_groups(spark, nothing):
    assert spelling.spelling_groups(spelling.planted_words(nothing)).count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_groups(spelling.planted_words(nothing), least_ratio=1)

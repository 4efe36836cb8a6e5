"""Chat formatting, line dedup and decontamination: results against loops, and no Python in plans."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from documents import docs_frame, sentence
from facetframe.llm import chat, decontam, lines
from tables import plan

TURNS = "conv_id long, turn long, role string, text string, body string, block int"


def turns_frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 3) for r in rows], TURNS)


def test_chat_reads_back_whatever_the_texts_hold(spark):
    rng = random.Random(1)
    bits = ["\\", "\\\\", "###", "####", "</turn>", "\n</turn>\n", "### user:\n", "\\t", "\\b", "\n", "", "é海", "#"]
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (1, None, None, "first"), (2, 0, "assistant", "x"),
            (3, 0, "user", "only"), (4, 5, "a:\n###", "role"), (4, 5, "a:\n###", "role"), (None, 1, "user", "n")]
    for conv in range(10, 40):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "system", "ass\\istant"])
            rows.append((conv, turn, role, "".join(rng.choices(bits, k=rng.randint(0, 8)))))
    examples = chat.format_examples(turns_frame(spark, rows))
    got = {r.conv_id: r for r in chat.conversation_digests(examples).collect()}
    by_conv = {}
    for c, n, role, text in rows:
        by_conv.setdefault(c, []).append((n is not None, n or 0, role or "", text or ""))
    assert set(got) == set(by_conv)
    for conv, turns in by_conv.items():
        turns.sort()
        whole = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        reply = "".join(t for _, _, r, t in turns if r == "assistant")
        r = got[conv]
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(reply), hashlib.sha256(reply.encode()).hexdigest())
    for r in examples.filter("conv_id IN (1, 3)").collect():
        trained = r.text[r.loss_start : r.loss_start + r.loss_length]
        assert (r.conv_id, trained) in [(1, ""), (3, "")]


def test_every_reply_is_an_example_with_all_turns_before_it(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(6)] + [(1, 6, "user", "end")]
    got = [tuple(r) for r in chat.format_examples(turns_frame(spark, rows)).orderBy("example").collect()]
    blocks = [f"### {'assistant' if i % 2 else 'user'}:\nt{i}\n</turn>\n" for i in range(6)]
    assert [g[3] for g in got[:3]] == ["".join(blocks[: k + 1]) for k in (1, 3, 5)]
    assert [g[3][g[4] : g[4] + g[5]] for g in got] == ["t1", "t3", "t5", ""]
    assert got[3][3].endswith("end\n</turn>\n") and {g[2] for g in got} == {4}


def test_no_turns_no_examples(spark):
    assert chat.conversation_digests(chat.format_examples(turns_frame(spark, []))).count() == 0


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_bit_parallel_distance(spark, edits):
    rng = random.Random(edits)
    pairs = []
    for _ in range(400):
        a = [rng.choice("abñ😀") for _ in range(rng.randint(1, 14))]
        b = list(a)
        for _ in range(rng.randint(0, 5)):
            at = rng.randint(0, len(b))
            b[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "ñ"])
        if b and abs(len(a) - len(b)) <= edits:
            pairs.append(("".join(a), "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string")
    near = lines.within_edits(F.col("a"), F.col("b"), edits)
    assert df.filter(near != (F.levenshtein("a", "b") <= edits)).count() == 0
    assert 0 < df.filter(near).count() < len(pairs)


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_keys_of_lines_are_code_that_the_jvm_compiles(spark, tmp_path):
    frame = spark.createDataFrame([("a" * 50, 50, 1)], "line string, chars int, id long")
    frame.write.parquet(str(tmp_path / "lines"))
    long = spark.read.parquet(str(tmp_path / "lines"))
    probes = lines._keys(long, "b", 2, range(3), lines._probe_offsets(2))
    plan_ = probes._jdf.queryExecution().executedPlan()
    codes = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(plan_)
    sizes = [codes.apply(i)._3().maxMethodCodeSize() for i in range(codes.size())]
    assert sizes and max(sizes) < 8000
    assert probes.count() == 12


def test_line_dedup_against_a_loop(spark):
    rng = random.Random(7)
    base = [sentence(rng, 6) for _ in range(25)]
    rows = []
    for doc in range(40):
        text = []
        for _ in range(rng.randint(0, 6)):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 0, 1, 2, 3])):
                line[rng.randrange(len(line))] = rng.choice(["", "x", "yy"])
            text.append("".join(line))
        rows.append((doc, "\n".join([*text, "short", ""])))
    rows += [(900, None), (901, ""), (902, rows[3][1]), (902, rows[3][1]), (None, base[0])]
    first = {}
    order = [(d is None, d or 0, n, line) for d, t in rows if t is not None for n, line in enumerate(t.split("\n"))]
    for place in sorted(order):
        if len(place[3]) >= 20:
            first.setdefault(place[3], place[:3])
    near = {a: [b for b in first if a != b and abs(len(a) - len(b)) <= 2 and edit_distance(a, b) <= 2] for a in first}
    docs = docs_frame(spark, rows)
    got = {r.doc_id: r for r in lines.line_counts(docs, 2, 20).collect()}
    cleaned = {r.doc_id: r.text for r in lines.without_repeated_lines(docs, 2, 20).collect()}
    assert lines.without_repeated_lines(docs, 2, 20).columns == docs.columns
    assert any(near.values())
    for doc, text in rows:
        found = (text or "").split("\n") if text is not None else []
        gone = [
            n
            for n, line in enumerate(found)
            if line in first
            and (first[line] != (doc is None, doc or 0, n) or any(first[b] < first[line] for b in near[line]))
        ]
        assert list(got[doc].dropped) == gone, doc
        assert got[doc].n_lines == len(found)
        kept = None if text is None else "\n".join(x for n, x in enumerate(found) if n not in gone)
        assert cleaned[doc] == kept
        if doc != 902:
            assert got[doc].n_links == sum(len(near.get(line, [])) for line in found)


def test_short_lines_are_grouped_for_exact_repeats(spark):
    long = "a line of more than forty characters, for near matches"
    rows = [(1, f"Les.\n\n{long}\nDes.\nLes."), (2, f"Les.\n\n{long}!"), (3, "x\nx\nDes."), (4, "abcdefghi"), (5, "abcdefghj")]
    docs = docs_frame(spark, rows)
    got = {r.doc_id: list(r.dropped) for r in lines.line_counts(docs, 2, 40, 1).collect()}
    assert got == {1: [4], 2: [0, 2], 3: [1, 2], 4: [], 5: []}
    cleaned = {r.doc_id: r.text for r in lines.without_repeated_lines(docs, 2, 40, 1).collect()}
    assert (cleaned[1], cleaned[2], cleaned[3]) == (f"Les.\n\n{long}\nDes.", "", "x")


def test_line_query_and_pipeline_drop_short_repeats(spark, tmp_path):
    import __spark_entry__ as entry
    import corpus_pipeline

    docs = docs_frame(spark, [(1, "Les.\nfirst text"), (2, "Les.\nsecond text")])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.dropped_lines for r in entry.queries()["op6_segment_line_dedup"](spark, str(tmp_path)).collect()}
    assert got == {1: "", 2: "0"}
    kept = corpus_pipeline.drop_repeated_lines(spark, docs, str(tmp_path)).collect()
    assert {r.doc_id: r.text for r in kept} == {1: "Les.\nfirst text", 2: "second text"}


def test_line_dedup_of_odd_and_of_no_documents(odd, nothing, odd_rows):
    assert lines.line_counts(odd).count() == len(odd_rows)
    assert lines.without_repeated_lines(nothing).count() == 0
    assert lines.line_counts(nothing).count() == 0
    with pytest.raises(ValueError):
        lines.line_links(odd, 4, 40)


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def hits(text, items, n):
    words, hit, found = WORD.findall(lower(text)), set(), set()
    for item, body in items:
        own = WORD.findall(lower(body))
        size = min(n, len(own))
        for k in range(len(own) - size + 1 if own else 0):
            for at in range(len(words) - size + 1):
                if words[at : at + size] == own[k : k + size]:
                    hit.update(range(at, at + size))
                    found.add("" if item is None else str(item))
    return len(words), len(hit), sorted(found)


def test_contamination_against_a_loop(spark, odd_rows):
    rng = random.Random(9)
    items = [(i, sentence(rng, rng.choice([3, 9, 10, 11, 25]), "abc")) for i in range(12)]
    items += [(20, None), (21, ""), (22, "?!"), (23, "ÉÀ Straße"), (24, items[2][1]), (25, "a a a a a a a a a a a")]
    # No id; one id with two texts; a repeated row.
    items += [(None, sentence(rng, 12, "abc")), (30, sentence(rng, 12, "abc")), (30, sentence(rng, 14, "abc")), items[3]]
    rows = [(i, t) for i, t in odd_rows if i not in (11, 12)]
    rows += [(300 + k, f"before {body} after") for k, (_, body) in enumerate(items[-4:])]
    for doc in range(100, 160):
        words = sentence(rng, 30, "abc").split()
        own = (items[rng.randrange(12)][1]).upper().split(" ")
        cut = rng.randint(0, max(0, len(own) - 9))
        words[5:5] = own[cut : cut + rng.randint(8, 25)]
        rows.append((doc, rng.choice([" ", ", ", "\n-"]).join(words)))
    rows += [(200, "a " * 30), (201, "x éÀ straße y"), (201, "x ÉÀ straße y"), (202, "_" + items[0][1] + "_")]
    item_frame = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc int")
    docs = docs_frame(spark, rows)
    got = decontam.contamination(docs, item_frame)
    expected = sorted((str(d), *hits(t, items, 10)) for d, t in rows)
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, list(r["items"])) for r in got.collect()) == expected
    assert any(e[2] for e in expected)
    assert [e[3] for e in expected if e[0] in ("300", "301", "302")] == [[""], ["30"], ["30"]]
    assert all(r.near_items >= len(r["items"]) for r in got.collect())
    kept = decontam.without_contaminated(docs, item_frame)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(e[0] for e in expected if not e[2])


def test_contamination_of_and_by_nothing(spark, odd, nothing, odd_rows):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert decontam.contamination(odd, none).filter("n_hit > 0").count() == 0
    assert decontam.contamination(odd, one).filter("n_hit > 0").count() == 3
    assert decontam.contamination(nothing, one).count() == 0
    assert decontam.contamination(odd, none).count() == len(odd_rows)


def test_native_operators_run_no_python(spark, odd):
    turns = turns_frame(spark, [(1, 0, "user", "x")])
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    for df in (
        chat.conversation_digests(chat.format_examples(turns)),
        lines.line_counts(odd),
        decontam.contamination(odd, items),
    ):
        assert "Python" not in plan(df) and "Arrow" not in plan(df) and "Nested" not in plan(df)

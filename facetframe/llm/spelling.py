"""Spelling variants: words one edit apart, found by composing finite-state machines.

The vocabulary is an acceptor; composing it with a transducer of one edit and with itself accepts
exactly the pairs of words one insertion, deletion or replacement apart. The composition is
partitioned by the state its start leads to: the words that share a prefix are one block. What happens
before a block is left to equi-joins, what happens inside one to a machine built there:

- An edit on an arc before the block leaves the rest of both words equal. For a replacement both
  words without the edited place are equal, for a deletion one word without it is the other.
- An edit inside the block: the task builds the minimal acceptor of the block's remainders (equal
  right languages share a state) and walks pairs of its states: the same state on both sides before
  the edit, after it two states whose common right language is the answer, remembered by pair.

A block with more than ``most_words`` words is split where its words first differ, which turns the edits
on that letter into the first kind, until every block fits; so no task holds more than ``most_words`` words of
a block, and a group of the joins is bounded by the alphabet. Each pair is found once. Every word only
keeps the number of its near words and the best of them; pairs are not stored.

Null texts have no words; a null id is an empty text in the hash. Repeated rows count each time. No
words give no rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetframe.llm.common import ascii_lower
from facetframe.sources.scratch import stored

LETTERS = r"A-Za-zÀ-ÿ"
PARTIAL = "word string, n_near long, best_n long, best string"


def planted_words(docs: DataFrame, *, least_length: int = 7, one_in: int = 31) -> DataFrame:
    """``word`` of every run of letters, one in ``one_in`` with a letter left out by its hash.

    Shorter runs than ``least_length`` are left out first: they cannot become longer.
    """
    runs = F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    words = docs.select(name.alias("doc"), F.explode(runs).alias("run"))
    words = words.select("doc", ascii_lower(F.col("run")).alias("run"))
    words = words.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")))
    at = F.pmod("h", F.length("run").cast("long")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % one_in == 0, cut).otherwise(F.col("run"))
    return words.select(word.alias("word")).filter(F.length("word") >= least_length)


def vocabulary(words: DataFrame, *, least_count: int = 2) -> DataFrame:
    """``word`` and its number ``n``, counted before the shuffle."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def with_blocks(vocab: DataFrame, *, least_prefix: int = 3, most_words: int = 20_000) -> DataFrame:
    """``depth``: the length of the prefix that names the word's block; ``places``: edits before it.

    Starts at ``least_prefix``. A block that is too large is split at the first letter in which its words
    differ, so every round splits all of them; between its old name and that letter all its words are
    alike, so no edit can lie there. A word that ends at that letter is a block of its own.
    """
    depth = F.least(F.lit(least_prefix), F.length("word"))
    places = F.when(depth > 0, F.sequence(F.lit(0), depth - 1)).otherwise(F.array().cast("array<int>"))
    rows = vocab.select("word", "n", depth.alias("depth"), places.alias("places"))
    block = F.substring("word", F.lit(1), F.col("depth"))

    def differs(i: Column) -> Column:
        return F.substring("least", i + 1, F.lit(1)) != F.substring("most", i + 1, F.lit(1))

    while True:
        sized = rows.groupBy(block.alias("block")).agg(
            F.count(F.lit(1)).alias("size"), F.min("word").alias("least"), F.max("word").alias("most")
        )
        # The least and the largest word agree as far as all words do.
        upto = F.sequence(F.length("block"), F.length("least"))
        large = sized.filter(F.col("size") > most_words).select(
            "block", F.filter(upto, differs)[0].alias("branch")
        )
        large = stored(large, "spelling_large")
        if large.isEmpty():
            return rows
        split = F.col("branch").isNotNull()
        longer = split & (F.length("word") > F.col("branch"))
        rows = stored(
            rows.withColumn("block", block)
            .join(large, "block", "left")
            .select(
                "word",
                "n",
                F.when(split, F.least(F.col("branch") + 1, F.length("word")))
                .otherwise(F.col("depth"))
                .alias("depth"),
                F.when(longer, F.concat("places", F.array("branch")))
                .otherwise(F.col("places"))
                .alias("places"),
            ),
            "spelling_blocks",
        )


def _without(i: Column) -> Column:
    return F.concat(
        F.substring("word", F.lit(1), i), F.substring("word", i + 2, F.length("word"))
    )


def _edits_before(blocks: DataFrame) -> DataFrame:
    """Near words whose edit lies before their blocks, as partial counts."""

    def place(i: Column) -> Column:
        left, right = F.substring("word", i + 1, F.lit(1)), F.substring("word", i + 2, F.lit(1))
        # Deleting any letter of a run gives one word: the last of the run stands for it.
        return F.struct(i.alias("i"), _without(i).alias("rest"), (left != right).alias("last"))

    cut = blocks.select(
        "word", "n", F.inline(F.transform("places", place))
    )
    # Replacements: words that agree but for one place, at most as many as there are letters.
    alike = cut.groupBy("rest", "i").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), "word"))).alias("members")
    )
    alike = alike.filter(F.size("members") > 1)
    top, second = F.col("members")[0], F.col("members")[1]
    other = F.when(F.col("x.word") == top["word"], second).otherwise(top)
    replaced = alike.select("members", F.explode("members").alias("x")).select(
        F.col("x.word").alias("word"),
        (F.size("members") - 1).cast("long").alias("n_near"),
        (-other["m"]).alias("best_n"),
        other["word"].alias("best"),
    )
    # Deletions: a word that is another without one place.
    shorter = blocks.select(F.col("word").alias("rest"), F.col("n").alias("rest_n"))
    deleted = cut.filter("last").join(shorter, "rest").select(
        F.inline(
            F.array(
                F.struct("word", F.lit(1).cast("long").alias("n_near"), F.col("rest_n").alias("best_n"), F.col("rest").alias("best")),
                F.struct(F.col("rest").alias("word"), F.lit(1).cast("long").alias("n_near"), F.col("n").alias("best_n"), F.col("word").alias("best")),
            )
        )
    )
    return replaced.unionByName(deleted)


def _shared(x: str, y: str) -> int:
    """The length of the common prefix."""
    n = min(len(x), len(y))
    if x[:n] == y[:n]:
        return n
    return next(i for i in range(n) if x[i] != y[i])


class Acceptor:
    """The minimal deterministic acceptor of a set of words; equal right languages are one state.

    Chains of states that neither branch nor accept are one arc with a longer label, so very long words
    cost their length. ``arcs`` of a state: first letter to (label, state).
    """

    def __init__(self) -> None:
        self.arcs: list[dict[str, tuple[str, int]]] = []
        self.final: list[bool] = []
        self._known: dict[tuple, int] = {}

    def add(self, words: list[str], start: int = 0) -> int:
        """The state whose right language is what follows ``start`` in the sorted, distinct words."""
        final, arcs = len(words[0]) == start, {}
        i = 1 if final else 0
        while i < len(words):
            letter, first = words[i][start], i
            while i < len(words) and words[i][start] == letter:
                i += 1
            end = _shared(words[first], words[i - 1])
            arcs[letter] = (words[first][start:end], self.add(words[first:i], end))
        key = (final, tuple(arcs.values()))
        if key not in self._known:
            self._known[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
        return self._known[key]


class OneEdit:
    """The composition of an acceptor, one edit, and the acceptor again."""

    def __init__(self, acceptor: Acceptor) -> None:
        self.of = acceptor
        self._common: dict[tuple, list[str]] = {}
        self._language: dict[int, list[str]] = {}
        self._pairs: dict[int, list[tuple[str, str]]] = {}

    def language(self, q: int) -> list[str]:
        """All that is accepted from a state."""
        if q not in self._language:
            found = [""] if self.of.final[q] else []
            for label, to in self.of.arcs[q].values():
                found += [label + rest for rest in self.language(to)]
            self._language[q] = found
        return self._language[q]

    def common(self, x: str, p: int, y: str, q: int) -> list[str]:
        """What is accepted both by reading ``x`` to state ``p`` and by reading ``y`` to ``q``."""
        n = _shared(x, y)
        head, x, y = x[:n], x[n:], y[n:]
        if x and y:
            return []
        key = (x, p, y, q)
        found = self._common.get(key)
        if found is None:
            arcs, others = self.of.arcs[p], self.of.arcs[q]
            if y:  # the one side is at a state, the other inside an arc
                arc = arcs.get(y[0])
                found = self.common(*arc, y, q) if arc else []
            elif x:
                arc = others.get(x[0])
                found = self.common(x, p, *arc) if arc else []
            elif p == q:
                found = self.language(p)
            else:
                found = [""] if self.of.final[p] and self.of.final[q] else []
                for letter in arcs.keys() & others.keys():
                    found += self.common(*arcs[letter], *others[letter])
            self._common[key] = found
        return [head + rest for rest in found] if head else found

    def pairs(self, q: int) -> list[tuple[str, str]]:
        """Pairs of words accepted from a state that are one edit apart, each once."""
        found = self._pairs.get(q)
        if found is None:
            found, arcs = [], list(self.of.arcs[q].values())
            for i, (label, to) in enumerate(arcs):
                letter, rest = label[0], label[1:]
                for other, elsewhere in arcs[:i]:
                    same = self.common(rest, to, other[1:], elsewhere)
                    found += [(letter + s, other[0] + s) for s in same]
                # A letter left out; of equal letters the last one, so the rest begins otherwise.
                found += [(letter + s, s) for s in self.common(rest, to, "", q) if s[:1] != letter]
                found += [(label + s, label + t) for s, t in self.pairs(to)]
            self._pairs[q] = found
        return found


def _near_in_block(prefix: str, rests: list[str], n: list[int]) -> pa.RecordBatch:
    acceptor = Acceptor()
    start = acceptor.add(rests)
    number = dict(zip(rests, n, strict=True))
    near: dict[str, list] = {}
    for one, two in OneEdit(acceptor).pairs(start):
        for a, b in ((one, two), (two, one)):
            best = (-number[b], b)
            known = near.get(a)
            if known is None:
                near[a] = [1, best]
            else:
                known[0] += 1
                known[1] = min(known[1], best)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([prefix + w for w in near], pa.string()),
            pa.array([k for k, _ in near.values()], pa.int64()),
            pa.array([-m for _, (m, _) in near.values()], pa.int64()),
            pa.array([prefix + b for _, (_, b) in near.values()], pa.string()),
        ],
        names=["word", "n_near", "best_n", "best"],
    )


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``prefix``, ``rest``, ``n`` in this order; one block at a time is held."""
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 200_000))  # as deep as a block has words
    prefix, rests, counts = None, [], []
    for batch in batches:
        rows = zip(*[batch.column(c).to_pylist() for c in ("prefix", "rest", "n")], strict=True)
        for p, rest, n in rows:
            if p != prefix:
                if len(rests) > 1:
                    yield _near_in_block(prefix, rests, counts)
                prefix, rests, counts = p, [], []
            rests.append(rest)
            counts.append(n)
    if len(rests) > 1:
        yield _near_in_block(prefix, rests, counts)


def near_words(blocks: DataFrame) -> DataFrame:
    """``word``, ``n_near`` and the near word ``best`` of largest ``best_n`` (ties: the least)."""
    inside = (
        blocks.select(
            F.substring("word", F.lit(1), F.col("depth")).alias("prefix"),
            F.substring("word", F.col("depth") + 1, F.length("word")).alias("rest"),
            "n",
        )
        .repartition("prefix")
        .sortWithinPartitions("prefix", "rest")
        .mapInArrow(_compose, PARTIAL)
    )
    best = F.min(F.struct((-F.col("best_n")).alias("m"), "best"))
    parts = _edits_before(blocks).unionByName(inside)
    grouped = parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return grouped.select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and the ``root`` its forms lead to.

    A form is ``least_ratio`` times as frequent as its word, so chains are short; following them
    doubles the steps each time.
    """
    rows = stored(forms.select("word", F.col("form").alias("root")), "spelling_roots")
    while True:
        further = rows.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = rows.join(further, "root", "left")
        if moved.filter(F.col("next").isNotNull()).isEmpty():
            return rows
        rows = stored(moved.select("word", F.coalesce("next", "root").alias("root")), "spelling_roots")


def spelling_groups(
    words: DataFrame,
    *,
    least_count: int = 2,
    least_ratio: int = 10,
    least_prefix: int = 3,
    most_words: int = 20_000,
) -> DataFrame:
    """Every frequent word with its near words' number, its form and its root.

    ``words`` has one row per occurrence. A word's form is its near word of largest count, if that is
    at least ``least_ratio`` (over 1) times its own; the root is where forms lead to.
    """
    if least_ratio < 2 or least_prefix < 1 or most_words < 1:
        raise ValueError("least_ratio is at least 2, least_prefix and most_words at least 1")
    vocab = stored(vocabulary(words, least_count=least_count), "spelling_words")
    blocks = with_blocks(vocab, least_prefix=least_prefix, most_words=most_words)
    near = near_words(blocks)
    rows = vocab.join(near, "word", "left")
    is_form = F.col("best_n") >= least_ratio * F.col("n")
    rows = stored(
        rows.select(
            "word",
            F.when(is_form, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best_n")).alias("form_n"),
        ),
        "spelling_forms",
    )
    roots = _roots(rows.filter("form IS NOT NULL"))
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )

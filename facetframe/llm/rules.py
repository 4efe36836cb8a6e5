"""Quality rules under weak supervision: rules vote or abstain, and what they are worth is estimated.

Every rule looks at signals of the whole text and votes *good* (1), *bad* (0) or not at all (null).
No labels are used. Expectation-maximisation over the votes of all documents estimates how often
each rule is right on good and on bad documents; a document's quality is the posterior probability
of *good* given its votes, which takes the place of a chain of filters that all must pass. An
abstention is no evidence.

All of it is columns and aggregates: the signals are expressions of the text, documents count once
per pattern of votes (at most 3 to the number of rules, whatever the table's size), and the rounds of
the estimation are a fold over these counts.

Null and empty texts have no words: every signal is 0 and the rules that need words abstain or vote
*bad*. Repeated rows, ties and null ids each keep their row. With no documents the estimates are
their starting values. Columns of the input are never overwritten.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetframe.functions.paths import quoted
from facetframe.llm.common import ASCII_UPPER
from facetframe.sources.scratch import stored

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

# Fewer words, or a larger share of repeated ones, fail a text whatever the votes are.
LEAST_WORDS = 20
MOST_REPEATED = 30

ROUNDS = 40
# What is believed before any vote is counted: most documents are good, a rule seldom accuses a good
# one, and sees one kind of bad document among several. The belief weighs as much as BELIEF times
# the documents.
GOOD_SHARE, RIGHT_ON_GOOD, RIGHT_ON_BAD, BELIEF = 0.85, 0.99, 0.4, 0.1

Signal = Callable[[Column], Column]


@dataclass(frozen=True)
class Rule:
    """Votes *good* where ``good`` holds, else *bad* where ``bad`` holds, else not at all."""

    name: str
    good: Signal
    bad: Signal

    def vote(self, signals: Column) -> Column:
        votes = F.when(self.good(signals), F.lit(1)).when(self.bad(signals), F.lit(0))
        return votes.cast("int")


def _band(name: str, value: Signal, good: float, bad: float, given: Signal | None = None) -> Rule:
    """Good up to one bound, bad from another on, in between and without ``given`` no vote."""

    def within(test: Signal) -> Signal:
        return test if given is None else lambda s: given(s) & test(s)

    return Rule(name, within(lambda s: value(s) <= good), within(lambda s: value(s) >= bad))


def _share(part: str, whole: str) -> Signal:
    return lambda s: s[part] / F.greatest(s[whole], F.lit(1))


def _mean_word(s: Column) -> Column:
    return s["word_chars"] / F.greatest(s["n_words"], F.lit(1))


def _some(column: str, least: int) -> Signal:
    return lambda s: s[column] >= least


RULES: tuple[Rule, ...] = (
    Rule("length", lambda s: s["n_words"] >= 50, lambda s: s["n_words"] < LEAST_WORDS),
    Rule(
        "word_length",
        lambda s: _mean_word(s).between(3, 9),
        lambda s: (s["n_words"] > 0) & ~_mean_word(s).between(2.5, 12),
    ),
    _band("symbols", _share("n_symbols", "n_words"), 0.02, 0.1, _some("n_words", 1)),
    _band("capitals", _share("n_capitals", "n_letters"), 0.15, 0.3, _some("n_letters", 1)),
    _band("letters", _share("n_other", "word_chars"), 0.1, 0.25, _some("n_words", 1)),
    _band("shouts", _share("n_shouts", "n_words"), 0.02, 0.1, _some("n_words", 1)),
    _band("repeated_lines", _share("n_dup_lines", "n_lines"), 0.05, 0.3, _some("n_lines", 2)),
    _band("repeated_words", _share("n_repeat_words", "n_words"), 0.05, 0.2, _some("n_words", 16)),
    _band("bare_words", _share("n_bare_words", "n_words"), 0.02, 0.1, _some("n_words", 1)),
    _band("variety", _share("n_same_words", "n_words"), 0.6, 0.8, _some("n_words", LEAST_WORDS)),
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _windows(words: Column) -> Column:
    """Start of every window of words, from 1."""
    return F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))


def _in_repeated_windows(words: Column) -> Column:
    """Words in windows that occur twice or more, by the words themselves."""
    keyed = F.transform(
        _windows(words), lambda i: F.struct(F.slice(words, i, WINDOW).alias("k"), i.alias("p"))
    )

    def count(ordered: Column) -> Column:
        def repeated(x: Column, i: Column) -> Column:
            before, after = F.get(ordered, i - 1)["k"], F.get(ordered, i + 1)["k"]
            return F.coalesce(x["k"] == before, F.lit(False)) | F.coalesce(x["k"] == after, F.lit(False))

        starts = F.sort_array(F.transform(F.filter(ordered, repeated), lambda x: x["p"]))

        def cover(done: Column, start: Column) -> Column:
            fresh = start + WINDOW - F.greatest(start, done["upto"])
            return F.struct((start + WINDOW).alias("upto"), (done["n"] + fresh).alias("n"))

        nothing = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n"))
        return F.aggregate(starts, nothing, cover)["n"]

    return _let(F.sort_array(keyed), count)


def _of_words(words: Column) -> Column:
    """Counts over the words. Texts without equal window hashes, most of them, are not sorted."""
    hashes = F.transform(
        _windows(words), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(-1, WINDOW - 1)])
    )
    windows = F.size(words) - (WINDOW - 1)
    repeats = F.when(windows < 2, F.lit(0)).when(
        F.size(F.array_distinct(hashes)) == windows, F.lit(0)
    )
    return F.struct(
        F.size(words).alias("n_words"),
        repeats.otherwise(_in_repeated_windows(words)).alias("n_repeat_words"),
        (F.size(words) - F.size(F.array_distinct(words))).alias("n_same_words"),
        F.size(F.filter(words, lambda w: ~w.rlike(r"[\p{L}\p{N}]"))).alias("n_bare_words"),
    )


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def text_signals(text: Column) -> Column:
    """What the rules look at, as a struct of counts over the whole text."""
    text = F.coalesce(text, F.lit(""))
    bare = F.trim(text, F.lit(SPACES))
    no_words = F.array().cast("array<string>")
    words = F.when(bare == "", no_words).otherwise(F.split(bare, "[ \t-\r]+"))
    lines = F.filter(F.split(text, "\n"), lambda line: F.trim(line, F.lit(SPACES)) != "")
    solid = _without(text, SPACES)
    letters = F.regexp_replace(solid, r"[^\p{L}\p{M}]+", "")

    def together(w: Column, found: Column, solid: Column, letters: Column) -> Column:
        counts = {
            "n_words": w["n_words"],
            "word_chars": F.length(solid),
            "n_symbols": F.length(solid) - F.length(_without(solid, SYMBOLS)),
            "n_dup_lines": F.size(found) - F.size(F.array_distinct(found)),
            "n_repeat_words": w["n_repeat_words"],
            "n_lines": F.size(found),
            "n_letters": F.length(letters),
            "n_capitals": F.length(letters) - F.length(_without(letters, ASCII_UPPER)),
            "n_other": F.length(solid) - F.length(letters),
            "n_shouts": F.length(solid) - F.length(_without(solid, "!")),
            "n_same_words": w["n_same_words"],
            "n_bare_words": w["n_bare_words"],
        }
        return F.struct(*[value.cast("long").alias(name) for name, value in counts.items()])

    return _let(
        F.struct(
            _let(words, _of_words).alias("w"),
            lines.alias("lines"),
            solid.alias("solid"),
            letters.alias("letters"),
        ),
        lambda x: together(x["w"], x["lines"], x["solid"], x["letters"]),
    )


def base_failed(signals: Column) -> Column:
    repeated = 100 * signals["n_repeat_words"] > MOST_REPEATED * signals["n_words"]
    return (signals["n_words"] < LEAST_WORDS) | repeated


def cast_votes(signals: Column, rules: Sequence[Rule] = RULES) -> Column:
    """The votes of all rules in their order: 1 good, 0 bad, null none."""
    return F.array(*[rule.vote(signals) for rule in rules])


@dataclass(frozen=True)
class RuleModel:
    """The share of good documents and, by rule, how often it is right on good and bad ones."""

    good_share: float
    right_on_good: tuple[float, ...]
    right_on_bad: tuple[float, ...]

    def quality(self, votes: Column) -> Column:
        """The posterior probability that a document with these votes is good."""
        evidence = F.lit(math.log(self.good_share / (1 - self.good_share)))
        for i, (a, b) in enumerate(zip(self.right_on_good, self.right_on_bad, strict=True)):
            vote = F.get(votes, F.lit(i))
            weight = F.when(vote == 1, math.log(a / (1 - b))).when(vote == 0, math.log((1 - a) / b))
            evidence = evidence + F.coalesce(weight, F.lit(0.0))
        return 1 / (1 + F.exp(-evidence))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda x, y: x + y)


def fit_rules(
    votes: DataFrame, n_rules: int, column: str = "votes", *, rounds: int = ROUNDS
) -> RuleModel:
    """Estimate the rules from the votes of all documents by expectation-maximisation.

    Documents are counted by pattern of votes, combined before the shuffle; the rounds are one fold
    over the patterns. The belief about rules is where the estimates start and part of every one, so
    that *good* keeps its meaning.
    """
    patterns = votes.groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    listed = patterns.agg(F.sort_array(F.collect_list(F.struct("v", "n"))).alias("p"))
    rules = F.sequence(F.lit(0), F.lit(n_rules - 1))

    def params(share: Column, good: Column, bad: Column) -> Column:
        return F.struct(share.alias("share"), good.alias("good"), bad.alias("bad"))

    def posterior(model: Column, pattern: Column) -> Column:
        def weight(i: Column) -> Column:
            a, b, vote = F.get(model["good"], i), F.get(model["bad"], i), F.get(pattern["v"], i)
            chosen = F.when(vote == 1, F.ln(a / (1 - b))).when(vote == 0, F.ln((1 - a) / b))
            return F.coalesce(chosen, F.lit(0.0))

        prior = F.ln(model["share"] / (1 - model["share"]))
        return 1 / (1 + F.exp(-(prior + _total(F.transform(rules, weight)))))

    def step(model: Column, _: Column) -> Column:
        def update(split: Column) -> Column:
            def mixed(believed: float, hits: Column, of: Column, weight: Column) -> Column:
                # One is added so that no documents give the belief itself.
                return (believed * (weight + 1) + hits) / (weight + 1 + of)

            def accuracy(i: Column, kind: str, right: int, believed: float, weight: Column) -> Column:
                votes = F.transform(
                    split,
                    lambda x: F.when(F.get(x["v"], i).isNotNull(), x[kind]).otherwise(F.lit(0.0)),
                )
                hits = F.transform(
                    split, lambda x: F.when(F.get(x["v"], i) == right, x[kind]).otherwise(F.lit(0.0))
                )
                return mixed(believed, _total(hits), _total(votes), weight)

            good = _total(F.transform(split, lambda x: x["g"]))
            bad = _total(F.transform(split, lambda x: x["b"]))
            weight = BELIEF * (good + bad)
            return params(
                mixed(GOOD_SHARE, good, good + bad, weight),
                F.transform(rules, lambda i: accuracy(i, "g", 1, RIGHT_ON_GOOD, weight * GOOD_SHARE)),
                F.transform(
                    rules, lambda i: accuracy(i, "b", 0, RIGHT_ON_BAD, weight * (1 - GOOD_SHARE))
                ),
            )

        def halves(p: Column) -> Column:
            return _let(
                posterior(model, p),
                lambda r: F.struct(
                    p["v"].alias("v"), (p["n"] * r).alias("g"), (p["n"] * (1 - r)).alias("b")
                ),
            )

        return _let(F.transform("p", halves), update)

    start = params(
        F.lit(GOOD_SHARE),
        F.transform(rules, lambda i: F.lit(RIGHT_ON_GOOD)),
        F.transform(rules, lambda i: F.lit(RIGHT_ON_BAD)),
    )
    fitted = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step)
    model = listed.select(fitted.alias("m")).first()["m"]
    return RuleModel(model["share"], tuple(model["good"]), tuple(model["bad"]))


def judge(
    docs: DataFrame,
    *,
    text: str = "text",
    keep: Sequence[str] | None = None,
    rules: Sequence[Rule] = RULES,
    least_quality: float = 0.5,
    name: str = "__quality",
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) and a struct ``name``.

    The struct has the signals, the votes, ``base_failed``, ``quality`` (0 to 1) and ``kept``. The
    texts are read once; the rows are stored with their votes before the rules are estimated, so
    leave out the text where it isn't needed.
    """
    columns = [F.col(quoted(c)) for c in (docs.columns if keep is None else keep)]
    parts = {"signals": F.col(name), "votes": F.col(f"{name}_votes")}
    read = docs.select(*columns, text_signals(F.col(text)).alias(name))
    voted = stored(read.select("*", cast_votes(parts["signals"], rules).alias(f"{name}_votes")), "votes")
    model = fit_rules(voted, len(rules), f"{name}_votes")
    failed, quality = base_failed(parts["signals"]), model.quality(parts["votes"])
    parts |= {"base_failed": failed, "quality": quality, "kept": ~failed & (quality >= least_quality)}
    whole = F.struct(*[value.alias(part) for part, value in parts.items()])
    return voted.select(*columns, whole.alias(name))


def quality_verdicts(docs: DataFrame, **settings) -> DataFrame:
    """Per row of ``docs`` its ``doc_id``, the counts of ``COUNTS``, base_failed, kept and the rest."""
    q = F.col("__quality")
    return judge(docs, keep=["doc_id"], **settings).select(
        "doc_id",
        *[q["signals"][c].alias(c) for c in COUNTS],
        *[q[c].alias(c) for c in ("base_failed", "kept", "quality", "votes")],
    )


def without_low_quality(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns."""
    kept = judge(docs, **settings).filter(F.col("__quality")["kept"])
    return kept.select(*[quoted(c) for c in docs.columns])

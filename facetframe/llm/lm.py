"""Scoring of texts with a log-bilinear model trained by noise-contrastive estimation.

Tokens are the words of the text with A-Z in lower case, and one end. The ``SHORTLIST`` most frequent
training tokens are classes of their own; every other word belongs to one of ``ENDINGS`` classes by
a hash of its last bytes, and has its smoothed share of that class. The model predicts the class of
a token from that of the token before: ``(context . C) . target + bias``. It is trained on the
counts of all class pairs of the training texts, which are summed by Spark and at most
classes x classes numbers; the expectation over the noise (the class frequencies) is taken exactly.
A batched matrix product over all contexts, normalised by a soft maximum, gives the log-probability
of every class, so the probabilities of all words and one unknown word of each class add up to 1.

Counts of all words are a distributed table that grows with the corpus. Tasks hold those of the
``KNOWN_WORDS`` most frequent words, a fixed number; what other words a text has meets their counts
in a join.

Defined cases: a null or empty text has the end token alone; repeated rows are scored each; ties in
frequency go by word; without training texts every word is unknown; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetframe.sources.scratch import stored

SHORTLIST = 1000
ENDINGS = 64
KNOWN_WORDS = 200_000
DIMENSIONS = 32
STEPS = 250
NOISE = 10
SMOOTHING = 0.1
END = b"\n"  # no word holds white space


def held_out(doc_id: Column) -> Column:
    """Rows that are not learned from: a tenth of the ids."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(10)) == 0


def tokens(text: str | None) -> list[bytes]:
    """Bytes lower-case A-Z only and split at exactly the six white-space characters."""
    words = (text or "").encode().lower().split()
    words.append(END)
    return words


def ending(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % ENDINGS


class Classes(dict):
    """Class numbers of the shortlist; other words have the number of their ending's class."""

    def __missing__(self, word: bytes) -> int:
        return len(self) + zlib.crc32(word[-3:]) % ENDINGS


def word_counts(texts: DataFrame) -> DataFrame:
    """``word``, ``ending`` and ``c`` over all texts, counted in each task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(tokens(text))
            if len(counts) > 400_000:
                yield from emitted(counts)
                counts = Counter()
        yield from emitted(counts)

    def emitted(counts: Counter) -> Iterator[pa.RecordBatch]:
        words = list(counts)
        for first in range(0, len(words), 50_000):
            part = words[first : first + 50_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part, pa.binary()),
                    pa.array([ending(w) for w in part], pa.int32()),
                    pa.array([counts[w] for w in part], pa.int64()),
                ],
                names=["word", "ending", "c"],
            )

    partial = texts.select("text").mapInArrow(count, "word binary, ending int, c long")
    return partial.groupBy("word", "ending").agg(F.sum("c").alias("c"))


def frequent_words(counts: DataFrame, most: int) -> dict[bytes, int]:
    """The words above a count that at most ``most`` words reach, with their counts.

    The count is found from the numbers of words in steps of a sixteenth of a power of two, so the
    tasks send no candidates.
    """
    step = F.floor(F.log2("c") * 16).alias("step")
    at_step = counts.groupBy(step).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("step"))
    reached, least = 0, None
    for row in at_step.collect():
        reached += row["n"]
        if reached > most:
            break
        least = row["step"]
    if least is None:
        return {}
    found = counts.filter(F.floor(F.log2("c") * 16) >= least).select("word", "c").toPandas()
    return {bytes(w): c for w, c in zip(found["word"], found["c"].tolist())}


def class_pairs(texts: DataFrame, classes: Classes) -> np.ndarray:
    """How often each class follows each class in all texts; an end stands before a text."""
    size = len(classes) + ENDINGS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(size * size, np.int64)
        before = classes[END]
        for batch in batches:
            found = [before]
            for text in batch.column(0).to_pylist():
                found.extend(map(classes.__getitem__, tokens(text)))
                if len(found) > 1_000_000:
                    ids = np.array(found)
                    cells += np.bincount(ids[:-1] * size + ids[1:], minlength=size * size)
                    found = [before]
            ids = np.array(found)
            cells += np.bincount(ids[:-1] * size + ids[1:], minlength=size * size)
        at = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(cells[at])], names=["cell", "n"])

    # Every text ends with an end, so texts one after another count as a text after an end does.
    sums = texts.select("text").mapInArrow(count, "cell long, n long").groupBy("cell")
    rows = sums.agg(F.sum("n").alias("n")).toPandas()
    pairs = np.zeros(size * size)
    pairs[rows["cell"].to_numpy(np.int64)] = rows["n"].to_numpy(float)
    return pairs.reshape(size, size)


def train(pairs: np.ndarray, *, steps: int = STEPS, seed: int = 1) -> dict[str, np.ndarray]:
    """Noise-contrastive estimation of the log-bilinear model on pair counts (Adam)."""
    size = len(pairs)
    rng = np.random.default_rng(seed)
    times = (pairs.sum(axis=0) + 0.5).astype(np.float64)
    noise = (times / times.sum()).astype(np.float32)
    model = {
        "context": (rng.standard_normal((size, DIMENSIONS)) * 0.1).astype(np.float32),
        "map": np.eye(DIMENSIONS, dtype=np.float32),
        "target": (rng.standard_normal((size, DIMENSIONS)) * 0.1).astype(np.float32),
        "bias": np.log(noise),
    }
    total = max(pairs.sum(), 1.0)
    seen = (pairs / total).astype(np.float32)
    drawn = seen.sum(axis=1, keepdims=True) * noise * NOISE
    log_noise = np.log(NOISE * noise)
    mean = {k: np.zeros_like(v) for k, v in model.items()}
    square = {k: np.zeros_like(v) for k, v in model.items()}
    for step in range(1, steps + 1):
        ahead = model["context"] @ model["map"]
        odds = ahead @ model["target"].T + (model["bias"] - log_noise)
        true = 0.5 + 0.5 * np.tanh(0.5 * odds)
        error = true * drawn - (1 - true) * seen
        d_ahead = error @ model["target"]
        grad = {
            "bias": error.sum(axis=0),
            "target": error.T @ ahead,
            "map": model["context"].T @ d_ahead,
            "context": d_ahead @ model["map"].T,
        }
        rate = 0.05 * min(1, step / 10) * (1 - 0.9 * step / steps)
        for k, g in grad.items():
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.99 * square[k] + 0.01 * g * g
            scale = np.sqrt(square[k] / (1 - 0.99**step)) + 1e-9
            model[k] = (model[k] - rate * mean[k] / (1 - 0.9**step) / scale).astype(np.float32)
    return model


def log10_probabilities(model: dict[str, np.ndarray]) -> np.ndarray:
    """(context class, class): normalised log10 probabilities, a block of contexts at a time."""
    ahead = model["context"] @ model["map"]
    out = np.empty((len(ahead), len(ahead)))
    for first in range(0, len(ahead), 256):
        part = slice(first, first + 256)
        logits = (ahead[part] @ model["target"].T + model["bias"]).astype(np.float64)
        logits -= logits.max(axis=1, keepdims=True)
        out[part] = logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))
    return out / np.log(10)


def score_texts(docs: DataFrame, training: DataFrame) -> DataFrame:
    """Score every ``text`` of ``docs`` (with ``doc_id`` and ``held_out``), learning from ``training``."""
    counts = stored(word_counts(training), "word_counts")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    # Fixed numbers of rows are collected: the frequent words, and sums for the endings.
    times = frequent_words(counts, KNOWN_WORDS)
    ends = counts.filter(F.col("word") == F.lit(END)).select("c").first()
    times[END] = ends["c"] if ends else 0
    shortlist = sorted(times, key=lambda w: (w != END, -times[w], w))[:SHORTLIST]
    classes = Classes({w: i for i, w in enumerate(shortlist)})
    ending_n, ending_v = np.zeros(ENDINGS), np.zeros(ENDINGS)
    for row in counts.groupBy("ending").agg(F.sum("c"), F.count(F.lit(1))).collect():
        ending_n[row[0]], ending_v[row[0]] = row[1], row[2]
    for w in shortlist:
        ending_n[ending(w)] -= times[w]
        ending_v[ending(w)] -= times[w] > 0
    table = log10_probabilities(train(class_pairs(training, classes))).astype(np.float32)

    spark = docs.sparkSession
    size = len(table)
    rest = np.log10(ending_n + SMOOTHING * (ending_v + 1))
    all_words = np.log10(n + SMOOTHING * (v + 1))
    unseen_ends = int(times[END] == 0)  # without training texts
    given = spark.sparkContext.broadcast(
        {
            "classes": classes,
            "table": table.reshape(-1),
            "known": {w: float(np.log10(c + SMOOTHING)) for w, c in times.items()},
        }
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = given.value
        numbers, log10_of, known = held["classes"], held["table"], held["known"]
        first_class = len(numbers)
        uid = TaskContext.get().partitionId() << 40
        for whole in batches:
            for first in range(0, len(whole), 200):
                batch = whole.slice(first, 200)
                rows = []
                for text in batch.column("text").to_pylist():
                    found = tokens(text)
                    ids = np.array([numbers[END], *map(numbers.__getitem__, found)])
                    score = float(log10_of[ids[:-1] * size + ids[1:]].sum(dtype=np.float64))
                    values = list(map(known.get, found))
                    rare = Counter(w for w, x in zip(found, values) if x is None)
                    own = np.array([x for x in values if x is not None])
                    some = own.sum() - len(found) * all_words
                    other = ids[1:] >= first_class
                    of_class = np.array([0.0 if x is None else x for x in values])[other]
                    score += of_class.sum() - rest[ids[1:][other] - first_class].sum()
                    rows.append(
                        (
                            uid,
                            len(found),
                            len(own) - unseen_ends,
                            float(some),
                            float(score),
                            [{"word": w, "m": m} for w, m in rare.items()],
                        )
                    )
                    uid += 1
                columns = list(zip(*rows))
                types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), RARE]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        batch.column("held_out"),
                        *(pa.array(c, t) for c, t in zip(columns, types)),
                    ],
                    names=["doc_id", "held_out", *SCORED],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    local = docs.select("doc_id", "held_out", "text").mapInArrow(
        score,
        f"doc_id {kind}, held_out boolean, uid long, n_tokens long, known long, base double, "
        "score double, rare array<struct<word: binary, m: long>>",
    )
    local = stored(local, "local_scores")
    # Words that are not among the frequent ones: few enough of each that no key is hot.
    parts = local.select("uid", F.inline("rare")).join(counts.select("word", "c"), "word", "left")
    c = F.coalesce("c", F.lit(0))
    log = F.col("m") * F.log10(c + SMOOTHING)
    added = parts.groupBy("uid").agg(
        F.sum(log).alias("more"), F.sum(F.when(c > 0, F.col("m")).otherwise(0)).alias("more_known")
    )
    more = F.coalesce("more", F.lit(0.0))
    return local.drop("rare").join(added, "uid", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )


RARE = pa.list_(pa.struct([("word", pa.binary()), ("m", pa.int64())]))
SCORED = ["uid", "n_tokens", "known", "base", "score", "rare"]

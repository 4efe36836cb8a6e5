"""Language identification with a bidirectional gated recurrent network over bytes.

The network labels every byte position of a text and the document's probability of a language is the
mean over its positions. It is trained in numpy by backpropagation through time on windows from a
bounded sample of labelled rows (``PER_LANGUAGE`` rows of each language, chosen by a hash of the
row), on the driver. Prediction runs over every byte of every text, in windows of ``WINDOW`` bytes
that start from an empty state; the last window ends with the text.

Defined cases: a null text, or one without letters, is ``und`` with score 0; without any labelled
row every text is ``und``; equal probabilities go to the language that sorts first; repeated rows
get equal results; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 64
HIDDEN = 8
PER_LANGUAGE = 1500
STEPS = 400
BATCH = 192
BLOCK = 2048
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
Model = dict[str, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5
    return x


def new_model(labels: int, hidden: int, seed: int) -> Model:
    rng = np.random.default_rng(seed)

    def normal(scale: float, *shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    return {
        "byte": normal(0.3, 2, 3 * hidden, 256),
        "state": normal(hidden**-0.5, 2, 3 * hidden, hidden),
        "out": normal((2 * hidden) ** -0.5, 2, labels, hidden),
        "bias": np.zeros((labels, 1), np.float32),
    }


def run_states(model: Model, both: np.ndarray, keep: list | None = None) -> np.ndarray:
    """The states after each step, (steps, 2, hidden, rows), of both directions.

    ``both`` holds the bytes in reading order and reversed, (2, steps, rows). ``keep`` collects what
    backpropagation needs.
    """
    hidden = model["state"].shape[2]
    steps, rows = both.shape[1:]
    states = np.empty((steps, 2, hidden, rows), np.float32)
    h = np.zeros((2, hidden, rows), np.float32)
    x = np.empty((2, 3 * hidden, rows), np.float32)
    u = np.empty_like(x)
    for t in range(steps):
        for way in (0, 1):
            np.take(model["byte"][way], both[way, t], axis=1, out=x[way], mode="clip")
        np.matmul(model["state"], h, out=u)
        gates = x[:, : 2 * hidden] + u[:, : 2 * hidden]
        gates = _sigmoid(gates)
        z, r = gates[:, :hidden], gates[:, hidden:]
        new = r * u[:, 2 * hidden :]
        new += x[:, 2 * hidden :]
        np.tanh(new, out=new)
        if keep is not None:
            keep.append((z, r, u[:, 2 * hidden :].copy(), new, h))
        state = np.subtract(h, new, out=states[t])
        state *= z
        state += new
        h = state
    return states


def position_probabilities(model: Model, states: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """(steps, labels, rows) from the states; a row has ``lengths`` bytes, the rest is padding."""
    steps = len(states)
    if (lengths == steps).all():
        back = states[::-1, 1]
    else:
        at = np.maximum(lengths[None, :] - 1 - np.arange(steps)[:, None], 0)
        back = np.take_along_axis(states[:, 1], at[:, None, :], axis=0)
    logits = model["out"][0] @ states[:, 0]
    logits += model["out"][1] @ back
    logits += model["bias"]
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def gradients(model: Model, both: np.ndarray, wanted: np.ndarray, weight: np.ndarray) -> Model:
    """Of the weighted cross entropy of every position, by backpropagation through time."""
    hidden = model["state"].shape[2]
    steps, rows = both.shape[1:]
    kept: list = []
    states = run_states(model, both, kept)
    error = position_probabilities(model, states, np.full(rows, steps))
    error[:, wanted, np.arange(rows)] -= 1
    error *= weight / (weight.sum() * steps)
    grad = {k: np.zeros_like(v) for k, v in model.items()}
    grad["bias"] = error.sum(axis=(0, 2))[:, None]
    grad["out"][0] = np.einsum("tlr,thr->lh", error, states[:, 0], optimize=True)
    grad["out"][1] = np.einsum("tlr,thr->lh", error, states[::-1, 1], optimize=True)
    into = np.stack(
        [model["out"][0].T @ error, (model["out"][1].T @ error)[::-1]], axis=1
    )
    dh = np.zeros((2, hidden, rows), np.float32)
    for t in range(steps - 1, -1, -1):
        z, r, u, new, before = kept[t]
        dh = dh + into[t]
        d_new = dh * (1 - z) * (1 - new * new)
        d_gates = np.concatenate(
            [dh * (before - new) * z * (1 - z), d_new * u * r * (1 - r), d_new * r], axis=1
        )
        d_byte = d_gates.copy()
        d_byte[:, 2 * hidden :] = d_new
        for way in (0, 1):
            grad["state"][way] += d_gates[way] @ before[way].T
            seen = np.zeros((rows, 256), np.float32)
            seen[np.arange(rows), both[way, t]] = 1
            grad["byte"][way] += d_byte[way] @ seen
        dh = dh * z + model["state"].transpose(0, 2, 1) @ d_gates
    return grad


def train(
    windows: np.ndarray,
    wanted: np.ndarray,
    labels: int,
    *,
    hidden: int = HIDDEN,
    steps: int = STEPS,
    seed: int = 1,
) -> Model:
    """A network for windows of equal length, (rows, bytes), with a label each (Adam)."""
    model = new_model(labels, hidden, seed)
    rng = np.random.default_rng(seed)
    mean = {k: np.zeros_like(v) for k, v in model.items()}
    square = {k: np.zeros_like(v) for k, v in model.items()}
    weight = (len(wanted) / np.maximum(np.bincount(wanted, minlength=labels), 1)).astype(np.float32)
    for step in range(1, steps + 1):
        at = rng.integers(0, len(windows), min(BATCH, len(windows)))
        both = np.stack([windows[at].T, windows[at].T[::-1]])
        grad = gradients(model, both, wanted[at], weight[wanted[at]])
        rate = 0.02 * min(1, step / 20) * (1 - 0.9 * step / steps)
        for k, g in grad.items():
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.99 * square[k] + 0.01 * g * g
            scale = np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8
            model[k] = (model[k] - rate * mean[k] / (1 - 0.9**step) / scale).astype(np.float32)
    return model


def pooled(model: Model, texts: list[bytes]) -> np.ndarray:
    """The mean probability of each label over all positions of each text (none empty)."""
    total = np.zeros((len(texts), model["bias"].size))
    short = [i for i, text in enumerate(texts) if len(text) < WINDOW]
    for first in range(0, len(short), BLOCK):
        ids = short[first : first + BLOCK]
        lengths = np.array([len(texts[i]) for i in ids])
        both = np.zeros((2, WINDOW, len(ids)), np.uint8)
        for row, i in enumerate(ids):
            raw = np.frombuffer(texts[i], np.uint8)
            both[0, : len(raw), row] = raw
            both[1, : len(raw), row] = raw[::-1]
        p = position_probabilities(model, run_states(model, both), lengths)
        p *= (np.arange(WINDOW)[:, None] < lengths)[:, None, :]
        total[ids] += p.sum(axis=0).T
    long = [i for i, text in enumerate(texts) if len(text) >= WINDOW]
    starts = [np.arange(0, len(texts[i]) - WINDOW + 1, WINDOW) for i in long]
    tails = np.array([len(texts[i]) - WINDOW for i in long], np.int64)
    if long:
        raw = np.frombuffer(b"".join(texts[i] for i in long), np.uint8)
        base = np.cumsum([0, *(len(texts[i]) for i in long[:-1])])
        owner = np.concatenate(
            [np.repeat(np.arange(len(long)), [len(s) for s in starts]), np.arange(len(long))]
        )
        start = np.concatenate([*starts, tails]) + base[owner]
        # Positions that the last window shares with the one before count once.
        covered = np.array([len(s) * WINDOW for s in starts]) - tails
        skip = np.concatenate([np.zeros(len(owner) - len(long), np.int64), covered])
        wanted = skip < WINDOW
        owner, start, skip = owner[wanted], start[wanted], skip[wanted]
        ids = np.array(long)
        for first in range(0, len(owner), BLOCK):
            part = slice(first, first + BLOCK)
            windows = raw[start[part] + np.arange(WINDOW)[:, None]]
            both = np.stack([windows, windows[::-1]])
            full = np.full(windows.shape[1], WINDOW)
            p = position_probabilities(model, run_states(model, both), full)
            if skip[part].any():
                p *= (np.arange(WINDOW)[:, None] >= skip[part])[:, None, :]
            np.add.at(total, ids[owner[part]], p.sum(axis=0).T)
    return total / np.maximum([len(text) for text in texts], 1)[:, None]


def sampled_windows(labelled: DataFrame, per_language: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, windows and labels from about ``per_language`` rows of each, chosen by hash."""
    rows = labelled.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return [], np.zeros((0, WINDOW), np.uint8), np.zeros(0, np.int64)
    share = F.create_map(
        *[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, per_language / n))]
    )
    spot = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    room = F.greatest(F.length("text") - WINDOW, F.lit(1))
    start = F.pmod(F.xxhash64("text", "doc_id"), room).cast("int") + 1
    sample = (
        rows.filter(spot < share[F.col("lang")] * (1 << 30))
        .select("lang", F.substring("text", start, F.lit(4 * WINDOW)).alias("text"), spot.alias("spot"))
        .collect()
    )
    languages, windows, wanted = sorted(counts), [], []
    for row in sorted(sample, key=lambda r: (r["spot"], r["lang"], r["text"])):
        raw = row["text"].encode()
        for first in range(0, max(1, len(raw) - WINDOW + 1), WINDOW):
            part = raw[first : first + WINDOW]
            if LETTER.search(part.decode(errors="ignore")):
                windows.append(np.frombuffer(part.ljust(WINDOW, b" "), np.uint8))
                wanted.append(languages.index(row["lang"]))
    if not windows:
        return [], np.zeros((0, WINDOW), np.uint8), np.zeros(0, np.int64)
    return languages, np.stack(windows), np.array(wanted)


def predict_languages(
    docs: DataFrame,
    labelled: DataFrame,
    *,
    names: tuple[str, str] = ("lang_pred", "score"),
    per_language: int = PER_LANGUAGE,
) -> DataFrame:
    """Add the predicted language and its probability to rows with a ``text``.

    ``labelled`` has ``doc_id``, ``text`` and ``lang``; columns of the given names are replaced.
    """
    languages, windows, wanted = sampled_windows(labelled, per_language)
    model = train(windows, wanted, len(languages)) if languages else None

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            known = [i for i, t in enumerate(texts) if model and t and LETTER.search(t)]
            found, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            for first in range(0, len(known), 256):
                ids = known[first : first + 256]
                p = pooled(model, [texts[i].encode() for i in ids])
                best = p.argmax(axis=1)
                for i, b, s in zip(ids, best, p.max(axis=1)):
                    # The last places depend on which texts share a block; equal texts score alike.
                    found[i], scores[i] = languages[b], round(min(float(s), 1.0), 9)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, *names],
            )

    fields = [f for f in docs.schema.fields if f.name not in names]
    schema = T.StructType(
        [*fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())]
    )
    return docs.select(*[f"`{f.name}`" for f in fields]).mapInArrow(predict, schema)


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: a third of the ids."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1

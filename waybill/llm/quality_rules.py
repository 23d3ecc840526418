"""Quality rules: counts over whole texts, and a hashed n-gram logistic regression with calibration.

The model is trained here on a bounded sample of labelled rows and scored in Arrow batches. Its
features are the shares of hashed lower-cased words, word pairs and 4-byte character n-grams; its
output is calibrated on held-out labelled rows and compared with a fixed threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import sample_texts, seeded_sample, stored
from waybill.llm.hashing import Run, gathered, hash_spans, runs, salted

#: The base rules.
LEAST_WORDS, REPEAT_WORDS, MOST_REPEATED_PERCENT = 10, 5, 20
SYMBOLS = b"#*$%&|<>"
#: Labelled rows that the model is fitted on, at most; a fifth of them only calibrate it.
TRAINING_ROWS = 4_000
#: Longer texts, in bytes, are not fitted on; with the rows this bounds the fitting task.
TRAINING_TEXT_BYTES = 32_768
HELD_OUT = 5
BITS, STEPS, PENALTY, SEED = 17, 120, 3e-6, 23
#: Kept from this calibrated probability on.
KEEP_FROM = 0.5

_IS_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, dtype=np.uint8))
_SLOTS = 1 << BITS


def _counts(run: Run) -> dict[str, np.ndarray]:
    """The base counts of each text of a run, of words and lines as they stand (case counts)."""
    starts, ends, text = run.word_starts, run.word_ends, run.word_text
    edges = np.zeros(len(run.data) + 1, dtype=np.int8)
    edges[starts] += 1
    edges[ends] -= 1
    in_word = np.cumsum(edges[:-1], dtype=np.int8).astype(bool)
    # A word that touches the next text's first word ends where that begins: both edges cancel.
    word_chars = run.per_text(in_word & ((run.data & 0xC0) != 0x80))

    repeated = np.zeros(len(starts) + 1, dtype=np.int64)
    hashes, first = run.windows(REPEAT_WORDS, exact=True)
    if len(first):
        keys = hashes ^ salted(text[first].astype(np.uint64), 1)
        _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
        again = first[counts[inverse] > 1]
        np.add.at(repeated, again, 1)
        np.add.at(repeated, again + REPEAT_WORDS, -1)
    covered = np.cumsum(repeated[:-1]) > 0

    cuts = np.flatnonzero(run.data == 0x0A)
    line_starts = np.concatenate([run.begins[:-1], cuts + 1])
    line_ends = np.concatenate([run.begins[1:], cuts])
    line_starts, line_ends = np.sort(line_starts, kind="stable"), np.sort(line_ends, kind="stable")
    words_before = np.searchsorted(starts, line_starts), np.searchsorted(starts, line_ends)
    full = words_before[1] > words_before[0]
    line_starts, line_ends, of_word = line_starts[full], line_ends[full], words_before[0][full]
    dup_lines = np.zeros(run.texts, dtype=np.int64)
    if len(line_starts):
        line_text = text[of_word]
        keys = hash_spans(run.data, line_starts, line_ends) ^ salted(line_text.astype(np.uint64), 2)
        _, firsts = np.unique(keys, return_index=True)
        dup_lines = np.bincount(line_text, minlength=run.texts) - np.bincount(
            line_text[firsts], minlength=run.texts
        )
    return {
        "n_words": run.words,
        "word_chars": word_chars,
        "n_symbols": run.per_text(_IS_SYMBOL[run.data]),
        "n_dup_lines": dup_lines,
        "n_repeat_words": np.bincount(text, weights=covered, minlength=run.texts).astype(np.int64),
    }


def _grams(run: Run) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, slot) of every feature occurrence, one family of features at a time."""
    small = lambda h, salt: (salted(h, salt) >> np.uint64(64 - BITS)).astype(np.int64)
    yield run.word_text, small(run.word_hash, 3)
    pairs, first = run.windows(2)
    yield run.word_text[first], small(pairs, 4)
    data = run.data.astype(np.uint32)
    if len(data) >= 4:
        code = data[:-3] | data[1:-2] << 8 | data[2:-1] << 16 | data[3:] << 24
        text = run.byte_text
        inside = text[:-3] == text[3:]
        code = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
        yield text[:-3][inside], code[inside].astype(np.int64)


class Model:
    """Weights per slot; a text's score is the sum over families of its grams' mean weight."""

    def __init__(self, weights: np.ndarray, bias: float, slope: float, shift: float):
        self.weights, self.bias, self.slope, self.shift = weights, bias, slope, shift

    @property
    def state(self) -> tuple:
        return self.weights, self.bias, self.slope, self.shift

    def probability(self, run: Run) -> np.ndarray:
        score = np.full(run.texts, self.bias)
        for text, slot in _grams(run):
            total = np.bincount(text, weights=self.weights[slot], minlength=run.texts)
            score += total / np.maximum(np.bincount(text, minlength=run.texts), 1)
        return 1 / (1 + np.exp(-np.clip(self.slope * score + self.shift, -30, 30)))


def _sparse(run: Run) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, slot, share) of the features of a run, once each."""
    parts = []
    for text, slot in _grams(run):
        keys, counts = np.unique(text * _SLOTS + slot, return_counts=True)
        of = keys // _SLOTS
        parts.append((of, keys % _SLOTS, counts / np.bincount(text, minlength=run.texts)[of]))
    return tuple(np.concatenate(part) for part in zip(*parts, strict=True))


def train(texts: pa.Array, good: np.ndarray, held_out: np.ndarray) -> Model:
    """Full-batch Adam on the class-balanced log loss, then Platt scaling on the held-out rows."""
    parts = []
    for row, run in runs(texts, lowered=True, blank_words=True):
        text, slot, share = _sparse(run)
        parts.append((text + row, slot.astype(np.int32), share.astype(np.float32)))
    if not len(good) or not parts or good.min() == good.max():
        return Model(np.zeros(_SLOTS), 0.0, 0.0, 4.0 if not len(good) or good[0] else -4.0)
    text, slot, share = (np.concatenate(part) for part in zip(*parts, strict=True))
    n, label = len(good), good.astype(float)
    fitted = ~held_out if 0 < label[~held_out].mean() < 1 else np.ones(n, dtype=bool)
    balance = np.where(label == 1, 0.5 / (label * fitted).sum(), 0.5 / ((1 - label) * fitted).sum()) * fitted
    used = fitted[text]
    of, at, by = text[used], slot[used], share[used]
    weights, bias, rate = np.zeros(_SLOTS), 0.0, 0.5
    mean, square = np.zeros(_SLOTS + 1), np.zeros(_SLOTS + 1)
    for step in range(1, STEPS + 1):
        score = np.bincount(of, weights=weights[at] * by, minlength=n) + bias
        error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - label) * balance
        gradient = np.append(np.bincount(at, weights=error[of] * by, minlength=_SLOTS), error.sum())
        gradient[:-1] += PENALTY * weights
        mean, square = 0.9 * mean + 0.1 * gradient, 0.999 * square + 0.001 * gradient**2
        move = rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    score = np.bincount(text, weights=weights[slot] * share, minlength=n) + bias
    rest = held_out if 0 < label[held_out].mean() < 1 else fitted
    return Model(weights, bias, *platt(score[rest], label[rest]))


def platt(score: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift that turn scores into probabilities (Newton steps, smoothed targets)."""
    high, low = label.sum(), (1 - label).sum()
    target = np.where(label == 1, (high + 1) / (high + 2), 1 / (low + 2))
    x = np.stack([score, np.ones_like(score)], axis=1)
    at = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        hessian = x.T @ (x * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (p - target) + 1e-6 * at)
        at = at - step / max(1.0, np.abs(step).max() / 2)
    return float(at[0]), float(at[1])


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Model:
    """Train on at most `rows` labelled documents, chosen by hash, in one task; returns the model.

    Labels that are null are left out; without both classes every text gets the one class there is
    (good without labels). An id with several labels counts with the lowest, and one that several rows
    have with one of their texts. Texts over TRAINING_TEXT_BYTES are left out, so that one task can
    hold the sample.
    """
    lowest = labels.filter("quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    sample = sample_texts(docs, seeded_sample(lowest, "doc_id", rows, SEED), TRAINING_TEXT_BYTES)
    sample = sample.select("text", F.col("quality").cast("int"), F.xxhash64(F.lit(SEED + 1), "doc_id").alias("draw"))

    def train_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = gathered(batches, _SAMPLE).sort_by([("draw", "ascending")])
        good = every["quality"].to_numpy() > 0
        model = train(every["text"], good, every["draw"].to_numpy() % HELD_OUT == 0)
        slots = np.flatnonzero(model.weights)
        values = np.concatenate([[model.bias, model.slope, model.shift], model.weights[slots]])
        keys = np.concatenate([[-1, -2, -3], slots])
        yield pa.RecordBatch.from_pydict({"slot": keys.astype(np.int64), "value": values.astype(float)})

    # One task: the sample is bounded by `rows`.
    fitted = stored(sample.repartition(1).mapInArrow(train_all, "slot bigint, value double"), "rules-model")
    found = {row.slot: row.value for row in fitted.collect()}
    if not found:  # without rows the task may not run
        return train(pa.array([], pa.string()), np.zeros(0, dtype=bool), np.zeros(0, dtype=bool))
    weights = np.zeros(_SLOTS)
    slots = [slot for slot in found if slot >= 0]
    weights[slots] = [found[slot] for slot in slots]
    return Model(weights, found[-1], found[-2], found[-3])


_SAMPLE = pa.schema([("text", pa.string()), ("quality", pa.int32()), ("draw", pa.int64())])
_RESULT = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint,"
    " n_repeat_words bigint, base_failed boolean, quality double, kept boolean"
)


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """Counts, calibrated quality and verdict of every document, in Arrow batches, without a shuffle.

    Null and empty texts have no words and fail the base rules. Repeated rows and null ids are
    returned as they come; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.state)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            for row, run in runs(batch.column("text"), lowered=True, blank_words=True):
                counts, quality = _counts(run), model.probability(run)
                n, repeats = counts["n_words"], counts["n_repeat_words"]
                failed = (n < LEAST_WORDS) | (100 * repeats > MOST_REPEATED_PERCENT * n)
                columns = [pa.array(column.astype(np.int64)) for column in counts.values()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(row, run.texts),
                        *columns,
                        pa.array(failed),
                        pa.array(quality),
                        pa.array(~failed & (quality >= KEEP_FROM)),
                    ],
                    names=["doc_id", *counts, "base_failed", "quality", "kept"],
                )

    return docs.select("doc_id", "text").mapInArrow(score, _RESULT)

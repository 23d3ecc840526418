"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One score per text, the sum of shared weights over its hashed features; ordered thresholds on that
score part the grades, so P(grade >= k) = logistic(score - threshold k). That gives an expected grade
and the tail probability that documents are selected by. Trained here on a bounded sample of rated
rows, scored in Arrow batches.

Features of a whole text: which hashed words and 5-byte character n-grams of words it has (once each,
so that one telling word counts as much in a long text), the shares of the 4-grams of its character classes (capitals, letters, digits,
each symbol), and the share of words that repeat the word before.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.llm.common import free_name, sample_texts, seeded_sample, stored
from waybill.llm.hashing import Run, gathered, runs, salted

#: Rated rows that the model is fitted on, at most.
TRAINING_ROWS = 8_000
#: Longer texts, in bytes, are not fitted on; with the rows this bounds the fitting task.
TRAINING_TEXT_BYTES = 32_768
SEED = 29
#: Feature slots. Of the words and n-grams that enough training texts have, those are used whose texts'
#: grades deviate most from the others', one for every few training texts and each by some standard
#: deviations: the many slots that tell nothing would add up in long texts.
BITS, LEAST_TEXTS, GRAM_BYTES = 22, 10, 5
TEXTS_PER_SLOT, LEAST_DEVIATION = 4, 4.0
#: L-BFGS steps, the L2 penalty of one weight in texts, and the scale of shares against presences.
STEPS, PENALTY, SHARE_SCALE = 80, 0.8, 20.0
#: Documents are selected when they reach this grade with this probability.
SELECT_GRADE, SELECT_FROM = 2, 0.5

# Slots of words and n-grams, then of character classes, then of repeated words.
_HASHED, _CLASS_BITS = 1 << BITS, 16
_REPEATS = _HASHED + (1 << _CLASS_BITS)
_SLOTS = _REPEATS + 1
_bytes = np.arange(256)
_CLASS = _bytes.astype(np.uint32)
_CLASS[(_bytes >= 0x41) & (_bytes <= 0x5A)] = ord("A")
_CLASS[((_bytes >= 0x61) & (_bytes <= 0x7A)) | (_bytes >= 0x80)] = ord("a")
_CLASS[(_bytes >= 0x30) & (_bytes <= 0x39)] = ord("0")


def _once(text: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, slot, occurrences), each pair once."""
    keys, counts = np.unique(text * _SLOTS + slot, return_counts=True)
    return keys // _SLOTS, keys % _SLOTS, counts


def features(run: Run, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, slot, value) of each text's features, of the `known` slots only where given."""
    use = lambda text, slot: (text[known[slot]], slot[known[slot]]) if known is not None else (text, slot)
    words = run.word_hash
    text, slot, _ = _once(*use(run.word_text, (salted(words, 5) >> np.uint64(64 - BITS)).astype(np.int64)))
    parts = [(text, slot, np.ones(len(text)))]
    if len(run.data) >= GRAM_BYTES:
        plain = np.where(run.breaks[run.data], 0x20, run.lowered_data).astype(np.uint64)
        last = len(plain) - GRAM_BYTES + 1
        code = sum(plain[i : i + last] << np.uint64(8 * i) for i in range(GRAM_BYTES))
        inside = run.byte_text[:last] == run.byte_text[GRAM_BYTES - 1 :]
        slot = (salted(code[inside], 6) >> np.uint64(64 - BITS)).astype(np.int64)
        text, slot, _ = _once(*use(run.byte_text[:last][inside], slot))
        parts.append((text, slot, np.ones(len(text))))
    if len(run.data) >= 4:
        kind = _CLASS[run.data]
        code = kind[:-3] | kind[1:-2] << 8 | kind[2:-1] << 16 | kind[3:] << 24
        text_of = run.byte_text
        inside = text_of[:-3] == text_of[3:]
        grams = np.bincount(text_of[:-3][inside], minlength=run.texts)
        slot = ((code[inside] * np.uint32(0x9E3779B1)) >> np.uint32(32 - _CLASS_BITS)).astype(np.int64) + _HASHED
        text, slot, counts = _once(*use(text_of[:-3][inside], slot))
        parts.append((text, slot, SHARE_SCALE * counts / grams[text]))
    same = np.flatnonzero((words[1:] == words[:-1]) & (run.word_text[1:] == run.word_text[:-1])) + 1
    again = np.bincount(run.word_text[same], minlength=run.texts)
    some = np.flatnonzero(again) if known is None or known[_REPEATS] else np.zeros(0, dtype=np.int64)
    parts.append((some, np.full(len(some), _REPEATS), SHARE_SCALE * again[some] / run.words[some]))
    return tuple(np.concatenate(part) for part in zip(*parts, strict=True))


class Model:
    """Weights of the used slots and the ordered thresholds."""

    def __init__(self, slots: np.ndarray, weights: np.ndarray, thresholds: np.ndarray):
        self.slots, self.weights, self.thresholds = slots, weights, thresholds

    @property
    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.slots, self.weights, self.thresholds

    @cached_property
    def _dense(self) -> tuple[np.ndarray, np.ndarray]:
        weights, known = np.zeros(_SLOTS, dtype=np.float32), np.zeros(_SLOTS, dtype=bool)
        weights[self.slots], known[self.slots] = self.weights, True
        return weights, known

    def reaches(self, run: Run) -> np.ndarray:
        """P(grade >= k) of each text, a column for each k from 1 on."""
        weights, known = self._dense
        text, slot, value = features(run, known)
        score = np.bincount(text, weights=weights[slot] * value, minlength=run.texts)
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -30, 30)))


def train(texts: pa.Array, grades: np.ndarray, steps: int = STEPS) -> Model:
    """L-BFGS on the cumulative-link likelihood with an L2 penalty.

    Thresholds are a first value and exponentials of gaps, which keeps them in order. Grades are whole
    numbers from 0; with fewer than two of them the model says that every text has the one there is.
    """
    top = int(max(grades.max(initial=0), SELECT_GRADE))
    if len(grades) == 0 or grades.min() == grades.max():
        only = int(grades[0]) if len(grades) else top
        thresholds = np.where(np.arange(1, top + 1) <= only, -10.0, 10.0)
        return Model(np.zeros(0, dtype=np.int64), np.zeros(0), thresholds)
    # A first pass only counts in how many texts, and in how many of each grade, a slot is.
    having = np.zeros(_SLOTS, dtype=np.int32)
    reaching = np.zeros((top, _SLOTS), dtype=np.int32)
    for row, run in runs(texts, lowered=True, blank_words=False):
        text, slot, _ = features(run)
        np.add.at(having, slot, 1)
        for k in range(1, top + 1):
            np.add.at(reaching[k - 1], slot[grades[text + row] >= k], 1)
    deviation = np.zeros(_HASHED)
    for k in range(1, top + 1):
        share = (grades >= k).mean()
        spread = np.sqrt(having * share * (1 - share) * (1 - having / len(grades)) + 1e-9)
        deviation = np.maximum(deviation, (np.abs(reaching[k - 1] - having * share) / spread)[:_HASHED])
    deviation[(having[:_HASHED] < LEAST_TEXTS) | (deviation < LEAST_DEVIATION)] = 0
    most = np.argsort(-deviation, kind="stable")[: max(1, len(grades) // TEXTS_PER_SLOT)]
    classes = _HASHED + np.flatnonzero(having[_HASHED:] >= LEAST_TEXTS)
    slots = np.concatenate([np.sort(most[deviation[most] > 0]), classes])
    column = np.full(_SLOTS, -1, dtype=np.int32)
    column[slots] = np.arange(len(slots))
    known = column >= 0
    parts = []
    for row, run in runs(texts, lowered=True, blank_words=False):
        text, slot, value = features(run, known)
        parts.append((text + row, column[slot], value))
    text, at, value = (np.concatenate(part) for part in zip(*parts, strict=True))
    width = len(slots)
    at_least = np.array([(grades >= k).mean() for k in range(1, top + 1)]).clip(1e-3, 1 - 1e-3)
    first = np.log(1 / at_least - 1)
    gaps = np.log(np.maximum(np.diff(first), 0.1))
    loss = likelihood(grades, top, (text, at, value), width)
    at_end = minimize(loss, np.concatenate([np.zeros(width), first[:1], gaps]), steps)
    return Model(slots, at_end[:width], _thresholds(at_end[width:]))


def likelihood(grades: np.ndarray, top: int, entries: tuple[np.ndarray, np.ndarray, np.ndarray], width: int):
    """The penalised cumulative-link loss of (weights, first threshold, log gaps), with its gradient.

    `entries` are (text, column, value) of the features; grades run from 0 to `top`.
    """
    text, at, value = entries
    n = len(grades)
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))
    rows = np.arange(n)

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        thresholds = _thresholds(x[width:])
        score = np.bincount(text, weights=x[at] * value, minlength=n)
        below = np.concatenate([np.zeros((n, 1)), sigmoid(thresholds - score[:, None]), np.ones((n, 1))], axis=1)
        upper, lower = below[rows, grades + 1], below[rows, grades]
        p = np.maximum(upper - lower, 1e-12)
        by_score = (1 - upper - lower) / n
        by_threshold = np.zeros((n, top + 2))
        by_threshold[rows, grades + 1] -= upper * (1 - upper) / p / n
        by_threshold[rows, grades] += lower * (1 - lower) / p / n
        per = by_threshold[:, 1:-1].sum(axis=0)
        by_weight = np.bincount(at, weights=by_score[text] * value, minlength=width) + PENALTY / n * x[:width]
        by_gap = [per[k + 1 :].sum() * np.exp(x[width + 1 + k]) for k in range(top - 1)]
        total = -np.log(p).mean() + PENALTY / n / 2 * (x[:width] ** 2).sum()
        return float(total), np.concatenate([by_weight, [per.sum()], by_gap])

    return loss


def _thresholds(x: np.ndarray) -> np.ndarray:
    return x[0] + np.concatenate([[0.0], np.cumsum(np.exp(x[1:]))])


def minimize(loss, x: np.ndarray, steps: int, memory: int = 10) -> np.ndarray:
    """Limited-memory BFGS with a backtracking line search."""
    value, gradient = loss(x)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        direction, kept = gradient.copy(), []
        for s, y in reversed(moves):
            kept.append((s @ direction) / (s @ y))
            direction -= kept[-1] * y
        if moves:
            s, y = moves[-1]
            direction *= (s @ y) / (y @ y)
        for (s, y), a in zip(moves, reversed(kept), strict=True):
            direction += s * (a - (y @ direction) / (s @ y))
        slope, rate = gradient @ direction, 1.0
        if slope <= 1e-12:
            break
        while rate > 1e-6:
            new = x - rate * direction
            new_value, new_gradient = loss(new)
            if new_value <= value - 1e-4 * rate * slope:
                break
            rate /= 2
        else:
            break
        s, y = new - x, new_gradient - gradient
        if s @ y > 1e-12:
            moves = [*moves[1 - memory :], (s, y)]
        done = value - new_value < 1e-6
        x, value, gradient = new, new_value, new_gradient
        if done:
            break
    return x


_SAMPLE = pa.schema([("text", pa.string()), ("grade", pa.int32()), ("draw", pa.int64())])


def grades(labels: DataFrame) -> DataFrame:
    """doc_id, grade: 0 poor, 1 toxic but well written, 2 good. Unrated rows are left out."""
    grade = F.when(F.col("quality") <= 0, 0).when(F.col("toxic") > 0, 1).otherwise(2)
    return labels.filter("quality IS NOT NULL").select("doc_id", grade.alias("grade"))


def fit(docs: DataFrame, rated: DataFrame, rows: int = TRAINING_ROWS) -> Model:
    """Train on at most `rows` rated documents (doc_id, grade), chosen by hash, in one task.

    An id that is rated more than once counts with its lowest grade, and one that several rows have
    with one of their texts. Texts over TRAINING_TEXT_BYTES are left out, so one task can hold the
    sample: 256 MB at most.
    """
    lowest = rated.groupBy("doc_id").agg(F.min("grade").alias("grade"))
    sample = sample_texts(docs, seeded_sample(lowest, "doc_id", rows, SEED), TRAINING_TEXT_BYTES)
    sample = sample.select("text", F.col("grade").cast("int"), F.xxhash64(F.lit(SEED + 1), "doc_id").alias("draw"))

    def train_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = gathered(batches, _SAMPLE).sort_by([("draw", "ascending")])
        model = train(every["text"], every["grade"].to_numpy())
        keys = np.concatenate([-1 - np.arange(len(model.thresholds)), model.slots])
        values = np.concatenate([model.thresholds, model.weights])
        yield pa.RecordBatch.from_pydict({"slot": keys.astype(np.int64), "value": values.astype(float)})

    fitted = stored(sample.repartition(1).mapInArrow(train_all, "slot bigint, value double"), "grade-model")
    found = fitted.toPandas().sort_values("slot")
    if not len(found):  # without rows the task may not run
        return train(pa.array([], pa.string()), np.zeros(0, dtype=np.int32))
    slot, value = found["slot"].to_numpy(), found["value"].to_numpy()
    return Model(slot[slot >= 0], value[slot >= 0], value[slot < 0][::-1])


def score(docs: DataFrame, model: Model) -> tuple[DataFrame, str, str]:
    """All columns of `docs` with the expected grade and the tail probability, and those two's names.

    Null and empty texts have no features; their score is 0. Rows stay as they are, repeated or with
    null ids, and no shuffle is made. Names that `docs` already has get an underscore.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.arrays)
    expected, tail = free_name(docs, "expected_grade"), free_name(docs, "select_probability")
    text_at = [c.lower() for c in docs.columns].index("text")
    schema = T.StructType(
        [*docs.schema.fields, T.StructField(expected, T.DoubleType()), T.StructField(tail, T.DoubleType())]
    )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            for row, run in runs(batch.column(text_at), lowered=True, blank_words=False):
                reaches = model.reaches(run)
                part = batch.slice(row, run.texts)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(reaches.sum(axis=1)), pa.array(reaches[:, SELECT_GRADE - 1])],
                    names=[*part.schema.names, expected, tail],
                )

    return docs.mapInArrow(add, schema), expected, tail


def select(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that the model selects, with their columns."""
    scored, _, tail = score(docs, model)
    return scored.filter(F.col(tail) >= SELECT_FROM).select(*docs.columns)

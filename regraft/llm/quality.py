"""Quality classifier: n-gram indicators scaled by class log-count ratios, then a linear hinge-loss model.

The n-grams of a text are its byte trigrams, sequences of five character-class
runs (capitals, small letters, digits, blanks, line ends, stops, other signs)
and sequences over "this word repeats the one before" and "this four-word
sequence came before", all hashed to ``SLOTS`` indicators. The log-count ratios
come from all labelled rows given; the model is fitted by dual coordinate
descent on at most ``FIT_ROWS`` of them, those of smallest hash. A logistic
curve through the margins makes scores between 0 and 1.

Defined results: null and empty texts have no n-gram and get the score of the
intercept; labels that are null or neither 0 nor 1 teach nothing; if a document
is labelled more than once, each label counts; with one class only, or no label
at all, every score is the share of label 1 (0.5 without any). Rows that repeat
are scored alike. A document without an id is scored like any other, and isn't
held out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, id_bits, in_arrow, marked_ids, per_batch, rows_of, stage, texts

SLOTS = 1 << 16
#: Labelled rows that the linear model is fitted on; the log-count ratios use all.
FIT_ROWS = 8_000
CHUNK = 1 << 12

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _character_classes() -> np.ndarray:
    classes = np.full(256, 6, np.uint8)
    classes[[*range(97, 123), *range(128, 256)]] = 0
    classes[65:91] = 1
    classes[48:58] = 2
    classes[[32, 9, 11, 12]] = 3
    classes[[10, 13]] = 4
    classes[[ord(c) for c in ".,;:?'\"-()"]] = 5
    return classes


CLASSES = _character_classes()
_POWERS = np.cumprod(np.full(4096, 0x100000001B3, np.uint64))


def _slots(codes: np.ndarray, salt: int) -> np.ndarray:
    return (((codes.astype(np.uint64) << np.uint64(4)) + np.uint64(salt)) * _MIX >> np.uint64(48)).astype(np.int64)


def _windows(codes: np.ndarray, length: int, base: int) -> np.ndarray:
    """Each run of ``length`` codes as one number."""
    if len(codes) < length:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(codes) - length + 1, np.uint64)
    for i in range(length):
        total = total * np.uint64(base) + codes[i : len(codes) - length + 1 + i].astype(np.uint64)
    return total


def word_hashes(data: np.ndarray, blank: np.ndarray) -> np.ndarray:
    inside = np.concatenate([[False], ~blank, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    values = (data[~blank].astype(np.uint64) + np.uint64(1)) * _POWERS[np.minimum(place, 4095)]
    return np.add.reduceat(values, np.cumsum(lengths) - lengths)


def indicators(text: str) -> np.ndarray:
    """The slots of a whole text's n-grams, ascending, as ``uint16``."""
    data = np.frombuffer(text.encode(), np.uint8)
    seen = np.zeros(SLOTS, bool)
    seen[_slots(_windows(data, 3, 256), 0)] = True
    classes = CLASSES[data]
    if len(classes):
        runs = classes[np.concatenate([[True], classes[1:] != classes[:-1]])]
        seen[_slots(_windows(runs, 5, 7), 1)] = True
    words = word_hashes(data, (classes == 3) | (classes == 4))
    if len(words) > 1:
        repeats = (words[1:] == words[:-1]).astype(np.uint8)
        for n in (1, 2, 3):
            seen[_slots(_windows(repeats, n, 2), 1 + n)] = True
        fours = _windows(words, 4, 0x5851F42D)
        if len(fours):
            _, first = np.unique(fours, return_index=True)
            again = np.ones(len(fours), np.uint8)
            again[first] = 0
            for n in (1, 8):
                seen[_slots(_windows(again, n, 2), 4 + n)] = True
    return np.flatnonzero(seen).astype(np.uint16)


@dataclass
class QualityModel:
    ratios: np.ndarray
    weights: np.ndarray
    intercept: float
    slope: float
    offset: float

    def margin(self, slots: np.ndarray) -> float:
        scaled = self.ratios[slots]
        length = np.sqrt(scaled @ scaled) or 1.0
        return float(scaled @ self.weights[slots] / length + self.intercept)

    def score(self, slots: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(slots) + self.offset, -30, 30))))


def class_counts(labelled: DataFrame) -> np.ndarray:
    """Indicator counts of label 0 and 1 over all rows, shape (2, SLOTS); tasks add up before the shuffle."""

    def count(batches):
        counts = np.zeros((2, SLOTS), np.int64)
        for batch in batches:
            for slots, label in zip(batch.column("slots").to_pylist(), batch.column("label").to_pylist(), strict=True):
                counts[label, np.frombuffer(slots, np.uint16)] += 1
        parts = [(i, counts[:, i : i + CHUNK]) for i in range(0, SLOTS, CHUNK)]
        parts = [(i, part.tobytes()) for i, part in parts if part.any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in parts], pa.int64()), pa.array([p for _, p in parts], pa.binary())],
            ["chunk", "counts"],
        )

    def total(group: pa.Table) -> pa.Table:
        parts = [np.frombuffer(p, np.int64) for p in group.column("counts").to_pylist()]
        return pa.table({"chunk": group.column("chunk")[:1], "counts": pa.array([sum(parts).tobytes()], pa.binary())})

    schema = "chunk long, counts binary"
    found = np.zeros((2, SLOTS), np.int64)
    # SLOTS / CHUNK rows come to the driver, whatever the input
    for chunk, part in in_arrow(labelled, count, schema).groupBy("chunk").applyInArrow(total, schema).collect():
        found[:, chunk : chunk + CHUNK] = np.frombuffer(bytes(part), np.int64).reshape(2, -1)
    return found


def descend(rows: list[np.ndarray], values: list[np.ndarray], signs: np.ndarray, costs: np.ndarray, rounds: int = 12):
    """Dual coordinate descent for the L2-regularised squared hinge loss; the last weight is the intercept."""
    weights = np.zeros(SLOTS + 1)
    duals = np.zeros(len(rows))
    curvature = np.array([v @ v + 1 for v in values]) + 0.5 / costs
    generator = np.random.default_rng(7)
    for _ in range(rounds):
        for i in generator.permutation(len(rows)):
            row, value, sign = rows[i], values[i], signs[i]
            slope = sign * (weights[row] @ value + weights[-1]) - 1 + duals[i] * 0.5 / costs[i]
            changed = max(duals[i] - slope / curvature[i], 0.0)
            if (step := (changed - duals[i]) * sign) != 0.0:
                weights[row] += step * value
                weights[-1] += step
                duals[i] = changed
    return weights


def logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through margins, with targets drawn in from 0 and 1."""
    ones, zeros = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    design, theta = np.stack([margins, np.ones_like(margins)], 1), np.array([1.0, 0.0])
    for _ in range(50):
        guess = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        hessian = (design * (guess * (1 - guess))[:, None]).T @ design + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, design.T @ (guess - target) + 1e-6 * theta)
        theta = theta - step
        if np.abs(step).max() < 1e-8:
            break
    return max(float(theta[0]), 1e-3), float(theta[1])


def fit_quality(documents: DataFrame, labels: DataFrame, cost: float = 1.0, fit_rows: int = FIT_ROWS) -> QualityModel:
    """Learns from ``labels(doc_id, label)``; the log-count ratios use all of its rows."""
    known = labels.select("doc_id", F.col("label").cast("int").alias("label")).where("doc_id IS NOT NULL AND label IN (0, 1)")
    bits = documents.sparkSession.sparkContext.broadcast(id_bits(known, "doc_id"))

    def featurise(batch: pa.RecordBatch) -> pa.RecordBatch:
        chosen = batch.filter(pa.array(marked_ids(bits.value, batch.column("doc_id"))))
        slots = [indicators(t).tobytes() for (t,) in rows_of(chosen, "text")]
        return pa.RecordBatch.from_arrays([chosen.column("doc_id"), pa.array(slots, pa.binary())], ["doc_id", "slots"])

    features = per_batch(texts(documents), featurise, "doc_id long, slots binary")
    labelled = stage(features.hint("merge").join(known, "doc_id"), "labelled")
    zeros, ones = class_counts(labelled.select("slots", "label"))
    sample = bounded_sample(labelled, "doc_id", fit_rows, "label", "slots").select("label", "slots").collect()
    y = np.array([r.label for r in sample])
    if len(set(y.tolist())) < 2:
        share = float(np.clip(y.mean(), 0.001, 0.999)) if len(y) else 0.5
        return QualityModel(np.zeros(SLOTS), np.zeros(SLOTS), 0.0, 1.0, float(np.log(share / (1 - share))))
    smooth = np.log((ones + 1) / (ones + 1).sum()) - np.log((zeros + 1) / (zeros + 1).sum())
    ratios = np.where(ones + zeros > 1, smooth, 0.0)
    rows = [np.frombuffer(bytes(r.slots), np.uint16) for r in sample]
    values = []
    for row in rows:
        scaled = ratios[row]
        values.append(scaled / (np.sqrt(scaled @ scaled) or 1.0))
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    weights = descend(rows, values, 2.0 * y - 1, cost * balance)
    model = QualityModel(ratios, weights[:-1], float(weights[-1]), 1.0, 0.0)
    model.slope, model.offset = logistic(np.array([model.margin(r) for r in rows]), y)
    return model


def score_quality(documents: DataFrame, model: QualityModel) -> DataFrame:
    """``doc_id, score`` for every row. The model (1 MB, of fixed size) is broadcast."""
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = [sent.value.score(indicators(t)) for (t,) in rows_of(batch, "text")]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return per_batch(texts(documents), work, "doc_id long, score double")


def accepted(documents: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The documents that score ``threshold`` or more, with all their columns."""
    model = fit_quality(documents, labels.select("doc_id", F.col("quality").alias("label")))
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        for batch in batches:
            scores = np.array([sent.value.score(indicators(t or "")) for (t,) in rows_of(batch, "text")])
            yield batch.filter(pa.array(scores >= threshold))

    return in_arrow(documents, work, documents.schema)


def held_out():
    """Rows that are never learnt from; a row without an id isn't one of them, and has no label either."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def quality(documents: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted``; ``labels`` has ``doc_id`` and ``quality``."""
    known = labels.select("doc_id", F.col("quality").alias("label")).where(~held_out())
    scored = score_quality(documents, fit_quality(documents, known))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )

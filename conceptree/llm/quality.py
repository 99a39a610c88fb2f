"""Quality scores: ridge regression on random Fourier features of document statistics.

Each text gives a row of statistics. Cosines of random projections of the standardised statistics
approximate a Gaussian kernel; the normal equations are summed by partition and solved with a
ridge; an isotonic fit on rows that the ridge has not seen turns its values into probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from conceptree.llm.langid import fold
from conceptree.llm.words import Words, bounded, grams, small_batches
from conceptree.session import materialize

#: Labelled rows that the scores are fitted on, about, and the partitions that they are summed in.
SAMPLE_ROWS, PARTS = 40_000, 8
FEATURES = 192
RIDGE = 1e-3
#: One in so many sampled rows is kept for the isotonic fit.
CALIBRATED = 4
BINS = 2000
_CLASSES = {
    "upper": [*range(65, 91)],
    "lower": [*range(97, 123)],
    "digit": [*range(48, 58)],
    "stop": [33, 46, 63],
    "mark": [33],
    "comma": [44, 58, 59],
    "symbol": [35, 36, 37, 38, 42, 43, 60, 61, 62, 64, 91, 93, 94, 95, 123, 124, 125, 126],
    "line": [10],
    "high": [*range(128, 256)],
}
NAMES = ["log_words", "word_length", "length_spread", "distinct", "repeated", "distinct_pairs", "repeated_lines", *_CLASSES]


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``NAMES`` for each text; all zero if it has no words."""
    words = Words(texts)
    n = words.counts()
    out = np.zeros((len(n), len(NAMES)))
    full = np.flatnonzero(n)
    if not len(full):
        return out
    h = words.hashes()
    first = words.first
    lengths = (words.ends - words.starts).astype(float)
    begin, count = first[full], n[full].astype(float)
    mean = np.add.reduceat(lengths, begin) / count
    out[full, 0] = np.log1p(count)
    out[full, 1] = np.log(mean)
    out[full, 2] = np.sqrt(np.maximum(np.add.reduceat(lengths**2, begin) / count - mean**2, 0)) / mean
    same = np.append(h[1:] == h[:-1], False)
    same[first[full + 1] - 1] = False
    out[full, 4] = np.add.reduceat(same.astype(float), begin) / count
    pairs = grams(h, 2)
    plain = texts.to_pylist()
    for i, a, b in zip(full.tolist(), begin.tolist(), first[full + 1].tolist(), strict=True):
        out[i, 3] = len(np.unique(h[a:b])) / (b - a)
        out[i, 5] = len(np.unique(pairs[a : b - 1])) / (b - 1 - a) if b - a > 1 else 1.0
        lines = [line for line in plain[i].split("\n") if line]
        out[i, 6] = 1 - len(set(lines)) / len(lines) if lines else 0.0
    letters = np.add.reduceat(lengths, begin)
    # From each text's first byte to its own last one; every second sum is what lies between two such texts.
    spans = np.stack([words.borders[full], words.borders[full + 1]], axis=1).ravel()
    for k, codes in enumerate(_CLASSES.values()):
        table = np.zeros(256)
        table[codes] = 1
        sums = np.add.reduceat(np.append(table[words.data], 0.0), spans)[::2]
        out[full, len(NAMES) - len(_CLASSES) + k] = sums / letters
    return out


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in bounded(whole, "text"):
            x = statistics(batch.column("text"))
            yield pa.record_batch([batch.column("doc_id"), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "x"])


@dataclass
class QualityModel:
    """Standardisation, projection, ridge weights, and the isotonic fit's corners."""

    mean: np.ndarray
    spread: np.ndarray
    turn: np.ndarray
    shift: np.ndarray
    weights: np.ndarray
    corners: np.ndarray
    levels: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -6, 6)
        waves = np.cos(z @ self.turn + self.shift) * np.sqrt(2 / self.turn.shape[1])
        return np.concatenate([waves, np.ones((len(x), 1))], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """The isotonic level, with a thousandth left to keep the order within a level."""
        raw = self.raw(x)
        level = np.interp(raw, self.corners, self.levels) if len(self.corners) else np.full(len(raw), 0.5)
        return np.clip(0.999 * level + 0.001 / (1 + np.exp(-np.clip(raw, -30, 30))), 0, 1)


def isotonic(at: np.ndarray, mean: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: corners and non-decreasing levels."""
    blocks: list[list[float]] = []  # level, weight, first, last
    for x, y, w in zip(at.tolist(), mean.tolist(), weight.tolist(), strict=True):
        blocks.append([y, w, x, x])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            y2, w2, _, last = blocks.pop()
            y1, w1, first, _ = blocks.pop()
            blocks.append([(y1 * w1 + y2 * w2) / (w1 + w2), w1 + w2, first, last])
    corners = [x for b in blocks for x in ([b[2]] if b[2] == b[3] else [b[2], b[3]])]
    levels = [b[0] for b in blocks for _ in ([0] if b[2] == b[3] else [0, 1])]
    return np.array(corners), np.array(levels)


def _x(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, len(NAMES)))
    n = 0
    for batch in batches:
        x = _x(batch)
        total += np.stack([x.sum(axis=0), (x**2).sum(axis=0)])
        n += len(x)
    yield pa.record_batch([pa.array([n]), pa.array([total.ravel()], pa.list_(pa.float64()))], ["n", "sums"])


def _equations(model: QualityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = model.turn.shape[1] + 1
        left, right = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            z, y = model.features(_x(batch)), batch.column("y").to_numpy()
            left += z.T @ z
            right += z.T @ y
        yield pa.record_batch([pa.array([np.append(left.ravel(), right)], pa.list_(pa.float64()))], ["sums"])

    return run


def _raw(model: QualityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.round(model.raw(_x(batch)) * BINS)
            yield pa.record_batch([pa.array(raw), batch.column("y")], ["raw", "y"])

    return run


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = 3) -> QualityModel:
    """Fit on ``labelled`` (doc_id, x, y), about ``sample_rows`` of it by hash of the id.

    The driver gets the sums of ``PARTS`` partitions and the counts of at most a few thousand bins.
    """
    n = labelled.count()
    random = np.random.Generator(np.random.PCG64(seed))
    turn = random.normal(size=(len(NAMES), FEATURES)) / np.sqrt(len(NAMES)) * 1.5
    shift = random.uniform(0, 2 * np.pi, FEATURES)
    none = np.zeros(0)
    model = QualityModel(np.zeros(len(NAMES)), np.ones(len(NAMES)), turn, shift, np.zeros(FEATURES + 1), none, none)
    if not n:
        return model
    draw = (F.xxhash64(F.lit(seed), "doc_id") / F.lit(float(1 << 63)) + 1) / 2
    sample = materialize(
        labelled.where(draw <= sample_rows / n).withColumn("part", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(CALIBRATED))),
        "training",
    )
    fitted = sample.where("part > 0").select("x", "y").coalesce(PARTS)
    sums = [(r["n"], np.array(r["sums"]).reshape(2, -1)) for r in fitted.mapInArrow(_moments, "n long, sums array<double>").collect()]
    count = max(1, sum(k for k, _ in sums))
    mean, square = sum(s for _, s in sums) / count
    model.mean, model.spread = mean, np.sqrt(np.maximum(square - mean**2, 0)) + 1e-3
    size = FEATURES + 1
    total = sum(np.array(r["sums"]) for r in fitted.mapInArrow(_equations(model), "sums array<double>").collect())
    left, right = total[: size * size].reshape(size, size), total[size * size :]
    model.weights = np.linalg.solve(left + RIDGE * count * np.eye(size) / size, right)
    bins = (
        sample.where("part = 0")
        .select("x", "y")
        .mapInArrow(_raw(model), "raw double, y double")
        .groupBy("raw")
        .agg(F.avg("y").alias("mean"), F.count(F.lit(1)).alias("n"))
        .orderBy("raw")
        .toPandas()
    )
    model.corners, model.levels = isotonic(bins["raw"].to_numpy() / BINS, bins["mean"].to_numpy(), bins["n"].to_numpy(float))
    return model


def _scored(model: QualityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(_x(batch)) if batch.num_rows else np.zeros(0)
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"]
            )

    return run


def score_quality(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of ``docs`` (doc_id, text).

    Fitted on ``labels`` (doc_id, quality 0 or 1) outside the fold ``held``. Other and null labels
    are left out, and repeated ones each count. A row without doc_id is held out. Texts without
    words, null among them, have all statistics zero and get the score of that. Without any label
    every score is close to 0.5.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    x = materialize(rows.mapInArrow(_statistics, f"doc_id {kind}, x array<double>"), "statistics")
    known = labels.where("quality in (0, 1)").select("doc_id", F.col("quality").cast("double").alias("y"))
    labelled = x.join(known, "doc_id").where(fold(folds) != held)
    model = fit(labelled)
    scored = x.mapInArrow(_scored(model), f"doc_id {kind}, score double, predicted int")
    return scored.select("doc_id", F.coalesce(fold(folds) == held, F.lit(True)).alias("held_out"), "score", "predicted")

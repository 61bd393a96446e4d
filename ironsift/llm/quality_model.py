"""Quality classifier: kernel ridge regression on document statistics, calibrated by isotonic regression.

Method: random Fourier features z(x) = sqrt(2 / D) cos(W x + b) approximate a Gaussian kernel over standardised
statistics of the text. Each partition sums its part of the normal equations (Z'Z and Z'y); the parts are added up
in a tree, and the driver solves one system of D + 1 unknowns. Scores of rows that the fit has not seen are then
calibrated: they are summed in fine bins over all partitions, and pool-adjacent-violators makes the rate of label
1 a monotone function of the score. Fit and calibration use every labelled row that is not held out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ironsift.llm.arrowtext import SPACES, U, id_and_text, mix, pieces, rows_of, text_buffers, tokens
from ironsift.llm.compression_rules import base_counts
from ironsift.llm.shared import kept

FEATURES = ["log_bytes", "log_words", "word_length", "longest_word", "symbols", "dup_lines", "repeat_words", "digits", "capitals", "punctuation", "spaces", "non_ascii", "distinct_words", "top_word", "lines", "ratio"]
N_FOURIER = 384
RIDGE = 1e-3
BINS = 1000
SEED = 20240817
TREE = 16

_DIGITS, _CAPITALS, _PUNCTUATION, _HIGH, _LINES = (np.zeros(256, bool) for _ in range(5))
_DIGITS[48:58] = True
_CAPITALS[65:91] = True
_PUNCTUATION[[ord(x) for x in ".,;:!?\"'()-"]] = True
_HIGH[128:] = True
_LINES[10] = True


def statistics(data: np.ndarray, offs: np.ndarray, press: zstandard.ZstdCompressor) -> np.ndarray:
    """One row of FEATURES for each text."""
    n = np.diff(offs)
    n_words, letters, symbols, dup_lines, repeat = (x.astype(float) for x in base_counts(data, offs))
    some, worded = np.maximum(n, 1), np.maximum(n_words, 1)
    ids, starts, ends = tokens(data, offs)
    row, first = rows_of(starts, offs)
    longest, top, distinct = np.zeros(len(n)), np.zeros(len(n)), np.zeros(len(n))
    np.maximum.at(longest, row, (ends - starts).astype(float))
    keys = np.sort(mix(ids ^ mix(row.astype(U) + U(7))))
    order = np.argsort(mix(ids ^ mix(row.astype(U) + U(7))), kind="stable")
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    of = row[order][at]
    np.add.at(distinct, of, 1)
    np.maximum.at(top, of, np.diff(np.concatenate((at, [len(keys)]))).astype(float))
    share = lambda table: np.diff(np.concatenate(([0], np.cumsum(table[data])))[offs]) / some
    raw = data.tobytes()
    ratio = [len(press.compress(raw[a:b])) / (b - a) if b > a else 1.0 for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
    lines = share(_LINES) * n
    return np.stack([np.log1p(n), np.log1p(n_words), letters / worded, np.log1p(longest), symbols / some, dup_lines / np.maximum(lines + 1, 1), repeat / worded, share(_DIGITS), share(_CAPITALS), share(_PUNCTUATION), share(SPACES), share(_HIGH), distinct / worded, top / worded, lines / worded, np.minimum(ratio, 1.5)], 1)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        data, offs = text_buffers(batch.column("text"))
        for a, b in pieces(offs):
            x = statistics(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a], press)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), *(pa.array(c) for c in x.T)], ["doc_id", *FEATURES])


class Model:
    """Fourier features of standardised statistics, ridge weights and a calibration curve."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray) -> None:
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = mean, np.where(scale > 1e-9, scale, 1.0)
        self.w = rng.normal(0, 1 / np.sqrt(len(FEATURES)), (len(FEATURES), N_FOURIER))
        self.b = rng.uniform(0, 2 * np.pi, N_FOURIER)
        self.weights = np.zeros(N_FOURIER + 1)
        self.curve = (np.array([0.0, 1.0]), np.array([0.5, 0.5]))

    def fourier(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.scale, -5, 5)
        z = np.sqrt(2 / N_FOURIER) * np.cos(x @ self.w + self.b)
        return np.concatenate((z, np.ones((len(z), 1))), 1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.fourier(x) @ self.weights, 0, 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        return np.clip(0.99 * np.interp(raw, *self.curve) + 0.01 * raw, 0, 1)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in FEATURES], 1) if batch.num_rows else np.zeros((0, len(FEATURES)))


def _sums(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One row for each partition: its part of the normal equations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = N_FOURIER + 1
        total = np.zeros((size, size + 1))
        for batch in batches:
            z = model.fourier(_matrix(batch))
            total[:, :size] += z.T @ z
            total[:, size] += z.T @ batch.column("label").to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for x in batch.column("part"):
            x = np.frombuffer(x.as_py())
            total = x.copy() if total is None else total + x
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])


def _binned(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, ones = np.zeros(BINS), np.zeros(BINS)
        for batch in batches:
            at = np.minimum((model.raw(_matrix(batch)) * BINS).astype(int), BINS - 1)
            np.add.at(n, at, 1)
            np.add.at(ones, at, batch.column("label").to_numpy(zero_copy_only=False))
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n[used]), pa.array(ones[used])], ["bin", "n", "ones"])

    return run


def isotonic(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The non-decreasing values nearest to the given ones (weighted squares)."""
    groups: list[list[float]] = []
    for v, w in zip(value, weight, strict=True):
        groups.append([v, w, 1])
        while len(groups) > 1 and groups[-2][0] >= groups[-1][0]:
            v2, w2, n2 = groups.pop()
            v1, w1, n1 = groups.pop()
            groups.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.concatenate([np.full(int(n), v) for v, _, n in groups]) if groups else np.zeros(0)


def remainder(doc_id: str) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def fit(measured: DataFrame, labels: DataFrame) -> Model:
    """A model from all labelled rows (doc_id, label) of the measured documents that are not held out."""
    stats = measured.agg(*(f(c).alias(f"{k}_{c}") for c in FEATURES for k, f in (("m", F.avg), ("s", F.stddev_pop)))).first().asDict()
    value = lambda k: np.array([stats[f"{k}_{c}"] or 0.0 for c in FEATURES])
    model = Model(value("m"), value("s"))
    labels = labels.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.avg("label").alias("label"))
    train = kept(measured.join(labels, "doc_id").withColumn("fold", remainder("doc_id")).filter("fold <> 2"), "train")
    parts = train.filter("fold < 2").mapInArrow(_sums(model), "part binary")
    n = parts.rdd.getNumPartitions()
    while n > TREE:
        n = -(-n // TREE)
        parts = parts.repartition(n).mapInArrow(_added, "part binary")
    size = N_FOURIER + 1
    total = np.zeros((size, size + 1))
    for row in parts.collect():  # at most TREE rows of fixed size
        total += np.frombuffer(row.part).reshape(size, size + 1)
    n_rows = total[size - 1, size - 1]
    if n_rows:
        penalty = np.full(size, RIDGE * n_rows / N_FOURIER)
        penalty[-1] = 1e-9 * n_rows
        model.weights = np.linalg.solve(total[:, :size] + np.diag(penalty), total[:, size])
        bins = train.filter("fold = 3").mapInArrow(_binned(model), "bin long, n double, ones double")
        bins = sorted(bins.groupBy("bin").agg(F.sum("n").alias("n"), F.sum("ones").alias("ones")).collect())  # BINS rows at most
        if bins:
            weight = np.array([r.n for r in bins])
            rate = isotonic(np.array([r.ones for r in bins]) / weight, weight)
            model.curve = (np.array([r.bin + 0.5 for r in bins]) / BINS, rate)
    return model


def _scored(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(_matrix(batch)))], ["doc_id", "score"])

    return run


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """doc_id, held_out and score of every document; a score near 1 means that label 1 is likely.

    The label is no input of a score, nor is any column but the text. A null text counts as empty and is scored.
    A null id is scored, never labelled, and not held out. Rows that share an id are scored one by one; labels that
    share an id are averaged; null labels and others than 0 and 1 are ignored. Without labels every score is about 0.5.
    """
    schema = "doc_id long, " + ", ".join(f"{c} double" for c in FEATURES)
    measured = kept(id_and_text(docs, id_col, text_col).mapInArrow(_measured, schema), "statistics")
    model = fit(measured, labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("label")))
    out = measured.mapInArrow(_scored(model), "doc_id long, score double")
    return out.select("doc_id", F.coalesce(remainder("doc_id") == 2, F.lit(False)).alias("held_out"), "score")

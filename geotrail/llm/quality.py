"""Operator 3: quality classifier with random Fourier features, ridge regression and isotonic calibration.

Statistics of the whole text (shares of character kinds, word and line shape,
repetition) are standardised and mapped by ``features`` random cosines whose
inner products approximate a Gaussian kernel. Ridge scores come from normal
equations summed over partitions; a pooled-adjacent-violators fit over a grid
of score cells (counts per cell, so its size does not depend on the data) turns
them into monotone probabilities.

The statistics are computed once per document and written to the shared
folder; learning reads only the labelled rows of that small table.

Edge cases: null and empty texts have all-zero statistics and get a score like
any other; labels without a document, null labels and repeated labels (the
larger wins) are defined; without any label every score is 0.5; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotrail.llm.common import materialize, select_docs, small_batches, sum_vectors, text_blocks, text_column, utf8_block

# byte kinds counted per text (fixed values)
KINDS = {
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "space": b" \t\x0b\x0c\r",
    "newline": b"\n",
    "stop": b".?;:",
    "comma": b",",
    "mark": b"!",
    "symbol": b"#*$%&|<>",
    "other": b"\"'()-/+=@[]\\^_`{}~",
}
KIND_NAMES = [*KINDS, "high"]
_LUT = np.full(256, len(KINDS), np.uint8)
for _k, _chars in enumerate(KINDS.values()):
    _LUT[list(_chars)] = _k
_LUT[[b for b in range(128) if _LUT[b] == len(KINDS)]] = len(KINDS) - 1
STATS = 24
FEATURES = 320
RIDGE = 1e-3
CELLS = 2048
SEED = 20_240_711


def shape_stats(text: bytes) -> list[float]:
    """Word and line statistics of one text."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return [0.0] * 11
    kinds = len(set(words))
    pairs = len(set(zip(words, words[1:]))) if n > 1 else 1
    runs = sum(a == b for a, b in zip(words, words[1:]))
    lines = [x for x in text.split(b"\n") if x.strip()]
    ends = sum(x.rstrip()[-1:] in (b".", b"!", b"?") for x in lines)
    length = sum(map(len, words))
    long = sum(len(w) > 14 for w in words)
    bare = sum(w.isalpha() for w in words)
    return [
        np.log1p(n), kinds / n, pairs / max(1, n - 1), runs / n, 1 - len(set(lines)) / max(1, len(lines)),
        ends / max(1, len(lines)), np.log1p(len(lines)), length / n, long / n, bare / n, n / max(1, len(lines)) / 100.0,
    ]


def statistics(col: pa.Array) -> np.ndarray:
    """One row of STATS numbers per text of a string column without nulls."""
    out = np.zeros((len(col), STATS))
    for lo, hi in text_blocks(col):
        data, off = utf8_block(col.slice(lo, hi - lo))
        size = np.diff(off)
        rows = np.repeat(np.arange(hi - lo, dtype=np.int64), size)
        kinds = len(KIND_NAMES)
        counts = np.bincount(rows * kinds + _LUT[data], minlength=(hi - lo) * kinds).reshape(-1, kinds)
        out[lo:hi, :kinds] = counts / np.maximum(1, size)[:, None]
        out[lo:hi, kinds] = np.log1p(size)
        raw = data.tobytes()
        for k in range(hi - lo):
            out[lo + k, kinds + 1 : kinds + 12] = shape_stats(raw[off[k] : off[k + 1]])
        # per word rates of symbol and mark bytes
        out[lo:hi, kinds + 12] = np.log1p(counts[:, KIND_NAMES.index("symbol")]) - out[lo:hi, kinds + 1]
    return out


def document_stats(docs: DataFrame) -> DataFrame:
    """``doc_id, stats (array<double>)``."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = statistics(text_column(batch))
            lists = pa.ListArray.from_arrays(np.arange(0, s.size + 1, STATS, dtype=np.int32), s.ravel())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "stats"])

    return select_docs(docs).mapInArrow(run, "doc_id long, stats array<double>")


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    edges: np.ndarray       # isotonic: score cells' upper bounds and values
    levels: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -4, 4)
        phi = np.sqrt(2.0 / len(self.phases)) * np.cos(z @ self.directions + self.phases)
        return np.hstack([phi, z, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(self.features(stats) @ self.weights, 0.0, 1.0)

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.edges, self.levels)


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Pooled adjacent violators: the increasing sequence nearest to y (weights w), x ascending."""
    value, weight, size = [], [], []
    for yi, wi in zip(y, w):
        value.append(float(yi))
        weight.append(float(wi))
        size.append(1)
        while len(value) > 1 and value[-2] > value[-1]:
            total = weight[-2] + weight[-1]
            value[-2] = (value[-2] * weight[-2] + value[-1] * weight[-1]) / total
            weight[-2], size[-2] = total, size[-2] + size[-1]
            del value[-1], weight[-1], size[-1]
    return np.repeat(value, size)


def _stats_matrix(batch: pa.RecordBatch) -> np.ndarray:
    col = batch.column("stats")
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), STATS)


def fit(rows: DataFrame, features: int = FEATURES, ridge: float = RIDGE, cells: int = CELLS) -> QualityModel:
    """Learn from ``stats, label`` rows (label 0 or 1); three passes over that small table."""
    rng = np.random.default_rng(SEED)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * STATS + 1)
        for batch in batches:
            s = _stats_matrix(batch)
            total += np.concatenate([s.sum(axis=0), (s * s).sum(axis=0), [len(s)]])
        yield pa.RecordBatch.from_pydict({"sums": [total.tobytes()]})

    sums = sum_vectors(rows.mapInArrow(moments, "sums binary"), "sums", 2 * STATS + 1)
    n = sums[-1]
    mean = sums[:STATS] / max(1.0, n)
    scale = np.sqrt(np.maximum(sums[STATS:-1] / max(1.0, n) - mean**2, 1e-12))
    # kernel width: the squared distance of two standardised rows is 2 * STATS on average
    model = QualityModel(
        mean, scale, rng.normal(size=(STATS, features)) / np.sqrt(STATS / 2.0), rng.uniform(0, 2 * np.pi, features),
        np.zeros(features + STATS + 1), np.array([0.0, 1.0]), np.array([0.5, 0.5]),
    )
    if not n:
        return model
    d = features + STATS + 1

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d + 1))
        for batch in batches:
            phi = model.features(_stats_matrix(batch))
            y = batch.column("label").to_numpy().astype(np.float64)
            total += phi.T @ np.hstack([phi, y[:, None]])
        yield pa.RecordBatch.from_pydict({"sums": [total.tobytes()]})

    sums = sum_vectors(rows.mapInArrow(normal, "sums binary"), "sums", d * (d + 1)).reshape(d, d + 1)
    penalty = ridge * n * np.eye(d)
    penalty[-1, -1] = 1e-9
    model.weights = np.linalg.solve(sums[:, :d] + penalty, sums[:, d])

    def cell_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, cells))
        for batch in batches:
            at = np.minimum((model.raw(_stats_matrix(batch)) * cells).astype(int), cells - 1)
            y = batch.column("label").to_numpy().astype(int)
            total += np.bincount(y * cells + at, minlength=2 * cells).reshape(2, cells)
        yield pa.RecordBatch.from_pydict({"sums": [total.tobytes()]})

    count = sum_vectors(rows.mapInArrow(cell_counts, "sums binary"), "sums", 2 * cells).reshape(2, cells)
    full = np.flatnonzero(count.sum(axis=0))
    weight = count[:, full].sum(axis=0)
    level = isotonic(full, count[1, full] / weight, weight)
    model.edges, model.levels = (full + 0.5) / cells, level
    return model


def score(stats: DataFrame, model: QualityModel) -> DataFrame:
    shared = stats.sparkSession.sparkContext.broadcast(model)   # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = shared.value.score(_stats_matrix(batch)) if len(batch) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s)], names=["doc_id", "score"])

    return stats.select("doc_id", "stats").mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, held_out, train=None) -> DataFrame:
    """``doc_id, held_out, score``: learn from labelled rows that are not held out, score every row.

    ``held_out`` maps an id column to a boolean column; ``labels`` has ``doc_id, quality``.
    """
    stats = materialize(document_stats(docs), "quality-stats")
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max("quality").cast("int").alias("label")
    )
    rows = stats.join(known.where(~held_out(F.col("doc_id"))), "doc_id").select("stats", "label")
    model = fit(materialize(rows, "quality-train"))
    return score(stats, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score")

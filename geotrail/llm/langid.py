"""Operator 4: language identification with string kernels, Nystroem landmarks and kernel ridge regression.

Kernel: two texts share a feature for every blended-spectrum n-gram (1 to
``max_n`` code points, hashed to 2^15 slots) present in both, whatever its
count; the kernel value is the size of the intersection over the geometric
mean of the two set sizes. ``landmarks`` training texts, the same number from
each language, span the Nystroem approximation of that kernel; one ridge
regression per language (one versus rest) is fitted on the landmark features
from normal equations summed over partitions.

A landmark's kernel value is linear in the presence vector, so the whole chain
(landmark products, Nystroem map, regression) folds into one matrix of slots x
languages: a batch of texts is scored by one product of its presence matrix.

The classifier is fitted on about ``max_rows`` labelled rows (a documented bound), taken by hash
order of id and text per language: by share, with a floor that keeps every language however rare
(:func:`quotas`). Prediction covers every row and whole texts.

Edge cases: null text or text without a letter: ``und`` with score 0; no
labelled row at all: everything is ``und``; ties go to the first language in
order; repeated rows get equal results; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geotrail.llm.common import materialize, small_batches, sum_vectors, text_column

SLOT_BITS = 15
MAX_N = 3
LANDMARKS = 192
MAX_ROWS = 12_000
RIDGE = 1e-3
SHARPNESS = 6.0        # of the softmax that turns regression values into a score
ROWS = 64              # presence matrix rows per product
UNDETERMINED = "und"
LETTER = regex.compile(r"\p{L}")
_MIX = [np.uint32(x) for x in (2654435761, 2246822519, 3266489917)]   # odd multipliers (fixed values)


def presence(text: str, out: np.ndarray, max_n: int = MAX_N) -> None:
    """Set ``out[slot] = 1`` for every n-gram of the lower-cased text."""
    codes = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    shift = np.uint32(32 - SLOT_BITS)
    for lo in range(0, len(codes), 1 << 18):
        part = codes[lo : lo + (1 << 18) + max_n - 1]
        h = part * _MIX[0]
        out[h >> shift] = 1
        for n in range(2, max_n + 1):
            if len(part) < n:
                break
            h = (h[:-1] ^ np.uint32(n)) * _MIX[1] + part[n - 1 :] * _MIX[2]
            out[((h ^ (h >> np.uint32(15))) * _MIX[0]) >> shift] = 1


def presence_blocks(texts: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, presence matrix) per block of rows; the matrix is reused."""
    m = np.zeros((ROWS, 1 << SLOT_BITS), np.float32)
    for lo in range(0, len(texts), ROWS):
        some = texts[lo : lo + ROWS]
        m[: len(some)] = 0
        for k, t in enumerate(some):
            presence(t, m[k])
        yield lo, m[: len(some)]


@dataclass
class LanguageModel:
    langs: list[str]
    weights: np.ndarray     # slots x languages
    bias: np.ndarray

    def values(self, m: np.ndarray) -> np.ndarray:
        norm = np.sqrt(np.maximum(1.0, m.sum(axis=1)))
        return (m @ self.weights) / norm[:, None] + self.bias

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        labels, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        if not self.langs:
            return labels, scores
        for lo, m in presence_blocks(texts):
            v = self.values(m)
            e = np.exp(SHARPNESS * (v - v.max(axis=1, keepdims=True)))
            e /= e.sum(axis=1, keepdims=True)
            for k, best in enumerate(v.argmax(axis=1)):
                if LETTER.search(texts[lo + k]):
                    labels[lo + k], scores[lo + k] = self.langs[best], float(e[k, best])
        return labels, scores


def quotas(counts: dict[str, int], max_rows: int) -> dict[str, int]:
    """Rows to learn from per language: all, if they are few enough; else by share, with a floor for rare languages.

    A quarter of the sample is set aside for the floors, so a language keeps rows whatever its share.
    """
    if sum(counts.values()) <= max_rows:
        return dict(counts)
    total = sum(counts.values())
    floor = max(1, max_rows // (4 * len(counts)))
    return {x: min(n, max(floor, int(max_rows * 0.75 * n / total))) for x, n in counts.items()}


def _sampled(docs: DataFrame, max_rows: int, counts: dict[str, int] | None = None) -> DataFrame:
    """Labelled rows ``text, lang``, about ``max_rows`` and some of every language, by hash of id and text.

    A hash share somewhat above each language's quota is taken first, so ranking the rest by hash never meets a whole language.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    if counts is None:
        counts = {r.lang: r["count"] for r in labelled.groupBy("lang").count().collect()}   # as many as languages
    slots = float(1 << 53)
    rows = []
    for lang, quota in quotas(counts, max_rows).items():
        wanted = quota + 6 * math.sqrt(quota) + 30   # a hash share of this size falls short of the quota almost never
        rows.append((lang, quota, int(slots * min(1.0, wanted / max(counts[lang], 1)))))
    if not rows:
        return labelled.limit(0).select("text", "lang", F.lit(0).cast("long").alias("place"))
    shares = F.broadcast(docs.sparkSession.createDataFrame(rows, "lang string, quota long, keep long"))   # one row per language
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit(11)), F.lit(1 << 53))
    picked = labelled.join(shares, "lang").withColumn("draw", draw).where(F.col("draw") < F.col("keep"))
    picked = picked.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("draw", "text")))
    return picked.where(F.col("k") <= F.col("quota")).select("text", "lang", F.xxhash64("text", "doc_id", F.lit(13)).alias("place"))


def fit(
    docs: DataFrame, train: Column | None = None, landmarks: int = LANDMARKS, max_rows: int = MAX_ROWS, ridge: float = RIDGE
) -> LanguageModel:
    """Learn from ``doc_id, text, lang`` rows (those where ``train`` holds)."""
    small_batches(docs.sparkSession)
    if train is not None:
        docs = docs.where(train)
    rows = materialize(_sampled(docs.select("doc_id", "text", "lang"), max_rows), "langid-train")
    langs = sorted(r.lang for r in rows.select("lang").distinct().collect())   # as many as languages
    if not langs:
        return LanguageModel([], np.zeros((1 << SLOT_BITS, 0), np.float32), np.zeros(0, np.float32))
    where = {x: k for k, x in enumerate(langs)}

    # landmarks: the same number of rows per language, by hash order, as packed presence vectors
    each = max(1, landmarks // len(langs))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("place", "text"))
    chosen = rows.withColumn("k", first).where(F.col("k") <= each).select("text")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [np.packbits(m.astype(np.uint8), axis=1) for _, m in presence_blocks(text_column(batch).to_pylist())]
            if bits:
                yield pa.RecordBatch.from_pydict({"bits": [row.tobytes() for b in bits for row in b]})

    packed = sorted({bytes(r.bits) for r in chosen.mapInArrow(pack, "bits binary").collect()})
    marks = np.array([np.unpackbits(np.frombuffer(b, np.uint8)) for b in packed], np.float32)
    marks /= np.sqrt(np.maximum(1.0, marks.sum(axis=1)))[:, None]
    # Nystroem map: phi(x) = K^(-1/2) k(landmarks, x)
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = values > 1e-6 * values.max()
    nystroem = (marks.T @ (vectors[:, good] / np.sqrt(values[good]))).astype(np.float32)   # slots x features
    d, c = nystroem.shape[1] + 1, len(langs)
    shared = docs.sparkSession.sparkContext.broadcast(nystroem)   # fixed size: 2^15 x landmarks floats

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d + c))
        for batch in batches:
            labels = [where[x] for x in batch.column("lang").to_pylist()]
            for lo, m in presence_blocks(text_column(batch).to_pylist()):
                phi = np.ones((len(m), d))
                phi[:, :-1] = (m @ shared.value) / np.sqrt(np.maximum(1.0, m.sum(axis=1)))[:, None]
                target = -np.ones((len(m), c))
                target[np.arange(len(m)), labels[lo : lo + len(m)]] = 1
                total += phi.T @ np.hstack([phi, target])
        yield pa.RecordBatch.from_pydict({"sums": [total.tobytes()]})

    sums = sum_vectors(rows.mapInArrow(partial, "sums binary"), "sums", d * (d + c)).reshape(d, d + c)
    n = max(1.0, sums[-1, d - 1])
    penalty = ridge * n * np.eye(d)
    penalty[-1, -1] = 1e-9
    w = np.linalg.solve(sums[:, :d] + penalty, sums[:, d:])
    return LanguageModel(langs, (nystroem @ w[:-1]).astype(np.float32), w[-1].astype(np.float32))


def predict(docs: DataFrame, model: LanguageModel, *keep: str) -> DataFrame:
    """Rows of ``docs`` (``doc_id, text`` and the columns in ``keep``) with ``lang_pred, score``; the text is not returned unless kept."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)   # slots x languages floats
    rest = [n for n in dict.fromkeys(["doc_id", *keep])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in text_column(batch).to_pylist()]
            labels, scores = shared.value.predict(texts)
            cols = [batch.column(n) for n in rest] + [pa.array(labels, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, names=[*rest, "lang_pred", "score"])

    source = docs.select(*dict.fromkeys(["doc_id", "text", *keep]))
    types = dict(source.dtypes)
    schema = ", ".join([*(f"`{n}` {types[n]}" for n in rest), "lang_pred string", "score double"])
    return source.mapInArrow(run, schema)

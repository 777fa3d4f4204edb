"""Operator 7: SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints: 64 bits, one per majority of the shingles' hash bits. Distinct
fingerprints (copies collapse first, map-side) are linked at ``max_bits`` or
fewer differing bits:

* the 64 bits are cut into parts, correlated bits together, so that skewed
  and redundant bits spoil one part instead of all of them;
* for thresholds e_i (-1: part unused) that sum to ``max_bits - parts + 1``, two
  fingerprints within ``max_bits`` must lie within e_i in some part i. Every
  fingerprint chooses its own thresholds by dynamic programming over the
  candidate counts estimated from a bounded sample, so a crowded value of one
  part is avoided by probing the others further out;
* the probes (all values within e_i of its part) meet the plain part values
  of all fingerprints in an equality join, and the pair is verified with one
  xor and bit count inside the join.

Any choice of thresholds finds every pair, so the estimate only affects
speed. Components of the links come from :mod:`geotrail.llm.graph`.

Edge cases: no word (null, empty): fingerprint zero, linked like any other;
null ids are kept, their component is the smallest non-null id (null if there
is none); repeated rows share a fingerprint; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geotrail.llm.common import join_classes, materialize, select_docs, small_batches, text_column
from geotrail.llm.graph import components

BITS = 64
SAMPLE_ROWS = 1 << 16       # fingerprints used to estimate candidate counts
BUCKET_AIM = 16             # mean fingerprints per part value before a part gets wider
PROBE_COST = 2.0            # cost of a probe row, in candidates


def fingerprint(text: str, shingle: int = 3) -> int:
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words)] if len(words) < shingle else list(map(b" ".join, zip(*(words[k:] for k in range(shingle)))))
    total = np.zeros(BITS, np.int64)
    for lo in range(0, len(grams), 1 << 16):
        h = np.frombuffer(b"".join(map(xxhash.xxh64_digest, grams[lo : lo + (1 << 16)], repeat(42))), np.uint8)
        total += np.unpackbits(h.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(grams)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed long)."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in text_column(batch).to_pylist()], np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps)], names=["doc_id", "fp"])

    return select_docs(docs).mapInArrow(run, "doc_id long, fp long")


def with_fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """All columns of ``docs`` and ``fp``."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t or "", shingle) for t in text_column(batch).to_pylist()], np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps)], names=[*batch.schema.names, "fp"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("fp", T.LongType())]))


def parts_for(n: int, max_bits: int) -> int:
    """Parts so that a part value has about BUCKET_AIM fingerprints at most, in 1 .. max_bits + 1."""
    width = max(1.0, np.log2(max(2, n) / BUCKET_AIM))
    return int(max(1, min(max_bits + 1, BITS // width)))


def correlated_parts(sample: np.ndarray, parts: int) -> list[list[int]]:
    """Group the bits greedily: each part starts with a free bit and takes the free bits most correlated with it."""
    bits = ((sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float64)
    spread = bits.std(axis=0) if len(sample) else np.zeros(BITS)
    corr = np.zeros((BITS, BITS))
    live = spread > 0
    if len(sample) > 1 and live.any():
        corr[np.ix_(live, live)] = np.abs(np.atleast_2d(np.corrcoef(bits[:, live].T)))
    free, out = list(range(BITS)), []
    for k in range(parts):
        width = BITS // parts + (k < BITS % parts)
        seed = max(free, key=lambda b: (corr[b, free].sum() - corr[b, b], -b))
        part = [seed]
        free.remove(seed)
        while len(part) < width:
            best = max(free, key=lambda b: (corr[b, part].sum(), -b))
            part.append(best)
            free.remove(best)
        out.append(sorted(part))
    return out


def project(fps: np.ndarray, part: list[int]) -> np.ndarray:
    out = np.zeros(len(fps), np.uint64)
    for k, b in enumerate(part):
        out |= ((fps >> np.uint64(b)) & np.uint64(1)) << np.uint64(k)
    return out


def masks_within(width: int, radius: int) -> np.ndarray:
    """All flips of at most ``radius`` of ``width`` bits."""
    return np.array([sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(width), r)], np.uint64)


class Allocator:
    """Thresholds per fingerprint by dynamic programming over estimated candidate counts."""

    def __init__(self, sample: np.ndarray, n: int, parts: list[list[int]], max_bits: int):
        self.parts, self.max_bits, self.n = parts, max_bits, n
        self.scale = n / max(1, len(sample))
        self.known = [np.unique(project(sample, p), return_counts=True) for p in parts]

    def _count(self, k: int, values: np.ndarray) -> np.ndarray:
        keys, counts = self.known[k]
        if not len(keys):
            return np.zeros(values.shape)
        at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
        # what the sample misses is taken as spread evenly
        return np.where(keys[at] == values, counts[at] * self.scale, self.n / 2.0 ** len(self.parts[k]))

    def thresholds(self, fps: np.ndarray) -> np.ndarray:
        budget, m = self.max_bits - len(self.parts) + 1, len(self.parts)
        radii = list(range(-1, self.max_bits + 1))
        cost = np.zeros((m, len(radii), len(fps)))
        for k, part in enumerate(self.parts):
            own = project(fps, part)
            for r in radii[1:]:
                size = len(masks_within(len(part), r))
                if r <= 1:
                    near = np.zeros(len(fps))
                    for mask in masks_within(len(part), r):
                        near += self._count(k, own ^ mask)
                else:
                    # further shells: evenly spread estimate
                    near = cost[k, r] + self.n * size / 2.0 ** len(part) + self._count(k, own)
                cost[k, r + 1] = near + PROBE_COST * size
        # best[s]: least cost of the parts so far with threshold sum s (offset by the parts: each is -1 at least)
        top = budget + m
        best = np.full((top + 1, len(fps)), np.inf)
        best[0] = 0
        choice = np.zeros((m, top + 1, len(fps)), np.int8)
        for k in range(m):
            new = np.full_like(best, np.inf)
            for r in radii:
                for s in range(r + 1, top + 1):
                    c = best[s - r - 1] + cost[k, r + 1]
                    better = c < new[s]
                    new[s][better] = c[better]
                    choice[k, s][better] = r
            best = new
        out, s = np.zeros((m, len(fps)), np.int64), np.full(len(fps), top)
        for k in reversed(range(m)):
            out[k] = choice[k, s, np.arange(len(fps))]
            s = s - out[k] - 1
        return out


def link_distinct(distinct: DataFrame, max_bits: int) -> DataFrame:
    """Distinct fingerprints (``fp``) -> linked pairs ``a, b`` (a > b), each pair of texts at least once."""
    n = distinct.count()
    # a bounded sample in hash order; it only steers the probes
    rows = distinct.orderBy(F.xxhash64("fp", F.lit(7))).limit(SAMPLE_ROWS).collect()
    sample = np.array([r.fp for r in rows], np.int64).astype(np.uint64)
    parts = correlated_parts(sample, parts_for(n, max_bits))
    allocator = Allocator(sample, n, parts, max_bits)
    sides = "part int, value long, fp long"

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy().astype(np.uint64)
            for k, part in enumerate(parts):
                yield _sides(np.full(len(fps), k), project(fps, part), fps)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy().astype(np.uint64)
            chosen = allocator.thresholds(fps)
            for k, part in enumerate(parts):
                own = project(fps, part)
                for r in range(max_bits + 1):
                    at = chosen[k] == r
                    if at.any():
                        masks = masks_within(len(part), r)
                        for lo in range(0, len(masks), 4096):
                            some = masks[lo : lo + 4096]
                            values = (own[at][:, None] ^ some[None, :]).ravel()
                            yield _sides(np.full(len(values), k), values, np.repeat(fps[at], len(some)))

    left = distinct.mapInArrow(probe, sides)
    right = distinct.mapInArrow(index, sides).withColumnRenamed("fp", "other")
    near = left.join(right, ["part", "value"]).where(
        (F.col("fp") != F.col("other")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= max_bits)
    )
    return near.select(F.greatest("fp", "other").alias("a"), F.least("fp", "other").alias("b"))


def _sides(part, value, fp) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(part.astype(np.int32)), pa.array(value.astype(np.int64)), pa.array(fp.astype(np.int64))],
        names=["part", "value", "fp"],
    )


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``doc_id, fp, fingerprint, component_id, root``, one row per input row.

    ``root`` is the component's smallest fingerprint, never null, unlike its smallest id.
    """
    by_doc = materialize(fingerprints(docs, shingle), "simhash-fp")
    # copies collapse before any join: one row per fingerprint, with its smallest document
    distinct = by_doc.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("n_rows"))
    distinct = materialize(distinct, "simhash-distinct")
    roots = components(link_distinct(distinct.select("fp"), max_bits))
    linked = distinct.select("fp", "low").join(roots, distinct.fp == roots.node).select("fp", "low", "root")
    linked = materialize(linked, "simhash-linked")
    low = linked.groupBy("root").agg(F.min("low").alias("component_id"), F.count("*").alias("n_rows"))
    moved = join_classes(linked.select("fp", "root"), materialize(low, "simhash-roots"), "root")
    moved = moved.select(F.col("fp").alias("linked_fp"), "component_id", "root")
    classes = distinct.join(moved, distinct.fp == moved.linked_fp, "left").select(
        "fp", F.when(F.col("linked_fp").isNull(), F.col("low")).otherwise(F.col("component_id")).alias("component_id"), F.coalesce("root", "fp").alias("root"), "n_rows"
    )
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    out = join_classes(by_doc, materialize(classes, "simhash-classes"), "fp")
    return out.select("doc_id", "fp", hexed.alias("fingerprint"), "component_id", "root")

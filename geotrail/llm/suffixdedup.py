"""Operator 9: removal of repeated byte strings with run-length indexes.

Every byte covered by a ``length``-byte string that also starts anywhere else
in the corpus is removed. One index over a whole corpus can't be built in one task, so
the windows (all ``length``-byte strings) are dealt to tasks by content:

1. A window's key is the least hash among its 32-byte grams, so equal windows
   have equal keys. Neighbouring windows mostly share their key; such a stretch is
   one *context* row (key, hash of its bytes, document, position). Every window of the
   corpus lies in exactly one context.
2. One aggregate per key (map-side combined) tells keys with one context
   occurrence (nothing repeats, unless the key's gram occurs in it twice), keys whose contexts are all the same bytes
   (everything repeats) and mixed keys.
3. The distinct contexts of mixed keys are fetched and dealt by key. Each task
   builds run-length indexes (:mod:`geotrail.llm.runindex`) over blocks of whole keys and
   streams the matching statistics: a window is repeated if its match is
   ``length`` bytes long, or its context occurs twice.
4. Mixed keys with more than ``max_contexts`` distinct contexts (the edge of a
   passage that very many documents share) are split further: their windows are
   counted by the hash of their bytes, spread over all tasks.
5. The repeated ranges are gathered per document and cut out of its bytes.

A document is known by its id and the hash of its text. Identical rows
share both: their contexts count twice and their ranges, kept once, apply to each of them.

Edge cases: null or empty text and texts under ``length`` bytes lose nothing; null ids
work like any other value; a text repeated as a whole loses all its bytes if it is long
enough; matches within one document count; empty tables give no rows. Texts
of any length are scanned in bounded pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotrail.llm.common import materialize, small_batches, text_column
from geotrail.llm.runindex import RunLengthIndex

LENGTH = 200
GRAM = 32
PIECE_BYTES = 1 << 20        # bytes per NumPy step
MAX_RUN = 256                # windows per context
MAX_CONTEXTS = 2_000         # distinct contexts of a key that one index takes
INDEX_BYTES = 600_000        # text per index
_K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xBF58476D1CE4E5B9)]  # odd mixers (fixed values)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the 32 bytes at every position."""
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    eight = np.empty(len(data) - 7, np.uint64)
    for s in range(8):
        view = data[s : s + (len(data) - s) // 8 * 8].view("<u8")
        eight[s::8] = view[: len(eight[s::8])]
    h = eight[:n] * _K[0]
    h ^= h >> np.uint64(32)
    for k in range(1, 4):
        h += eight[8 * k : 8 * k + n]
        h *= _K[k]
        h ^= h >> np.uint64(29)
    h *= _K[0]
    h ^= h >> np.uint64(32)
    return h


def window_minimum(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbouring values (block-wise running minima)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    blocks = -(-len(h) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(h)] = h
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def contexts_of(data: np.ndarray, off: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(segment, key, first window in the segment, windows, periodic) of every context; segments lie between the offsets.

    ``periodic``: the key's gram occurs twice in the context, so a window may repeat inside it.
    """
    grams = gram_hashes(data)
    least = window_minimum(grams, length - GRAM + 1)
    n = len(least)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z.astype(np.uint64), z, z, z.astype(bool)
    size = np.diff(off)
    valid = np.zeros(n + 1, np.int8)
    some = size >= length
    np.add.at(valid, off[:-1][some], 1)
    np.add.at(valid, np.minimum(off[1:][some] - length + 1, n), -1)
    valid = np.cumsum(valid[:n]) > 0
    edge = np.ones(n, bool)
    edge[1:] = (least[1:] != least[:-1]) | ~valid[:-1]
    edge[off[:-1][(off[:-1] < n)]] = True
    edge &= valid
    begin = np.flatnonzero(edge)
    # a stretch ends where the next one begins or where windows stop being valid
    gaps = np.flatnonzero(~valid)
    following = np.append(begin[1:], n)
    stop = np.append(gaps, n)[np.searchsorted(gaps, begin)]
    count = np.minimum(following, stop) - begin
    # long stretches of one key (periodic text) in bounded pieces
    pieces = -(-count // MAX_RUN)
    inner = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = np.repeat(begin, pieces) + inner * MAX_RUN
    count = np.minimum(MAX_RUN, np.repeat(begin + count, pieces) - first)
    segment = np.searchsorted(off, first, side="right") - 1
    # the least gram starts a window, and the next window still has that least value: it occurs again
    leads = np.concatenate([[0], np.cumsum(grams[:n] == least)])
    periodic = leads[first + count - 1] > leads[first]
    return segment, least[first], first - off[segment], count, periodic


def _pieces(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """(row, position, bytes) segments, grouped to about PIECE_BYTES; long texts in overlapping segments."""
    group, total = [], 0
    for k, t in enumerate(texts):
        for lo in range(0, max(1, len(t) - length + 1), PIECE_BYTES):
            part = t[lo : lo + PIECE_BYTES + length - 1]
            if len(part) < length:
                continue
            if group and total + len(part) > PIECE_BYTES:
                yield group
                group, total = [], 0
            group.append((k, lo, part))
            total += len(part)
    if group:
        yield group


def _documents(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def _context_table(docs: DataFrame, length: int) -> DataFrame:
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = batch.column("doc_id"), batch.column("text_hash")
            texts = [t.encode() for t in text_column(batch).to_pylist()]
            for group in _pieces(texts, length):
                off = np.concatenate([[0], np.cumsum([len(p) for _, _, p in group])]).astype(np.int64)
                data = np.frombuffer(b"".join(p for _, _, p in group), np.uint8)
                segment, key, first, count, periodic = contexts_of(data, off, length)
                raw = data.tobytes()
                lo = (off[segment] + first).tolist()
                hi = (off[segment] + first + count + length - 1).tolist()
                digest = xxhash.xxh3_64_intdigest
                content = np.array([digest(raw[a:b]) for a, b in zip(lo, hi)], np.uint64).astype(np.int64)
                row = np.array([k for k, _, _ in group], np.int64)[segment]
                at = np.array([p for _, p, _ in group], np.int64)[segment] + first
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(take), hashes.take(take), pa.array(key.astype(np.int64)), pa.array(content), pa.array(at), pa.array(count.astype(np.int32)), pa.array(periodic)],
                    names=["doc_id", "text_hash", "key", "content", "at", "windows", "periodic"],
                )

    return docs.mapInArrow(run, "doc_id long, text_hash long, key long, content long, at long, windows int, periodic boolean")


def _fetch(wanted: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """``key, content, copies, body``: the bytes of one occurrence of each context."""
    lists = wanted.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("key", "content", "copies", "at", "windows")).alias("spans"))
    d, s = docs.alias("d"), lists.alias("s")
    same = F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.text_hash") == F.col("s.text_hash"))
    met = d.join(s, same).select("d.text", "s.spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, spans in zip(text_column(batch).to_pylist(), batch.column("spans").to_pylist()):
                raw = text.encode()
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": [s["key"] for s in spans], "content": [s["content"] for s in spans], "copies": [s["copies"] for s in spans],
                        "body": [raw[s["at"] : s["at"] + s["windows"] + length - 1] for s in spans],
                    },
                    schema=pa.schema([("key", pa.int64()), ("content", pa.int64()), ("copies", pa.int64()), ("body", pa.binary())]),
                )

    return met.mapInArrow(run, "key long, content long, copies long, body binary")


def _ranges(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of true values as (first, end)."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return edge[::2], edge[1::2]


def repeated_windows(contexts: list[tuple[bytes, int]], length: int) -> list[np.ndarray]:
    """For distinct contexts (bytes, copies): which of their windows occur twice in the collection."""
    index = RunLengthIndex([b for b, _ in contexts])
    stats = index.matching_statistics()
    out = []
    for k, (body, copies) in enumerate(contexts):
        n = len(body) - length + 1
        out.append(np.ones(n, bool) if copies > 1 else index.part_statistics(k, stats)[:n] >= length)
    return out


def _index_spans(bodies: DataFrame, length: int) -> DataFrame:
    """``key, content, first, last`` window ranges that repeat; ``bodies`` is dealt and sorted by key."""

    def solve(block: dict[tuple[int, int], tuple[bytes, int]]) -> pa.RecordBatch:
        cols: list[list[int]] = [[], [], [], []]
        names = list(block)
        for (key, content), hit in zip(names, repeated_windows([block[x] for x in names], length)):
            for a, b in zip(*_ranges(hit)):
                for c, v in zip(cols, (key, content, int(a), int(b))):
                    c.append(v)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["key", "content", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: dict[tuple[int, int], tuple[bytes, int]] = {}
        size, last = 0, None
        for batch in batches:
            for key, content, copies, body in zip(*(batch.column(c).to_pylist() for c in ("key", "content", "copies", "body"))):
                if key != last and size >= INDEX_BYTES:
                    yield solve(block)
                    block, size = {}, 0
                if (key, content) not in block:     # identical rows of a document bring a context twice
                    size += len(body)
                block[key, content] = (body, copies)
                last = key
        if block:
            yield solve(block)

    return bodies.repartition("key").sortWithinPartitions("key").mapInArrow(run, "key long, content long, first long, last long")


def _counted_spans(bodies: DataFrame, length: int) -> DataFrame:
    """The same for keys with very many distinct contexts, by counting windows."""
    import xxhash

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, content, copies, body in zip(*(batch.column(c).to_pylist() for c in ("key", "content", "copies", "body"))):
                n = len(body) - length + 1
                h = np.array([xxhash.xxh3_64_intdigest(body[k : k + length]) for k in range(n)], np.uint64).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, key)), pa.array(np.full(n, content)), pa.array(np.full(n, copies)), pa.array(h), pa.array(np.arange(n))],
                    names=["key", "content", "copies", "window", "place"],
                )

    each = bodies.dropDuplicates(["key", "content"]).mapInArrow(windows, "key long, content long, copies long, window long, place long")
    each = materialize(each, "dedup-windows")
    twice = each.groupBy("key", "window").agg(F.sum("copies").alias("n")).where("n > 1").select("key", "window")
    hit = each.join(twice, ["key", "window"]).select("key", "content", "place")
    # neighbouring places of a context form one range
    place = hit.groupBy("key", "content").agg(F.sort_array(F.collect_list("place")).alias("p"))    # at most MAX_RUN places
    ranges = F.expr(
        "transform(filter(sequence(0, size(p) - 1), k -> k = 0 or p[k] != p[k - 1] + 1), k -> p[k])"
    )
    ends = F.expr("transform(filter(sequence(0, size(p) - 1), k -> k = size(p) - 1 or p[k + 1] != p[k] + 1), k -> p[k] + 1)")
    return place.select("key", "content", F.explode(F.arrays_zip(ranges.alias("first"), ends.alias("last"))).alias("r")).select(
        "key", "content", F.col("r.first").alias("first"), F.col("r.last").alias("last")
    )


def repeated_ranges(docs: DataFrame, length: int = LENGTH, max_contexts: int = MAX_CONTEXTS) -> DataFrame:
    """``doc_id, text_hash, lo, hi``: byte ranges covered by repeated strings (ranges may overlap)."""
    small_batches(docs.sparkSession)
    d = _documents(docs)
    table = materialize(_context_table(d, length), "dedup-contexts")
    keys = table.groupBy("key").agg(F.count("*").alias("n"), F.min("content").alias("low"), F.max("content").alias("high"), F.max("periodic").alias("periodic"))
    known = keys.where("n > 1 or periodic").select("key", ((F.col("low") != F.col("high")) | (F.col("n") == 1)).alias("mixed"))
    occurrences = materialize(table.drop("periodic").join(known, "key"), "dedup-occurrences")
    whole = occurrences.where("not mixed").select(
        "doc_id", "text_hash", F.col("at").alias("lo"), (F.col("at") + F.col("windows") + (length - 1)).alias("hi")
    )
    mixed = occurrences.where("mixed")
    distinct = mixed.groupBy("key", "content").agg(
        F.count("*").alias("copies"), F.min_by(F.struct("doc_id", "text_hash", "at", "windows"), F.struct("text_hash", "at")).alias("r")
    )
    distinct = materialize(distinct.select("key", "content", "copies", "r.*"), "dedup-distinct")
    crowded = distinct.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > max_contexts).select("key")
    crowded = materialize(crowded, "dedup-crowded")
    bodies = materialize(_fetch(distinct, d, length), "dedup-bodies")
    spans = _index_spans(bodies.join(crowded, "key", "left_anti"), length)
    if crowded.limit(1).count():
        spans = spans.unionByName(_counted_spans(bodies.join(crowded, "key", "left_semi"), length))
    found = mixed.join(materialize(spans, "dedup-spans"), ["key", "content"]).select(
        "doc_id", "text_hash", (F.col("at") + F.col("first")).alias("lo"), (F.col("at") + F.col("last") + (length - 1)).alias("hi")
    )
    return whole.unionByName(found)


def cut_ranges(raw: bytes, ranges: list[tuple[int, int]]) -> tuple[bytes, int]:
    """The bytes outside the ranges, and the number of maximal removed runs."""
    kept, at, runs = [], 0, 0
    end = -1
    for lo, hi in sorted(ranges):
        if lo > end:
            kept.append(raw[max(0, end) : lo])
            runs += 1
        end = max(end, hi)
    kept.append(raw[max(0, end) :])
    return b"".join(kept), runs


def _with_ranges(docs: DataFrame, length: int) -> DataFrame:
    """``docs`` (with ``doc_id, text_hash, text``) and its list of ranges."""
    found = repeated_ranges(docs, length)
    # a set: identical rows bring the same ranges once each, and every one of them gets the list
    lists = found.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("lo", "hi")).alias("_ranges"))
    d, s = docs.withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit("")))).alias("d"), lists.alias("s")
    same = F.col("d.doc_id").cast("long").eqNullSafe(F.col("s.doc_id")) & (F.col("d.text_hash") == F.col("s.text_hash"))
    return d.join(s, same, "left").select(*[F.col(f"d.`{c}`").alias(c) for c in docs.columns], F.col("s._ranges").alias("_ranges"))


def dedup_digest(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per row."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, ranges in zip(text_column(batch).to_pylist(), batch.column("_ranges").to_pylist()):
                raw = text.encode()
                kept, n = cut_ranges(raw, [(r["lo"], r["hi"]) for r in ranges or ()])
                rows.append((len(raw), len(raw) - len(kept), n, hashlib.sha256(kept).hexdigest()))
            cols = list(zip(*rows)) or [()] * 4
            types = [pa.int64()] * 3 + [pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(cols, types))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return _with_ranges(source, length).mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The rows of ``docs`` (all columns) with repeated strings cut out of ``text``.

    A character cut in two is dropped; null texts stay null; ``n_chars``, if there, follows the new text.
    """
    fields = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, ranges in zip(text_column(batch).to_pylist(), batch.column("_ranges").to_pylist()):
                if text is not None and ranges:
                    text = cut_ranges(text.encode(), [(r["lo"], r["hi"]) for r in ranges])[0].decode(errors="ignore")
                out.append(text)
            cols = [pa.array(out, pa.string()) if f.name == "text" else batch.column(f.name) for f in fields]
            yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in fields])

    cut = _with_ranges(docs, length).mapInArrow(run, fields)
    return cut.withColumn("n_chars", F.length("text").cast(fields["n_chars"].dataType)) if "n_chars" in fields.names else cut

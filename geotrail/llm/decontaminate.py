"""Operator 2: benchmark decontamination with CGK embeddings and bit-sampling LSH.

Symbols are normalised words (lower case, cut at all Unicode marks and spaces; a character of a
script written without spaces is a word). A
document is contaminated by an item of n words when some stretch of it is
within ``floor(edits * n)`` word edits of the item.

The CGK random walk reads a word sequence through a random bit function of
(step, word): each step emits the word under the reader and the bit decides
whether the reader moves on. Two sequences a few edits apart meet again soon,
so their embeddings have a small Hamming distance, and sampled
embedding positions collide often. Every item has several anchors (its
words that are rarest in the benchmark): wherever a document has an anchor word, the
item-sized window that puts the word at the anchor's place is embedded with the same
walks, and the window becomes a candidate when all sampled positions of some
walk agree. Anchor plus sample is one bucket key of the bit-sampling scheme;
anchors x walks are its repetitions.

The walks may miss passages whose words shift (one-sided insertions or deletions, long
items), so a second path makes the recall complete: an item with limit e is cut into e + 1
pieces, and a stretch within e edits holds at least one of them unchanged. Windows around such
pieces are candidates too. Overlapping windows of one item are joined and verified by the exact edit distance
between the item and the best stretch in them.

Plan: one pass over the documents, no shuffle. The benchmark travels to the
tasks in blocks of at most ``BLOCK_ITEMS`` items and ``BLOCK_CHARS`` characters.

Edge cases: null or empty texts and items without a word never match;
repeated items or documents report each pair of rows; empty tables give no rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotrail.llm.common import select_docs, small_batches, text_column

EDITS = 0.2
ANCHOR_SHARE = 0.4      # of an item's words, at least MIN_ANCHORS, at most MAX_ANCHORS
MIN_ANCHORS, MAX_ANCHORS = 4, 12
WALKS = 3
SAMPLED = 2             # embedding positions per walk
BLOCK_ITEMS = 20_000
BLOCK_CHARS = 50_000_000
BLOCK_TEXT = 2_000_000  # characters per NumPy step
SEED = 97
# scripts written without spaces: Thai, Lao, Myanmar, Khmer, kana, Han
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
# ASCII other than letters and digits separates words
_CUT = bytes(b if chr(b).isalnum() or b > 127 else 0x20 for b in range(256))
PAD = -1


_MARK_KINDS = {"Pc", "Pd", "Ps", "Pe", "Pi", "Pf", "Po", "Sm", "Sc", "Sk", "So", "Zs", "Zl", "Zp", "Cc"}


@cache
def _instead(char: str) -> str:
    """What stands for a character outside ASCII when words are cut: a space for a mark, a word of its own for unspaced scripts."""
    if unicodedata.category(char) in _MARK_KINDS:
        return " "
    return f" {char} " if _UNSPACED.match(char) else char


def normal_words(text: str) -> list[bytes]:
    text = text.lower()
    if not text.isascii():
        cut = {ord(c): x for c in set(text) if c > "\x7f" and (x := _instead(c)) != c}
        if len(cut) > 8:
            text = text.translate(cut)
        else:
            for c, x in cut.items():
                text = text.replace(chr(c), x)
    return text.encode().translate(_CUT).split()


def run_hashes(ids: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` symbols, by its start."""
    h = np.zeros(max(0, len(ids) - length + 1), np.uint64)
    for j in range(length):
        h = h * np.uint64(0x9E3779B97F4A7C15) + ids[j : j + len(h)].astype(np.uint64)
        h ^= h >> np.uint64(29)
    return h


def _bit(symbol: np.ndarray, step, walk: int) -> np.ndarray:
    """The walk's random bit of (step, symbol): a fixed integer hash."""
    h = symbol.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((int(step) * 0xC2B2AE3D27D4EB4F + walk * 0x165667B19E3779F9 + SEED) % (1 << 64))
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return ((h >> np.uint64(40)) & np.uint64(1)).astype(np.int64)


def cgk(words: np.ndarray, steps: int, walk: int) -> np.ndarray:
    """The embedding of one sequence: ``steps`` symbols, PAD past the end."""
    out, i = np.full(steps, PAD, np.int64), 0
    for j in range(steps):
        if i >= len(words):
            break
        out[j] = words[i]
        i += int(_bit(words[i : i + 1], j, walk)[0])
    return out


def best_distance(item: list[int], text: list[int], limit: int) -> int | None:
    """Least edit distance between the item and any stretch of the text, None above ``limit``."""
    row = [0] * (len(text) + 1)
    for a in item:
        left, diagonal = row[0] + 1, row[0]
        row[0] = left
        least = left
        for j, b in enumerate(text, 1):
            up = row[j]
            cost = diagonal if a == b else 1 + min(diagonal, up, left)
            diagonal, left = up, cost
            row[j] = cost
            if cost < least:
                least = cost
        if least > limit:
            return None
    d = min(row)
    return d if d <= limit else None


class ItemIndex:
    """One block of benchmark items: vocabulary, anchors and sampled embedding positions."""

    def __init__(self, items: list[tuple[int | None, str]], edits: float = EDITS, walks: int = WALKS, sampled: int = SAMPLED):
        split = [(i, normal_words(t)) for i, t in items]
        split = [(i, w) for i, w in split if w]
        self.ids = [i for i, _ in split]
        count = Counter(w for _, ws in split for w in ws)
        self.vocab = {w: k + 1 for k, w in enumerate(sorted(count))}     # 0: any other word
        self.words = [np.array([self.vocab[w] for w in ws], np.int64) for _, ws in split]
        self.size = np.array([len(w) for w in self.words], np.int64)
        self.limit = [int(edits * len(w)) for w in self.words]
        self.walks, self.sampled = walks, sampled
        rng = np.random.default_rng(SEED)
        by_word: dict[int, list[tuple[int, int, int]]] = {}
        self.positions = np.zeros((len(split), MAX_ANCHORS, walks, sampled), np.int64)
        self.symbols = np.zeros_like(self.positions)
        for k, (_, ws) in enumerate(split):
            n = len(ws)
            many = min(n, MAX_ANCHORS, max(MIN_ANCHORS, int(np.ceil(ANCHOR_SHARE * n))))
            rare = sorted(range(n), key=lambda o: (count[ws[o]], -len(ws[o]), o))[:many]
            for a, o in enumerate(rare):
                by_word.setdefault(int(self.words[k][o]), []).append((k, a, o))
            self.positions[k] = np.sort(rng.integers(0, max(1, 2 * n), (MAX_ANCHORS, walks, sampled)), axis=-1)
        for walk in range(walks):
            for k, w in enumerate(self.words):
                emb = cgk(w, 2 * len(w), walk)
                self.symbols[k, :, walk] = emb[self.positions[k, :, walk]]
        # anchors by word: rows of (item, anchor, offset), a slice per word
        top = len(self.vocab) + 1
        self.first = np.zeros(top + 1, np.int64)
        rows = []
        for w in range(top):
            self.first[w] = len(rows)
            rows += by_word.get(w, [])
        self.first[top] = len(rows)
        self.anchors = np.array(rows, np.int64).reshape(-1, 3)
        # pieces by length: of limit + 1 pieces of an item one is unchanged in any stretch within the limit
        found: dict[int, list[tuple[int, int, int]]] = {}
        for k, w in enumerate(self.words):
            many = self.limit[k] + 1
            length = len(w) // many
            h = run_hashes(w, length)
            found.setdefault(length, []).extend((int(h[o]), k, o) for o in (j * len(w) // many for j in range(many)))
        self.pieces = {}
        for length, three in found.items():
            three.sort()
            keys, first = np.unique(np.array([x for x, _, _ in three], np.uint64), return_index=True)
            self.pieces[length] = (keys, np.append(first, len(three)), np.array([x[1:] for x in three], np.int64))
        self.bags = [Counter(w.tolist()) for w in self.words]

    def match(self, texts: list[str]) -> list[list[tuple[int, int]]]:
        """Per text, (item index, distance) of the items it contains."""
        out: list[list[tuple[int, int]]] = [[] for _ in texts]
        if not self.words:
            return out
        lo = 0
        while lo < len(texts):
            hi, total = lo, 0
            while hi < len(texts) and (hi == lo or total + len(texts[hi]) <= BLOCK_TEXT):
                total += len(texts[hi])
                hi += 1
            self._match_block(texts[lo:hi], out[lo:hi])
            lo = hi
        return out

    def _match_block(self, texts: list[str], out: list[list]) -> None:
        get = self.vocab.get
        parts = [np.array([get(w, 0) for w in normal_words(t)], np.int64) for t in texts]
        size = np.array([len(p) for p in parts], np.int64)
        start = np.concatenate([[0], np.cumsum(size)])
        ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        both = [self._by_walks(ids, start), self._by_pieces(ids, start)]
        doc, item, window = np.unique(np.concatenate([np.stack(x) for x in both], axis=1), axis=1)
        # overlapping windows of one document and item are one stretch
        reach = np.array(self.limit, np.int64)[item]
        same = (doc[1:] == doc[:-1]) & (item[1:] == item[:-1]) & (window[1:] - reach[1:] <= window[:-1] + self.size[item[:-1]] + reach[:-1])
        heads = np.flatnonzero(np.append(True, ~same)[: len(doc)])
        seen: dict[tuple[int, int], int] = {}
        for k, end in zip(heads.tolist(), [*heads[1:].tolist(), len(doc)]):
            d, i = int(doc[k]), int(item[k])
            n, limit = int(self.size[i]), self.limit[i]
            if seen.get((d, i)) == 0:
                continue
            lo, hi = max(int(start[d]), int(window[k]) - limit), min(int(start[d + 1]), int(window[end - 1]) + n + limit)
            stretch = ids[lo:hi].tolist()
            # a stretch within the limit shares all but that many words
            if n - (self.bags[i] & Counter(stretch)).total() > limit:
                continue
            whole = any(start[d] <= w and w + n <= start[d + 1] and np.array_equal(ids[w : w + n], self.words[i]) for w in window[k:end])
            dist = 0 if whole else best_distance(self.words[i].tolist(), stretch, limit)
            if dist is not None and dist < seen.get((d, i), limit + 1):
                seen[d, i] = dist
        for (d, i), dist in sorted(seen.items()):
            out[d].append((i, dist))

    def _by_pieces(self, ids: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, item, window) wherever a piece of an item stands unchanged."""
        found = [np.zeros((3, 0), np.int64)]
        for length, (keys, first, rows) in self.pieces.items():
            h = run_hashes(ids, length)
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            place = np.flatnonzero(keys[at] == h)
            doc = np.searchsorted(start, place, side="right") - 1
            inside = place + length <= start[doc + 1]
            place, doc = place[inside], doc[inside]
            key = at[place]
            many = first[key + 1] - first[key]
            row = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first[key], many)
            item, offset = rows[row].T
            found.append(np.stack([np.repeat(doc, many), item, np.repeat(place, many) - offset]))
        return tuple(np.concatenate(found, axis=1))

    def _by_walks(self, ids: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, item, window) of the anchored windows whose embedding agrees on some walk's samples."""
        hit = np.flatnonzero(self.first[ids + 1] > self.first[ids])
        many = self.first[ids[hit] + 1] - self.first[ids[hit]]
        at = np.repeat(hit, many)
        row = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(self.first[ids[hit]], many)
        item, anchor, offset = self.anchors[row].T
        doc = np.searchsorted(start, at, side="right") - 1
        window = at - offset
        found = np.zeros(len(at), bool)
        for walk in range(self.walks):
            live = np.flatnonzero(~found)
            if not len(live):
                break
            pos, want = self.positions[item[live], anchor[live], walk], self.symbols[item[live], anchor[live], walk]
            found[live] = self._walk(ids, window[live], start[doc[live]], start[doc[live] + 1], self.size[item[live]], pos, want, walk)
        return doc[found], item[found], window[found]

    def _walk(self, ids, window, low, high, size, pos, want, walk) -> np.ndarray:
        """Whether the windows' embeddings have the wanted symbols at the sampled positions."""
        live = np.arange(len(window))
        ok = np.ones(len(window), bool)
        i = np.zeros(len(window), np.int64)
        nxt = np.zeros(len(window), np.int64)
        j = 0
        while len(live):
            at = window[live] + i[live]
            inside = (i[live] < size[live]) & (at >= low[live]) & (at < high[live])
            symbol = np.where(inside, ids[np.clip(at, 0, len(ids) - 1)], np.where(i[live] < size[live], 0, PAD))
            while True:     # positions may repeat
                due = pos[live, np.minimum(nxt[live], self.sampled - 1)] == j
                due &= nxt[live] < self.sampled
                if not due.any():
                    break
                bad = due & (symbol != want[live, np.minimum(nxt[live], self.sampled - 1)])
                ok[live[bad]] = False
                nxt[live[due]] += 1
            i[live] += np.where(symbol == PAD, 0, _bit(np.maximum(symbol, 0), j, walk))
            stay = ok[live] & (nxt[live] < self.sampled)
            live = live[stay]
            j += 1
        return ok


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """The benchmark in blocks of bounded size, each collected on its own."""
    items = select_docs(benchmark, id_col="item_id")
    n, chars = items.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // BLOCK_ITEMS), -(-chars // BLOCK_CHARS))
    for b in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)) == b)
        yield sorted(((r.doc_id, r.text) for r in part.collect()), key=lambda x: (x[0] is None, x[0], x[1]))


def contaminated(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS) -> DataFrame:
    """``doc_id, item_id, item_words, distance, similarity``: one row per document and item it contains."""
    spark = docs.sparkSession
    small_batches(spark)
    source, out = select_docs(docs), None
    schema = "doc_id long, item_id long, item_words long, distance long, similarity double"
    for items in item_blocks(benchmark):
        shared = spark.sparkContext.broadcast(ItemIndex(items, edits))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                rows = []
                ids = batch.column("doc_id").to_pylist()
                for doc_id, found in zip(ids, index.match(text_column(batch).to_pylist())):
                    rows += [(doc_id, index.ids[i], int(index.size[i]), d, 1 - d / int(index.size[i])) for i, d in found]
                cols = list(zip(*rows)) or [(), (), (), (), ()]
                types = [pa.int64()] * 4 + [pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, types)], names=["doc_id", "item_id", "item_words", "distance", "similarity"]
                )

        part = source.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS) -> DataFrame:
    """The rows of ``docs`` (all columns) whose text contains no item."""
    spark = docs.sparkSession
    small_batches(spark)
    for items in item_blocks(benchmark):
        shared = spark.sparkContext.broadcast(ItemIndex(items, edits))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = shared.value.match([t or "" for t in text_column(batch).to_pylist()])
                yield batch.filter(pa.array([not f for f in found], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs

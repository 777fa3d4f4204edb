"""Operator 8: language-model scoring by online logistic context mixing.

A text is its lower-cased words and one end symbol; a word is its core, closed by a space, and its trailing marks behind
a symbol; a word that repeats the one before it may also be one repeat symbol. All of it is spelled in bytes, every byte a path of bits in a prefix code (frequent bytes
have short paths), marks, ends and repeats included. For every bit, predictors look up counts of zeros and ones under
hashed contexts (the last 1, 2, 3 and 5 bytes and the whole word so far with the text's class, the last 4 bytes without
it; classes are the languages of the training documents). The contexts of a word's first ``SEAM`` bytes reach into the
word before it, as far as its last ``LEAD`` bytes, those of its marks into the marks of the words before. Their log-odds are mixed by weights
that a gate chooses from how much evidence two of the contexts have; the weights are learned
by online gradient steps, and an adaptive map refines the mixed probability.

Seams. No context of a later byte reaches across the space, so a word's cost falls apart: its seam (the bytes it sees
of the word before, its own first ``SEAM`` bytes), its marks behind their state, and the rest, which depends on the word alone. Distinct seams and
words are spelled once per worker, as long as its memory holds them.

Texts. Which class's predictions to trust is refined online, symbol by symbol: the weight
of a class is its prior times the probability it gave to the text so far. The log probabilities add up to the text's
total, reported as log10 and as bits per byte of text.

What is learned comes from all training documents: counts of words and seams by class (map-side combined,
one shuffle) and context counts of all of them, weighted by occurrences. The
mixing weights are learned online in every partition of them and averaged, the refinement map is summed
over all; there one own occurrence is taken out of
the counts, so that unseen words are predicted honestly, and a word or seam counts as often as it occurs. The slots of
the hashed contexts are sized from the counted bits, up to ``MAX_SLOT_BITS``. The model is frozen
for scoring, so a document's score does not depend on how the scored rows are partitioned.

The base score (smoothed unigram) needs each token's corpus count: at most ``HEAD_WORDS`` of the
frequent words travel to the tasks, all others meet the count table in a join of
per-document counts.

Edge cases: null or empty text is the end token alone; a null language is a class of its own;
without training documents probabilities are even; repeated rows are scored alike;
an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotrail.llm.common import lower_words_of, materialize, small_batches, sum_vectors, text_blocks, text_column

CONTEXTS = 6
MIN_SLOT_BITS, MAX_SLOT_BITS = 16, 19   # slots of a context: as many as the distinct words and seams have bits, within these bounds
RANGES = 4                  # parts of a context's slots: they are summed apart
HEAD_WORDS = 300_000        # words whose base counts travel to the tasks, at most
MAX_CLASSES = 8             # the most frequent languages; all others count with the last of them
EVIDENCE = 6                # buckets of evidence; gates are pairs of them
GATES = EVIDENCE * EVIDENCE
SPAN = 12                   # log-odds covered by the refinement map, to both sides
CELLS = 145                 # of the refinement map
TUNE_CORES = 40_000         # with fewer distinct words and seams the online steps go over them several times
CLASS_WORDS = 20_000        # the most frequent words are spelled under every class, others under those that a text may belong to
SURE = 40.0                 # a class whose share of a text's probability is below exp(-SURE) can't change its floating-point value
MEMO_WORDS = 300_000        # words remembered per worker, beside the frequent ones
COUNT_WORDS = 500_000       # words that a counting task holds
MEMO_SEAMS = 300_000        # seams remembered per worker
RATE = 0.02
BATCH = 2048                # bits per online step
TRAIN_CORES = 400_000       # distinct words and seams per task that counts contexts or learns the mix
SEAM = 4                    # first bytes of a word whose contexts reach across the space before it
LEAD = 2                    # last bytes of the word before that they reach
MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
END, AGAIN, GLUE = b"\xff", b"\xfe", b"\xfd"     # symbols that no UTF-8 text contains: end, repeat, marks behind a core
TAIL = 1 << 62              # flag of a tail's key
WORDS, SEAMS = 0, 3         # kinds of counted rows
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xBF58476D1CE4E5B9)]  # odd mixers (fixed values)


def split_word(word: bytes) -> tuple[bytes, bytes]:
    """(core, its trailing marks); a word of marks alone is a core."""
    core = word.rstrip(MARKS) or word
    return core, word[len(core) :]


def mark_kind(core: bytes, tail: bytes) -> int:
    """What the contexts of the next word's marks see of this word."""
    if not tail:
        return 6 if core and not core.rstrip(MARKS) else 0
    return {b".": 1, b",": 2, b"!": 3}.get(tail[:1], 4 if tail[:1] in (b"#", b"$", b"%", b"&", b"*") else 5)


def states_before(kind: np.ndarray, prev: np.ndarray) -> np.ndarray:
    """State before each word: kind of the word before, 7 at a text's start, 8 after letters behind a word of marks."""
    state = np.where(prev == 0, 7, kind[prev])
    earlier = np.zeros_like(prev)
    earlier[1:] = prev[:-1]
    state[(state == 0) & (kind[earlier] == 6)] = 8
    return state


def tail_seam(state: int, tail: bytes) -> bytes:
    """A word's marks, or that there are none, as a seam behind the state."""
    return bytes([1 + state]) + b" " + GLUE + tail + b" "


class ByteCode:
    """A prefix code over bytes: frequent bytes have short paths through its binary tree."""

    def __init__(self, counts: np.ndarray):
        heap = [(int(c), b, b) for b, c in enumerate(counts + 1)]
        heapq.heapify(heap)
        children: dict[int, tuple[int, int]] = {}
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            node = 256 + len(children)
            children[node] = (a[2], b[2])
            heapq.heappush(heap, (a[0] + b[0], node, node))
        paths: dict[int, list[tuple[int, int]]] = {}
        open_nodes = [(heap[0][2], [])]
        while open_nodes:
            node, path = open_nodes.pop()
            if node < 256:
                paths[node] = path
            else:
                open_nodes += [(child, [*path, (node - 256, bit)]) for bit, child in enumerate(children[node])]
        self.size = np.array([len(paths[b]) for b in range(256)], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.node = np.array([n for b in range(256) for n, _ in paths[b]], np.uint64) * _M[2] * _M[3]
        self.bit = np.array([x for b in range(256) for _, x in paths[b]], np.int8)

    def contexts(self, items: list[bytes], skip: int = 0) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(context hash of each byte for the last 1, 2, 3, 5 bytes, the word so far, the last 4; byte of each bit; node hash; bits; item of each byte).

        An item is a whole word, whose core is spelled, closed by a space, the first ``skip`` bytes being only context; or a
        seam, told by its space: what is seen of the words before, the space, the first bytes of the word or its marks.
        """
        space = np.fromiter((w.find(b" ") for w in items), np.int64, len(items))
        whole = space < 0
        raws = [w if x else b" " + split_word(w)[0] + b" " for w, x in zip(items, (~whole).tolist())]
        size = np.fromiter(map(len, raws), np.int64, len(raws))
        lead = np.where(whole, 0, space) + 1
        data = np.frombuffer(b"".join(raws), np.uint8)
        n, orders = len(data), {}
        item = np.repeat(np.arange(len(raws)), size)
        place = np.arange(n) - np.repeat(np.cumsum(size) - size, size)
        inside = place - lead[item]     # place in the word; negative before it
        mine = np.flatnonzero(inside >= np.where(whole, skip, 0)[item])
        last, wide = np.zeros(n, np.uint64), data.astype(np.uint64) + np.uint64(1)
        for k in range(1, 6):
            last *= np.uint64(263)
            last[k:] += wide[: max(0, n - k)] * (place[k:] >= k)
            orders[k] = last.take(mine) * _M[1]
        power = np.cumprod(np.full(int(size.max(initial=1)), 263, np.uint64))
        term = wide * power[np.maximum(inside, 0)]
        before = np.cumsum(term, dtype=np.uint64) - term
        so_far = (before[mine] - before[mine - inside[mine]]) * _M[1]
        spelled = data[mine]
        many = self.size[spelled]
        byte = np.repeat(np.arange(len(mine)), many)
        at = np.arange(len(byte)) + np.repeat(self.start[spelled] - np.cumsum(many) + many, many)
        return [orders[1], orders[2], orders[3], orders[5], so_far, orders[4]], byte, self.node[at], self.bit[at], item[mine]


def class_lead(cls: np.ndarray | int) -> np.ndarray:
    """What a class adds to the hashes of its bytes' contexts."""
    return (np.atleast_1d(np.asarray(cls)).astype(np.uint64) + np.uint64(1)) * _M[0] * _M[3]


def bit_hash(h: list[np.ndarray], byte: np.ndarray, node: np.ndarray, k: int) -> np.ndarray:
    """Hash of context ``k`` and node of each bit, without a class."""
    x = ((h[k] + np.uint64(k)) * _M[3]).take(byte)
    x += node
    return x


def bit_slots(h: list[np.ndarray], byte: np.ndarray, node: np.ndarray, cls: np.ndarray | int, slot_bits: int, k: int) -> np.ndarray:
    """Slot of context ``k`` for each bit and the class of its byte; the last context has no class."""
    x = bit_hash(h, byte, node, k)
    if k < CONTEXTS - 1:
        lead = class_lead(cls)
        x += lead.take(byte) if len(lead) > 1 else lead
    x >>= np.uint64(64 - slot_bits)
    return x.view(np.int64)


def _squash(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-z))


def packed(counts: np.ndarray) -> np.ndarray:
    """Counts as the upper halves of floats: exact up to 256, within 0.4 % above."""
    return ((counts.astype(np.float32).view(np.uint32) + np.uint32(0x8000)) >> np.uint32(16)).astype(np.uint16)


def unpacked(halves: np.ndarray) -> np.ndarray:
    return (halves.astype(np.uint32) << np.uint32(16)).view(np.float32)


GATED = (2, 4)      # the contexts whose evidence chooses the weights: last 3 bytes and the word so far


def _log_odds(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.log((ones + np.float32(0.1)) / (zeros + np.float32(0.1)))


def _evidence(total: np.ndarray) -> np.ndarray:
    return sum((total > x).astype(np.int8) for x in (0.5, 3.5, 20.5, 200.5, 5000.5))


def cell_of(z: np.ndarray) -> np.ndarray:
    return np.rint(np.clip((z + SPAN) * ((CELLS - 1) / (2 * SPAN)), 0, CELLS - 1)).astype(np.int32)


@dataclass
class MixModel:
    """Everything a task needs to score texts; its size has fixed bounds."""

    classes: list                                   # languages (None: no language), the last one also for all others
    prior: np.ndarray                               # log probability of each class
    zeros: np.ndarray | None                        # contexts x slots, packed; None once settled for scoring
    ones: np.ndarray | None
    code: ByteCode
    slot_bits: int
    weights: np.ndarray = field(default_factory=lambda: np.full((GATES, CONTEXTS), 0.25))
    refine: np.ndarray | None = None                # gates x CELLS probabilities
    odds: np.ndarray | None = None                  # made by settle()
    own: np.ndarray | None = None                   # made by own_out()

    def own_out(self, slots: Iterator[np.ndarray], bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log-odds: contexts x bits, gate of each bit) with one own occurrence taken out of the counts."""
        if self.own is None:        # for every context, bit value and slot, once per worker
            n = self.zeros.shape[1]
            self.own, self.own_gate = np.empty((CONTEXTS, 2 * n), np.float32), {}
            for k in range(CONTEXTS):
                a, b = unpacked(self.zeros[k]), unpacked(self.ones[k])
                a, b = np.append(np.maximum(a - 1, 0), a), np.append(b, np.maximum(b - 1, 0))
                self.own[k] = _log_odds(a, b)
                if k in GATED:
                    self.own_gate[k] = _evidence(a + b)
        odds = np.empty((CONTEXTS, len(bits)), np.float32)
        gate = np.zeros(len(bits), np.int64)
        half = bits.astype(np.int64) << self.slot_bits
        for k, slot in enumerate(slots):
            slot += half
            odds[k] = self.own[k].take(slot)
            if k in GATED:
                gate *= EVIDENCE
                gate += self.own_gate[k].take(slot)
        return odds, gate

    def settle(self) -> None:
        """Look-up tables for scoring: log-odds and evidence of every slot, log probability of every gate and cell."""
        if self.odds is None:
            self.odds, self.gate = np.empty(self.zeros.shape, np.float32), {}
            for k in range(CONTEXTS):
                a, b = unpacked(self.zeros[k]), unpacked(self.ones[k])
                self.odds[k] = _log_odds(a, b)
                if k in GATED:
                    self.gate[k] = _evidence(a + b)
            p = np.clip(self.refine, 1e-6, 1 - 1e-6)
            self.logs = np.log(np.stack([1 - p, p], axis=-1)).astype(np.float32)    # gates x cells x bit
            self.mix = np.ascontiguousarray(self.weights.T.astype(np.float32))
            self.zeros = self.ones = self.own = None

    def spelled(self, items: list[bytes], skip: int = 0, classes=None) -> np.ndarray:
        """Natural log probability of each item's bits (see ``ByteCode.contexts``) under each class, or those asked for."""
        self.settle()
        classes = range(len(self.classes)) if classes is None else classes
        out = np.zeros((len(items), len(classes)), np.float32)
        for lo in range(0, len(items), 1000):
            some = items[lo : lo + 1000]
            h, byte, node, bits, item = self.code.contexts(some, skip)
            item = item[byte]
            # the last context has no class: its log-odds are the same for all of them
            shared = self.odds[-1].take(bit_slots(h, byte, node, 0, self.slot_bits, CONTEXTS - 1))
            hashes = [bit_hash(h, byte, node, k) for k in range(CONTEXTS - 1)]
            for place, z in enumerate(classes):
                slots = [((x + class_lead(z)) >> np.uint64(64 - self.slot_bits)).view(np.int64) for x in hashes]
                gate = np.zeros(len(bits), np.int64)
                for k in GATED:
                    gate *= EVIDENCE
                    gate += self.gate[k].take(slots[k])
                x = shared * self.mix[-1].take(gate)
                for k in range(CONTEXTS - 1):
                    x += self.odds[k].take(slots[k]) * self.mix[k].take(gate)
                gate *= CELLS
                gate += cell_of(x)
                gate *= 2
                gate += bits
                out[lo : lo + len(some), place] = np.bincount(item, self.logs.ravel().take(gate), len(some))
        return out

    def core_costs(self, words: list[bytes]) -> np.ndarray:
        """Log probability of each word under each class, spelled from its first byte with nothing before it."""
        return self.spelled(words)


class WordIndex(dict):
    """word -> number, numbers given in order of appearance; ``new`` lists what came since the last look."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        k = self[word] = len(self)
        self.new.append(word)
        return k

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def seam_of(word: bytes) -> bytes:
    """The first bytes of a closed word, whose contexts reach into the word before."""
    return word[:SEAM] if len(word) >= SEAM else word + b" "


def numbered_words(texts: list[str], index: WordIndex) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the words of all texts, each text closed by the empty word as its end; place of each text's first one)"""
    words: list[bytes] = []
    start = np.zeros(len(texts), np.int64)
    for k, t in enumerate(texts):
        start[k] = len(words)
        words += lower_words_of(t)
        words.append(b"")
    return index.numbers(words), start


def before_each(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the word before each, 0 at a text's start; whether it is the same word). The empty word has number 0."""
    prev = np.zeros_like(ids)
    prev[1:] = ids[:-1]
    return prev, (ids == prev) & (ids != 0)


class TextScorer:
    """Scores texts through their distinct words and seams, which are remembered: the frequent words for good, others up to MEMO_WORDS."""

    def __init__(self, model: MixModel, words: list[bytes], base: np.ndarray):
        self.model, self.frequent, self.frequent_base = model, words, base
        self._reset()

    def _reset(self) -> None:
        n = len(self.model.classes)
        self.index, self.leads, self.firsts = WordIndex(), WordIndex(), WordIndex()
        self.words: list[bytes] = []
        # per word: its last bytes, its first ones, its base; per class and word: cost of the bytes behind the seam, whether it is worked out
        self.lead, self.first, self.base = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.tails, self.tail, self.kind = WordIndex(), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.rest, self.known = np.zeros((n, 0), np.float32), np.zeros((n, 0), bool)
        self.again = self.firsts[AGAIN]
        self._forget_seams()
        self.index.numbers([b"", *self.frequent])
        self._grow()
        known = dict(zip(self.frequent, self.frequent_base))
        self.base[:] = [known.get(w, np.nan) for w in self.words]
        self.kept = len(self.words)

    def _forget_seams(self) -> None:
        self.seams = WordIndex()        # of lead << 32 | first, or TAIL | state << 32 | tail; -1: nothing, which costs nothing
        self.seams[-1]
        self.seams.new.clear()
        self.seam = np.zeros((len(self.model.classes), 1024), np.float32)

    def _forget(self) -> None:
        """Drop what is remembered beside the frequent words."""
        if len(self.firsts) > MEMO_WORDS + self.kept:
            self._reset()
            return
        for w in self.words[self.kept :]:
            del self.index[w]
        del self.words[self.kept :]
        for name in ("lead", "first", "tail", "kind", "base", "rest", "known"):
            setattr(self, name, getattr(self, name)[..., : self.kept].copy())

    def _grow(self) -> None:
        """Entries for the words that the index has met since the last call."""
        new, self.index.new = self.index.new, []
        if not new:
            return
        self.words += new
        n = len(self.words)
        if n > len(self.lead):      # in steps, not per batch
            size = n + n // 8 if n > len(new) else n
            for name, empty in (("lead", 0), ("first", 0), ("tail", 0), ("kind", 0), ("base", np.nan), ("rest", 0), ("known", False)):
                setattr(self, name, _widened(getattr(self, name), size, empty))
        lo, split = n - len(new), list(map(split_word, new))
        self.lead[lo:n] = self.leads.numbers([w[-LEAD:] for w in new])
        self.first[lo:n] = self.firsts.numbers([seam_of(c) if c else END for c, _ in split])
        self.tail[lo:n] = self.tails.numbers([t for _, t in split])
        self.kind[lo:n] = [mark_kind(c, t) for c, t in split]

    def _spell(self, ids: np.ndarray, classes) -> None:
        """Work out what lies behind the seam of these words under these classes."""
        self.known[classes[0] : classes[-1] + 1, ids] = True
        long = [k for k in ids.tolist() if len(self.words[k]) >= SEAM]
        if long:
            self.rest[classes[0] : classes[-1] + 1, long] = self.model.spelled([self.words[k] for k in long], SEAM, classes).T

    def load(self, texts: list[str]) -> None:
        if len(self.words) > self.kept + MEMO_WORDS:
            self._forget()
        if len(self.seams) > MEMO_SEAMS:
            self._forget_seams()
        self.ids, self.start = numbered_words(texts, self.index)
        self._grow()

    def _seam_rows(self, keys: np.ndarray) -> np.ndarray:
        """Columns of ``seam`` for keys ``lead << 32 | first``."""
        distinct, where = np.unique(keys, return_inverse=True)
        rows = self.seams.numbers(distinct.tolist())
        new, self.seams.new = self.seams.new, []
        if new:
            leads, firsts, tails = list(self.leads), list(self.firsts), list(self.tails)
            parts = [(k, k >> 32 & 0x3FFFFFFF, k & 0xFFFFFFFF) for k in new]
            costs = self.model.spelled([tail_seam(a, tails[b]) if k & TAIL else leads[a] + b" " + firsts[b] for k, a, b in parts])
            n = len(self.seams)
            if n > self.seam.shape[1]:
                self.seam = _widened(self.seam, 2 * n, 0)
            self.seam[:, n - len(new) : n] = costs.T
        return rows[where]

    def log_probabilities(self) -> np.ndarray:
        """Natural log probability of each loaded text: the sum over classes of prior times all that the class predicted."""
        ids, start = self.ids, self.start
        prev, same = before_each(ids)
        lead = self.lead[prev] << 32
        tail = np.where(ids == 0, -1, TAIL | states_before(self.kind, prev) << 32 | self.tail[ids])
        rows = self._seam_rows(np.concatenate([lead | self.first[ids], tail, lead[same] | self.again]))
        again = np.zeros(len(ids), np.int64)
        again[same] = rows[2 * len(ids) :]
        rows, tail = rows[: len(ids)], rows[len(ids) : 2 * len(ids)]
        size = np.diff(np.append(start, len(ids)))

        def total(z: int, texts: np.ndarray | None = None) -> np.ndarray:
            """Log probability of the texts under class z, prior included; what is not worked out counts as certain."""
            own = slice(None) if texts is None else np.repeat(texts, size)
            cost = self.rest[z].take(ids[own])
            cost += self.seam[z].take(rows[own])
            cost += self.seam[z].take(tail[own])
            twice = np.flatnonzero(same[own])
            if len(twice):      # spelled, or the repeat symbol
                cost[twice] = np.logaddexp(cost[twice], self.seam[z].take(again[own][twice]))
            many = size if texts is None else size[texts]
            return np.add.reduceat(cost.astype(np.float64), np.cumsum(many) - many) + self.model.prior[z]

        def exact(z: int, texts: np.ndarray) -> np.ndarray:
            need = ids[np.repeat(texts, size)]
            need = need[~self.known[z].take(need)]
            if len(need):
                self._spell(np.unique(need), (z,))
            return total(z, texts)

        classes = range(len(self.model.classes))
        usual = ids[ids < CLASS_WORDS]
        usual = usual[~self.known.all(axis=0)[usual]]
        if len(usual):
            self._spell(np.unique(usual), classes)
        most = np.stack([total(z) for z in classes])      # upper bounds
        best = most.argmax(axis=0)
        value = np.full(most.shape, -np.inf)
        for z in classes:
            if (own := best == z).any():
                value[z, own] = exact(z, own)
        least = value.max(axis=0) - SURE
        for z in classes:
            if (near := (best != z) & (most[z] >= least)).any():
                value[z, near] = exact(z, near)
        return np.logaddexp.reduce(value, axis=0)


def _widened(old: np.ndarray, size: int, empty) -> np.ndarray:
    """With ``size`` columns, new ones empty."""
    out = np.full((*old.shape[:-1], size), empty, old.dtype)
    out[..., : old.shape[-1]] = old
    return out


class CorpusCounter:
    """Counts of words and seams by class."""

    def __init__(self, classes: int):
        self.index, self.leads, self.firsts = WordIndex(), WordIndex(), WordIndex()
        self.words: list[bytes] = []
        self.lead, self.first = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.tails, self.tail, self.kind = WordIndex(), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.by_class = np.zeros((classes, 0), np.int64)
        self.marks: Counter = Counter()     # of class << 40 | state << 32 | tail
        self.seams: list[tuple[np.ndarray, np.ndarray]] = []     # (class << 60 | lead << 30 | first, count)
        self.held = 0
        self.again = self.firsts[AGAIN]
        self.index[b""]

    def add(self, texts: list[str], classes: list[int]) -> None:
        ids, start = numbered_words(texts, self.index)
        new, self.index.new = self.index.new, []
        self.words += new
        split = list(map(split_word, new))
        self.lead = np.append(self.lead, self.leads.numbers([w[-LEAD:] for w in new]))
        self.first = np.append(self.first, self.firsts.numbers([seam_of(c) if c else END for c, _ in split]))
        self.tail = np.append(self.tail, self.tails.numbers([t for _, t in split]))
        self.kind = np.append(self.kind, np.array([mark_kind(c, t) for c, t in split], np.int64))
        if len(self.words) > self.by_class.shape[1]:    # grown in doubling steps
            grown = np.zeros((len(self.by_class), 2 * len(self.words)), np.int64)
            grown[:, : self.by_class.shape[1]] = self.by_class
            self.by_class = grown
        cls = np.repeat(np.array(classes, np.int64), np.diff(np.append(start, len(ids))))
        for z in set(classes):
            found = np.bincount(ids[cls == z])
            self.by_class[z, : len(found)] += found
        prev, same = before_each(ids)
        keys = cls << 60 | self.lead[prev] << 30 | np.where(same, self.again, self.first[ids])
        self.seams.append(np.unique(keys, return_counts=True))
        marks = (cls << 40 | states_before(self.kind, prev) << 32 | self.tail[ids])[(ids != 0) & ~same]
        for key, n in zip(*(x.tolist() for x in np.unique(marks, return_counts=True))):
            self.marks[key] += n
        self.held += len(self.seams[-1][0])
        if self.held > 4 * MEMO_SEAMS:
            self._merge_seams()

    def _merge_seams(self) -> None:
        if len(self.seams) > 1:
            keys, where = np.unique(np.concatenate([k for k, _ in self.seams]), return_inverse=True)
            counts = np.bincount(where, np.concatenate([n for _, n in self.seams])).astype(np.int64)
            self.seams, self.held = [(keys, counts)], len(keys)

    def full(self) -> bool:
        return len(self.words) > COUNT_WORDS or self.held > 3 * MEMO_SEAMS and len(self.seams) == 1

    def batches(self, size: int = 20_000) -> Iterator[pa.RecordBatch]:
        """``kind, cls, item, c``: words (the empty one is the end token) and seams."""
        words = pa.array(self.words, pa.binary())
        for z, row in enumerate(self.by_class):
            at = np.flatnonzero(row)
            for lo in range(0, len(at), size):
                some = at[lo : lo + size]
                yield self._rows(WORDS, np.full(len(some), z), words.take(pa.array(some)), row[some])
        self._merge_seams()
        leads, firsts, tails = list(self.leads), list(self.firsts), list(self.tails)
        if self.marks:
            items = pa.array([tail_seam(k >> 32 & 255, tails[k & 0xFFFFFFFF]) for k in self.marks], pa.binary())
            yield self._rows(SEAMS, np.array([k >> 40 for k in self.marks]), items, np.array(list(self.marks.values())))
        for keys, counts in self.seams:
            for lo in range(0, len(keys), size):
                some, ones = keys[lo : lo + size], (1 << 30) - 1
                pairs = zip((some >> 30 & ones).tolist(), (some & ones).tolist())
                items = pa.array([leads[a] + b" " + firsts[b] for a, b in pairs], pa.binary())
                yield self._rows(SEAMS, some >> 60, items, counts[lo : lo + size])

    @staticmethod
    def _rows(kind: int, cls: np.ndarray, items: pa.Array, c: np.ndarray) -> pa.RecordBatch:
        kinds = pa.array(np.full(len(c), kind, np.int32))
        return pa.RecordBatch.from_arrays([kinds, pa.array(cls.astype(np.int32)), items, pa.array(c)], names=["kind", "cls", "item", "c"])


def corpus_counts(docs: DataFrame, classes: list) -> DataFrame:
    """``kind, cls, item, c`` of ``text, lang`` rows, summed: words and seams by class."""
    where = {x: k for k, x in enumerate(classes)}
    rest = len(classes) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = CorpusCounter(len(classes))
        for batch in batches:
            texts, cls = text_column(batch), [where.get(x, rest) for x in batch.column("lang").to_pylist()]
            for lo, hi in text_blocks(texts):
                total.add(texts.slice(lo, hi - lo).to_pylist(), cls[lo:hi])
                if total.full():
                    yield from total.batches()
                    total = CorpusCounter(len(classes))
        yield from total.batches()

    schema = "kind int, cls int, item binary, c long"
    return docs.mapInArrow(run, schema).groupBy("kind", "cls", "item").agg(F.sum("c").alias("c"))


def _core_blocks(batch: pa.RecordBatch, rows: int = 2000) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    items, cls, c = batch.column("item").to_pylist(), batch.column("cls").to_numpy(), batch.column("c").to_numpy()
    for lo in range(0, len(items), rows):
        yield items[lo : lo + rows], cls[lo : lo + rows], c[lo : lo + rows].astype(np.float64)


def byte_counts(items: list[bytes], c: np.ndarray, skip: int = 0) -> np.ndarray:
    """Spelled bytes of the items: by occurrences, then once per item."""
    parts = [w[w.index(b" ") + 1 :] if b" " in w else (split_word(w)[0] + b" ")[skip:] for w in items]
    data = np.frombuffer(b"".join(parts), np.uint8)
    each = np.repeat(c, [len(p) for p in parts])
    return np.stack([np.bincount(data, each, 256), np.bincount(data, minlength=256)])


def gather_contexts(code: ByteCode, items: list[bytes], cls: np.ndarray, c: np.ndarray, total: np.ndarray, slot_bits: int, skip: int = 0) -> None:
    """Add all ``c`` occurrences of every (class, item) to the context counts."""
    h, byte, node, bits, item = code.contexts(items, skip)
    many = c.astype(total.dtype)[item][byte]
    flat, lead = total.reshape(-1), bits.astype(np.int64) * (CONTEXTS << slot_bits)
    for k in range(CONTEXTS):
        np.add.at(flat, bit_slots(h, byte, node, cls[item], slot_bits, k) + (lead + (k << slot_bits)), many)


def _own_out_block(model: MixModel, items: list[bytes], cls: np.ndarray, c: np.ndarray, skip: int):
    """(log-odds, gate, bit, occurrences) of each bit of a block of items, one own occurrence taken out."""
    h, byte, node, bits, item = model.code.contexts(items, skip)
    odds, gate = model.own_out((bit_slots(h, byte, node, cls[item], model.slot_bits, k) for k in range(CONTEXTS)), bits)
    return odds, gate, bits, c[item][byte]


def learn_weights(model: MixModel, blocks, passes: int = 1, skip: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Online gradient steps on the gated weights over (items, classes, occurrences) blocks.

    Returns the weights and the occurrences of bits that each gate saw.
    """
    own, seen = model.weights.copy(), np.zeros(GATES)
    for _ in range(passes):
        for block in blocks:
            odds, gate, bits, many = _own_out_block(model, *block, skip)
            for lo in range(0, len(bits), BATCH):
                o, g, w = odds[:, lo : lo + BATCH], gate[lo : lo + BATCH], many[lo : lo + BATCH]
                x = np.einsum("kb,bk->b", o, own.take(g, 0))
                err = w * (bits[lo : lo + BATCH] - _squash(np.clip(x, -16, 16)))
                amount = np.bincount(g, w, GATES)
                seen += amount
                for k in range(CONTEXTS):
                    own[:, k] += RATE * np.bincount(g, err * o[k], GATES) / np.maximum(1, amount)
    return own, seen


def averaged(learned: list[tuple[np.ndarray, np.ndarray]], start: np.ndarray) -> np.ndarray:
    """Weights of several partitions, each gate by what the partitions saw of it."""
    seen = sum(n for _, n in learned)
    total = sum(w * n[:, None] for w, n in learned)
    return np.where(seen[:, None] > 0, total / np.maximum(1e-9, seen)[:, None], start)


def cell_counts(model: MixModel, items: list[bytes], cls: np.ndarray, c: np.ndarray, skip: int = 0) -> np.ndarray:
    """Zeros and ones (occurrences) in each cell of the refinement map."""
    odds, gate, bits, many = _own_out_block(model, items, cls, c, skip)
    x = sum(odds[k] * model.weights[:, k].take(gate) for k in range(CONTEXTS))
    at = gate * CELLS + cell_of(x)
    ones = np.bincount(at, many * bits, GATES * CELLS)
    return np.stack([np.bincount(at, many, GATES * CELLS) - ones, ones])


def refinement(total: np.ndarray) -> np.ndarray:
    prior = _squash(np.linspace(-SPAN, SPAN, CELLS))
    zeros, ones = total.reshape(2, GATES, CELLS)
    return (ones + 4 * prior) / (zeros + ones + 4)


def train(counts: DataFrame, classes: list, class_docs: np.ndarray) -> MixModel:
    """Context counts, mixing weights and refinement map from all words and seams by their occurrences."""
    spark = counts.sparkSession
    items = counts.where(F.col("kind").isin(WORDS, SEAMS) & (F.length("item") > 0)).select("kind", "cls", F.col("item").cast("binary").alias("item"), "c")
    # seams hold the first bytes of all words; words counted without them are spelled from their first byte
    skip = SEAM if items.where(F.col("kind") == SEAMS).limit(1).count() else 0
    cores = items.where((F.col("kind") == SEAMS) | (F.length("item") >= skip)).drop("kind")
    n_cores = cores.count()
    parts = 1 + n_cores // TRAIN_CORES
    rows = cores.repartition(parts)      # each task gives one table of fixed size

    def summed(source: DataFrame, shape: tuple, add, dtype=np.float64) -> np.ndarray:
        """Sum over all blocks of what ``add(total, items, cls, c)`` adds."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape, dtype)
            for batch in batches:
                for block in _core_blocks(batch):
                    add(total, *block)
            yield pa.RecordBatch.from_pydict({"sums": [total.tobytes()]})

        return sum_vectors(source.mapInArrow(run, "sums binary"), "sums", math.prod(shape), dtype).reshape(shape)

    def add_bytes(total, words, cls, c) -> None:
        total += byte_counts(words, c, skip)

    by_occurrence, by_core = summed(rows, (2, 256), add_bytes)
    code = ByteCode(by_occurrence.astype(np.int64))
    slot_bits = int(np.clip(math.ceil(math.log2(max(1.0, by_core @ code.size))), MIN_SLOT_BITS, MAX_SLOT_BITS))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, CONTEXTS, 1 << slot_bits), np.float32)
        for batch in batches:
            for block in _core_blocks(batch):
                gather_contexts(code, *block, total, slot_bits, skip)
        for k, part in enumerate(total.reshape(2 * CONTEXTS * RANGES, -1)):
            yield pa.RecordBatch.from_pydict({"k": pa.array([k], pa.int32()), "sums": [part.tobytes()]})

    # one shard per context, bit value and range of slots: shards are summed and packed in the tasks
    parts_of = rows.mapInArrow(gather, "k int, sums binary").rdd.map(lambda r: (r[0], np.frombuffer(bytes(r[1]), np.float32)))
    shards = parts_of.reduceByKey(lambda a, b: a + b).mapValues(lambda v: packed(v).tobytes()).collect()
    both = np.zeros((2 * CONTEXTS * RANGES, (1 << slot_bits) // RANGES), np.uint16)
    for k, part in shards:
        both[k] = np.frombuffer(part, np.uint16)
    del shards
    both = both.reshape(2 * CONTEXTS, -1)
    model = MixModel(classes, np.log(class_docs / class_docs.sum()), both[:CONTEXTS], both[CONTEXTS:], code, slot_bits)
    # the same items in the same order for the online steps, however the counts lie
    dealt = cores.repartition(parts, F.xxhash64("item", "cls")).sortWithinPartitions(F.xxhash64("item", "cls"), "item", "cls")
    shared = spark.sparkContext.broadcast(model)
    passes = int(np.clip(TUNE_CORES // max(1, n_cores), 1, 20))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = (block for batch in batches for block in _core_blocks(batch))
        own, seen = learn_weights(shared.value, blocks if passes == 1 else list(blocks), passes, skip)
        yield pa.RecordBatch.from_pydict({"own": [own.tobytes()], "seen": [seen.tobytes()]})

    learned = dealt.mapInArrow(learn, "own binary, seen binary").collect()      # one small row per partition
    vectors = [(np.frombuffer(bytes(r.own)).reshape(GATES, CONTEXTS), np.frombuffer(bytes(r.seen))) for r in learned]
    weights = averaged(vectors, model.weights) if vectors else model.weights

    def add_cells(total, words, cls, c) -> None:
        shared.value.weights = weights
        total += cell_counts(shared.value, words, cls, c, skip)

    model.refine = refinement(summed(rows, (2, GATES * CELLS), add_cells))
    model.weights = weights
    shared.unpersist()
    model.settle()
    del both
    return model


def head_words(words: DataFrame) -> tuple[list[bytes], np.ndarray]:
    """(words, log10 of count plus a half) of all words from some count on: at most HEAD_WORDS, the most frequent first."""
    # counts cut to their first 8 binary digits: a table of a few thousand rows at any size
    unit = F.pow(F.lit(2.0), F.greatest(F.lit(0), F.length(F.bin("c")) - 8))
    grouped = words.select((F.floor(F.col("c") / unit) * unit).cast("long").alias("floor")).groupBy("floor").agg(F.count("*").alias("n"))
    least, held = None, 0
    for r in sorted(grouped.collect(), key=lambda r: -r.floor):
        held += r.n
        if held > HEAD_WORDS:
            break
        least = r.floor
    if least is None:
        return [], np.zeros(0)
    top = words.where(F.col("c") >= least).toArrow().sort_by([("c", "descending"), ("word", "ascending")])
    return top.column("word").to_pylist(), np.log10(top.column("c").to_numpy() + 0.5)


_SCORERS: dict = {}


def _scorer(shared, name: str) -> TextScorer:
    """One scorer per worker process and model: tasks of a job share its memory of words."""
    if _SCORERS.get("of") != name:
        _SCORERS.update({"of": name, "scorer": TextScorer(*shared.value)})
    return _SCORERS["scorer"]


def score_documents(docs: DataFrame, held_out: Column) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte`` per row.

    Needs ``doc_id, text, lang``; ``held_out`` is a condition on ``doc_id``. ``lang`` is read from training rows only.
    """
    spark = docs.sparkSession
    small_batches(spark)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), "lang")
    learn = source.where(~held_out).select("text", "lang")
    langs = learn.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_CLASSES).collect()
    # the last class also takes every language that is not named
    classes = [r.lang for r in langs] or [None]
    class_docs = np.array([r.n for r in langs] or [0], np.float64) + 0.5
    counts = materialize(corpus_counts(learn, classes), "lm-counts")
    model = train(counts, classes, class_docs)
    words = materialize(counts.where(F.col("kind") == WORDS).groupBy(F.col("item").alias("word")).agg(F.sum("c").alias("c")), "lm-words")
    n_tokens, kinds = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    low = math.log10(n_tokens + 0.5 * (kinds + 1))
    shared, name = spark.sparkContext.broadcast((model, *head_words(words))), uuid.uuid4().hex
    names = ["row", "doc_id", "word", "n", "n_known", "base", "score", "n_bytes"]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()]

    def filled(cols: dict, n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(cols[x], t) if x in cols else pa.nulls(n, t) for x, t in zip(names, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(shared, name)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            column = text_column(batch)
            for lo, hi in text_blocks(column):
                texts = column.slice(lo, hi - lo).to_pylist()
                scorer.load(texts)
                ids, start, rows = scorer.ids, scorer.start, np.arange(row, row + hi - lo)
                row += hi - lo
                base = scorer.base[ids]
                out = np.isnan(base)
                base[out] = 0
                size = np.diff(np.append(start, len(ids)))
                yield filled({
                    "row": rows, "doc_id": batch.column("doc_id").slice(lo, hi - lo), "n": size,
                    "n_known": np.add.reduceat(~out, start, dtype=np.int64), "base": np.add.reduceat(base, start),
                    "score": scorer.log_probabilities() / math.log(10), "n_bytes": [len(t.encode()) for t in texts],
                }, hi - lo)
                if out.any():
                    of = np.repeat(np.arange(hi - lo), size)[out]
                    keys, many = np.unique(of << 32 | ids[out], return_counts=True)
                    missing = [scorer.words[k] for k in (keys & 0xFFFFFFFF).tolist()]
                    yield filled({"row": rows[keys >> 32], "word": missing, "n": many}, len(keys))

    schema = "row long, doc_id long, word binary, n long, n_known long, base double, score double, n_bytes long"
    out = materialize(source.select("doc_id", "text").mapInArrow(run, schema), "lm-rows")
    # words outside the head: the join side with one row per word is the count table
    met = out.where("word is not null").select("row", "word", "n").join(words, "word", "left").groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("tail_known"),
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("tail_base"),
    )
    return out.where("word is null").drop("word").join(met, "row", "left").select(
        "doc_id",
        F.col("n").alias("n_tokens"),
        (F.col("n_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("tail_base", F.lit(0.0)) - F.col("n") * F.lit(low)).alias("base_score"),
        "score",
        (-F.col("score") / F.lit(math.log10(2)) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )

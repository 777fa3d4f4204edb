"""Ids of whole text columns by the tokenizers library: Arrow cuts the words, NumPy lays the ids out in text order.

The vocabulary's normaliser and pre-tokeniser drop white space and work within a white-space-free word, so a text's
ids are the concatenation of its words' ids; letters and the ASCII marks behind them are two runs of its pattern, so
such a word's ids are those of its two parts. ``encode_column`` finds the distinct words of a block of texts, takes
them apart, and asks a bounded table per worker process; only parts that it doesn't hold reach the library.

Ids of many words are kept ragged: one array of ids, and the offsets at which each word's ids begin and the last ends.
"""

from __future__ import annotations

import os
import string
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from geotrail.llm.common import text_blocks

MAX_WORDS = 550_000     # held per worker process
MAX_WORD_BYTES = 64     # longer words are encoded, not kept
STEP_BYTES = 8_000_000  # UTF-8 bytes of text that are cut into words at once (a longer text is a block of its own)
STEP_WORDS = 2_000_000  # words encoded at once, of STEP_BYTES at most
GROUP = 64              # words joined for one call of the library
SEPARATOR = "<|startoftext|>"   # a special token of the vocabulary: cuts the joined words apart
#: letters up to U+00FF: composed already, lower case known, one run
LETTERS = "a-zA-ZªµºÀ-ÖØ-öø-ÿ"
#: ASCII marks that are one run behind letters ("'" may open a short form, "<" a special token)
MARKS = "".join(c for c in string.punctuation if c not in "'<")
LETTERS_ONLY = f"^[{LETTERS}]+$"
ONE_RUN = f"^(?:[{LETTERS}]+|[{''.join(chr(92) + c for c in MARKS)}]+)$"
_TABLES: dict = {}


def pick(ids: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ragged rows ``rows`` of ragged ids, in that order."""
    start = offsets[rows]
    size = offsets[rows + 1] - start
    out = np.zeros(len(rows) + 1, np.int64)
    np.cumsum(size, out=out[1:])
    at = np.repeat(start - out[:-1], size)
    at += np.arange(len(at))
    return ids[at], out


def ragged(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.zeros(len(packed) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, packed), np.int64, len(packed)) // 4, out=offsets[1:])
    return np.frombuffer(b"".join(packed), "<u4"), offsets


def chained(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ragged ids of ``a``, then of ``b``."""
    return np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1][1:] + a[1][-1]])


class WordTable:
    """Ids of words; when it is full, the half used last stays (row 0, the empty word, always does)."""

    def __init__(self, encode_new: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], max_words: int = MAX_WORDS):
        self.encode_new, self.max_words = encode_new, max_words
        self.words = pa.array([""], pa.string())
        self.ragged = np.zeros(0, "<u4"), np.zeros(2, np.int64)
        self.used, self.step = np.zeros(1, np.int64), 0

    def lookup(self, words: pa.Array, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct ``words``, ragged, taken in the order ``of`` (-1: no word, no ids)."""
        self.step += 1
        found = pc.index_in(words, value_set=self.words)
        missing = found.is_null()
        rows = found.fill_null(0).to_numpy().astype(np.int64)
        self.used[rows] = self.step
        new = words.filter(missing)
        if not len(new):
            return pick(*self.ragged, np.append(rows, 0)[of])
        rows[np.flatnonzero(missing)] = len(self.words) + np.arange(len(new))
        held = chained(self.ragged, self.encode_new(new))
        out = pick(*held, np.append(rows, 0)[of])
        self.words, self.ragged = pa.concat_arrays([self.words, new]), held
        self.used = np.append(self.used, np.full(len(new), self.step))
        self._bound(pc.max(pc.binary_length(new)).as_py() > MAX_WORD_BYTES)
        return out

    def _bound(self, long_words: bool) -> None:
        if not long_words and len(self.words) <= self.max_words:
            return
        kept = np.flatnonzero(pc.less_equal(pc.binary_length(self.words), MAX_WORD_BYTES))
        if len(kept) > self.max_words:
            last = np.argsort(-self.used[kept[1:]], kind="stable")[: self.max_words // 2]
            kept = np.concatenate([kept[:1], kept[1:][np.sort(last)]])
        self.words, self.used = self.words.take(pa.array(kept)), self.used[kept]
        self.ragged = pick(*self.ragged, kept)


def library_table(path: str) -> WordTable:
    """The worker's table of words encoded by the tokenizers library, special tokens not added."""
    if path not in _TABLES:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        def load() -> Tokenizer:
            tok = Tokenizer.from_file(path)
            tok.no_truncation()
            tok.no_padding()
            return tok

        whole, runs = load(), load()
        cut = whole.token_to_id(SEPARATOR)
        # a run in lower case: the normaliser would change nothing, the pattern cut nothing
        runs.normalizer = None
        runs.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )

        def ids(tok: Tokenizer, texts: list[str]) -> list[np.ndarray]:
            return [np.array(e.ids, "<u4") for e in tok.encode_batch_fast(texts, add_special_tokens=False)]

        # tokens that end a run of the vocabulary's pattern
        ends = np.zeros(max(whole.get_vocab().values()) + 1, bool)
        ends[[i for t, i in whole.get_vocab().items() if t.endswith("</w>")]] = True

        def encode_runs(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            """One token ends each run, and so cuts the joined runs apart."""
            groups = pa.ListArray.from_arrays(pa.array([*range(0, len(words), GROUP), len(words)], pa.int32()), words)
            texts = [t.lower() for t in pc.binary_join(groups, " ").to_pylist()]
            x = np.concatenate([np.zeros(0, "<u4"), *ids(runs, texts)])
            return x, np.append(0, np.flatnonzero(ends[x]) + 1)

        def encode_whole(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
            """Words with marks or digits inside, other scripts, special tokens: as the library takes them."""
            out: list = [b""] * len(words)
            special = ["<|" in w or len(w) > MAX_WORD_BYTES for w in words]
            alone = [i for i, s in enumerate(special) if s]
            for i, x in zip(alone, ids(whole, [words[i] for i in alone])):
                out[i] = x.tobytes()
            rest = [i for i, s in enumerate(special) if not s]
            groups = [rest[k : k + GROUP] for k in range(0, len(rest), GROUP)]
            for group, x in zip(groups, ids(whole, [SEPARATOR.join([words[i] for i in g]) for g in groups])):
                packed, at = x.tobytes(), (4 * np.flatnonzero(x == cut)).tolist()
                for i, lo, hi in zip(group, [0, *[a + 4 for a in at]], [*at, len(packed)]):
                    out[i] = packed[lo:hi]
            return ragged(out)

        def encode_new(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            short = pc.less_equal(pc.binary_length(words), MAX_WORD_BYTES)
            run = pc.and_(short, pc.match_substring_regex(words, ONE_RUN))
            other = pc.invert(run)
            both = chained(encode_runs(words.filter(run)), encode_whole(words.filter(other).to_pylist()))
            order = np.empty(len(words), np.int64)
            order[np.concatenate([np.flatnonzero(run), np.flatnonzero(other)])] = np.arange(len(words))
            return pick(*both, order)

        _TABLES[path] = WordTable(encode_new)
    return _TABLES[path]


def text_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in one column, and where each text's words end.

    A-Z become lower case, as the vocabulary does it; special tokens are told by their exact spelling.
    """
    low = pc.ascii_lower(texts)
    special = pc.match_substring(texts, "<|")
    if special.true_count:
        low = pc.if_else(special, texts, low)
    words = pc.ascii_split_whitespace(low)
    return words.flatten(), np.cumsum(pc.list_value_length(words).to_numpy(), dtype=np.int64)


def word_steps(words: pa.Array) -> Iterator[pa.Array]:
    """The words in order, up to ``STEP_WORDS`` and ``STEP_BYTES`` of them at a time (or one word)."""
    if not len(words):
        yield words
        return
    starts = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, 4 * words.offset)
    at = 0
    while at < len(words):
        fit = np.searchsorted(starts[at : at + STEP_WORDS + 1], int(starts[at]) + STEP_BYTES, "right")
        yield words.slice(at, max(1, int(fit) - 1))
        at += max(1, int(fit) - 1)


def encode_words(words: pa.Array, table: WordTable) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words, ragged."""
    coded = words.dictionary_encode()
    forms = coded.dictionary
    core = pc.ascii_rtrim(forms, characters=MARKS)
    letters = pc.match_substring_regex(core, LETTERS_ONLY)
    marked = pc.and_(letters, pc.less(pc.binary_length(core), pc.binary_length(forms)))
    marks = pc.replace_substring_regex(forms.filter(marked), f"^[{LETTERS}]+", "")
    parts = pa.concat_arrays([pc.if_else(letters, core, forms), marks]).dictionary_encode()
    code = parts.indices.to_numpy()
    of = np.full((len(forms), 2), -1, np.int64)
    of[:, 0] = code[: len(forms)]
    of[np.flatnonzero(marked), 1] = code[len(forms) :]
    ids, offsets = table.lookup(parts.dictionary, of.ravel())
    return pick(ids, offsets[::2], coded.indices.to_numpy())


def encode_column(texts: pa.Array, table: WordTable, end_id: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All texts' ids in order, each text's closed by ``end_id``: (ids, sizes of the texts that end among them).

    A piece is of a block of texts, or of a step of a long text's words.
    """
    for lo, hi in text_blocks(texts, STEP_BYTES):
        words, ends = text_words(texts.slice(lo, hi - lo))
        at = done = held = 0   # words so far, texts ended so far, ids of the open one
        for part in word_steps(words):
            ids, offsets = encode_words(part, table)
            last = int(np.searchsorted(ends, at + len(part), "right"))
            stops = offsets[ends[done:last] - at]
            yield np.insert(ids, stops, end_id), np.diff(stops, prepend=-held) + 1
            held = len(ids) - int(stops[-1]) if len(stops) else held + len(ids)
            at, done = at + len(part), last

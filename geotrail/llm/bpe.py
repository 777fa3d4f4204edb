"""Operator 10: BPE encoding and decoding as a streaming transducer with bounded lookahead.

Encoding. A BPE token boundary far enough to the left of the end of what has
been read can no longer change. ``sufficient_lookahead`` computes that
distance from the merge list: a merge (x, y) at a boundary can only be
disturbed from the right while y itself may still be broken up, that is by an
earlier merge (r, z) whose left part r lies on y's right edge, which in turn
depends on z and what may disturb z. Earlier merges have strictly lower
ranks, so one pass over the merges in rank order gives for each token the
number of symbols beyond its end that may still matter; the maximum of
``len(y) + reach(y)`` over all merges is the lookahead L (it needs merges
whose parts are made by earlier merges, which is checked). The transducer
buffers at most a few L symbols, emits the tokens that end L or more symbols
before the buffer's end and keeps the rest: constant memory for runs of any
length. A boundary that exists splits BPE into two independent problems, so
the emitted tokens and the re-encoded rest give the ids of the whole run.

Text is cut into runs as the vocabulary file says (NFC, white space to a
space, per-character lower case, then the split pattern); long texts are fed in
pieces, cut at white space or before a character that normalisation cannot join
to its left neighbour.

On Spark a document enters ``DocumentEncoder`` in pieces of ``PIECE_CHARS``. Runs that white space has closed are
answered by a memo of words (two generations, bounded); an open one waits, or streams through the transducer once it
is long. The ids go on to the decoder and the digests piece by piece.

Decoding. ``StreamDecoder`` maps ids to bytes and bytes to text through an
incremental UTF-8 state machine. A vocabulary without a decoder (this one)
joins its token strings with single spaces, as the library does; with
``byte_level=True`` the byte alphabet is mapped back and ``</w>`` ends a word.

Edge cases: null or empty text has no ids and decodes to empty text; lone or
repeated rows are independent; an empty table gives no rows.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from geotrail.llm import wordcache
from geotrail.llm.common import select_docs, small_batches, text_column

END = "</w>"
PIECE_CHARS = 1 << 16
MEMO_RUNS = 300_000     # words remembered per generation and worker process
OPEN_BYTES = 4096       # an open word longer than this is encoded as it comes
WHITE = [bytes([b]) for b in b" \n\t\x0b\x0c\r"]
# white space of the vocabulary's \s class (fixed values: the code points with Unicode White_Space)
SPACE_POINTS = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SPACES = regex.compile("[" + "".join(map(chr, SPACE_POINTS)) + "]+")


def byte_alphabet() -> list[str]:
    """The printable stand-in of every byte in byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in printable)}
    return [chr(other.get(b, b)) for b in range(256)]


def _symbols(token: str) -> int:
    return len(token) - len(END) if token.endswith(END) and len(token) > len(END) else len(token)


def sufficient_lookahead(merges: list[tuple[str, str]]) -> int:
    """Symbols to the right of a boundary that decide it, for every possible text."""
    reach: dict[str, int] = {}     # beyond a token's end: what may still break the token up
    pull: dict[str, int] = {}      # beyond a token's end: what may take the token as a left part
    most = 1
    for x, y in merges:
        for part in (x, y):
            if _symbols(part) > 1 and part not in reach:
                raise ValueError(f"merge list is not proper: {part!r} is used before it is made")
        need = _symbols(y) + max(pull.get(y, 0), reach.get(y, 0))
        # the new token is disturbed from the right only through its right part
        reach[x + y] = max(reach.get(x + y, 0), need - _symbols(y))
        pull[x] = max(pull.get(x, 0), need)
        most = max(most, need)
    return most


class MergeTable:
    """Merge ranks over token ids, with the lookahead of the list."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        self.lookahead = sufficient_lookahead(merges)
        self.rank = {(self.vocab[x], self.vocab[y]): (k, self.vocab[x + y]) for k, (x, y) in enumerate(merges)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.token_bytes = {i: t.encode() for i, t in self.strings.items()}
        self.size = [0] * (max(self.strings) + 1)
        for i, s in self.strings.items():
            self.size[i] = _symbols(s)
        self.by_byte = [self.vocab[c] for c in byte_alphabet()]
        self.by_last_byte = [self.vocab[c + END] for c in byte_alphabet()]
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(pattern)
        self.special_pattern = regex.compile("|".join(regex.escape(s) for s in self.special))

    def merge(self, ids: list[int]) -> list[int]:
        """Plain BPE: lowest rank first, leftmost among equals."""
        rank = self.rank
        ids = list(ids)
        if len(ids) <= 48:
            # short runs: one merge at a time, only its neighbours' ranks change
            get = rank.get
            ranks = [get(pair, NO_MERGE) for pair in zip(ids, ids[1:])]
            while ranks:
                best = min(ranks)
                if best is NO_MERGE:
                    break
                k = ranks.index(best)
                ids[k : k + 2] = (best[1],)
                del ranks[k]
                if k:
                    ranks[k - 1] = get((ids[k - 1], ids[k]), NO_MERGE)
                if k < len(ranks):
                    ranks[k] = get((ids[k], ids[k + 1]), NO_MERGE)
            return ids
        while len(ids) > 1:
            best = min((rank.get(pair, NO_MERGE) for pair in zip(ids, ids[1:])))
            if best is NO_MERGE:
                break
            a, k, out, n = best[1], 0, [], len(ids)
            while k < n:
                if k + 1 < n and rank.get((ids[k], ids[k + 1])) == best:
                    out.append(a)
                    k += 2
                else:
                    out.append(ids[k])
                    k += 1
            ids = out
        return ids


NO_MERGE = (1 << 60, -1)


class RunTransducer:
    """Bytes of one run in, stable token ids out; holds at most a few lookaheads of symbols."""

    def __init__(self, table: MergeTable):
        self.table, self.limit = table, 8 * table.lookahead
        self.size = table.size
        self.held: list[int] = []   # bytes not yet in an emitted token

    def feed(self, data: bytes) -> list[int]:
        out: list[int] = []
        for lo in range(0, len(data), self.limit):
            self.held.extend(data[lo : lo + self.limit])
            if len(self.held) > 2 * self.limit:
                out += self._emit()
        return out

    def _emit(self) -> list[int]:
        # the last byte may turn out to end the run, which changes its symbol: it stays outside
        body = self.held[:-1]
        tokens = self.table.merge([self.table.by_byte[b] for b in body])
        stable, at, out = len(body) - self.table.lookahead, 0, []
        for t in tokens:
            if at + self.size[t] > stable:
                break
            at += self.size[t]
            out.append(t)
        del self.held[:at]
        return out

    def finish(self) -> list[int]:
        if not self.held:
            return []
        symbols = [self.table.by_byte[b] for b in self.held]
        symbols[-1] = self.table.by_last_byte[self.held[-1]]
        self.held = []
        return self.table.merge(symbols)


def _lower(text: str) -> str:
    # per character, as the vocabulary's normaliser does: no final-sigma rule
    return text.replace(chr(0x3A3), chr(0x3C3)).lower()


def _joins_left(c: str) -> bool:
    """Whether normalisation may combine the character with what precedes it."""
    # marks, conjoining Hangul vowels and finals, and characters that normalisation changes
    return unicodedata.category(c)[0] == "M" or 0x1160 <= ord(c) <= 0x11FF or unicodedata.normalize("NFC", c) != c


class StreamEncoder:
    """Text pieces in, ids out; equals encoding the joined text."""

    def __init__(self, table: MergeTable):
        self.table = table
        self.raw = ""                       # not yet normalised
        self.text = ""                      # normalised, not yet cut into runs
        self.open: tuple[regex.Pattern, RunTransducer] | None = None

    def feed(self, piece: str) -> list[int]:
        self.raw += piece
        if len(self.raw) < PIECE_CHARS:
            return []
        cut = self._cut()
        ready, self.raw = self.raw[:cut], self.raw[cut:]
        return self._take(ready, False)

    def _cut(self) -> int:
        """A position that neither normalisation nor a special token crosses (0: none yet)."""
        raw = self.raw
        for k in range(len(raw) - 1, max(0, len(raw) - 4096), -1):
            if raw[k] in " \n\t\r":
                return k
        for k in range(len(raw) - 1, 0, -1):
            if not _joins_left(raw[k]) and "<" not in raw[max(0, k - 32) : k]:
                return k
        return 0

    def finish(self) -> list[int]:
        ready, self.raw = self.raw, ""
        return self._take(ready, True)

    def _take(self, raw: str, last: bool) -> list[int]:
        out: list[int] = []
        parts, at = [], 0
        for m in self.table.special_pattern.finditer(raw):
            parts += [(raw[at : m.start()], None), ("", self.table.special[m[0]])]
            at = m.end()
        parts.append((raw[at:], None))
        for k, (part, special) in enumerate(parts):
            if special is None:
                self.text += _lower(SPACES.sub(" ", unicodedata.normalize("NFC", part)))
                out += self._runs(last or k < len(parts) - 1)
            else:
                out.append(special)
        return out

    def _runs(self, last: bool) -> list[int]:
        """Encode the runs of the normalised text; an unfinished run at its end stays open."""
        out: list[int] = []
        text, at = self.text, 0
        if self.open:
            pattern, transducer = self.open
            m = pattern.match(text)
            end = m.end() if m else 0
            out += transducer.feed(text[:end].encode())
            if end == len(text) and not last:
                self.text = ""
                return out
            out += transducer.finish()
            self.open, at = None, end
        for m in self.table.pattern.finditer(text, at):
            if m.end() == len(text) and not last:
                at = m.start()
                run = m[0]
                kind = next((p for p in (LETTERS, OTHERS) if p.fullmatch(run)), None)
                if kind is not None and len(run) > 2:   # a contraction may still need its first characters
                    transducer = RunTransducer(self.table)
                    out += transducer.feed(run.encode())
                    self.open, at = (kind, transducer), len(text)
                break
            transducer = RunTransducer(self.table)
            out += transducer.feed(m[0].encode())
            out += transducer.finish()
            at = m.end()
        else:
            # no match touches the end: only white space is left, which makes no token
            at = len(text)
        self.text = "" if last else text[at:]
        return out


LETTERS = regex.compile(r"\p{L}+")
OTHERS = regex.compile(r"[^\s\p{L}\p{N}]+")


class StreamDecoder:
    """Ids in, text out, through an incremental UTF-8 state machine."""

    def __init__(self, table: MergeTable, byte_level: bool = False):
        self.table, self.byte_level = table, byte_level
        self.machine = codecs.getincrementaldecoder("utf-8")(errors="replace")
        self.started = False
        if byte_level:
            self.byte_of = {c: b for b, c in enumerate(byte_alphabet())}

    def _bytes(self, token: int) -> bytes:
        s = self.table.strings.get(token)
        if s is None or token in self.table.special.values():
            return (s or "").encode()
        body, end = (s[: -len(END)], b" ") if s.endswith(END) else (s, b"")
        return bytes(self.byte_of[c] for c in body) + end

    def feed(self, ids) -> str:
        if self.byte_level:
            return "".join(self.machine.decode(self._bytes(int(i))) for i in ids)
        known = [self.table.token_bytes[i] for i in ids if i in self.table.token_bytes]
        if not known:
            return ""
        lead = b" " if self.started else b""
        self.started = True
        return self.machine.decode(lead + b" ".join(known))

    def finish(self) -> str:
        return self.machine.decode(b"", True)


_TABLES: dict[str, MergeTable] = {}


def merge_table(path: str) -> MergeTable:
    """One table per worker process and file."""
    if path not in _TABLES:
        _TABLES[path] = MergeTable(path)
    return _TABLES[path]


def encode_text(text: str, table: MergeTable, piece: int = PIECE_CHARS) -> list[int]:
    enc, out = StreamEncoder(table), []
    for lo in range(0, len(text), piece):
        out += enc.feed(text[lo : lo + piece])
    return out + enc.finish()


def decode_ids(ids, table: MergeTable, byte_level: bool = False) -> str:
    dec = StreamDecoder(table, byte_level)
    return dec.feed(ids) + dec.finish()


def encode_closed(run: bytes, table: MergeTable) -> list[int]:
    """Ids of a run whose end is known; longer ones go through the transducer."""
    if len(run) <= 2 * 8 * table.lookahead:
        by_byte = table.by_byte
        symbols = [by_byte[b] for b in run]
        symbols[-1] = table.by_last_byte[run[-1]]
        return table.merge(symbols)
    t = RunTransducer(table)
    return t.feed(run) + t.finish()


def _memo(path: str) -> wordcache.WordMemo:
    """Ids of closed words, per worker process: what the encoder is asked again and again."""
    if ("transducer", path) not in wordcache._MEMOS:
        table = merge_table(path)
        # runs of letters or marks inside words, in two generations like the words
        runs: list[dict] = [{}, {}]

        def encode_run(run: str) -> bytes:
            ids = runs[0].get(run)
            if ids is None:
                ids = runs[1].get(run)
                if ids is None:
                    ids = array("I", encode_closed(run.encode(), table)).tobytes()
                if len(runs[0]) >= MEMO_RUNS:
                    runs[:] = [{}, runs[0]]
                runs[0][run] = ids
            return ids

        def encode_new(words: list[bytes]) -> list[bytes]:
            out = []
            for w in words:
                if len(w) > wordcache.MAX_WORD_BYTES or b"<|" in w:
                    out.append(array("I", encode_text(w.decode(), table)).tobytes())
                elif w.isalpha():   # ASCII letters: one run, met once per generation of the word memo
                    out.append(array("I", encode_closed(w.lower(), table)).tobytes())
                else:
                    text = w.decode()
                    text = text.lower() if w.isascii() else _lower(SPACES.sub(" ", unicodedata.normalize("NFC", text)))
                    found = table.pattern.findall(text)
                    if len(found) == 1:
                        out.append(array("I", encode_closed(found[0].encode(), table)).tobytes())
                    else:
                        out.append(b"".join([encode_run(run) for run in found]))
            return out

        wordcache._MEMOS["transducer", path] = wordcache.WordMemo(encode_new, MEMO_RUNS)
    return wordcache._MEMOS["transducer", path]


class DocumentEncoder:
    """Text pieces in, packed ids out, in memory bounded by a piece.

    White space closes a run: closed runs are answered by the memo. The word still open at the end of a
    piece waits for the next one; if it grows beyond ``OPEN_BYTES`` it is fed to a
    :class:`StreamEncoder` as it comes, which emits what its lookahead makes stable.
    """

    def __init__(self, table: MergeTable, memo: wordcache.WordMemo):
        self.table, self.memo = table, memo
        self.carry = b""
        self.stream: StreamEncoder | None = None

    def feed(self, piece: str) -> bytes:
        raw = piece.encode()
        out = b""
        if self.stream is not None:
            end = _first_white(raw)
            out = self._packed(self.stream.feed(raw[:end].decode()))
            if end == len(raw):
                return out
            out += self._packed(self.stream.finish())
            self.stream, raw = None, raw[end:]
        raw = self.carry + raw
        cut = max(map(raw.rfind, WHITE)) + 1
        self.carry = raw[cut:]
        out += self._words(raw[:cut])
        if len(self.carry) > OPEN_BYTES:
            self.stream = StreamEncoder(self.table)
            out += self._packed(self.stream.feed(self.carry.decode()))
            self.carry = b""
        return out

    def finish(self) -> bytes:
        out = self._packed(self.stream.finish()) if self.stream is not None else self._words(self.carry)
        self.carry, self.stream = b"", None
        return out

    def _words(self, raw: bytes) -> bytes:
        return self.memo.joined([wordcache.folded(raw).split()])[0]

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return array("I", ids).tobytes()


def _first_white(raw: bytes) -> int:
    found = [k for k in map(raw.find, WHITE) if k >= 0]
    return min(found, default=len(raw))


def text_pieces(text: str) -> Iterator[str]:
    for lo in range(0, len(text), PIECE_CHARS):
        yield text[lo : lo + PIECE_CHARS]


def encode_decode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Per document the operator's real outputs, ``ids`` (packed uint32) and ``decoded``, with their digests."""

    def whole(table: MergeTable, parts: Iterator[bytes]) -> tuple:
        decoder, ids, text = StreamDecoder(table), [], []
        for part in parts:
            ids.append(part)
            text.append(decoder.feed(memoryview(part).cast("I")))
        text.append(decoder.finish())
        packed, decoded = b"".join(ids), "".join(text)
        return len(packed) // 4, hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), packed, decoded

    return _mapped(docs, tokenizer_path, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids binary, decoded string", whole)


def encode_decode_digest(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Per document ``doc_id, n_tokens, ids_sha256, decoded_sha256``; neither ids nor text are ever held whole."""

    def digest(table: MergeTable, parts: Iterator[bytes]) -> tuple:
        decoder, ids, text, n = StreamDecoder(table), hashlib.sha256(), hashlib.sha256(), 0
        for part in parts:
            n += len(part) // 4
            ids.update(part)
            text.update(decoder.feed(memoryview(part).cast("I")).encode())
        text.update(decoder.finish().encode())
        return n, ids.hexdigest(), text.hexdigest()

    return _mapped(docs, tokenizer_path, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", digest)


def encoded(text: str, table: MergeTable, memo: wordcache.WordMemo) -> Iterator[bytes]:
    """Packed ids of one text, part by part."""
    encoder = DocumentEncoder(table, memo)
    for piece in text_pieces(text):
        yield encoder.feed(piece)
    yield encoder.finish()


def _mapped(docs: DataFrame, path: str, schema: str, row) -> DataFrame:
    small_batches(docs.sparkSession)
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [(f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, memo = merge_table(path), _memo(path)
        for batch in batches:
            rows = [row(table, encoded(t, table, memo)) for t in text_column(batch).to_pylist()]
            if rows:
                cols = [batch.column("doc_id"), *(pa.array(list(c), t) for c, (_, t) in zip(zip(*rows), fields[1:]))]
                yield pa.RecordBatch.from_arrays(cols, names=[n for n, _ in fields])

    return select_docs(docs).mapInArrow(run, schema)

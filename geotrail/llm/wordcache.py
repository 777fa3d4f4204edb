"""Per-word memo for encoders whose pre-tokeniser never joins across white space.

The vocabulary's normaliser and pre-tokeniser drop white space and work
within a white-space-free run, so a text's ids are the concatenation of its
runs' ids. Each worker process keeps a bounded two-generation memo from a run's
UTF-8 bytes to its packed ids; only runs not met before reach the encoder.
"""

from __future__ import annotations

from collections.abc import Callable

MAX_WORDS = 550_000     # per generation and worker process
MAX_WORD_BYTES = 64     # longer runs are encoded, not kept
TAILS = b".,!?;:"        # marks that form a run of their own behind a letter
_MEMOS: dict = {}


class WordMemo:
    """Packed ids per word; two dictionaries: when the young one is full it becomes the old one (bounded memory).

    A word that ends in an ASCII letter and one mark of ``TAILS`` is two runs for the vocabulary's pattern: its ids are
    those of the word without the mark, then the mark's.
    """

    def __init__(self, encode_new: Callable[[list[bytes]], list[bytes]], max_words: int = MAX_WORDS):
        self.encode_new, self.max_words = encode_new, max_words
        self.young: dict = {}
        self.old: dict = {}
        self.tails: dict = {}

    def _known(self, words, found: dict) -> list[bytes]:
        """Fill ``found`` from the memo; returns the words it doesn't hold."""
        new = []
        young, old = self.young, self.old
        for w in words:
            v = young.get(w)
            if v is None:
                v = old.get(w)
                if v is None:
                    new.append(w)
                    continue
                young[w] = v
            found[w] = v
        return new

    def lookup(self, words: set) -> dict:
        """The ids of every word of the batch."""
        found: dict = {}
        new = self._known(words, found)
        if new:
            tailed = [w for w in new if len(w) > 1 and w[-1] in TAILS and 97 <= w[-2] <= 122]
            whole = [w for w in new if not (len(w) > 1 and w[-1] in TAILS and 97 <= w[-2] <= 122)]
            cores = {w[:-1] for w in tailed}.difference(found, whole)
            whole += self._known(cores, found)
            self._keep(zip(whole, self.encode_new(whole)), found)
            if not self.tails:
                self.tails = dict(zip(TAILS, self.encode_new([bytes([t]) for t in TAILS])))
            self._keep([(w, found[w[:-1]] + self.tails[w[-1]]) for w in tailed], found)
        if len(self.young) >= self.max_words:
            self.old, self.young = self.young, {}
        return found

    def joined(self, texts: list[list[bytes]]) -> list[bytes]:
        """The packed ids of each text, given as its words. Only words that the young generation lacks are looked up apart."""
        get = self.young.get
        found = [list(map(get, words)) for words in texts]
        missing: set = set()
        for words, ids in zip(texts, found):
            if None in ids:
                missing.update([w for w, v in zip(words, ids) if v is None])
        if missing:
            new = self.lookup(missing)
            for k, (words, ids) in enumerate(zip(texts, found)):
                if None in ids:
                    found[k] = [new[w] if v is None else v for w, v in zip(words, ids)]
        return [b"".join(ids) for ids in found]

    def _keep(self, values, found: dict) -> None:
        young = self.young
        for w, v in values:
            found[w] = v
            if len(w) <= MAX_WORD_BYTES:
                young[w] = v


def folded(text: bytes) -> bytes:
    """A-Z to lower case, as the vocabulary does; special tokens are told by their exact spelling."""
    return text if b"<|" in text else text.lower()

"""Token counts of whole texts by a SentencePiece model, without keeping a single id.

An Arrow function receives the text column batch by batch and returns lengths only.
Texts are first cut into pieces of about ``PIECE_CHARS``, then the pieces of all rows are
packed into encoder calls of about ``CALL_BYTES``: a batch of very long texts and one of
very short ones cost the same memory, and no call holds more ids than its bytes.

A cut is *safe* if the counts of both sides add up to the count of the whole. A merge can
only join symbols into a piece of the vocabulary, so no merge reaches over a border between
characters ``a b`` that stand side by side in no piece. The encoder puts one word mark in front of
every piece of text; hence two kinds of cut:

* at a blank whose left neighbour never precedes the word mark in a piece: the blank is
  dropped, and the mark in front of the right side takes its place;
* between ``a`` and ``b`` where neither ``a b`` nor mark + ``b`` is part of a piece: the mark
  then stands alone in front of the right side, one token that is subtracted.

A text without a safe place stays whole. The rules hold for models that change nothing in the text
before the merges (no normalisation, a leading word mark, blanks kept); others are refused.

Null text counts as empty (no token, no byte). Repeated rows, ties and null ids are counted row by row;
other columns, whatever their names, pass untouched beside the text (``n_bytes`` and
``n_tokens`` of the input are replaced). An empty table gives an empty table. Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotrail.llm.common import small_batches

MARK = "▁"             # the word mark: what the encoder makes of a blank
PIECE_CHARS = 16_384        # a longer text is cut at the first safe place after so many characters
CALL_BYTES = 262_144        # text handed to one encoder call
PROBE = " two  blanks\n\ttab é é ﬁ ｆ x "


class PieceCounter:
    """Counts tokens of texts with one model; one per worker process (:func:`counter`)."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        if self.model.normalize(PROBE) != MARK + PROBE.replace(" ", MARK):
            raise ValueError("the model changes texts before it encodes them: no cut is known to be safe")
        plain = (
            self.model.id_to_piece(i)
            for i in range(self.model.get_piece_size())
            if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i))
        )
        #: pairs of characters that stand side by side in some piece
        self.pairs = {pair for piece in plain for pair in zip(piece, piece[1:])}

    def _safe(self, text: str, at: int) -> int | None:
        """Characters to drop (1: the blank, 0: none) if ``text`` may be cut before index ``at``, else None."""
        left, right = text[at - 1], text[at]
        left = MARK if left == " " else left
        if right in (" ", MARK):
            # the right side must not become empty: a lone blank is a token of its own
            blank = right == " " and (left, MARK) not in self.pairs and at + 1 < len(text)
            return 1 if blank else None
        return 0 if (left, right) not in self.pairs and (MARK, right) not in self.pairs else None

    def pieces(self, text: str, size: int = PIECE_CHARS) -> Iterator[tuple[str, int]]:
        """(piece, tokens to subtract from its count); the differences add up to the text's count."""
        start, extra = 0, 0
        at = size
        while at < len(text):
            drop = self._safe(text, at)
            if drop is None:
                at += 1
                continue
            yield text[start:at], extra
            start, extra = at + drop, 1 - drop
            at = start + size
        yield text[start:], extra

    def counts(self, texts: list[str], size: int = PIECE_CHARS, call_bytes: int = CALL_BYTES) -> np.ndarray:
        total = np.zeros(len(texts), np.int64)
        call, rows, held = [], [], 0

        def flush() -> None:
            lengths = [len(ids) for ids in self.model.encode(call, num_threads=1)] if call else []
            np.add.at(total, rows, np.array(lengths, np.int64))

        for row, text in enumerate(texts):
            for piece, extra in self.pieces(text, size):
                total[row] -= extra
                call.append(piece)
                rows.append(row)
                held += 4 * len(piece) if not piece.isascii() else len(piece)
                if held >= call_bytes:
                    flush()
                    call, rows, held = [], [], 0
        flush()
        return total


@lru_cache(maxsize=4)
def counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def count_tokens(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8) and ``n_tokens`` of the whole text, both long."""

    @F.arrow_udf("long")
    def lengths(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count = counter(path).counts
        for texts in batches:
            yield pa.array(count(texts.to_pylist()), pa.int64())

    small_batches(docs.sparkSession)
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return docs.withColumns({"n_bytes": F.octet_length(text).cast("long"), "n_tokens": lengths(text)})

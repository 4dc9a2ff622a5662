"""Operator 2: token counts of huge documents by overlapping chunks that are spliced.

A long text is encoded in chunks that overlap.  Two neighbouring chunks are spliced at a
place inside their overlap at which tokens of both begin and that no merge can cross:
before a blank that follows another character.  The vocabulary proves it, as no piece
has a blank after another character; for a model of which that is not true, or whose
normaliser does more than mark blanks, texts are encoded whole.  Without a common
boundary the overlap is doubled, and past the whole chunk the chunk is.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import lru_cache

import sentencepiece
from pyspark.sql import DataFrame

from claimloom.llm.common import columns, map_rows

CHUNK_BYTES = 16384
OVERLAP_BYTES = 256
TOKEN_LIMIT = 4096
_BLANK = "▁"  # how the library writes a blank inside a piece
# A blank after a character that is neither a blank nor looks like one to the library.
_PROVEN = re.compile(rb"(?<!\xe2\x96)[^ ](?= )|(?<=\xe2\x96)[^ \x81](?= )")


class Counter:
    """A model with what its vocabulary proves about cuts.  Texts and places are in bytes."""

    def __init__(self, model_path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        #: No piece goes on with a blank after another character: no merge crosses such a place.
        starts_only = not any(_BLANK in piece.lstrip(_BLANK) for piece in pieces)
        #: The normaliser only marks blanks, and puts one before the text.
        sample = " a  B \n\tc\u00e9 \uff21"
        marks_only = self.model.normalize(sample) == _BLANK + sample.replace(" ", _BLANK)
        self.proves_cuts = starts_only and marks_only

    def count(self, text: bytes, chunk: int = CHUNK_BYTES, overlap: int = OVERLAP_BYTES) -> int:
        if len(text) <= chunk + overlap or not self.proves_cuts:
            return len(self.model.encode(text.decode("utf-8", "replace")))
        total, start = 0, 0
        while True:
            end = _character(text, start + chunk)
            left = self._places(text, start, end)
            if end == len(text):
                return total + len(left)
            cut, wide = None, overlap
            while cut is None and wide < end - start:
                cut = self._common(text, left, end - wide, end, _character(text, end + wide))
                wide *= 2
            if cut is None:  # nowhere in the chunk: take a longer one
                chunk *= 2
                continue
            total += bisect_left(left, cut)
            start = cut

    def _places(self, text: bytes, start: int, end: int) -> list[int]:
        """Where the tokens of text[start:end] begin; start is 0 or a proven place.

        The library puts a blank before what it encodes.  At a proven place that blank is
        the text's own, so the chunk goes in without it.
        """
        skip = 1 if start else 0
        proto = self.model.encode(text[start + skip : end].decode("utf-8", "replace"), return_type="proto")
        places = [start + skip + piece.begin for piece in proto.pieces]
        return [start, *places[1:]]

    def _common(self, text: bytes, left: list[int], low: int, end: int, high: int) -> int | None:
        """The last proven place in text[low:end] where tokens of both encodings begin."""
        proven = [found.start() + 1 for found in _PROVEN.finditer(text, max(low, 1) - 1, end)]
        if not proven:
            return None
        both = set(self._places(text, proven[0], high)).intersection(left)
        return next((place for place in reversed(proven) if place in both), None)


def _character(text: bytes, place: int) -> int:
    """The place, or the start of the character that it cuts; at most the text's end."""
    if place >= len(text):
        return len(text)
    while text[place] & 0xC0 == 0x80:
        place -= 1
    return place


@lru_cache(maxsize=2)
def counter(model_path: str) -> Counter:
    return Counter(model_path)


def count_tokens(docs: DataFrame, model_path: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of each row's whole ``text``.

    NULL text counts as empty: no bytes, no tokens, not over the limit.  Repeated rows stay
    repeated.  No shuffle; a worker holds one document and the ids of one chunk.
    """

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        model = counter(model_path)
        for doc_id, text in rows:
            text = text or b""
            n = model.count(text)
            yield doc_id, len(text), n, n > limit

    schema = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return map_rows(columns(docs, doc_id="doc_id", text="text"), run, schema)

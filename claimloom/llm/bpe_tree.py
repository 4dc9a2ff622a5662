"""Operator 1: byte-level BPE as a monoid, encoded and decoded by tree reduction.

A text is halved until a piece is short, pieces are encoded on their own, and
neighbours are joined again.  A join re-encodes only a window around the seam.  The
window ends at anchors: places after a character that is not white space and before a
blank, tab or line feed.  No match of the pattern spans such a place, because white
space can only be the first character of a match that holds anything else, and a match
that starts there sees nothing of what lies before.  So the tokens on either side of an
anchor are those of the two sides encoded alone: outside the window they are proven
stable.  The window grows from the seam until it finds its anchors, or covers a whole side.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import regex
import tiktoken
from pyspark.sql import DataFrame

from claimloom.llm.common import columns, map_rows

LEAF_CHARS = 8192
LEAF_IDS = 16384
FIRST_WINDOW = 32

_ANCHOR = regex.compile(r"(?<=[^\s\x1c-\x1f])(?=[ \t\n])")


@lru_cache(maxsize=2)
def encoder(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    """The rank file as an encoder without special tokens; loaded once per worker."""
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _plain(codec: tiktoken.Encoding, text: str) -> np.ndarray:
    return codec.encode_to_numpy(text, disallowed_special=())


def encode(codec: tiktoken.Encoding, text: str, leaf_chars: int = LEAF_CHARS) -> np.ndarray:
    """Ids of the whole text (uint32), by tree reduction."""

    def node(start: int, end: int) -> np.ndarray:
        if end - start <= leaf_chars:
            return _plain(codec, text[start:end])
        middle = (start + end) // 2
        return join(codec, text, start, middle, end, node(start, middle), node(middle, end))

    return node(0, len(text))


def join(
    codec: tiktoken.Encoding, text: str, start: int, seam: int, end: int, left: np.ndarray, right: np.ndarray
) -> np.ndarray:
    """Ids of text[start:end] from those of its two sides."""
    low, high = _window_start(text, start, seam), _window_end(text, seam, end)
    if low == seam or high == seam:  # the seam is an anchor itself
        return np.concatenate([left, right])
    kept = len(left) - len(_plain(codec, text[low:seam]))
    dropped = len(_plain(codec, text[seam:high]))
    return np.concatenate([left[:kept], _plain(codec, text[low:high]), right[dropped:]])


def _window_start(text: str, start: int, seam: int) -> int:
    """The last anchor up to the seam, else the start."""
    width = FIRST_WINDOW
    while True:
        edge = max(start, seam - width)
        found = [m.start() for m in _ANCHOR.finditer(text, edge, min(len(text), seam + 1)) if edge < m.start() <= seam]
        if found or edge == start:
            return found[-1] if found else start
        width *= 2


def _window_end(text: str, seam: int, end: int) -> int:
    """The first anchor from the seam on, else the end."""
    width = FIRST_WINDOW
    while True:
        edge = min(end, seam + width)
        for found in _ANCHOR.finditer(text, max(0, seam - 1), edge):
            if seam <= found.start() < edge:
                return found.start()
        if edge == end:
            return end
        width *= 2


def decode(codec: tiktoken.Encoding, ids: np.ndarray, leaf_ids: int = LEAF_IDS) -> bytes:
    """Bytes of the ids: leaves decoded alone, concatenated up the tree."""
    if len(ids) <= leaf_ids:
        return codec.decode_bytes(ids.tolist())
    middle = len(ids) // 2
    return decode(codec, ids[:middle], leaf_ids) + decode(codec, ids[middle:], leaf_ids)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, ids (little-endian uint32) of each row's whole ``text``.

    NULL text is encoded as empty text (no ids); a NULL id stays NULL; repeated rows stay
    repeated; an empty table gives an empty table.  No shuffle: a row is encoded where it
    is read, one document at a time.
    """

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        codec = encoder(ranks_path, pattern)
        for doc_id, text in rows:
            ids = encode(codec, (text or b"").decode("utf-8", "replace"))
            yield doc_id, len(ids), ids.astype("<u4").tobytes()

    narrow = columns(docs, doc_id=id_col, text="text")
    return map_rows(narrow, run, "doc_id bigint, n_tokens bigint, ids binary", rows=256)


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, text (binary) of rows of ``encode_documents``; NULL ids give empty bytes."""

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        codec = encoder(ranks_path, pattern)
        for doc_id, ids in rows:
            yield doc_id, decode(codec, np.frombuffer(ids or b"", "<u4"))

    return map_rows(columns(encoded, doc_id="doc_id", ids="ids"), run, "doc_id bigint, text binary", rows=256)


def digest_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: the round trip of each row in one pass.

    NULL text is empty: no tokens, and the digests of nothing.  Repeated rows and rows
    without an id give a row each.
    """

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        codec = encoder(ranks_path, pattern)
        for doc_id, text in rows:
            ids = encode(codec, (text or b"").decode("utf-8", "replace"))
            digest = hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest()
            yield doc_id, len(ids), digest, hashlib.sha256(decode(codec, ids)).hexdigest()

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_rows(columns(docs, doc_id="doc_id", text="text"), run, schema)

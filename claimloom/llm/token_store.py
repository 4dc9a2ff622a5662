"""Operator 3: token ids as directly addressable codes, in document order.

Ids are split into chunks of eight bits.  Level 0 holds the lowest chunk of every id;
its continuation bitmap says which ids go on at level 1, and so forth.  A rank directory
counts the continuations before every block of the bitmap, so that the place of id i at
the next level is one look-up and one count within a block: any token is read without
decoding its neighbours.

The store is a table of segments.  A segment holds the codes of whole documents (about
``segment_ids`` ids, more only if one document alone has more), and how many ids come
before it in its shard.  Shards are the range partitions of the documents by doc_id; the
one table that spans the store has one row per shard.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from claimloom.llm.common import Scratch, columns, map_rows

SEGMENT_IDS = 1 << 20
_BLOCK_BITS = 512
_LONG_WORD = 64
_MARK = b"\x01"  # stands between words that are encoded in one call
_CALL_BYTES = 1 << 16
_PUNCTUATED = re.compile(rb"([!-&(-/:-@\[-^`{-~])(?<=[a-z].)")  # but for ' and _, which may go on a word
_LATIN = "".join(c for c in map(chr, [*range(0x61, 0x7B), *range(0xDF, 0x180)]) if c.islower())
#: Words a worker keeps the ids of, some 100 bytes each with their ids.
KEPT_IDS = 500_000


class Codes:
    """Ids as levels of bytes, bitmaps and rank directories."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self._levels = levels

    @classmethod
    def build(cls, ids: np.ndarray) -> Codes:
        levels, rest = [], ids.astype(np.uint64)
        while True:
            goes_on = rest > 0xFF
            bitmap = np.packbits(goes_on, bitorder="little")
            padded = np.zeros(-(-max(len(rest), 1) // _BLOCK_BITS) * _BLOCK_BITS // 8, np.uint8)
            padded[: len(bitmap)] = bitmap
            ones = np.bitwise_count(padded).reshape(-1, _BLOCK_BITS // 8).sum(axis=1, dtype=np.uint64)
            ranks = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u8")
            levels.append(((rest & 0xFF).astype(np.uint8), padded, ranks))
            rest = rest[goes_on] >> np.uint64(8)
            if not len(rest):
                return cls(levels)

    def tobytes(self) -> bytes:
        parts = [struct.pack("<I", len(self._levels))]
        for chunk, bitmap, ranks in self._levels:
            parts += [struct.pack("<Q", len(chunk)), chunk.tobytes(), bitmap.tobytes(), ranks.tobytes()]
        return b"".join(parts)

    @classmethod
    def read(cls, data: bytes) -> Codes:
        levels, at = [], 4
        for _ in range(struct.unpack_from("<I", data)[0]):
            (n,) = struct.unpack_from("<Q", data, at)
            blocks = -(-max(n, 1) // _BLOCK_BITS)
            chunk = np.frombuffer(data, np.uint8, n, at + 8)
            bitmap = np.frombuffer(data, np.uint8, blocks * _BLOCK_BITS // 8, at + 8 + n)
            ranks = np.frombuffer(data, "<u8", blocks, at + 8 + n + len(bitmap))
            levels.append((chunk, bitmap, ranks))
            at += 8 + n + len(bitmap) + 8 * blocks
        return cls(levels)

    @staticmethod
    def _rank(level: tuple[np.ndarray, np.ndarray, np.ndarray], i: int) -> int:
        """How many ids before place i go on."""
        _, bitmap, ranks = level
        block, within = divmod(i, _BLOCK_BITS)
        if block == len(ranks):
            return int(ranks[-1]) + int(np.bitwise_count(bitmap[-_BLOCK_BITS // 8 :]).sum())
        first = block * _BLOCK_BITS // 8
        whole = bitmap[first : first + within // 8]
        part = int(bitmap[first + within // 8]) & ((1 << within % 8) - 1)
        return int(ranks[block]) + int(np.bitwise_count(whole).sum()) + part.bit_count()

    def __getitem__(self, i: int) -> int:
        value = 0
        for depth, level in enumerate(self._levels):
            value |= int(level[0][i]) << (8 * depth)
            if not level[1][i // 8] >> (i % 8) & 1:
                break
            i = self._rank(level, i)
        return value

    def slice(self, low: int, high: int) -> np.ndarray:
        """Ids low to high - 1 as uint32."""
        high = min(high, len(self._levels[0][0]))
        ids = np.zeros(max(0, high - low), np.uint32)
        if not len(ids):
            return ids
        where, depth = np.arange(len(ids)), 0
        while len(where):
            chunk, bitmap, _ = level = self._levels[depth]
            ids[where] |= chunk[low:high].astype(np.uint32) << np.uint32(8 * depth)
            bits = np.unpackbits(bitmap[low // 8 : -(-high // 8)], bitorder="little")
            goes_on = bits[low % 8 : low % 8 + high - low].astype(bool)
            where = where[goes_on]
            if len(where):
                low = self._rank(level, low)
                high = low + len(where)
            depth += 1
        return ids


class WordEncoder:
    """The ids the tokenizers library gives for whole texts, word by word.

    White space ends every match of this kind of tokenizer and leaves no token itself, so
    the ids of a text are those of its words one after another.  Words that come again
    are looked up; new ones go to the library many at a time.  Words of letters alone are
    one match each and end with a token that ends a word; between others stands a mark.
    Words of lower-case Latin letters, which its normaliser and splitter leave as they are,
    go straight to its model, written in the letters that the splitter hands on.

    If the library lower-cases, capitals A-Z are lowered first; and a blank is put between
    a letter a-z and the punctuation after it, where a match ends anyway.  Both make more
    words equal, and neither is done to a text in which an added token could be meant.
    """

    def __init__(self, path: str, kept: int = KEPT_IDS):
        self._library = Tokenizer.from_file(path)
        self._library.no_truncation()
        self._library.no_padding()
        self._mark = self._library.encode(_MARK.decode(), add_special_tokens=False).ids
        self._known: dict[bytes, bytes] = {}
        self._kept = kept
        rules = json.loads(self._library.to_str())
        self._added = [t["content"].encode().lower() for t in rules["added_tokens"]]
        letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        normal = self._library.normalizer
        self._lowers = normal is not None and normal.normalize_str(letters) == letters.lower()
        suffix = rules["model"].get("end_of_word_suffix")
        vocabulary = self._library.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True

        # A word of letters that pass through normaliser and splitter as they are goes to the
        # model at once; the probe holds every two letters side by side.
        splitter = self._library.pre_tokenizer
        self._written: dict[int, str] = {}
        for candidates in (_LATIN, letters.lower()) if self._ends.any() and splitter is not None else ():
            written = {c: "".join(piece for piece, _ in splitter.pre_tokenize_str(c)) for c in candidates}
            probe = "".join(a + b for a in candidates for b in candidates)
            pieces = [piece for piece, _ in splitter.pre_tokenize_str(probe)]
            whole = pieces == ["".join(map(written.__getitem__, probe))] and len(pieces[0].split()) == 1
            if whole and (normal is None or normal.normalize_str(probe) == probe):
                self._written = {ord(c): text for c, text in written.items()}
                break
        self._letters = re.compile(f"[{''.join(map(chr, self._written))}]+" if self._written else r"(?!)")
        self._as_is = all(self._written.get(ord(c)) == c for c in letters.lower())
        self._straight = Tokenizer(self._library.model)
        self._straight.pre_tokenizer = pre_tokenizers.WhitespaceSplit()

    def _ids(self, text: str, library: Tokenizer | None = None) -> np.ndarray:
        ids = (library or self._library).encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, np.uint32)

    def _together(
        self, words: list[bytes], between: str, texts: list[str] | None = None, library: Tokenizer | None = None
    ) -> None:
        """Learn words in calls of about _CALL_BYTES, if their ids can be told apart; ``texts`` is what is encoded for them."""
        start = 0
        while start < len(words):
            call, size = start, 0
            while call < len(words) and size < _CALL_BYTES:
                size += len(words[call])
                call += 1
            if texts is None:
                text = between.encode().join(words[start:call]).decode("utf-8", "replace")
            else:
                text = between.join(texts[start:call])
            ids = self._ids(text, library)
            if between == " ":
                ends = np.flatnonzero(self._ends[ids]) + 1
                starts = np.append(0, ends[:-1])
            else:
                marks = np.flatnonzero(ids == self._mark[0])
                starts, ends = np.append(0, marks + 1), np.append(marks, len(ids))
            data = ids.astype("<u4").tobytes()
            if len(ends) == call - start and len(ids):
                found = map(slice, (4 * starts).tolist(), (4 * ends).tolist())
                self._known.update(zip(words[start:call], map(data.__getitem__, found)))
            start = call

    def _learn(self, words: set[bytes]) -> None:
        known = self._known
        short = [w for w in words if len(w) <= _LONG_WORD]
        if self._as_is:
            plain = [w for w in short if w.isalpha() and w.islower()]
            self._together(plain, " ", library=self._straight)
            short = [w for w in short if w not in known]
        texts = [w.decode("utf-8", "replace") for w in short]
        if self._written:
            straight = [(w, t.translate(self._written)) for w, t in zip(short, texts) if self._letters.fullmatch(t)]
            self._together([w for w, _ in straight], " ", [t for _, t in straight], self._straight)
        if self._ends.any():
            self._together([w for w, t in zip(short, texts) if w not in known and t.isalpha()], " ")
        if len(self._mark) == 1:
            between = f" {_MARK.decode()} "
            self._together([w for w in short if w not in known and _MARK not in w], between)
        for word in words.difference(known):  # long words, and those that cannot be told apart
            known[word] = self._ids(word.decode("utf-8", "replace")).astype("<u4").tobytes()

    def _words(self, text: bytes) -> list[bytes]:
        low = text.lower()
        if any(token in low for token in self._added):
            return text.split()
        return _PUNCTUATED.sub(rb" \1", low if self._lowers else text).split()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """For each text its ids as little-endian uint32."""
        split = [self._words(text) for text in texts]
        if len(self._known) > self._kept:
            self._known.clear()
        new = set().union(*split).difference(self._known)
        self._learn(new)
        ids = [b"".join(map(self._known.__getitem__, words)) for words in split]
        for word in [w for w in new if len(w) > _LONG_WORD]:
            del self._known[word]
        return ids


@lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


@dataclass(frozen=True)
class Store:
    """The segments as written, and how many ids come before each shard."""

    segments: DataFrame
    shards: DataFrame
    segment_ids: int


_SEGMENTS = "shard bigint, segment bigint, before bigint, n_ids bigint, doc_ids array<bigint>, ends binary, codes binary"


def _segments(path: str, end_id: int, segment_ids: int):
    """Rows in document order become the segments of this partition's shard."""
    end = np.array([end_id], "<u4").tobytes()

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        encoder, shard = word_encoder(path), TaskContext.get().partitionId()
        before = segment = 0
        held: list[tuple] = []
        texts: list[tuple] = []

        def encoded() -> None:
            found = encoder.encode([text or b"" for _, text in texts])
            held.extend((doc_id, ids + end) for (doc_id, _), ids in zip(texts, found))
            texts.clear()

        def packed() -> tuple:
            nonlocal before, segment
            ids = np.frombuffer(b"".join(ids for _, ids in held), "<u4")
            ends = np.cumsum([len(ids) // 4 for _, ids in held]).astype("<u8")
            row = (shard, segment, before, len(ids), [d for d, _ in held], ends.tobytes(), Codes.build(ids).tobytes())
            before, segment = before + len(ids), segment + 1
            held.clear()
            return row

        size = ids_held = 0
        for row in rows:
            texts.append(row)
            size += len(row[1] or b"")
            if size >= 1 << 20:
                known = len(held)
                encoded()
                ids_held += sum(len(ids) for _, ids in held[known:]) // 4
                size = 0
                if ids_held >= segment_ids:
                    yield packed()
                    ids_held = 0
        encoded()
        if held:
            yield packed()

    return run


def write(
    docs: DataFrame, path: str, end_id: int, partitions: int | None = None, segment_ids: int = SEGMENT_IDS
) -> Store:
    """Encode ``text`` of all rows, end each with ``end_id`` and write them by doc_id.

    NULL text is empty: its document has the end id alone.  Rows with a NULL doc_id come
    first.  Rows that share a doc_id are kept, in the order of a hash of their text; the
    input partition is the last sort key, so that copies of one row spread over shards.
    """
    rows = columns(docs, doc_id="doc_id", text="text").withColumn("_hash", F.xxhash64("text"))
    rows = rows.withColumn("_source", F.spark_partition_id())
    order = ["doc_id", "_hash", "_source"]
    ranged = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
    ordered = ranged.sortWithinPartitions(*order).select("doc_id", "text")
    segments = map_rows(ordered, _segments(path, end_id, segment_ids), _SEGMENTS, rows=1)
    landed = Scratch(docs.sparkSession, "tokens").land(segments, "segments")
    # One row per write task: the window and the broadcast below are bounded by their number.
    sizes = landed.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = sizes.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shard_start"))
    return Store(landed, shards, segment_ids)


def documents(store: Store) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the codes."""

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for before, shard_start, doc_ids, ends, codes in rows:
            read, low = Codes.read(codes), 0
            for doc_id, high in zip(doc_ids, np.frombuffer(ends, "<u8").tolist()):
                ids = read.slice(low, high).astype("<u4")
                yield doc_id, shard_start + before + low, high - low, zlib.crc32(ids.tobytes())
                low = high

    placed = store.segments.join(F.broadcast(store.shards), "shard")
    narrow = placed.select("before", "shard_start", "doc_ids", "ends", "codes")
    return map_rows(narrow, run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def tokens_at(store: Store, positions: DataFrame) -> DataFrame:
    """position, token for places of the whole id stream (0 is the first id of all).

    A place outside the stream or NULL gives no row; repeated places give one row each.
    Only the codes of segments that are asked for are read.
    """
    span = store.segment_ids

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for position, start, codes in rows:
            yield position, Codes.read(codes)[position - start]

    placed = store.segments.join(F.broadcast(store.shards), "shard")
    start = F.col("shard_start") + F.col("before")
    index = placed.select("shard", "segment", start.alias("_start"), (start + F.col("n_ids")).alias("_end"))
    cells = F.sequence(F.expr(f"_start div {span}"), F.expr(f"(_end - 1) div {span}"))
    index = index.withColumn("_cell", F.explode(cells))
    asked = positions.select("position", F.expr(f"position div {span}").alias("_cell"))
    asked = asked.join(index, "_cell").filter((F.col("position") >= F.col("_start")) & (F.col("position") < F.col("_end")))
    found = store.segments.select("shard", "segment", "codes").join(asked, ["shard", "segment"])
    return map_rows(found.select("position", "_start", "codes"), run, "position bigint, token bigint")

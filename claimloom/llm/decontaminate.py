"""Operator 8: benchmark decontamination by a generalised suffix automaton.

The automaton holds every run of words of the normalised test items.  A document's words
are streamed through it; after each word it is in the state of the longest run that ends
there and occurs in an item.  Where that run has the length of a window, a window ends:
all its words are hit, and the state says which items have it.

Items are dealt by hash into parts of a bounded number of words, each with an automaton
small enough for a worker.  A batch of documents passes the parts one after another, its
hits so far in bitmaps, and none is left out.  Items beyond what workers can hold come in
blocks of parts: all documents pass one block after another, their hits landed in between.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import partial, reduce
from itertools import count, islice, repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.llm.common import Scratch, columns, map_rows, slices

WINDOW = 10
#: Words of items in one automaton: some 100 MB at most in a worker.
PART_WORDS = 100_000
KEPT_AUTOMATA = 2
#: Words of items that are broadcast at a time, the proven bound: below 200 MB.
MAX_ITEM_WORDS = 5_000_000
HELD_ROWS = 1000
#: A document with more than this share of its words hit goes as a whole.
MAX_COVERAGE = 0.5

# Lower-cases A-Z and turns what cannot be part of a word into blanks.
_NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_NORMAL).split()


class Automaton:
    """Generalised suffix automaton of items: lists of words, each with an id or None."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.codes: dict[bytes, int] = {}
        self._next: list[dict[int, int]] = [{}]
        self._link, self._size = [-1], [0]
        ends: list[tuple[int, list[int]]] = []
        self._items: list[str | None] = []
        for item_id, words in items:
            if not words:
                continue
            self._items.append(item_id)
            state, path = 0, []
            for word in words:
                state = self._extend(state, self.codes.setdefault(word, len(self.codes) + 1))
                path.append(self.codes[word])
            ends.append((len(self._items) - 1, path))
        #: Per state: (length of a window that ends here, the items it comes from), own windows only.
        own: dict[int, dict[int, set[int]]] = {}
        for item, path in ends:
            size = min(window, len(path))
            for start in range(len(path) - size + 1):
                state = self._find(path[start : start + size])
                own.setdefault(state, {}).setdefault(size, set()).add(item)
        self._own = own
        self.shortest = min((size for sizes in own.values() for size in sizes), default=window)
        self._seen: dict[int, list[tuple[int, set[int]]]] = {}

    def _extend(self, last: int, code: int) -> int:
        follow, link, size = self._next, self._link, self._size
        if code in follow[last]:  # the run is known from an earlier item
            known = follow[last][code]
            return known if size[known] == size[last] + 1 else self._clone(last, code, known)
        new = len(follow)
        follow.append({})
        link.append(0)
        size.append(size[last] + 1)
        state = last
        while state != -1 and code not in follow[state]:
            follow[state][code] = new
            state = link[state]
        if state != -1:
            known = follow[state][code]
            link[new] = known if size[known] == size[state] + 1 else self._clone(state, code, known)
        return new

    def _clone(self, state: int, code: int, known: int) -> int:
        """A state for the runs of ``known`` that are no longer than those of ``state`` plus one."""
        follow, link, size = self._next, self._link, self._size
        copy = len(follow)
        follow.append(dict(follow[known]))
        link.append(link[known])
        size.append(size[state] + 1)
        link[known] = copy
        while state != -1 and follow[state].get(code) == known:
            follow[state][code] = copy
            state = link[state]
        return copy

    def _find(self, path: list[int]) -> int:
        state = 0
        for code in path:
            state = self._next[state][code]
        return state

    def _windows(self, state: int) -> list[tuple[int, set[int]]]:
        """Windows that end wherever a run of this state ends, shortest last."""
        if state not in self._seen:
            found, at = [], state
            while at > 0:
                found += sorted(self._own.get(at, {}).items(), key=lambda w: -w[0])
                at = self._link[at]
            self._seen[state] = found
        return self._seen[state]

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[int]]:
        """Which words are hit, and the items (by number) whose windows occur."""
        hit, items = np.zeros(len(words), bool), set()
        if not self._items:
            return hit, items
        codes = np.fromiter(map(self.codes.get, words, repeat(0)), np.int64, len(words))
        edges = np.flatnonzero(np.diff(np.concatenate([[0], codes != 0, [0]])))
        follow, link, size = self._next, self._link, self._size
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - start < self.shortest:
                continue
            state = length = 0
            for place, code in enumerate(codes[start:end].tolist(), start + 1):
                while code not in follow[state]:  # codes of known words: the root has them all
                    state = link[state]
                    length = size[state]
                state = follow[state][code]
                length += 1
                if length >= self.shortest:
                    for wide, of in self._windows(state):
                        if wide <= length:
                            hit[place - wide : place] = True
                            items |= of
        return hit, items

    def names(self, items: set[int]) -> set[str]:
        return {self._items[i] for i in items if self._items[i] is not None}


_BUILT: dict[str, Automaton] = {}


@dataclass(frozen=True)
class Parts:
    """Broadcast parts of the test items; workers keep the automata of the last few."""

    name: str
    items: list[Broadcast]
    window: int

    def automaton(self, k: int) -> Automaton:
        key = f"{self.name}-{k}"
        if key not in _BUILT:
            if len(_BUILT) >= KEPT_AUTOMATA:
                del _BUILT[next(iter(_BUILT))]
            _BUILT[key] = Automaton(self.items[k].value, self.window)
        return _BUILT[key]

    def scan(self, texts: list[bytes | None]) -> Iterator[tuple[bytes, np.ndarray, set[str]]]:
        """For each text: the text, which of its words are hit, and the ids of the items found."""
        if len(self.items) == 1:
            automaton = self.automaton(0)
            for text in texts:
                hit, items = automaton.scan(words_of(text))
                yield text or b"", hit, automaton.names(items)
            return
        bitmaps: list[bytes | None] = [None] * len(texts)
        names: list[set[str]] = [set() for _ in texts]
        for k in range(len(self.items)):
            automaton = self.automaton(k)
            for i, text in enumerate(texts):
                hit, items = automaton.scan(words_of(text))
                if items or bitmaps[i] is None:
                    before = bitmaps[i]
                    if before is not None:
                        hit |= np.unpackbits(np.frombuffer(before, np.uint8), count=len(hit)).astype(bool)
                    bitmaps[i] = np.packbits(hit).tobytes()
                    names[i] |= automaton.names(items)
        for text, bits, found in zip(texts, bitmaps, names):
            n = len(words_of(text))
            yield text or b"", np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool), found


def parts_of(benchmark: DataFrame, window: int = WINDOW, part_words: int = PART_WORDS) -> list[Callable[[], Parts]]:
    """The test items in parts of about ``part_words`` words, each collected and broadcast alone.

    NULL and empty items have no words and match nothing.  Equal texts with different ids
    are both found.  An item with a NULL id hits words but is not listed.  Workers hold the
    items of all parts of a block, so a block has ``MAX_ITEM_WORDS`` at most; each is sent
    when it is called for.
    """
    items = columns(benchmark, item_id=F.col("item_id").cast("string"), text="text")
    apart = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
    total = items.agg(F.sum(F.size(F.split(F.coalesce("text", F.lit("")), apart)))).first()[0] or 0
    several = total > MAX_ITEM_WORDS
    part_words = min(part_words, MAX_ITEM_WORDS)
    count = -(-total // part_words) or 1
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(count)).cast("int").alias("_part")
    if several:
        pieces = map_rows(items, lambda rows: _pieces(rows, window, part_words), "item_id string, text string").distinct()
        dealt = Scratch(benchmark.sparkSession, "items").land(
            pieces.select("item_id", "text", part).repartition("_part"), "parts", by="_part"
        )
    else:
        dealt = items.select("item_id", "text", part)
    context = benchmark.sparkSession.sparkContext

    def send(first: int, after: int) -> Parts:
        sent = []
        for k in range(first, after):
            rows = dealt.filter(F.col("_part") == k).select("item_id", "text").collect()
            held = [(r.item_id, words_of((r.text or "").encode())) for r in rows]
            sent.append(context.broadcast(sorted(held, key=lambda item: (item[0] or "", item[1]))))
        return Parts(uuid.uuid4().hex, sent, window)

    step = max(1, MAX_ITEM_WORDS // part_words) if several else count
    return [partial(send, first, min(first + step, count)) for first in range(0, count, step)]


def _pieces(rows: Iterable[tuple], window: int, part_words: int) -> Iterator[tuple]:
    """Items in pieces that share all but one word of a window, so that they have the same windows."""
    size = max(part_words, window)
    for item_id, text in rows:
        words = words_of(text)
        for start in range(0, max(1, len(words) - window + 1), size - window + 1):
            yield None if item_id is None else item_id.decode(), b" ".join(words[start : start + size]).decode()


def _pass(docs: DataFrame, blocks: list[Callable[[], Parts]], scratch: Scratch, name: str) -> DataFrame:
    """``docs`` with a column ``name``: bits of the words hit in any block, and the items found.

    Columns but ``text`` stay as they are.  After each block its table is landed, and the one before it goes.
    """
    names = docs.columns
    at = names.index("text")
    kind = T.StructType().add("bits", T.BinaryType()).add("items", T.ArrayType(T.StringType()))
    schema = T.StructType([*docs.schema.fields, T.StructField(name, kind)])
    rows = docs
    for k, block in enumerate(blocks):
        parts = block()

        def run(batches: Iterator[pa.RecordBatch], parts: Parts = parts, k: int = k) -> Iterator[pa.RecordBatch]:
            arrow = pa.struct([("bits", pa.binary()), ("items", pa.list_(pa.string()))])
            for batch in slices(batches):
                texts = batch.column(at).cast(pa.binary()).to_pylist()
                before = batch.column(batch.num_columns - 1).to_pylist() if k else repeat({"bits": b"", "items": []})
                now = []
                for (_, hit, items), known in zip(parts.scan(texts), before):
                    hit |= _bits(known["bits"], len(hit))
                    bits = np.packbits(hit).tobytes() if hit.any() else b""
                    now.append({"bits": bits, "items": sorted(items.union(known["items"]))})
                held = [*batch.columns[: len(names)], pa.array(now, arrow)]
                yield pa.RecordBatch.from_arrays(held, [*names, name])

        rows = scratch.land(rows.mapInArrow(run, schema), f"{name}-{k}")
        if k:
            scratch.drop(f"{name}-{k - 1}")
        for sent in parts.items:
            sent.destroy()
    return rows


def _bits(packed: bytes, count: int) -> np.ndarray:
    if not packed:
        return np.zeros(count, bool)
    return np.unpackbits(np.frombuffer(packed, np.uint8), count=count).astype(bool)


def find_items(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_words: int = PART_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of each row of ``docs``.

    NULL text has no words.  Repeated rows stay repeated, empty tables give empty tables.
    No shuffle: documents are scanned where they are read.
    """
    blocks = parts_of(benchmark, window, part_words)
    rows = columns(docs, doc_id="doc_id", text="text")
    schema = "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"

    def found(doc_id: int | None, hit: np.ndarray, names: Iterable[str]) -> tuple:
        n, listed = int(hit.sum()), sorted(names)
        digest = hashlib.sha256(",".join(listed).encode()).hexdigest()
        return doc_id, len(hit), n, len(listed), digest, n > 0

    if len(blocks) > 1:
        scanned = _pass(rows, blocks, Scratch(docs.sparkSession, "hits"), "hits")

        def told(rows: Iterable[tuple]) -> Iterator[tuple]:
            for doc_id, text, bits, names in rows:
                yield found(doc_id, _bits(bits, len(words_of(text))), names)

        return map_rows(scanned.select("doc_id", "text", "hits.bits", "hits.items"), told, schema)
    parts = blocks[0]()

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        rows = iter(rows)
        while held := list(islice(rows, HELD_ROWS)):
            scanned = parts.scan([text for _, text in held])
            for (doc_id, _), (_, hit, names) in zip(held, scanned):
                yield found(doc_id, hit, names)

    return map_rows(rows, run, schema)


def cut_hits(text: bytes, hit: np.ndarray) -> bytes:
    """The text with each run of hit words, and what lies between them, put down to a line feed."""
    places = [found.span() for found in re.finditer(rb"\S+", text.translate(_NORMAL))]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit, [0]])))
    kept, at = [], 0
    for first, after in zip(edges[::2].tolist(), edges[1::2].tolist()):
        kept += [text[at : places[first][0]], b"\n"]
        at = places[after - 1][1]
    return b"".join([*kept, text[at:]])


def clean(
    docs: DataFrame, benchmark: DataFrame, max_coverage: float = MAX_COVERAGE, window: int = WINDOW
) -> DataFrame:
    """``docs`` without test items: spans are cut out, documents made up of them go.

    A document with more than ``max_coverage`` of its words hit is dropped; of others the
    hit spans are removed, again until no window is left.  Other columns stay as they are,
    but for ``n_chars``, where there is one, which follows the text.  Rows whose text is
    NULL or empty stay as they are, as do all rows if no item has a word; repeated rows
    are treated alike.
    """
    blocks = parts_of(benchmark, window)
    names = docs.columns
    at = names.index("text")
    if len(blocks) > 1:
        return _lengths(_clean_by_blocks(docs, blocks, max_coverage), docs)
    parts = blocks[0]()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            kept, new = [], []
            for i, (text, hit, _) in enumerate(parts.scan(texts)):
                if hit.sum() > max_coverage * len(hit):
                    continue
                while hit.any():
                    text = cut_hits(text, hit)
                    _, hit, _ = next(iter(parts.scan([text])))
                kept.append(i)
                new.append(None if texts[i] is None else text.decode("utf-8", "replace"))
            rows = batch.take(pa.array(kept, pa.int64()))
            rows = rows.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))
            yield rows

    return _lengths(docs.mapInArrow(run, docs.schema), docs)


def _lengths(cut: DataFrame, docs: DataFrame) -> DataFrame:
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


def _clean_by_blocks(docs: DataFrame, blocks: list[Callable[[], Parts]], max_coverage: float) -> DataFrame:
    """As ``clean``, in rounds: what is hit in any block is cut out, and what was cut passes all blocks again."""
    scratch, names, done = Scratch(docs.sparkSession, "clean"), docs.columns, []
    at = names.index("text")

    def cut(batches: Iterator[pa.RecordBatch], most: float) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            kept, new = [], []
            for i, (text, hits) in enumerate(zip(texts, batch.column(batch.num_columns - 1).to_pylist())):
                hit = _bits(hits["bits"], len(words_of(text)))
                if hit.sum() <= most * len(hit):
                    kept.append(i)
                    new.append(cut_hits(text, hit).decode("utf-8", "replace"))
            rows = batch.select(names).take(pa.array(kept, pa.int64()))
            yield rows.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return cut(batches, max_coverage)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return cut(batches, 1.0)

    left = docs
    for number in count():
        name = f"_hits_{uuid.uuid4().hex}"
        scanned = _pass(left, blocks, scratch, name)
        is_hit = F.length(f"{name}.bits") > 0
        done.append(scanned.filter(~is_hit).select(*names))
        rows = scanned.filter(is_hit).mapInArrow(again if number else first, docs.schema)
        left = scratch.land(rows, f"cut-{number}")
        if left.isEmpty():
            return reduce(DataFrame.unionAll, done)

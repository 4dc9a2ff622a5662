"""Operator 6: near-duplicates by MinHash with tensored banding, links confirmed on full sets.

A document's set holds its distinct shingles of five words.  Two small collections of
``TABLES`` keys are made from ``WIDTH`` minima each; every pair of a key of the one with a
key of the other is a key of one of ``TABLES`` squared tables.  48 minima do the work of 576.

1. Rows are sketched; rows with equal sets become one node.
2. Nodes that share a table key are candidates.  Within a bucket sketches are compared,
   and a spanning forest of the pairs that may reach the threshold is handed on.
3. Candidate edges form clusters.  The sets of a cluster's nodes meet in tasks, in blocks
   of bounded size: every two blocks of a cluster meet in one task, where the sizes of all
   intersections that could reach the threshold are counted and confirmed links kept, again
   as a forest.
4. Components of the confirmed links give each row its class.

So no task holds more than two blocks, no list of pairs is ever made, and a link between
two nodes of a cluster is never missed; what may be missed is a pair that shares no table
key or looks unlike in its sketch: one of 8,000 pairs at exactly the threshold, fewer above
it, and only if no chain of other links joins them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import Scratch, WordHashes, columns, map_rows
from claimloom.llm.components import components
from claimloom.operators.keys import number_rows

SHINGLE = 5
PERCENT = 75
TABLES = 12
WIDTH = 2
MINIMA = 2 * TABLES * WIDTH
#: Equal minima of the 48 from which a pair is a candidate: at the threshold 36 are expected.
ALIKE = MINIMA // 2
BUCKET_ROWS = 2048
BLOCK_SHINGLES = 1 << 20
BLOCK_NODES = 2048

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * _MIX
    return values ^ (values >> np.uint64(29))


def _factors() -> np.ndarray:
    return _mixed(np.arange(1, MINIMA + 1, dtype=np.uint64) * _ODD) | np.uint64(1)


def shingles_of(text: bytes | None, hashes: WordHashes) -> np.ndarray:
    """The document's set: sorted distinct 64-bit hashes of its shingles."""
    words = hashes.of((text or b"").lower().split())  # bytes: A-Z only, and the six white spaces
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    size = min(n, SHINGLE)
    total = np.full(n - size + 1, size, np.uint64)
    for k in range(size):
        total = total * _ODD + words[k : n - size + 1 + k]
    return np.unique(_mixed(total))


def sketch_of(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    return np.array([((shingles * f) >> np.uint64(32)).min() for f in factors], np.uint32)


def table_keys(sketches: np.ndarray) -> np.ndarray:
    """For each sketch its TABLES squared keys, as signed 64-bit numbers."""
    half = sketches.astype(np.uint64).reshape(len(sketches), 2, TABLES, WIDTH)
    small = np.zeros(half.shape[:3], np.uint64)
    for k in range(WIDTH):
        small = _mixed((small ^ half[..., k]) * _ODD)
    number = np.arange(TABLES * TABLES, dtype=np.uint64).reshape(TABLES, TABLES)
    pairs = _mixed((small[:, 0, :, None] * _ODD + small[:, 1, None, :]) ^ (number * _MIX))
    return pairs.reshape(len(sketches), -1).view(np.int64)


def _sketch_rows(rows: Iterable[tuple]) -> Iterator[tuple]:
    hashes, factors = WordHashes(), _factors()
    for doc_id, text, text_hash in rows:
        shingles = shingles_of(text, hashes)
        if not len(shingles):
            yield doc_id, text_hash, 0, None, None
            continue
        mark = xxhash.xxh3_128_digest(shingles.tobytes())
        yield doc_id, text_hash, len(shingles), mark, sketch_of(shingles, factors).tobytes()


def _key_rows(rows: Iterable[tuple]) -> Iterator[tuple]:
    for node, sketch in rows:
        yield node, table_keys(np.frombuffer(sketch, np.uint32)[None, :])[0].tolist()


class Forest:
    """Union-find over places 0 to n - 1; roots are the smallest place."""

    def __init__(self, n: int):
        self.root = list(range(n))

    def find(self, x: int) -> int:
        root = self.root
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        self.root[max(x, y)] = min(x, y)

    def edges(self, nodes: list[int]) -> Iterator[tuple[int, int]]:
        for x in range(len(nodes)):
            if (root := self.find(x)) != x:
                yield nodes[x], nodes[root]


def alike(nodes: list[int], sketches: np.ndarray) -> Iterator[tuple[int, int]]:
    """A spanning forest of the pairs of a bucket that are alike enough to be candidates."""
    rest = np.arange(len(nodes))
    while len(rest) > 1:
        seed, rest = rest[0], rest[1:]
        found = [seed]
        while found and len(rest):
            near = (sketches[rest] == sketches[found.pop()]).sum(axis=1) >= ALIKE
            for x in rest[near].tolist():
                yield nodes[x], nodes[seed]
                found.append(x)
            rest = rest[~near]


def _reaching(order: list[int], parts: list[np.ndarray], sizes: np.ndarray, asked: list[int], forest: Forest) -> None:
    """Join each of ``asked`` with those in ``order`` (by size) that it is linked with.

    A set can only reach the threshold with sets of similar size: a stretch of ``order``.
    The stretch's intersections are counted at once, by marking the asked set's shingles.
    """
    joined = np.concatenate([parts[x] for x in order])
    own_sizes = sizes[order]
    starts = np.concatenate([[0], np.cumsum(own_sizes)])
    present = np.zeros(max(part.max() for part in parts) + 1, bool)
    for x in asked:
        n = sizes[x]
        low = np.searchsorted(100 * own_sizes, PERCENT * n, "left")
        high = np.searchsorted(PERCENT * own_sizes, 100 * n, "right")
        if low == high:
            continue
        present[parts[x]] = True
        stretch = present[joined[starts[low] : starts[high]]]
        shared = np.add.reduceat(stretch, starts[low:high] - starts[low], dtype=np.int64)
        present[parts[x]] = False
        united = n + own_sizes[low:high] - shared
        for k in np.flatnonzero(100 * shared >= PERCENT * united).tolist():
            forest.join(x, order[low + k])


def links(sets: list[np.ndarray], sides: list[int]) -> Forest:
    """Confirmed links as a forest: of all pairs, or if there are two sides of pairs across."""
    forest = Forest(len(sets))
    sizes = np.array([len(s) for s in sets])
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    parts = np.split(codes, np.cumsum(sizes)[:-1])
    order = np.argsort(sizes, kind="stable").tolist()
    first = min(sides)
    asked = [x for x in order if sides[x] == first]
    across = [x for x in order if sides[x] != first]
    _reaching(across or order, parts, sizes, asked, forest)
    return forest


def _compare_buckets(rows: Iterable[tuple]) -> Iterator[tuple]:
    for _, same in groupby(rows, key=lambda row: row[:3]):
        held = {row[3]: row[4] for row in same}
        if len(held) > 1:
            yield from alike(list(held), np.frombuffer(b"".join(held.values()), np.uint32).reshape(len(held), -1))


def _confirm_blocks(rows: Iterable[tuple]) -> Iterator[tuple]:
    for (_, low, high), same in groupby(rows, key=lambda row: row[:3]):
        held = {node: (block, data) for _, _, _, block, node, data in same}
        if len({block for block, _ in held.values()}) == (1 if low == high else 2):
            nodes = sorted(held)
            sets = [np.frombuffer(held[node][1], np.uint64) for node in nodes]
            yield from links(sets, [held[node][0] for node in nodes]).edges(nodes)


def _set_rows(rows: Iterable[tuple]) -> Iterator[tuple]:
    """Sets of representatives; copies of a row follow one another, and one of them is enough."""
    hashes, last = WordHashes(), None
    for text, node, mark, cluster, block, blocks in rows:
        if node == last:
            continue
        shingles = shingles_of(text, hashes)
        if xxhash.xxh3_128_digest(shingles.tobytes()) == mark:
            last = node
            yield node, cluster, block, blocks, shingles.tobytes()


def _with_texts(narrow: DataFrame, dealt: DataFrame) -> DataFrame:
    """The rows representatives were taken from, with their texts: a row meets those of its own id and text only."""
    # Representatives in clusters grow with the corpus: they are never broadcast, at any size.
    same = narrow["doc_id"].eqNullSafe(dealt["_id"]) & (narrow["text_hash"] == dealt["_hash"])
    found = narrow.join(dealt.hint("merge"), same)
    return found.select("text", "node", "mark", "cluster", "_block", "_blocks")


def _meetings(df: DataFrame, block: str, blocks: str) -> DataFrame:
    """Each row once for every block its own block meets, as (_low, _high)."""
    met = df.withColumn("_met", F.explode(F.sequence(F.lit(0), F.col(blocks) - 1)))
    return met.withColumns({"_low": F.least(block, "_met"), "_high": F.greatest(block, "_met")})


def _buckets(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """_key, node, _size: members of the buckets with two nodes or more.

    A bucket of two is its smallest and its largest node, so the same pair found in many
    tables is one bucket; members of larger ones are looked up by their key.
    """
    # A node's keys are six times its sketch: files that one task would read are dealt to many.
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = nodes.select("node", "sketch").repartition(tasks)
    keyed = map_rows(dealt, _key_rows, "node bigint, keys array<bigint>", rows=500)
    keys = keyed.select("node", F.explode("keys").alias("_key"))
    sizes = keys.groupBy("_key").agg(
        F.count(F.lit(1)).alias("_size"), F.min("node").alias("_first"), F.max("node").alias("_last")
    )
    shared = scratch.land(sizes.filter("_size > 1"), "shared")
    pairs = shared.filter("_size = 2").select("_first", "_last").distinct()
    pairs = pairs.select(
        F.xxhash64("_first", "_last").alias("_key"), F.explode(F.array("_first", "_last")).alias("node"), F.lit(2).alias("_size")
    )
    larger = keys.join(shared.filter("_size > 2").select("_key", F.col("_size").cast("int")), "_key")
    return pairs.unionByName(larger)


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs``.

    NULL or empty text and text without words has an empty set and is a class of its own.
    Rows that share a doc_id, or have a NULL one, are rows like others; a class whose ids
    are all NULL has a NULL component_id, and its rows are kept.
    """
    scratch = Scratch(docs.sparkSession, "minhash")
    narrow = columns(docs, doc_id="doc_id", text="text").withColumn("text_hash", F.xxhash64("text"))
    schema = "doc_id bigint, text_hash bigint, n_shingles bigint, mark binary, sketch binary"
    rows = scratch.land(map_rows(narrow, _sketch_rows, schema), "rows")
    # The smallest id, a NULL one only if there is no other, and the text of a row that has it.
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash"))
    grouped = rows.filter("mark IS NOT NULL").groupBy("mark").agg(
        least.alias("_least"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")
    )
    grouped = grouped.select("mark", "_least.doc_id", "_least.text_hash", "n_shingles", "sketch")
    nodes = scratch.land(number_rows(grouped, "node", landing=f"{scratch.root}/grouped"), "nodes")
    scratch.drop("grouped")

    buckets = _buckets(nodes, scratch)
    blocks = F.ceil(F.col("_size") / BUCKET_ROWS).cast("int")
    members = buckets.join(nodes.select("node", "sketch"), "node").withColumn("_blocks", blocks)
    members = members.withColumn("_block", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int"))
    met = _meetings(members, "_block", "_blocks").select("_key", "_low", "_high", "node", "sketch")
    met = met.repartition("_key", "_low", "_high").sortWithinPartitions("_key", "_low", "_high", "node")
    candidates = components(map_rows(met, _compare_buckets, "u bigint, v bigint", rows=20_000), scratch, "candidates")
    scratch.drop("shared")

    known = candidates.withColumnRenamed("label", "cluster").join(nodes, "node")
    known = scratch.land(known.select("node", "cluster", "mark", "doc_id", "text_hash", "n_shingles"), "clusters")
    sizes = known.groupBy("cluster").agg(
        F.greatest(
            F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES), F.ceil(F.count(F.lit(1)) / BLOCK_NODES), F.lit(1)
        ).cast("int").alias("_blocks")
    )
    dealt = known.join(sizes, "cluster").withColumn("_block", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int"))
    ids = [F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")]
    dealt = dealt.select(*ids, "node", "mark", "cluster", "_block", "_blocks")
    found = _with_texts(narrow, dealt)
    sets = map_rows(found, _set_rows, "node bigint, cluster bigint, _block int, _blocks int, shingles binary", rows=200)
    met = _meetings(sets, "_block", "_blocks").select("cluster", "_low", "_high", "_block", "node", "shingles")
    met = met.repartition("cluster", "_low", "_high").sortWithinPartitions("cluster", "_low", "_high", "node")
    linked = components(map_rows(met, _confirm_blocks, "u bigint, v bigint", rows=20_000), scratch, "links")
    scratch.drop("clusters")

    labelled = nodes.select("mark", "node", "doc_id").join(linked, "node", "left")
    labelled = labelled.withColumn("label", F.coalesce("label", "node"))
    least = labelled.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    marks = labelled.join(least, "label").select("mark", "component_id")
    judged = rows.select("doc_id", "n_shingles", "mark").join(marks, "mark", "left")
    component = F.when(F.col("mark").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    judged = judged.select("doc_id", "n_shingles", component.alias("component_id"))
    return judged.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """The whole rows of ``docs``, one document of each class.

    Rows without an id stay.  Rows with the same id and text are one document.
    """
    kept = classes(docs).filter("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    rows = docs.filter("doc_id IS NOT NULL").join(kept, "doc_id", "left_semi").select(F.struct("*").alias("_row"))
    rows = rows.withColumns({"_id": F.col("_row.doc_id"), "_text": F.xxhash64("_row.text")})
    rows = rows.dropDuplicates(["_id", "_text"]).select("_row.*")
    return rows.unionByName(docs.filter("doc_id IS NULL"))

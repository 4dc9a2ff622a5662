"""Operator 13: hard negatives by exact integer scores from float32 products.

Vectors are made whole numbers.  Their inner products with the anchors are taken modulo
several small primes, each as a product of two float32 matrices of residues, exact
because no partial sum passes 2**24.  Chinese remaindering puts the signed scores
together.  A window below each positive's score then selects the negatives.

The anchors are a stated query set: packs of them meet all rows in blocks, spread by two
numbers (pack of anchors, salt of rows), so neither a label nor a vector decides where a
row goes.  A task holds one pack of anchors and one tile of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, prod

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from claimloom.llm.common import Scratch, columns

#: The moduli, the largest primes of one byte; their product stays below 2**63.
PRIMES = [251, 241, 239, 233, 229, 227, 223, 211]
#: Sums of products of residues stay exact in float32 below this.
EXACT = 1 << 24
SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: A negative's score is at least and at most so many hundredths of its positive's.
LOW, HIGH = 30, 90
#: Anchors a task holds, rows of a salt at least, salts at most, and scores of a tile.
PACK, SALT_ROWS, SALTS = 8192, 512, 512
TILE_ANCHORS, TILE_ROWS = 512, 4096
#: Stands for a missing vec_id: after all others.
NO_ID = (1 << 63) - 1


class Residues:
    """Products of whole-number matrices through residues.

    ``largest`` is the largest absolute component and ``width`` the number of components:
    as many primes are taken as the scores they allow need.
    """

    def __init__(self, largest: int, width: int):
        self.bound = largest * largest * width
        self.primes: list[int] = []
        while prod(self.primes) <= 2 * self.bound:
            if len(self.primes) == len(PRIMES):
                raise ValueError(f"scores up to {self.bound} do not fit 64 bits")
            self.primes.append(PRIMES[len(self.primes)])
        self.step = EXACT // (PRIMES[0] // 2) ** 2

    def of(self, vectors: np.ndarray) -> list[np.ndarray]:
        """Per prime the residues of smallest size, as float32."""
        return [((vectors + p // 2) % p - p // 2).astype(np.float32) for p in self.primes]

    def scores(self, a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
        """All inner products of rows of ``a`` with rows of ``b``."""
        shape = a[0].shape[0] if a else 0, b[0].shape[0] if b else 0
        digits: list[np.ndarray] = []
        value, unit = np.zeros(shape, np.int64), 1
        for k, p in enumerate(self.primes):
            found = np.zeros(shape, np.int64)
            for at in range(0, a[k].shape[1], self.step):
                found += (a[k][:, at : at + self.step] @ b[k][:, at : at + self.step].T).astype(np.int64)
            # The next digit in the mixed radix of the primes so far.
            for before, digit in zip(self.primes, digits):
                found = (found - digit) % p * pow(before, -1, p)
            digits.append(found % p)
            value += digits[-1] * unit
            unit *= p
        return np.where(value > unit // 2, value - unit, value)


def best_first(scores: np.ndarray, k: int, bound: int) -> np.ndarray:
    """Columns of the ``k`` highest scores of each row, highest first, ties by column."""
    n = scores.shape[1]
    k = min(k, n)
    if (bound + 2) * n >= 1 << 62:  # no room for the column beside the score
        return np.argsort(-scores, axis=1, kind="stable")[:, :k]
    keys = scores * n + np.arange(n - 1, -1, -1)
    chosen = np.argpartition(keys, n - k, axis=1)[:, n - k :] if k < n else np.tile(np.arange(n), (len(keys), 1))
    order = np.argsort(-np.take_along_axis(keys, chosen, 1), axis=1)
    return np.take_along_axis(chosen, order, 1)


class Kept:
    """The best ``k`` of each row's candidates so far; tiles come in the order of the ids."""

    def __init__(self, rows: int, k: int, bound: int):
        self.none = -bound - 1
        self.bound, self.k = bound, k
        self.scores = np.full((rows, 0), self.none)
        self.ids = np.zeros((rows, 0), np.int64)

    def add(self, at: slice, scores: np.ndarray, ids: np.ndarray, grown: tuple[list, list]) -> None:
        """Merge a tile for the rows ``at``; the parts gathered in ``grown`` replace the state."""
        chosen = best_first(scores, self.k, self.bound)
        both = np.concatenate([self.scores[at], np.take_along_axis(scores, chosen, 1)], axis=1)
        named = np.concatenate([self.ids[at], ids[chosen]], axis=1)
        order = np.argsort(-both, axis=1, kind="stable")[:, : self.k]
        grown[0].append(np.take_along_axis(both, order, 1))
        grown[1].append(np.take_along_axis(named, order, 1))

    def replace(self, grown: tuple[list, list]) -> None:
        self.scores, self.ids = np.concatenate(grown[0]), np.concatenate(grown[1])


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of a list array as a matrix; shorter ones end in zeros."""
    lengths = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(vectors), width), np.int64)
    rows = np.repeat(np.arange(len(vectors)), lengths)
    places = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[rows, places] = vectors.flatten().to_numpy(zero_copy_only=False)
    return out


class _Group:
    """Anchors of one pack against the rows of one salt."""

    def __init__(self, residues: Residues, width: int, windows: int, k: int):
        self.residues, self.width, self.windows, self.k = residues, width, windows, k
        self.parts: list[pa.RecordBatch] = []
        self.kept: list[Kept] = []

    def start(self) -> None:
        batch = pa.Table.from_batches(self.parts).combine_chunks().to_batches()[0]
        self.rid, self.id, self.label = (batch[c].to_numpy(zero_copy_only=False) for c in ("rid", "vec_id", "label"))
        self.vectors = self.residues.of(_matrix(batch["vec"], self.width))
        if self.windows:
            low = np.full((self.windows, len(self.rid)), 1, np.int64)
            high = np.zeros_like(low)  # an empty window
            for row, found in enumerate(batch["positives"].to_pylist()):
                for w, positive in enumerate(found):
                    score = positive["score"]
                    low[w, row], high[w, row] = -(-LOW * score // 100), HIGH * score // 100
            self.low, self.high = low, high
        self.kept = [Kept(len(self.rid), self.k, self.residues.bound) for _ in range(self.windows or 1)]

    def add(self, batch: pa.RecordBatch) -> None:
        if batch["kind"][0].as_py() == 0:
            self.parts.append(batch)
            return
        if not self.parts:
            return
        if not self.kept:
            self.start()
        rid, ids, label = (batch[c].to_numpy(zero_copy_only=False) for c in ("rid", "vec_id", "label"))
        vectors = self.residues.of(_matrix(batch["vec"], self.width))
        none = self.kept[0].none
        grown = [([], []) for _ in self.kept]
        for first in range(0, len(self.rid), TILE_ANCHORS):
            at = slice(first, first + TILE_ANCHORS)
            scores = self.residues.scores([m[at] for m in self.vectors], vectors)
            same = self.label[at, None] == label[None, :]
            if not self.windows:
                same &= self.rid[at, None] != rid[None, :]
                self.kept[0].add(at, np.where(same, scores, none), ids, grown[0])
                continue
            for w, kept in enumerate(self.kept):
                fits = ~same & (scores >= self.low[w, at, None]) & (scores <= self.high[w, at, None])
                kept.add(at, np.where(fits, scores, none), ids, grown[w])
        for kept, parts in zip(self.kept, grown):
            kept.replace(parts)

    def result(self, names: list[str]) -> Iterator[pa.RecordBatch]:
        for w, kept in enumerate(self.kept):
            row, place = np.nonzero(kept.scores != kept.none)
            found = [self.rid[row], self.id[row], np.full(len(row), w, np.int64)]
            found += [kept.ids[row, place], kept.scores[row, place]]
            if len(row):
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names)


def _against(scratch: Scratch, anchors: DataFrame, rows: DataFrame, sizes: dict, windows: int, k: int) -> DataFrame:
    """rid, anchor_id, w, other_id, score: for each anchor (and window) the best k rows of each salt."""
    packs = ceil(sizes["anchors"] / PACK)
    salts = min(SALTS, max(1, ceil(sizes["rows"] / SALT_ROWS)))
    names = ["rid", "anchor_id", "w", "other_id", "score"]
    schema = ", ".join(f"{name} bigint" for name in names)
    if not packs:
        return scratch.spark.createDataFrame([], schema)
    pack = F.pmod(F.xxhash64("rid"), F.lit(packs))
    salt = F.pmod(F.xxhash64("rid", F.lit("salt")), F.lit(salts))
    held = ["rid", "vec_id", "label", "vec"]
    every = lambda n: F.explode(F.expr(f"sequence(0L, {n - 1}L)"))
    sides = anchors.select(pack.alias("pack"), every(salts).alias("salt"), F.lit(0).alias("kind"), *held, "positives")
    none = F.lit(None).cast(sides.schema["positives"].dataType).alias("positives")
    sides = sides.union(rows.select(every(packs).alias("pack"), salt.alias("salt"), F.lit(1).alias("kind"), *held, none))
    residues, width = Residues(sizes["largest"], sizes["width"]), sizes["width"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group = None, None
        for batch in batches:
            parts = [batch[c].to_numpy(zero_copy_only=False) for c in ("pack", "salt", "kind")]
            cuts = np.flatnonzero(np.any([p[1:] != p[:-1] for p in parts], axis=0)) + 1
            edges = [0, *cuts.tolist(), batch.num_rows]
            for start, end in zip(edges, edges[1:]):
                if start == end:
                    continue
                if (now := (parts[0][start], parts[1][start])) != key:
                    if group is not None:
                        yield from group.result(names)
                    key, group = now, _Group(residues, width, windows, k)
                for first in range(start, end, TILE_ROWS):
                    group.add(batch.slice(first, min(TILE_ROWS, end - first)))
        if group is not None:
            yield from group.result(names)

    dealt = sides.repartition("pack", "salt").sortWithinPartitions("pack", "salt", "kind", "vec_id", "rid")
    return dealt.mapInArrow(run, schema)


def _first(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first k of each group with their rank: higher scores first, ties by smaller id."""
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "other_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def usable(vectors: DataFrame, anchor: Column) -> DataFrame:
    """vec_id, label, vec (whole numbers) and anchor of the rows that take part."""
    finite = F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    kept = columns(vectors, vec_id="vec_id", label="label", embedding="embedding", anchor=F.coalesce(anchor, F.lit(False)))
    kept = kept.filter("label IS NOT NULL AND embedding IS NOT NULL").filter(finite)
    scaled = F.transform("embedding", lambda x: F.floor(SCALE * x.cast("double")))
    return kept.select(
        F.coalesce("vec_id", F.lit(NO_ID)).cast("bigint").alias("vec_id"),
        F.col("label").cast("bigint").alias("label"),
        scaled.alias("vec"),
        "anchor",
    )


def mine(vectors: DataFrame, anchor: Column) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, label and embedding; the rows for which ``anchor`` holds are the
    anchors.  Rows with a NULL label or vector, or a NULL or non-finite component, take no
    part; those with a NULL vec_id do, after all others of their score.  Repeated rows are
    rows of their own, and other rows than the anchor they equal.  Shorter vectors count as
    ending in zeros, empty ones score 0.  An empty table, or one without anchors, gives no
    rows; other columns are ignored.  Scores beyond 62 bits raise an error.
    """
    scratch = Scratch(vectors.sparkSession, "negatives")
    seen = Observation()
    largest = F.array_max(F.transform("vec", lambda x: F.abs(x)))
    watched = (
        usable(vectors, anchor)
        .withColumn("rid", F.monotonically_increasing_id())
        .observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.count_if("anchor").alias("anchors"),
            F.coalesce(F.max(largest), F.lit(0)).alias("largest"),
            F.coalesce(F.max(F.size("vec")), F.lit(0)).alias("width"),
        )
    )
    rows = scratch.land(watched, "rows")
    sizes = seen.get
    pairs = F.lit(None).cast("array<struct<other_id:bigint,score:bigint>>").alias("positives")
    anchors = rows.filter("anchor").select("*", pairs)
    found = _first(_against(scratch, anchors, rows, sizes, 0, POSITIVES), ["rid"], POSITIVES)
    listed = F.transform(
        F.array_sort(F.collect_list(F.struct("rank", "other_id", "score"))),
        lambda x: F.struct(x["other_id"].alias("other_id"), x["score"].alias("score")),
    )
    positives = scratch.land(found.groupBy("rid").agg(listed.alias("positives")), "positives")
    anchors = anchors.drop("positives").join(positives, "rid")
    found = _first(_against(scratch, anchors, rows, sizes, POSITIVES, NEGATIVES), ["rid", "w"], NEGATIVES)
    positive = F.element_at("positives", (F.col("w") + 1).cast("int"))
    named = found.join(positives, "rid")
    shown = lambda c: F.when(c != NO_ID, c)
    return named.select(
        shown(F.col("anchor_id")).alias("anchor_id"),
        shown(positive["other_id"]).alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        shown(F.col("other_id")).alias("negative_id"),
        positive["score"].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )

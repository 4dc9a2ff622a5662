"""Operator 12: shards of equal size by a minimum-cost flow that moves the fewest bytes.

A sharded table is files of blocks.  A block is a set of rows of one shard, small against
a shard and even in size: rows are dealt to blocks one by one, so no key, copy or source
makes a block large.  What the driver knows is a row per block, a number set by a
parameter and not by the data.

To reshard, the flow from old shards (their bytes) to new ones (their capacities) at the
least cost tells how many bytes go from which shard to which; blocks are chosen to carry
it, whole files first.  Only files that hold a block that leaves its shard are written
again; the manifest of the new state names these and the untouched ones.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from dataclasses import dataclass
from functools import cached_property

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.llm.common import Scratch

OLD_SHARDS, NEW_SHARDS = 12, 16
#: The driver holds a row for so many blocks of each shard a table starts with.
BLOCKS_PER_SHARD = 1024
#: Blocks moved for each shard to even out what the rounding of flows to blocks leaves.
EVENING_MOVES = 100


def min_cost_flow(supply: list[int], capacity: list[int], cost: np.ndarray) -> np.ndarray:
    """Amounts from each supply to each capacity that place all supply at the least cost.

    Successive shortest paths: each path is found on costs reduced by potentials, which
    stay at least 0, and may take back flow that an earlier path has sent.
    """
    if sum(capacity) < sum(supply):
        raise ValueError(f"{sum(supply)} do not fit capacities of {sum(capacity)}")
    n, m = len(supply), len(capacity)
    flow = np.zeros((n, m), np.int64)
    room = np.array(capacity, np.int64)
    cost = np.asarray(cost, np.float64)
    from_potential, to_potential = np.zeros(n), cost.min(axis=0, initial=0)
    for source in range(n):
        left = supply[source]
        while left > 0:
            near_from, near_to = np.full(n, np.inf), np.full(m, np.inf)
            came_to, came_from = np.full(m, -1), np.full(n, -1)
            done_from, done_to = np.zeros(n, bool), np.zeros(m, bool)
            near_from[source] = 0
            while True:
                open_from = np.where(done_from, np.inf, near_from)
                open_to = np.where(done_to, np.inf, near_to)
                i, j = int(open_from.argmin()), int(open_to.argmin())
                if open_from[i] < open_to[j]:
                    done_from[i] = True
                    ways = near_from[i] + np.maximum(cost[i] + from_potential[i] - to_potential, 0)
                    closer = ways < near_to
                    near_to[closer], came_to[closer] = ways[closer], i
                    continue
                done_to[j] = True
                if room[j] > 0:
                    end, reached = j, open_to[j]
                    break
                back = np.where(flow[:, j] > 0, near_to[j], np.inf)
                closer = back < near_from
                near_from[closer], came_from[closer] = back[closer], j
            from_potential += np.minimum(near_from, reached)
            to_potential += np.minimum(near_to, reached)
            path, at = [], end
            while True:
                i = int(came_to[at])
                path.append((i, at))
                if i == source:
                    break
                at = int(came_from[i])
                path.append((i, at))
            amount = min([left, int(room[end]), *(int(flow[arc]) for arc in path[1::2])])
            for step, arc in enumerate(path):
                flow[arc] += amount if step % 2 == 0 else -amount
            room[end] -= amount
            left -= amount
    return flow


@dataclass(frozen=True)
class Block:
    block: int
    shard: int
    parts: tuple[tuple[str, int, int], ...]  # file, bytes, rows: a file may be read, and so written, by several tasks

    @cached_property
    def bytes(self) -> int:
        return sum(size for _, size, _ in self.parts)

    @cached_property
    def rows(self) -> int:
        return sum(rows for _, _, rows in self.parts)

    @cached_property
    def files(self) -> list[str]:
        return [file for file, _, _ in self.parts]


def _runs_by_file(blocks: list[Block]) -> list[Block]:
    """A shard's blocks, those of one file side by side."""
    return sorted(blocks, key=lambda b: (b.files, b.block))


def choose(blocks: list[Block], flow: np.ndarray) -> dict[int, int]:
    """The new shard of each block: runs of blocks carry the flow, then the rest is evened out.

    A block goes to the shard for which it is nearest to what the flow still wants; blocks
    larger than that stay where they are unless evening moves them.
    """
    target: dict[int, int] = {}
    want = flow.sum(axis=0)
    held = defaultdict(list)
    for b in blocks:
        held[b.shard].append(b)
    load = np.zeros(len(want), np.int64)
    within: dict[int, list[Block]] = defaultdict(list)
    for shard, own in held.items():
        wanted = {j: int(x) for j, x in enumerate(flow[shard]) if x and j != shard}
        if shard >= len(want):  # the shard goes: what rounding leaves goes to its largest share
            home = int(np.argmax(flow[shard]))
        else:
            home = shard
        queue = _runs_by_file(own)
        for j in sorted(wanted):
            rest = []
            for k, b in enumerate(queue):
                if wanted[j] <= 0:
                    rest += queue[k:]
                    break
                if b.bytes <= 2 * wanted[j] - 1 and j != home:
                    target[b.block] = j
                    wanted[j] -= b.bytes
                else:
                    rest.append(b)
            queue = rest
        for b in queue:
            target[b.block] = home
    for b in blocks:
        load[target[b.block]] += b.bytes
        within[target[b.block]].append(b)
    for _ in range(EVENING_MOVES * len(want)):
        over = load - want
        low = int(over.argmin())
        for high in np.argsort(-over, kind="stable"):
            gap = int(over[high] - over[low])
            fits = [b for b in within[int(high)] if 0 < b.bytes < gap]
            if fits:
                break
        else:
            break
        # Half the gap evens the two out; among blocks as good, one that has moved already.
        best = min(fits, key=lambda b: (abs(2 * b.bytes - gap), b.shard == int(high), b.block))
        within[int(high)].remove(best)
        within[low].append(best)
        load[high] -= best.bytes
        load[low] += best.bytes
        target[best.block] = low
    return target


class ShardedTable:
    """Rows in shards, as files of blocks.

    Stored rows are the given ones in one column ``row`` (so no name clashes), with
    ``size``, ``block`` and ``place``, the rank within the block.  ``blocks`` is the state
    the driver holds: which shard and files have a block, its bytes and its rows.
    """

    def __init__(self, scratch: Scratch, schema: T.StructType, blocks: list[Block], shards: int, moved: int = 0):
        self.blocks, self.shards, self.moved_bytes = blocks, shards, moved
        self._scratch, self._schema = scratch, schema

    @classmethod
    def create(cls, rows: DataFrame, shard: Column, size: Column, shards: int) -> ShardedTable:
        """Deal ``rows``, read from files, to shards by ``shard`` and to blocks one by one."""
        scratch = Scratch(rows.sparkSession, "shards")
        row = F.struct(*[rows[c] for c in rows.columns]).alias("row")
        bucket = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(BLOCKS_PER_SHARD))
        dealt = rows.select(row, size.cast("bigint").alias("size"), shard.cast("int").alias("shard"))
        dealt = dealt.withColumn("block", (F.col("shard") * BLOCKS_PER_SHARD + bucket).cast("int"))
        within = Window.partitionBy("shard", "block").orderBy("size")
        placed = dealt.withColumn("place", F.row_number().over(within)).select("shard", "row", "size", "block", "place")
        return cls(scratch, placed.schema, cls._write(scratch, placed), shards)

    @staticmethod
    def _write(scratch: Scratch, placed: DataFrame) -> list[Block]:
        """Write rows into a folder for each shard; the blocks that lie there."""
        state = f"state-{uuid.uuid4().hex}"
        stored = scratch.land(placed, state, by="shard")
        parts = stored.groupBy("shard", "block", F.col("_metadata.file_name").alias("file")).agg(
            F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")
        )
        listed = F.array_sort(F.collect_list(F.struct("file", "bytes", "rows")))
        found = parts.groupBy("shard", "block").agg(listed.alias("parts")).orderBy("shard", "block").collect()
        root = f"{scratch.root}/{state}"
        return [
            Block(r.block, r.shard, tuple((f"{root}/shard={r.shard}/{p[0]}", p[1], p[2]) for p in r.parts)) for r in found
        ]

    def sizes(self) -> list[int]:
        """Bytes of each shard."""
        found = [0] * self.shards
        for b in self.blocks:
            found[b.shard] += b.bytes
        return found

    def files(self) -> list[str]:
        return sorted({file for b in self.blocks for file in b.files})

    def reshard(self, capacity: list[int], cost: np.ndarray | None = None) -> ShardedTable:
        """The table in as many shards as capacities are given, each filled up to its capacity.

        ``cost[i, j]`` is that of a byte from old shard i to new shard j; by default 0 if it
        stays and 1 if it moves.  Files without a block that leaves its shard are kept.
        """
        if cost is None:
            cost = 1 - np.eye(self.shards, len(capacity))
        target = choose(self.blocks, min_cost_flow(self.sizes(), capacity, cost))
        gone = [b for b in self.blocks if target[b.block] != b.shard]
        touched = {file for b in gone for file in b.files}
        moved = self._files(sorted(touched)).join(F.broadcast(self._table(target)), "block")
        moved = moved.select("shard", "row", "size", "block", "place")
        written = {b.block: b.parts for b in self._write(self._scratch, moved)} if touched else {}
        blocks = []
        for b in self.blocks:
            stay = tuple(part for part in b.parts if part[0] not in touched)
            blocks.append(Block(b.block, target[b.block], stay + written.get(b.block, ())))
        return ShardedTable(self._scratch, self._schema, blocks, len(capacity), sum(b.bytes for b in gone))

    def _files(self, files: list[str]) -> DataFrame:
        schema = T.StructType([f for f in self._schema if f.name != "shard"])
        spark = self._scratch.spark
        return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)

    def _table(self, values: dict[int, int], name: str = "shard") -> DataFrame:
        """A row per block, at most ``BLOCKS_PER_SHARD`` for each shard the table started with."""
        return self._scratch.spark.createDataFrame(list(values.items()), f"block int, {name} bigint")

    def rows(self) -> DataFrame:
        """shard, slot (from 0 without gaps in each shard), size and row, read from the files."""
        first, next_slot = {}, [0] * self.shards
        for b in sorted(self.blocks, key=lambda b: b.block):
            first[b.block] = next_slot[b.shard]
            next_slot[b.shard] += b.rows
        places = self._table({b.block: b.shard for b in self.blocks}).join(self._table(first, "first"), "block")
        found = self._files(self.files()).join(F.broadcast(places), "block")
        slot = F.col("first") + F.col("place") - 1
        return found.select(F.col("shard").cast("int").alias("shard"), slot.alias("slot"), "size", "row")


def equal_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (k < total % shards) for k in range(shards)]


def grow_documents(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of ``docs`` after resharding.

    The table starts in ``OLD_SHARDS`` shards by a hash of doc_id and is resharded to
    ``NEW_SHARDS`` of equal bytes.  Size is the UTF-8 bytes of a text plus 1; a NULL text
    has size 1 and the checksum of an empty one.  Documents with a NULL or repeated doc_id,
    and repeated rows, are rows of their own; copies are not kept together, as a group of
    them may outgrow a shard.  A text larger than a shard's share makes its shard larger.
    An empty table gives no rows; other columns are stored along.
    """
    size = F.coalesce(F.octet_length(docs["text"]), F.lit(0)) + 1
    old = F.pmod(F.xxhash64(docs["doc_id"]), F.lit(OLD_SHARDS))
    table = ShardedTable.create(docs, old, size, OLD_SHARDS)
    after = table.reshard(equal_capacities(sum(table.sizes()), NEW_SHARDS))
    crc = F.crc32(F.coalesce(F.col("row.text"), F.lit("")).cast("binary"))
    return after.rows().select(
        F.col("row.doc_id").alias("doc_id"),
        "size",
        crc.alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

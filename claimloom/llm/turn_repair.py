"""Operator 11: conversations repaired by the cheapest edits, found by a persistent audit DP.

Roles have to read as an optional system turn and pairs of user and assistant.  For every
row and state of that pattern the program keeps the cost and the audit (the edits so far,
one letter each) of the cheapest way there.  Audits are nodes that share their prefixes:
a node has its letter, ancestors at powers of two and a rolling hash.  Of two audits of
one cost the smaller is found at the first letter in which they differ, by a binary
search for their longest common prefix over ancestors of equal hash; a prefix found equal
by hash is then compared letter by letter, down to a node both share.

A conversation can be of any length.  Rows are sorted over all tasks and cut into blocks.
What lies within a block is repaired there.  A conversation cut by an edge of a block is a
chain of segments; each is repaired from every state to every state, a pass over the
segments' costs and the order of their audits picks one of them each, and no task holds
more than a block and a few numbers per segment.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import cmp_to_key
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.llm.common import SPACES, Scratch, columns, map_rows

#: Rows a segment has at most.
BLOCK_ROWS = 4096
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: States: nothing yet, after a system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: Where an inserted or reroled turn leads, and a kept one by its initial.
NEXT = [USER, USER, ASSISTANT, USER]
KEPT = [{"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER}]
ROLE = {USER: b"user", ASSISTANT: b"assistant"}
#: Turns to insert at the end until the pattern is complete.
MISSING = [0, 2, 1, 0]
NONE = 1 << 60
_PRIME, _BASE = (1 << 61) - 1, 911_382_323

Fault = str  # blank, duplicate, truncated or none
Way = tuple  # cost, node of the audit


class Audits:
    """Strings that grow by a letter at a time and share their prefixes."""

    def __init__(self, base: int = _BASE, prime: int = _PRIME):
        self.letter, self.depth, self.hash, self.up = [""], [0], [0], [[]]
        self._base, self._prime = base, prime
        self._same: dict[int, int] = {}  # nodes found equal, each to an earlier one

    def add(self, node: int, letter: str) -> int:
        new = len(self.letter)
        ups, at = [node], node
        while len(self.up[at]) >= len(ups):
            at = self.up[at][len(ups) - 1]
            ups.append(at)
        self.letter.append(letter)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * self._base + ord(letter)) % self._prime)
        self.up.append(ups)
        return new

    def text(self, node: int) -> str:
        letters = []
        while node:
            letters.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(letters))

    def _at_depth(self, node: int, depth: int) -> int:
        while (over := self.depth[node] - depth) > 0:
            node = self.up[node][over.bit_length() - 1]
        return node

    def _one(self, node: int) -> int:
        while node in self._same:
            node = self._same[node]
        return node

    def _differ(self, a: int, b: int) -> tuple[int, int] | None:
        """Of two nodes of one depth and hash, those at the first letter in which they really differ."""
        first, top = None, (a, b)
        while (a := self._one(a)) != (b := self._one(b)):
            if self.letter[a] != self.letter[b]:
                first = a, b
            a, b = self.up[a][0], self.up[b][0]
        if first is None and (x := self._one(top[0])) != (y := self._one(top[1])):
            self._same[max(x, y)] = min(x, y)
        return first

    def compare(self, a: int, b: int) -> int:
        """Below, at or above 0 as the text of ``a`` is less than, equal to or greater than that of ``b``."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self._at_depth(a, depth), self._at_depth(b, depth)
        if self.hash[x] == self.hash[y]:
            differ = self._differ(x, y)
            if differ is None:
                return self.depth[a] - self.depth[b]
        else:
            for k in range(len(self.up[x]) - 1, -1, -1):
                if k < len(self.up[x]) and self.hash[self.up[x][k]] != self.hash[self.up[y][k]]:
                    x, y = self.up[x][k], self.up[y][k]
            differ = self._differ(self.up[x][0], self.up[y][0]) or (x, y)
        x, y = differ
        return -1 if self.letter[x] < self.letter[y] else 1



def _better(audits: Audits, a: Way | None, b: Way) -> Way:
    """The cheaper way, of equal ones that with the smaller audit."""
    if a is None or b[0] < a[0]:
        return b
    return b if b[0] == a[0] and audits.compare(b[1], a[1]) < 0 else a


def _inserted(audits: Audits, ways: list[Way | None]) -> list[Way | None]:
    """The ways with turns inserted where that makes them better: two at most ever do."""
    ways = list(ways)
    changed = [state for state in STATES if ways[state] is not None]
    for _ in range(2):
        before, changed = [(state, ways[state]) for state in changed], []
        for state, (cost, node) in before:
            to, known = NEXT[state], ways[NEXT[state]]
            if known is None or cost + INSERT <= known[0]:
                ways[to] = _better(audits, known, (cost + INSERT, audits.add(node, "I")))
                if ways[to] is not known:
                    changed.append(to)
    return ways


def segment_ways(rows: list[tuple[str, Fault]], start: int, audits: Audits) -> list[Way | None]:
    """For each state the best way from ``start`` through ``rows`` (initial, fault), no turn inserted after them."""
    ways: list[Way | None] = [(0, 0) if state == start else None for state in STATES]
    for initial, fault in rows:
        candidates: list[tuple[int, int, int, str]] = []
        extra = TRUNCATED if fault == "truncated" else 0
        for state, way in enumerate(_inserted(audits, ways)):
            if way is None:
                continue
            cost, node = way
            candidates.append((state, cost + DELETE, node, "D"))
            if fault not in ("blank", "duplicate"):
                if initial in KEPT[state]:
                    candidates.append((KEPT[state][initial], cost + KEEP + extra, node, "K"))
                candidates.append((NEXT[state], cost + REROLE + extra, node, "R"))
        least = [NONE] * 4
        for state, cost, _, _ in candidates:
            least[state] = min(least[state], cost)
        ways = [None] * 4
        for state, cost, node, letter in candidates:
            if cost == least[state]:
                ways[state] = _better(audits, ways[state], (cost, audits.add(node, letter)))
    return ways


def finished(audits: Audits, ways: list[Way | None]) -> Way:
    """The best way that ends in a complete pattern."""
    best = None
    for way, missing in zip(ways, MISSING):
        if way is not None:
            node = way[1]
            for _ in range(missing):
                node = audits.add(node, "I")
            best = _better(audits, best, (way[0] + INSERT * missing, node))
    return best


def next_state(state: int, letter: str, initial: str) -> int:
    return state if letter == "D" else KEPT[state][initial] if letter == "K" else NEXT[state]


def _segments(rows: Iterable[tuple]) -> Iterator[tuple]:
    """A row per segment and way through it, from rows sorted by part, block and seq.

    A run of a conversation that touches neither edge of its block is whole, and has one
    way; others have one from each state to each.
    """
    for (part, block), held in groupby(_marked(rows), key=lambda row: (row[0], row[1])):
        runs: list[list[tuple]] = []
        for row in held:
            if not runs or runs[-1][0][3] != row[3]:
                runs.append([])
            runs[-1].append(row)
        for k, run in enumerate(runs):
            faults = [_fault(*row[5:]) for row in run]
            turns = [(row[4].decode(), fault) for row, fault in zip(run, faults)]
            illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
            numbers = [faults.count(f) for f in ("blank", "duplicate", "truncated")] + [illegal]
            common = (part, block, run[0][2], len(run), run[0][3], turns[0][0], turns[-1][0], *numbers)
            audits = Audits()
            if 0 < k < len(runs) - 1:
                cost, node = finished(audits, segment_ways(turns, START, audits))
                yield (*common, True, START, 0, cost, 0, audits.text(node))
                continue
            for start in STATES:
                ways = segment_ways(turns, start, audits)
                found = [state for state in STATES if ways[state] is not None]
                ranked = sorted(found, key=cmp_to_key(lambda a, b: audits.compare(ways[a][1], ways[b][1])))
                for state in found:
                    cost, node = ways[state]
                    yield (*common, False, start, state, cost, ranked.index(state), audits.text(node))


def _marked(rows: Iterable[tuple]) -> Iterator[tuple]:
    """Rows with whether a mark that they are the first of their role and text came before them."""
    first = None
    for part, block, seq, mark, conv, initial, blank, cut in rows:
        if mark == 0:
            first = (part, seq)
        else:
            yield part, block, seq, conv, initial, blank, cut, first == (part, seq)


def _fault(blank: bool, cut: bool, first: bool) -> Fault:
    return "blank" if blank else "duplicate" if not first else "truncated" if cut else "none"


def _chosen(rows: Iterable[tuple]) -> Iterator[tuple]:
    """Of each segment of a chain the way the best repair takes; rows sorted by conv, part, seq, start, state."""
    for _, chain in groupby(rows, key=lambda row: row[0]):
        places, edges, ways = [], [], []
        for key, same in groupby(chain, key=lambda row: row[1:6]):
            part, block, seq, opens, closes = key
            places.append((part, block, seq))
            edges.append((opens, closes))
            table = np.full((2, 4, 4), NONE)
            for row in same:
                table[:, row[6], row[7]] = row[8], row[9]
            ways.append(table)
        togo = [np.array(MISSING) * INSERT]
        for table in reversed(ways):
            # An inserted turn before a segment is part of its ways, so states need no more of them here.
            togo.append((table[0] + togo[-1]).min(axis=1))
        togo.reverse()
        state = START
        for k, table in enumerate(ways):
            total = table[0][state] + togo[k + 1]
            after = min(np.flatnonzero(total == total.min()), key=lambda q: table[1][state][q])
            last = k == len(ways) - 1
            pair = (edges[k - 1][1] + edges[k][0]).decode() if k else "ua"
            missing = MISSING[after] if last else 0
            yield (*places[k], state, int(after), missing, int(pair not in ("su", "ua", "au")))
            state = int(after)


_PLACE = "part int, block int, seq bigint"
_SEGMENTS = (
    f"{_PLACE}, n int, conv string, opens string, closes string, blank bigint, duplicate bigint, truncated bigint,"
    " illegal bigint, whole boolean, start int, state int, cost bigint, rank int, audit string"
)
_CHOSEN = f"{_PLACE}, start int, state int, missing int, pair bigint"


def order_rows(turns: DataFrame, scratch: Scratch, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """conv, turn, role, text, digest and the place of each row: part, block (its segment's) and seq.

    Rows lie in the order of their conversations, spread over all tasks, equal ones too.
    """
    keys = ["conv", F.col("turn").asc_nulls_first(), "role", "digest", "deal"]
    space = {c: F.coalesce(turns[c].cast("string"), F.lit(" ")) for c in ("role", "text")}
    both = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    rows = columns(turns, conv=turns["conv_id"].cast("string"), turn="turn", **space)
    rows = rows.withColumns({"digest": F.unhex(F.sha2(both, 256)), "deal": F.monotonically_increasing_id()})
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("deal")
    names = ordered.columns

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            places = np.arange(seq, seq + batch.num_rows)
            seq += batch.num_rows
            own = [np.full(batch.num_rows, part, np.int32), (places // block_rows).astype(np.int32), places]
            arrays = [*[batch[name] for name in names], *map(pa.array, own)]
            yield pa.RecordBatch.from_arrays(arrays, [*names, "part", "block", "seq"])

    schema = T.StructType([*ordered.schema, *_types(scratch, _PLACE)])
    return scratch.land(ordered.mapInArrow(number, schema), "rows")


def _types(scratch: Scratch, names: str) -> T.StructType:
    return scratch.spark.createDataFrame([], names).schema


def find_pieces(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """A row per segment: its place, conversation, numbers of faults, the way taken, its cost and audit."""
    place = ["part", "block", "seq"]
    first = rows.groupBy("conv", "digest").agg(F.min(F.struct(*place)).alias("at")).select("at.*")
    blank = F.length(F.rtrim("text", F.lit(SPACES))) == 0
    cut = ~F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1)).isin(".", "!", "?")
    marks = first.select(*place, F.lit(0).alias("mark"), *[F.lit(None).alias(c) for c in ("conv", "initial", "blank", "cut")])
    light = rows.select(*place, F.lit(1).alias("mark"), "conv", F.left("role", F.lit(1)), blank, cut)
    order = ["part", "block", "seq", "mark"]
    # A number is given, or Spark would bring these light rows together in few tasks; the work on them is not light.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = marks.union(light).repartition(tasks, "part", "block").sortWithinPartitions(*order)
    segments = scratch.land(map_rows(dealt, _segments, _SEGMENTS, rows=200), "segments")
    chains = segments.filter("NOT whole").select(
        "conv", *place, "opens", "closes", "start", "state", "cost", "rank"
    )
    chains = chains.repartition("conv").sortWithinPartitions("conv", "part", "seq", "start", "state")
    chosen = map_rows(chains, _chosen, _CHOSEN)
    taken = segments.filter("NOT whole").join(chosen, [*place, "start", "state"]).select(
        *place,
        "n",
        "conv",
        "blank",
        "duplicate",
        "truncated",
        (F.col("illegal") + F.col("pair")).alias("illegal"),
        "start",
        (F.col("cost") + F.col("missing") * INSERT).alias("cost"),
        F.concat("audit", F.repeat(F.lit("I"), F.col("missing"))).alias("audit"),
    )
    pieces = segments.filter("whole").select(*taken.columns).union(taken)
    return scratch.land(pieces, "pieces")


def _apply(rows: Iterable[tuple]) -> Iterator[tuple]:
    """The turns after the edits, from rows sorted by part, seq and mark: before a segment comes its piece."""
    letters, state, left = iter(""), START, 0
    for part, seq, mark, conv, role, text, audit, start, n in rows:
        if mark == 0:
            letters, state, left = iter(audit.decode()), start, n
            continue
        place, left = 0, left - 1
        for letter in letters:
            after = next_state(state, letter, role.decode()[:1])
            if letter != "D":
                said = (role, text) if letter == "K" else (ROLE[after], text if letter == "R" else b"")
                yield conv, part, seq, place, *said, letter
            state, place = after, place + 1
            if letter != "I" and left:
                break


def apply_pieces(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """conv, part, seq, place, role, text, edit of every turn of the repaired conversations, in that order."""
    none = lambda *names: [F.lit(None).alias(c) for c in names]
    edits = pieces.select("part", "seq", F.lit(0).alias("mark"), "block", *none("conv", "role", "text"), "audit", "start", "n")
    said = rows.select("part", "seq", F.lit(1).alias("mark"), "block", "conv", "role", "text", *none("audit", "start", "n"))
    dealt = edits.union(said).repartition("part", "block").sortWithinPartitions("part", "seq", "mark").drop("block")
    return map_rows(dealt, _apply, "conv string, part int, seq bigint, place int, role string, text string, edit string", rows=500)


def _digests(rows: Iterable[tuple]) -> Iterator[tuple]:
    for conv, turns in groupby(rows, key=lambda row: row[0]):
        whole = hashlib.sha256()
        for k, (_, role, text) in enumerate(turns):
            whole.update((b"\n" if k else b"") + role + b":" + text)
        yield conv, whole.hexdigest()


def repair(turns: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows in order, a piece of audit per segment, and the turns of the repaired conversations.

    ``turns`` has conv_id, turn, role and text; a NULL role or text counts as one space.
    Rows of a conversation are taken by turn, those without one first, equal turns by role
    and a digest of role and text; repeated rows are duplicates, as any row whose role and
    text came before.  Rows with a NULL conv_id are one conversation.  Other columns are
    ignored.  An empty table gives no rows.
    """
    scratch = Scratch(turns.sparkSession, "turns")
    rows = order_rows(turns, scratch, block_rows)
    pieces = find_pieces(rows, scratch)
    scratch.drop("segments")
    return rows, pieces, apply_pieces(rows, pieces)


def audit_conversations(turns: DataFrame, conv_ids: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """For each conv_id of ``conv_ids`` the faults, cost, audit and digest of its repaired turns.

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.
    A conversation without rows in ``turns`` has zeros, an empty audit and the digest of
    nothing.  The digest is one SHA-256 over a whole conversation, which only one task can
    work out; it streams the turns and holds one at a time.
    """
    rows, pieces, repaired = repair(turns, block_rows)
    per_turn = rows.select("conv", "turn").distinct().groupBy("conv")
    gaps = per_turn.agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).cast("bigint").alias("gaps"))
    order = ["conv", "part", "seq", "place"]
    said = repaired.repartition("conv").sortWithinPartitions(*order).select("conv", "role", "text")
    digests = map_rows(said, _digests, "conv string, sha string")
    numbers = ["blank", "duplicate", "truncated", "illegal", "cost"]
    known = {
        **dict.fromkeys([*numbers, "gaps"], "bigint"),
        "piece": "struct<part:int,seq:bigint,audit:string>",
        "sha": "string",
    }

    def part(df: DataFrame, **given: object) -> DataFrame:
        return df.select("conv", *[given.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in known.items()])

    ids = conv_ids.select(conv_ids["conv_id"].cast("string").alias("conv")).distinct()
    piece = F.struct("part", "seq", "audit")
    parts = part(ids).union(part(pieces, piece=piece, **{c: F.col(c) for c in numbers}))
    parts = parts.union(part(gaps, gaps=F.col("gaps"))).union(part(digests, sha=F.col("sha")))
    pieced = F.transform(F.array_sort(F.collect_list("piece")), lambda x: x["audit"])
    found = parts.groupBy("conv").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("gaps", *numbers)],
        F.array_join(pieced, "").alias("audit"),
        F.coalesce(F.max("sha"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
    return found.select(F.col("conv").cast(conv_ids.schema["conv_id"].dataType).alias("conv_id"), *found.columns[1:])

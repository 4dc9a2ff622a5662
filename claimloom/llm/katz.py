"""Operator 7: language model scores by Katz back-off over word pairs.

Counts are discounted by Good-Turing; what a context loses goes to the words not seen
after it, in proportion to their unigram probability, by a back-off weight that makes the
context's probabilities add up to one; the unigrams leave theirs to the unknown word.

Every token of every document is counted and scored, though no table of the model fits a
worker.  Documents are gathered in batches of about ``BATCH_TOKENS`` tokens, written once
as codes into a sorted dictionary of word hashes.  A batch asks the unigram table for
each of its words once, and the bigram table for each of its pairs once; the tables are
dealt into buckets by hash, and a bucket answers all batches.  What travels is a batch's
distinct words and pairs, packed, never a row per token:

    batches -> words by bucket -> unigram table, answers (count of each word)
    batches + answers -> pairs by bucket of the context -> bigram table, answers
    batches + answers + sums of hot contexts -> log probabilities of each document

A context with ``HOT_TOKENS`` tokens or more is dealt by its following word as well, over all
buckets, so what a bucket holds of one context has a bound that does not grow with the corpus.
The sums of these contexts are a table that is joined to the batches that ask for them.
Words are known by 64-bit hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import Scratch, WordHashes, columns, crc_mod, map_rows

BATCH_TOKENS = 1_000_000
#: Words or pairs of a bucket, about.
BUCKET_ENTRIES = 100_000
LEAST_BUCKETS = 256
#: Counts up to this are discounted.
GOOD_TURING = 5
#: Contexts with at least so many tokens are dealt by the word that follows.
HOT_TOKENS = 100_000

# Neither can be a word: words hold no white space.
_END, _BEGIN = b"\n", b" "
_UNKNOWN = np.uint64(2**64 - 1)
_BEGIN_ID = np.uint64(2**64 - 2)


def pack(values: np.ndarray) -> bytes:
    """An array by byte planes, deflated: high bytes are mostly zero."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return values.dtype.char.encode() + zlib.compress(planes.tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    kind = np.dtype(data[:1].decode())
    planes = np.frombuffer(zlib.decompress(data[1:]), np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _narrow(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint32) if not len(values) or values.max() < 2**32 else values.astype(np.uint64)


def discounts(of_counts: list[int]) -> np.ndarray:
    """What of each count 0, 1 ... GOOD_TURING stays, from the numbers of types with count 1, 2 ...

    Good-Turing with the largest k up to GOOD_TURING for which every discount lies between
    0 and 1; counts above k keep all.  Tables too small for any k give up half a count.
    """
    n = [0, *of_counts]
    for k in range(GOOD_TURING, 0, -1):
        if not all(n[1 : k + 2]):
            continue
        rest = (k + 1) * n[k + 1] / n[1]
        if rest >= 1:
            continue
        kept = [((r + 1) * n[r + 1] / n[r] / r - rest) / (1 - rest) for r in range(1, k + 1)]
        if all(0 < d < 1 for d in kept):
            return np.array([1.0, *kept, *[1.0] * (GOOD_TURING - k)])
    return np.array([1.0, *[1 - 0.5 / r for r in range(1, GOOD_TURING + 1)]])


@dataclass(frozen=True)
class Unigrams:
    """What all batches know of the unigram table."""

    tokens: int
    types: int
    kept: np.ndarray
    total: int  # the denominator: one more than the tokens if no count is discounted

    @classmethod
    def of(cls, tokens: int, types: int, of_counts: list[int]) -> Unigrams:
        kept = discounts(of_counts)
        lost = sum((1 - kept[r]) * r * of_counts[r - 1] for r in range(1, GOOD_TURING + 1))
        return cls(tokens, types, kept, tokens if lost > 0 else tokens + 1)

    def discounted(self, counts: np.ndarray) -> np.ndarray:
        return counts * self.kept[np.where(counts <= GOOD_TURING, counts, 0)]

    def probabilities(self, counts: np.ndarray, unknown: float) -> np.ndarray:
        return np.where(counts > 0, self.discounted(counts) / self.total, unknown)

    def unknown(self, of_counts: list[int]) -> float:
        """The probability of the unknown word: all that the known ones leave."""
        low = sum(r * n for r, n in enumerate(of_counts[:GOOD_TURING], 1))
        held = sum(self.kept[r] * r * n for r, n in enumerate(of_counts[:GOOD_TURING], 1))
        return (self.total - (self.tokens - low) - held) / self.total


def _batches(rows: Iterable[tuple]) -> Iterator[tuple]:
    """batch, doc_ids, train, lengths, words (sorted hashes), codes of the tokens, number of words, code of begin."""
    hashes, number = WordHashes(), 0
    end, begin = hashes.of([_END, _BEGIN])
    held: list[tuple] = []
    size = 0

    def packed() -> tuple:
        nonlocal number
        words, codes = np.unique(np.concatenate([h for _, _, h in held] + [[begin]]), return_inverse=True)
        batch, code = (TaskContext.get().partitionId() << 32) + number, int(np.searchsorted(words, begin))
        number += 1
        lengths = np.array([len(h) for _, _, h in held], np.uint64)
        train = np.array([t for _, t, _ in held], np.uint8)
        ids = [d for d, _, _ in held]
        held.clear()
        tokens = pack(codes[:-1].astype(np.uint32))
        return batch, ids, pack(train), pack(lengths), pack(words), tokens, len(words), code

    for doc_id, train, text in rows:
        found = np.append(hashes.of((text or b"").lower().split()), end)
        held.append((doc_id, bool(train), found))
        size += len(found)
        if size >= BATCH_TOKENS:
            yield packed()
            size = 0
    if held:
        yield packed()


_BATCHES = "batch bigint, doc_ids array<bigint>, train binary, lengths binary, words binary, codes binary, n_words bigint, begin int"


def _buckets_of(words: np.ndarray, bits: int) -> np.ndarray:
    return (words >> np.uint64(64 - bits)).astype(np.int64)


def _spread(contexts: np.ndarray, words: np.ndarray, bits: int) -> np.ndarray:
    """Buckets of pairs with a hot context: the word's bucket, moved on by a hash of the context.

    A frequent word follows most hot contexts, so its own bucket would hold a pair for each.
    """
    moved = _buckets_of(contexts * np.uint64(0x9E3779B97F4A7C15), bits)
    return (words + moved) & ((1 << bits) - 1)


def _runs(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, start, end) of the runs of a sorted array."""
    edges = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
    for start, end in zip(edges, edges[1:]):
        if start < end:
            yield int(values[start]), start, end


def _of_counts(counts: np.ndarray) -> list[int]:
    return np.bincount(counts[counts <= GOOD_TURING + 1].astype(np.int64), minlength=GOOD_TURING + 2)[1:].tolist()


def _ask_words(bits: int):
    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for batch, train, lengths, words, codes, begin in rows:
            words, codes = unpack(words), unpack(codes)
            trained = np.repeat(unpack(train), unpack(lengths).astype(np.int64)).astype(bool)
            counts = np.bincount(codes[trained], minlength=len(words))
            counts[begin] = 0
            for bucket, start, end in _runs(_buckets_of(words, bits)):
                yield bucket, batch, pack(words[start:end]), pack(_narrow(counts[start:end]))

    return run


def _answer_words(rows: Iterable[tuple]) -> Iterator[tuple]:
    """Answers (kind 0) to the batches, with the hot contexts among them, and the bucket of the unigram table (kind 1)."""
    for bucket, same in groupby(rows, key=lambda row: row[0]):
        asked = [(batch, unpack(words), unpack(counts)) for _, batch, words, counts in same]
        words, place = np.unique(np.concatenate([w for _, w, _ in asked]), return_inverse=True)
        counts = np.bincount(place, np.concatenate([c for _, _, c in asked])).astype(np.int64)
        known = counts > 0
        ids = np.where(known, np.uint64(bucket << 32) + np.cumsum(known).astype(np.uint64) - np.uint64(1), _UNKNOWN)
        at = 0
        for batch, own, _ in asked:
            mine = place[at : at + len(own)]
            at += len(own)
            hot = ids[mine][counts[mine] >= HOT_TOKENS]
            yield 0, batch, bucket, pack(ids[mine]), pack(_narrow(counts[mine])), hot.astype(np.int64).tolist()
        stats = [int(counts.sum()), int(known.sum()), *_of_counts(counts[known])]
        yield 1, None, bucket, pack(words[known]), pack(_narrow(counts[known])), stats


_ANSWERS = "kind int, batch bigint, bucket int, a binary, b binary, stats array<bigint>"


@dataclass
class Pairs:
    """The distinct pairs of a batch, sorted by context and word, and where each token's pair is."""

    context: np.ndarray
    word: np.ndarray
    place: np.ndarray
    trained: np.ndarray
    bucket: np.ndarray  # -1: nothing to ask, as the context is unknown
    hot: np.ndarray


@dataclass
class Batch:
    """A batch with the answers for its words: ids, counts and contexts by code."""

    doc_ids: list
    trained: np.ndarray
    starts: np.ndarray
    codes: np.ndarray
    ids: np.ndarray
    counts: np.ndarray
    buckets: np.ndarray

    @classmethod
    def of(cls, doc_ids: list, train: bytes, lengths: bytes, codes: bytes, answers: list[tuple]) -> Batch:
        sizes = unpack(lengths).astype(np.int64)
        ids = [unpack(a) for _, a, _ in answers]
        counts = np.concatenate([unpack(b).astype(np.int64) for _, _, b in answers])
        buckets = np.repeat([bucket for bucket, _, _ in answers], [len(a) for a in ids])
        trained = np.repeat(unpack(train), sizes).astype(bool)
        return cls(doc_ids, trained, np.cumsum(sizes) - sizes, unpack(codes), np.concatenate(ids), counts, buckets)

    def pairs(self, begin: int, bits: int) -> Pairs:
        """The batch's pairs; ``begin`` is the code of the context that starts a document."""
        before = np.concatenate([[begin], self.codes[:-1]]).astype(np.uint64)
        before[self.starts] = begin
        wide = np.uint64(len(self.ids))
        keys, place = np.unique(before * wide + self.codes.astype(np.uint64), return_inverse=True)
        context, word = (keys // wide).astype(np.int64), (keys % wide).astype(np.int64)
        trained = np.bincount(place[self.trained], minlength=len(keys))
        hot = (context == begin) | (self.counts[context] >= HOT_TOKENS)
        spread = _spread(self.context_ids(begin)[context], self.buckets[word], bits)
        bucket = np.where(hot, spread, self.buckets[context])
        known = (context == begin) | (self.ids[context] != _UNKNOWN)
        return Pairs(context, word, place, trained, np.where(known, bucket, -1), hot)

    def context_ids(self, begin: int) -> np.ndarray:
        ids = self.ids.copy()
        ids[begin] = _BEGIN_ID
        return ids


def _gathered(rows: Iterable[tuple]) -> Iterator[tuple[int, Batch, int, dict, tuple[list, list]]]:
    """Batches with all that answers them.

    (batch, its words answered, code of begin, answers for pairs, sums of its hot contexts)
    """
    for batch, same in groupby(rows, key=lambda row: row[0]):
        first, words, pairs, sums = None, [], {}, ([], [])
        for _, kind, bucket, begin, doc_ids, a, b, c, d, numbers in same:
            if kind == 0:
                first, code = (doc_ids, a, b, c), begin
            elif kind == 1:
                words.append((bucket, a, b))
            elif kind == 2:
                pairs[bucket] = (a, b, c, d)
            else:
                sums = (doc_ids, numbers)
        yield batch, Batch.of(*first, words), code, pairs, sums


def _ask_pairs(bits: int):
    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for number, batch, begin, _, _ in _gathered(rows):
            pairs, ids = batch.pairs(begin, bits), batch.context_ids(begin)
            order = np.argsort(pairs.bucket, kind="stable")
            for bucket, start, end in _runs(pairs.bucket[order]):
                if bucket >= 0:
                    mine = order[start:end]
                    word = pairs.word[mine]
                    yield (
                        bucket, number, pack(ids[pairs.context[mine]]), pack(batch.ids[word]),
                        pack(_narrow(batch.counts[word])), pack(_narrow(pairs.trained[mine])),
                        pack(pairs.hot[mine].astype(np.uint8)),
                    )

    return run


_PAIR_QUESTIONS = "bucket int, batch bigint, context binary, word binary, counts binary, trained binary, hot binary"


def _contexts(context: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs sorted by context: the contexts, and those of them with a pair not seen."""
    starts = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
    heads = context[starts]
    return heads, heads[np.minimum.reduceat(counts, starts) == 0]


def _answer_pairs(unigrams: Unigrams):
    """Answers (kind 0), the bucket of the bigram table (kind 1), sums of hot contexts (kind 2).

    An answer holds the count of each pair asked for, then for each context asked for, in
    order, whether it loses anything to discounts, then for those with a pair not seen what
    their back-off weight needs: the types with count 1 to GOOD_TURING, and the unigram
    probability of all that was seen.
    """

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for bucket, same in groupby(rows, key=lambda row: row[0]):
            asked = [(row[1], [unpack(x) for x in row[2:]]) for row in same]
            context, word, word_counts, trained, hot = (
                np.concatenate([x[i].astype(kind) for _, x in asked])
                for i, kind in enumerate((np.uint64, np.uint64, np.int64, np.int64, bool))
            )
            contexts, c = np.unique(context, return_inverse=True)
            words, first_word, w = np.unique(word, return_index=True, return_inverse=True)
            pairs, first, place = np.unique(c * len(words) + w, return_index=True, return_inverse=True)
            counts = np.bincount(place, trained).astype(np.int64)
            seen = counts > 0
            of, n = c[first][seen], counts[seen]
            sums = np.zeros((len(contexts), GOOD_TURING + 2))
            sums[:, 0] = np.bincount(of, n, len(contexts))  # tokens: needed of hot contexts alone
            for r in range(1, GOOD_TURING + 1):
                sums[:, r] = np.bincount(of, n == r, len(contexts))
            loses = sums[:, 1:-1].any(axis=1)
            probabilities = unigrams.discounted(word_counts[first][seen]) / unigrams.total
            sums[:, -1] = np.bincount(of, probabilities, len(contexts))
            at = 0
            for batch, (own, *_) in asked:
                mine = slice(at, at + len(own))
                at += len(own)
                found = counts[place[mine]]
                heads, weighed = _contexts(c[mine], found)
                parts = (_narrow(found), loses[heads].astype(np.uint8))
                types = _narrow(sums[weighed, 1:-1].astype(np.int64).ravel())
                yield 0, batch, bucket, *map(pack, parts), pack(types), pack(sums[weighed, -1]), None
            is_hot = np.zeros(len(contexts), bool)
            is_hot[c[hot]] = True
            ids, table = contexts[of], (pack(contexts[of]), pack(words[w[first][seen]]), pack(_narrow(n)))
            if len(ids):
                yield 1, None, bucket, *table, None, _of_counts(n)
            if is_hot.any():
                yield 2, None, bucket, pack(contexts[is_hot]), None, pack(sums[is_hot].ravel()), None, None

    return run


_PAIR_ANSWERS = "kind int, batch bigint, bucket int, a binary, b binary, c binary, d binary, stats array<bigint>"


def _scores(unigrams: Unigrams, unknown: float, kept: np.ndarray, bits: int):
    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        smooth = np.log10(unigrams.tokens + unigrams.types + 1)
        for _, batch, begin, answers, (hot, numbers) in _gathered(rows):
            pairs, ids = batch.pairs(begin, bits), batch.context_ids(begin)
            hot_sums = dict(zip(hot, np.array(numbers).reshape(-1, GOOD_TURING + 2)))
            counts = np.zeros(len(pairs.bucket), np.int64)
            sums = np.zeros((len(ids), GOOD_TURING + 2))
            loses = np.zeros(len(ids), bool)
            for bucket, (a, b, types, seen) in answers.items():
                mine = np.flatnonzero(pairs.bucket == bucket)
                counts[mine] = unpack(a)
                heads, weighed = _contexts(pairs.context[mine], counts[mine])
                loses[heads] = unpack(b)
                sums[weighed, 1:-1] = unpack(types).reshape(-1, GOOD_TURING)
                sums[weighed, -1] = unpack(seen)
            sums[:, 0] = batch.counts  # a word is followed by a token as often as it occurs
            for code in np.unique(pairs.context[pairs.hot]).tolist():
                sums[code] = hot_sums.get(int(ids[code].view(np.int64)), 0.0)
                loses[code] = sums[code, 1:-1].any()
            lower = unigrams.probabilities(batch.counts, unknown)
            total, types, seen = sums[:, 0], sums[:, 1:-1], sums[:, -1]
            low = np.arange(1, GOOD_TURING + 1)
            lost = (types * low * (1 - kept[1:])).sum(axis=1)
            total = np.where(loses, total, total + 1)  # a context that loses nothing counts one more
            weight = np.where(loses, lost, 1.0) / total / (1 - seen)
            weight[sums[:, 0] == 0] = 1.0  # nothing is known of the context
            stays = kept[np.where(counts <= GOOD_TURING, counts, 0)]
            known = stays * counts / total[pairs.context]
            chance = np.where(counts > 0, known, weight[pairs.context] * lower[pairs.word])
            score = np.add.reduceat(np.log10(chance)[pairs.place], batch.starts)
            own = batch.counts[batch.codes]
            base = np.add.reduceat(np.log10(own + 1) - smooth, batch.starts)
            n_known = np.add.reduceat((own > 0).astype(np.int64), batch.starts)
            n_tokens = np.diff(np.append(batch.starts, len(own)))
            columns_of = zip(batch.doc_ids, n_tokens.tolist(), n_known.tolist(), base.tolist(), score.tolist())
            for doc_id, n, k, b, s in columns_of:
                yield doc_id, n, k, unigrams.tokens, b, s

    return run


def _for_batches(
    batches: DataFrame, words: DataFrame, pairs: DataFrame | None = None, sums: DataFrame | None = None
) -> DataFrame:
    """Each batch's own row, then the answers for it, side by side in one partition."""
    names = ["batch", "kind", "bucket", "begin", "doc_ids", "a", "b", "c", "d", "numbers"]
    kinds = dict.fromkeys("abcd", "binary") | {"begin": "int", "doc_ids": "array<bigint>", "numbers": "array<double>"}

    def rows_of(df: DataFrame, kind: int, **given: str) -> DataFrame:
        given = {"batch": "batch", "bucket": "bucket"} | given
        values = {name: F.col(column) for name, column in given.items()} | {"kind": F.lit(kind)}
        return df.select(*[values.get(name, F.lit(None).cast(kinds.get(name, "int"))).alias(name) for name in names])

    own = batches.withColumn("bucket", F.lit(-1))
    rows = rows_of(own, 0, begin="begin", doc_ids="doc_ids", a="train", b="lengths", c="codes")
    rows = rows.unionByName(rows_of(words.filter("kind = 0"), 1, a="a", b="b"))
    if pairs is not None:
        rows = rows.unionByName(rows_of(pairs.filter("kind = 0"), 2, a="a", b="b", c="c", d="d"))
        hot = sums.withColumn("bucket", F.lit(-1))
        rows = rows.unionByName(rows_of(hot, 3, doc_ids="contexts", numbers="numbers"))
    return rows.repartition("batch").sortWithinPartitions("batch", "kind", "bucket")


def _added_up(stats: DataFrame, n: int) -> list[int]:
    sums = [F.coalesce(F.sum(F.col("stats")[i]), F.lit(0)) for i in range(n)]
    return list(stats.filter("kind = 1").agg(*sums).first())


@dataclass(frozen=True)
class Katz:
    """Scores of the documents, and the tables of the model, packed by bucket.

    ``unigrams`` has word hashes (a) and counts (b); ``bigrams`` the ids of contexts (a) and
    of words (b), with the counts of the pairs (c).  An id is the bucket and the place in it.
    """

    scores: DataFrame
    unigrams: DataFrame
    bigrams: DataFrame


def model_and_scores(docs: DataFrame, training: Column) -> Katz:
    """Learn from the rows of ``docs`` for which ``training`` holds; score all.

    ``scores`` has doc_id, n_tokens, n_known, train_tokens, base_score and score, a row for
    each row of ``docs``.  NULL or empty text is the end token alone.  If nothing is
    learned, every token is the unknown word with probability one and scores are 0.
    """
    scratch = Scratch(docs.sparkSession, "katz")
    narrow = columns(docs, doc_id="doc_id", train=training, text="text")
    batches = scratch.land(map_rows(narrow, _batches, _BATCHES, rows=1), "batches")
    entries = batches.agg(F.sum("n_words")).first()[0] or 0
    bits = max(LEAST_BUCKETS, entries // BUCKET_ENTRIES).bit_length()

    questions = map_rows(
        batches.select("batch", "train", "lengths", "words", "codes", "begin"), _ask_words(bits),
        "bucket int, batch bigint, words binary, counts binary", rows=200,
    )
    dealt = questions.repartition("bucket").sortWithinPartitions("bucket", "batch")
    words = scratch.land(map_rows(dealt, _answer_words, _ANSWERS, rows=100), "unigrams", by="kind")
    tokens, types, *of_counts = _added_up(words, GOOD_TURING + 3)
    unigrams = Unigrams.of(tokens, types, of_counts)
    unknown = unigrams.unknown(of_counts)

    questions = map_rows(_for_batches(batches, words), _ask_pairs(bits), _PAIR_QUESTIONS, rows=50)
    dealt = questions.repartition("bucket").sortWithinPartitions("bucket", "batch")
    pairs = scratch.land(map_rows(dealt, _answer_pairs(unigrams), _PAIR_ANSWERS, rows=50), "bigrams", by="kind")
    kept = discounts(_added_up(pairs, GOOD_TURING + 1))
    sums = scratch.land(_hot_sums(pairs), "hot")

    rows = _for_batches(batches, words, pairs, _sums_asked(batches, words, sums))
    schema = "doc_id bigint, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    scores = map_rows(rows, _scores(unigrams, unknown, kept, bits), schema, rows=5000)
    return Katz(scores, words.filter("kind = 1"), pairs.filter("kind = 1"))


def _hot_sums(pairs: DataFrame) -> DataFrame:
    """context, numbers: the sums of each hot context over all buckets."""
    names = [f"s{i}" for i in range(GOOD_TURING + 2)]

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for contexts, sums in rows:
            found = unpack(sums).reshape(-1, GOOD_TURING + 2).tolist()
            yield from ((context, *mine) for context, mine in zip(unpack(contexts).view(np.int64).tolist(), found))

    schema = ", ".join(["context bigint", *[f"{name} double" for name in names]])
    rows = map_rows(pairs.filter("kind = 2").select("a", "c"), run, schema)
    sums = rows.groupBy("context").agg(*[F.sum(name).alias(name) for name in names])
    return sums.select("context", F.array(*names).alias("numbers"))


def _sums_asked(batches: DataFrame, words: DataFrame, sums: DataFrame) -> DataFrame:
    """batch, contexts, numbers: for each batch the sums of the hot contexts in it, one after the other.

    Spark knows the size of the landed sums and decides how to join them; beyond a broadcast it
    splits a context that most batches ask for.  A batch has no more contexts than tokens.
    """
    begin = batches.select("batch", F.lit(int(_BEGIN_ID.view(np.int64))).alias("context"))
    asked = words.filter("kind = 0").select("batch", F.explode("stats").alias("context")).unionByName(begin)
    found = asked.join(sums, "context").groupBy("batch").agg(F.collect_list(F.struct("context", "numbers")).alias("x"))
    return found.select("batch", F.col("x.context").alias("contexts"), F.flatten("x.numbers").alias("numbers"))


def is_training() -> Column:
    """Rows that may be learned from: crc32 of the id modulo 7 is not 2."""
    return crc_mod("doc_id", 7) != 2


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row."""
    scores = model_and_scores(docs, is_training()).scores
    return scores.withColumn("held_out", ~is_training())

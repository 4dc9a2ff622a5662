"""Operator 5: language of documents by spans: scripts, word scores, Viterbi.

A word is a run of letters of one script.  The script narrows the languages that may
have written it; each of them scores the word by its letter trigrams.  Viterbi over the
words, with a penalty for each change of language, labels spans; the document's language
is the one with the most letters in its spans.  Documents are walked many at a time, a
word of each in every step.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.common import columns, crc_mod, map_rows, slices

UNKNOWN = "und"
#: The classifier is fitted on at most so many labelled documents of a language.
SAMPLE_PER_LANGUAGE = 3000
#: Trigrams are counted in so many cells, whatever their number: the model is as many floats per language.
CELLS = 1 << 16
MAX_LANGUAGES = 512
#: Documents are gathered for a walk up to so many scores (words times languages), and at least one.
WALK_SCORES = 1 << 21
WALK_TEXTS = 512
SWITCH_PENALTY = 12.0
#: A language writes a script if at least this share of its letters is in it.
SCRIPT_SHARE = 0.01
#: The filter lets a document go in which no language holds this share of the letters.
MIN_SCORE = 1 / 3
_CHUNK = 1 << 18

#: First code points of script ranges and the script that starts there.
SCRIPT_STARTS = [
    (0x0000, "other"),
    (0x0041, "latin"),
    (0x02B0, "other"),
    (0x0370, "greek"),
    (0x0400, "cyrillic"),
    (0x0530, "armenian"),
    (0x0590, "hebrew"),
    (0x0600, "arabic"),
    (0x0700, "other"),
    (0x0750, "arabic"),
    (0x0780, "other"),
    (0x0900, "devanagari"),
    (0x0980, "bengali"),
    (0x0A00, "other"),
    (0x0B80, "tamil"),
    (0x0C00, "other"),
    (0x0E00, "thai"),
    (0x0E80, "other"),
    (0x10A0, "georgian"),
    (0x1100, "hangul"),
    (0x1200, "other"),
    (0x1E00, "latin"),
    (0x1F00, "greek"),
    (0x2000, "other"),
    (0x3040, "kana"),
    (0x3100, "other"),
    (0x3400, "han"),
    (0xA000, "other"),
    (0xAC00, "hangul"),
    (0xD7B0, "other"),
    (0xF900, "han"),
    (0xFB00, "other"),
    (0x20000, "han"),
    (0x32000, "other"),
]
_SCRIPTS = sorted({name for _, name in SCRIPT_STARTS})
_NO_LETTER = len(_SCRIPTS)


@cache
def _kinds() -> np.ndarray:
    """The script of each code point, or that it is no letter."""
    starts = [start for start, _ in SCRIPT_STARTS]
    lengths = np.diff([*starts, 0x110000])
    kinds = np.repeat(np.array([_SCRIPTS.index(name) for _, name in SCRIPT_STARTS], np.uint8), lengths)
    kinds[[c for c in range(0x110000) if not chr(c).isalpha()]] = _NO_LETTER
    return kinds


@dataclass(frozen=True)
class Words:
    """Words of a text, in columns: letters, script, and the cells of all their trigrams.

    ``joined``: the first goes on where the last word of the chunk before ended.
    """

    sizes: np.ndarray
    scripts: np.ndarray
    cells: np.ndarray
    first_cell: np.ndarray
    joined: bool


def words_of(text: str) -> Iterator[Words]:
    """The words of a text, a chunk of letters at a time; a word of any length may lie in several."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    table = _kinds()
    for start in range(0, len(codes), _CHUNK):
        end = min(len(codes), start + _CHUNK)
        # One code point more on either side, a blank beyond the ends of the text.
        around = np.zeros(end - start + 2, np.uint64)
        low, high = max(start - 1, 0), min(end + 1, len(codes))
        around[low - start + 1 : high - start + 1] = codes[low:high]
        kinds = table[around]
        same = kinds[1:] == kinds[:-1]
        own = kinds[1:-1]
        letter = own != _NO_LETTER
        if not letter.any():
            continue
        joined = bool(same[0] and letter[0])
        first = letter & ~same[:-1]
        first[0] = letter[0]
        at = np.flatnonzero(letter)
        begins = np.flatnonzero(first[at])
        # A word of n letters between two blanks has n trigrams, one around each letter.
        mixed = np.where(same[:-1][at], around[at], 0) * np.uint64(0x9E3779B1) + around[at + 1]
        mixed = mixed * np.uint64(0x85EBCA77) + np.where(same[1:][at], around[at + 2], 0)
        cells = (mixed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 16)
        sizes = np.diff(begins, append=len(at))
        yield Words(sizes, own[at[begins]].astype(np.int64), cells.astype(np.int64), begins, joined)


@dataclass(frozen=True)
class Model:
    """Log probabilities of trigram cells per language, and which language writes which script."""

    languages: list[str]
    cells: np.ndarray
    writes: np.ndarray

    def scores(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Letters of each word, and its score in each language that can have written it."""
        sizes, scripts, scores = [], [], []
        for words in words_of(text):
            own, kinds, found = words.sizes, words.scripts, self.cells[words.cells]
            found = np.add.reduceat(found, words.first_cell, axis=0, dtype=np.float64)
            if words.joined:
                sizes[-1][-1] += own[0]
                scores[-1][-1] += found[0]
                own, kinds, found = own[1:], kinds[1:], found[1:]
            if len(own):
                sizes.append(own)
                scripts.append(kinds)
                scores.append(found)
        if not sizes:
            return np.zeros(0, np.int64), np.zeros((0, len(self.languages)))
        found, candidates = np.concatenate(scores), self.writes[np.concatenate(scripts)]
        if not candidates.all():
            candidates[~candidates.any(axis=1)] = True  # no language has the script: none is ruled out
            found = np.where(candidates, found, found.min(axis=1, keepdims=True) - RULED_OUT)
        return np.concatenate(sizes), found

    def predict(self, text: str, penalty: float = SWITCH_PENALTY) -> tuple[str, float]:
        """The language with the most letters and its share of them (0 to 1)."""
        return next(self.predict_all([text], penalty))

    def predict_all(self, texts: Iterable[str], penalty: float = SWITCH_PENALTY) -> Iterator[tuple[str, float]]:
        """What ``predict`` gives for each text, in order; many are walked together."""
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for text in texts:
            held.append(self.scores(text) if self.languages else (np.zeros(0), np.zeros((0, 0))))
            size += held[-1][1].size
            if size >= WALK_SCORES or len(held) >= WALK_TEXTS:
                yield from self._judged(held, penalty)
                held, size = [], 0
        yield from self._judged(held, penalty)

    def _judged(self, held: list[tuple[np.ndarray, np.ndarray]], penalty: float) -> Iterator[tuple[str, float]]:
        for (sizes, _), path in zip(held, viterbi_all([scores for _, scores in held], penalty)):
            if not len(sizes):
                yield UNKNOWN, 0.0
                continue
            letters = np.bincount(path, sizes, len(self.languages))
            best = int(letters.argmax())
            yield self.languages[best], float(letters[best] / letters.sum())

    def spans(self, text: str, penalty: float = SWITCH_PENALTY) -> list[tuple[int, int, str]]:
        """(first word, word after the last, language) of each span."""
        _, scores = self.scores(text)
        if not len(scores) or not self.languages:
            return []
        path = viterbi(scores, penalty)
        edges = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(path)]
        return [(a, b, self.languages[path[a]]) for a, b in zip(edges, edges[1:])]


#: What a word scores less in a language that does not write its script.
RULED_OUT = 50.0


def viterbi(scores: np.ndarray, penalty: float) -> np.ndarray:
    """The best language of each word: scores summed up, less a penalty for each change."""
    return viterbi_all([scores], penalty)[0]


def viterbi_all(scores: list[np.ndarray], penalty: float) -> list[np.ndarray]:
    """``viterbi`` of each document: a step takes the next word of every one that has one left.

    If within no stretch of a document another language gains more than half the penalty
    on the best one overall, no path with changes can win, and the walk is spared: a path
    of m stretches in other languages pays for m - 1 changes at least.
    """
    paths: list[np.ndarray] = []
    walked = []
    for place, own in enumerate(scores):
        if not len(own):
            paths.append(np.zeros(0, np.int64))
            continue
        total = own.cumsum(axis=0)
        best = int(total[-1].argmax())
        total = total[:, [best]] - total
        # The most a language gains in a stretch: the highest lead the best one had before, less what is left.
        lead = np.maximum(np.maximum.accumulate(total, axis=0), 0)
        paths.append(np.full(len(own), best))
        if (lead - total).max() > penalty / 2:
            walked.append(place)
    if walked:
        walked.sort(key=lambda place: -len(scores[place]))
        for place, path in zip(walked, _walk([scores[place] for place in walked], penalty)):
            paths[place] = path
    return paths


def _walk(scores: list[np.ndarray], penalty: float) -> list[np.ndarray]:
    """Viterbi paths of documents, longest first: those with a word i are the first of them."""
    lengths = np.array([len(own) for own in scores])
    steps, k = int(lengths[0]), scores[0].shape[1]
    active = np.searchsorted(-lengths, -np.arange(steps), "left")
    offset = np.concatenate([[0], np.cumsum(active)])
    # By step, then by document.
    laid = np.empty((offset[-1], k))
    for d, own in enumerate(scores):
        laid[offset[: len(own)] + d] = own
    came = np.empty((offset[-1], k), np.int16)
    own = np.arange(k, dtype=np.int16)
    now = laid[: active[0]].copy()
    bounds = list(zip(active.tolist(), offset.tolist()))
    for a, start in bounds[1:]:
        now_of = now[:a]
        changed = now_of.max(axis=1, keepdims=True) - penalty
        stays = now_of >= changed
        came[start : start + a] = np.where(stays, own, now_of.argmax(axis=1)[:, None])
        np.maximum(now_of, changed, out=now_of)
        now_of += laid[start : start + a]
    path = np.empty(offset[-1], np.int64)
    state = now.argmax(axis=1)
    every = np.arange(len(scores))
    for a, start in reversed(bounds):
        path[start : start + a] = state[:a]
        if start:
            state[:a] = came[start + every[:a], state[:a]]
    return [path[offset[: len(own)] + d] for d, own in enumerate(scores)]


def _hash_at(share: float) -> int:
    """The signed 64-bit hash below which that share of all hashes lies."""
    return min(2**63 - 1, int(share * 2**64) - 2**63)


def fit(labelled: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """A model of rows (doc_id, text, lang); rows with a NULL text or lang teach nothing.

    Of each language the ``per_language`` documents with the lowest hash of text and id
    are taken (fewer only if copies make up half of them): a bounded sample of whole texts, the same whatever the partitions; copies of
    one row count once.  What is collected is bounded by cells and scripts times languages.
    """
    usable = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    usable = usable.select("lang", "text", F.xxhash64("doc_id", "text").alias("_hash"))
    counts = usable.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} values of lang: the model has a column for each")
    # Hashes are even: twice the sample lies below this share of them, and only that is ranked.
    below = [F.struct(F.lit(r.lang), F.lit(_hash_at(2 * per_language / r["count"]))) for r in counts]
    near = usable.select("lang", "_hash")
    if below:
        near = near.filter(F.col("_hash") <= F.map_from_entries(F.array(*below))[F.col("lang")])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_hash"))
    lowest = near.withColumn("_rank", rank).filter(F.col("_rank") <= per_language)
    # per_language hashes of each of a bounded number of languages
    taught = usable.join(F.broadcast(lowest.select("lang", "_hash")), ["lang", "_hash"], "left_semi")
    taught = taught.dropDuplicates(["lang", "_hash"])

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        cells: dict[bytes, np.ndarray] = {}
        for lang, text in rows:
            counts = cells.setdefault(lang, np.zeros(CELLS + len(_SCRIPTS), np.int64))
            for words in words_of(text.decode("utf-8", "replace")):
                counts[:CELLS] += np.bincount(words.cells, minlength=CELLS)
                counts[CELLS:] += np.bincount(words.scripts, words.sizes, len(_SCRIPTS)).astype(np.int64)
        for lang, counts in cells.items():
            for cell in np.flatnonzero(counts).tolist():
                yield lang.decode(), cell, int(counts[cell])

    partial = map_rows(taught.select("lang", "text"), run, "lang string, cell int, n bigint", rows=50_000)
    found = partial.groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(found["lang"].unique())
    counts = np.zeros((len(languages), CELLS + len(_SCRIPTS)))
    if languages:
        counts[found["lang"].map({lang: i for i, lang in enumerate(languages)}), found["cell"]] = found["n"]
    cells, scripts = counts[:, :CELLS] + 0.5, counts[:, CELLS:]
    logs = np.log(cells / cells.sum(axis=1, keepdims=True))
    share = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    return Model(languages, np.ascontiguousarray(logs.T, np.float32), np.ascontiguousarray((share >= SCRIPT_SHARE).T))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of each row's whole ``text``; no shuffle.

    Text that is NULL or has no letter, and any text if nothing was learned, is ``und``
    with score 0.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # CELLS floats a language

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        ids: deque = deque()

        def texts() -> Iterator[str]:
            for doc_id, text in rows:
                ids.append(doc_id)
                yield (text or b"").decode("utf-8", "replace")

        for lang, score in sent.value.predict_all(texts()):
            yield ids.popleft(), lang, score

    return map_rows(columns(docs, doc_id="doc_id", text="text"), run, "doc_id bigint, lang_pred string, score double")


def training_rows(docs: DataFrame) -> DataFrame:
    """Rows that may be learned from: crc32 of the id modulo 3 is not 1."""
    return columns(docs, doc_id="doc_id", text="text", lang="lang").filter(crc_mod("doc_id", 3) != 1)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from the training rows, predicted for all."""
    found = predict(docs, fit(training_rows(docs)))
    return found.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The whole rows of ``docs`` with a language that holds at least ``min_score`` of the letters.

    Rows whose text is NULL, empty or without a letter go, as do all if nothing was
    learned; a repeated row is judged like the first, a NULL id changes nothing.  The
    model is fitted at the call, which runs Spark jobs.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fit(training_rows(docs)))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in slices(batches):
            found = model.predict_all(t or "" for t in batch.column(at).to_pylist())
            yield batch.filter(pa.array([lang != UNKNOWN and score >= min_score for lang, score in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

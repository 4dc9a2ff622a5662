"""Operator 4: quality rules judged for documents and for their hosts, in DataFrame functions only.

Each document is tried by base rules.  Their failures are summed up by host (column
``source``); a host's rate is shrunk by a beta prior whose mean and strength come from
the rates of all hosts, so that a host with few documents is not condemned by chance.
A host whose shrunk rate is above the limit is rejected, and its documents with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import SPACES, Scratch, columns

MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"
MAX_HOST_RATE = 0.5
#: The prior counts as so many documents at least and at most.
PRIOR_STRENGTH = (1.0, 1e6)

RULES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def with_rules(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with ``_rules``, a struct of the counts of ``RULES`` and base_failed.

    Everything about a document is worked out within its row: windows are hashed, the
    sorted hashes show which occur again, and the words that such windows cover are the
    steps between their places, five at most.  NULL text counts as text without words.
    """
    text = F.coalesce(text, F.lit(""))
    spaced = F.translate(text, SPACES, " " * len(SPACES))
    rows = docs.withColumns(
        {
            "_text": text,
            "_words": F.filter(F.split(spaced, " "), lambda w: w != ""),
            "_lines": F.filter(F.split(text, "\n"), lambda line: _without(line, SPACES) != ""),
        }
    )
    rows = rows.withColumn("_last", F.size("_words") - WINDOW)
    words = F.transform("_words", lambda w: F.xxhash64(w))
    rows = rows.withColumn("_hashes", F.when(F.col("_last") >= 1, words).otherwise(F.array().cast("array<bigint>")))

    def window(start: Column) -> Column:
        return F.xxhash64(*[F.get("_hashes", start + i) for i in range(WINDOW)])

    starts = F.sequence(F.lit(0), "_last")
    rows = rows.withColumn("_windows", F.when(F.col("_last") >= 1, F.transform(starts, window)))
    again = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("_placed", F.when(again, placed))

    def occurs_again(entry: Column, k: Column) -> Column:
        before, after = (F.get("_placed", k + step)["h"] for step in (-1, 1))
        return F.coalesce(entry["h"] == before, F.lit(False)) | F.coalesce(entry["h"] == after, F.lit(False))

    places = F.sort_array(F.transform(F.filter("_placed", occurs_again), lambda entry: entry["i"]))
    rows = rows.withColumn("_places", places)

    def covered(place: Column, k: Column) -> Column:
        return F.least(F.lit(WINDOW), F.coalesce(F.get("_places", k + 1) - place, F.lit(WINDOW)))

    covers = F.aggregate(F.transform("_places", covered), F.lit(0).cast("bigint"), lambda a, x: a + x)
    counts = {
        "n_words": F.size("_words"),
        "word_chars": F.length(_without(F.col("_text"), SPACES)),
        "n_symbols": F.length("_text") - F.length(_without(F.col("_text"), SYMBOLS)),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.coalesce(covers, F.lit(0)),
    }
    rows = rows.withColumns({f"_{name}": count.cast("bigint") for name, count in counts.items()})
    failed = (F.col("_n_words") < MIN_WORDS) | (
        100 * F.col("_n_repeat_words") > MAX_REPEATED_PERCENT * F.col("_n_words")
    )
    rules = F.struct(*[F.col(f"_{name}").alias(name) for name in RULES], failed.alias("base_failed"))
    return rows.select(*docs.columns, rules.alias("_rules"))


def rejected_hosts(judged: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """host, rate of the hosts that are rejected, from rows (host, base_failed).

    Rows without a host belong to none.  The prior is fitted by moments: its mean is the
    rate over all documents, its strength what makes the spread of a beta distribution
    equal to the spread of the hosts' rates, weighted by their documents.  Only those two
    numbers pass through the driver.
    """
    hosts = judged.filter(F.col("host").isNotNull()).groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("base_failed").alias("failed")
    )
    squares = F.sum(F.col("failed") * F.col("failed") / F.col("n"))
    n, failed, square = hosts.agg(F.sum("n"), F.sum("failed"), squares).first()
    mean = failed / n if n else 0.0
    spread = max(0.0, (square or 0.0) / n - mean * mean) if n else 0.0
    low, high = PRIOR_STRENGTH
    strength = min(high, max(low, mean * (1 - mean) / spread - 1)) if spread > 0 else high
    rate = (F.col("failed") + F.lit(mean * strength)) / (F.col("n") + F.lit(strength))
    return hosts.select("host", rate.alias("rate")).filter(F.col("rate") > max_rate)


def judge_documents(docs: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """doc_id, the counts of ``RULES``, base_failed and kept, a row for each row of ``docs``.

    NULL or empty text has no words and fails; a NULL source is judged by the base rules
    alone; an empty table gives an empty table.  Landed once without the texts: the
    hosts' counts and the verdicts are both made from that narrow table.
    """
    narrow = columns(docs, doc_id="doc_id", host="source", _body="text")
    rows = with_rules(narrow, F.col("_body")).select("doc_id", "host", "_rules.*")
    judged = Scratch(docs.sparkSession, "quality").land(rows, "judged")
    rejected = rejected_hosts(judged, max_rate).select("host", F.lit(True).alias("rejected"))
    kept = ~F.col("base_failed") & F.col("rejected").isNull()
    return judged.join(rejected, "host", "left").select("doc_id", *RULES, "base_failed", kept.alias("kept"))


def keep_good(docs: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The whole rows of ``docs`` that the rules and their host's verdict let pass.

    Rows whose text is NULL or empty go; a NULL source is judged by the base rules alone;
    repeated rows are judged alike and all stay or go.  The rates of the hosts and the
    prior are found at the call, which runs Spark jobs.
    """
    rows = docs.select(F.struct("*").alias("_row"))
    judged = with_rules(rows, F.col("_row.text")).select(
        "_row", F.col("_row.source").alias("host"), F.col("_rules.base_failed").alias("base_failed")
    )
    scratch = Scratch(docs.sparkSession, "quality")
    landed = scratch.land(judged, "judged")
    # Landed, so that Spark knows its size: whole documents are only shuffled if it is large.
    rejected = scratch.land(rejected_hosts(landed.select("host", "base_failed"), max_rate).select("host"), "hosts")
    passed = landed.filter(~F.col("base_failed")).join(rejected, "host", "left_anti")
    return passed.select("_row.*")

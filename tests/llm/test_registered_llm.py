import hashlib
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from claimloom.llm import decontaminate, language_spans, queries

from .test_duplicates import brute_classes
from .test_rules import brute_items

DATA = "/root/testdata/sf0.001"
#: Words as the items know them, of text in any case.
NORMAL = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for file in os.listdir(DATA):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{file}'")
    return connection


def test_all_operators_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert set(queries.QUERIES) <= names and "pipeline" in names
    assert {name.split("_")[0] for name in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, tables, name):
    df = queries.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    result = tables.execute(queries.ORACLE_SQL[name])
    theirs = [c[0] for c in result.description]
    assert sorted(theirs) == columns
    expected = sorted(repr([row[theirs.index(c)] for c in columns]) for row in result.fetchall())
    assert sorted(repr([row[c] for c in columns]) for row in df.collect()) == expected


def test_held_out_accuracy(spark, tables):
    truth = dict(tables.execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = [r for r in queries.QUERIES["op5_language"](spark, DATA).collect() if r.held_out and r.lang_pred != "und"]
    right = sum(r.lang_pred == truth[r.doc_id] for r in rows)
    assert right >= 0.97 * len(rows) > 0


def test_page_text_against_the_page_source(spark, tables):
    import html
    import re

    pages = {p: h for p, h in tables.execute("SELECT page_id, html FROM pages").fetchall()}
    for row in queries.QUERIES["op10_page_text"](spark, DATA).collect():
        inner = re.search(r"<article>(.*)</article>", pages[row.page_id], re.S)[1]
        blocks = [html.unescape(re.sub(r"<[^>]*>", " ", b)) for b in re.split(r"</?(?:p|h1)>", inner)]
        expected = "\n".join(" ".join(b.split()) for b in blocks if b.strip())
        assert (row.text, row.n_chars) == (expected, len(expected))


def test_pipeline_against_its_operators(spark, tables, ranks):
    """Every stage's decision, taken again from the operators' own results."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    good = {r.doc_id for r in queries.QUERIES["op4_quality_rules"](spark, DATA).collect() if r.kept}
    stages = dict(corpus_pipeline.STAGES)
    after = {}
    for name in ("quality_rules", "language", "near_duplicates", "decontaminate"):
        docs = stages[name](spark, docs, DATA)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        after[name] = {r.doc_id: r.text for r in docs.collect()}
    assert set(after["quality_rules"]) == good
    assert set(after["language"]) <= good
    assert set(after["near_duplicates"]) <= set(after["language"])
    rows = corpus_pipeline.run(spark, DATA).collect()
    assert {r.doc_id for r in rows} == set(after["decontaminate"])
    for r in rows:
        text = after["decontaminate"][r.doc_id]
        assert r.n_tokens == len(ranks.encode_ordinary(text))
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_each_stage_against_a_plain_version(spark):
    """Exactly what each stage keeps of its input, and the texts it leaves."""
    stages = dict(corpus_pipeline.STAGES)
    tables = [spark.read.parquet(f"{DATA}/documents.parquet")]
    for name in ("quality_rules", "language", "near_duplicates", "decontaminate"):
        tables.append(stages[name](spark, tables[-1], DATA).localCheckpoint())
    _, good, identified, single, clean = [{r.doc_id: r.text for r in t.collect()} for t in tables]

    found = language_spans.identify(tables[1]).collect()
    scored = {r.doc_id for r in found if r.lang_pred != language_spans.UNKNOWN and r.score >= language_spans.MIN_SCORE}
    assert identified == {i: good[i] for i in scored}

    ids = sorted(identified)
    _, label = brute_classes([identified[i] for i in ids])
    assert single == {i: identified[i] for k, i in enumerate(ids) if label[k] == k}

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    expected = {}
    for i, text in single.items():
        n, hit, _ = brute_items(text, items)
        if len(hit) > decontaminate.MAX_COVERAGE * n:
            continue
        while hit:
            spans = [m.span() for m in NORMAL.finditer(text)]
            for last in sorted((k for k in hit if k + 1 not in hit), reverse=True):
                first = max(k for k in hit if k <= last and k - 1 not in hit)
                text = text[: spans[first][0]] + "\n" + text[spans[last][1] :]
            _, hit, _ = brute_items(text, items)
        expected[i] = text
    assert clean == expected and len(clean) > 0

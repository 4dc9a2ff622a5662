import hashlib
import random
import re

import pytest

from claimloom.llm import decontaminate, host_quality, url_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_rules(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    n = len(words)
    failed = n < 10 or 100 * len(hit) > 20 * n
    symbols = sum(c in "#*$%&|<>" for c in text)
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit), failed


def rule_texts():
    rng = random.Random(2)
    texts = [None, "", " \t", "one", "a b c d e", "a a a a a a a a a a a a", "é# | $\n\né# | $\n x \x1c\x85\xa0 y"]
    for _ in range(60):
        texts.append("".join(rng.choice(["a", "b", "c", "dd"]) + rng.choice([" ", "\n", "  "]) for _ in range(rng.randrange(200))))
    texts.append(" ".join(f"w{i % 700}" for i in range(1400)))
    return texts


def test_rules_against_brute_force(docs):
    texts = rule_texts()
    found = host_quality.judge_documents(docs(texts)).collect()
    assert len(found) == len(texts)
    for r in found:
        assert tuple(r[1:7]) == brute_rules(texts[r.doc_id])
    assert host_quality.judge_documents(docs([])).count() == 0


def test_bad_host_takes_its_documents_along(spark):
    good = " ".join(f"word{i}" for i in range(30))
    rows = [(i, good if i % 10 == 0 else "bad", "farm") for i in range(100)]
    rows += [(1000 + i, good if i % 10 else "bad", f"host{i % 7}") for i in range(210)]
    rows += [(2000, "bad", "tiny"), (2001, good, None), (2002, good, "tiny2"), (2003, good, "tiny")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    docs = docs.selectExpr("*", "'x' AS n_words", "1 AS host", "2 AS rejected", "3 AS _text")
    kept = {r.doc_id for r in host_quality.judge_documents(docs).collect() if r.kept}
    assert not any(d < 100 for d in kept)
    assert {r[0] for r in rows if r[0] >= 1000 and r[1] == good} == kept
    passed = host_quality.keep_good(docs)
    assert passed.columns == docs.columns and {r.doc_id for r in passed.collect()} == kept


URLS = [
    ("http://A.Example.NET/en/x", "a.example.net", "/en/x", "example.net/en/", "allow"),
    ("http://a.example.net/enx", "a.example.net", "/enx", "net/", "block"),
    ("https://example.com/de/", "example.com", "/de/", "example.com/de/", "block"),
    ("https://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
    ("https://b.org/fr/1?x=/", "b.org", "/fr/1", "org/fr/", "allow"),
    ("x://net", "net", "", None, "allow"),
    ("x://net/#a", "net", "/", "net/", "block"),
    ("x://net?/", "net", "", None, "allow"),
    ("net/en", "", "", None, "allow"),
    ("a://b://c/d", "b:", "//c/d", None, "allow"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
    ("http://.net/", ".net", "/", "net/", "block"),
    ("http://x.net/\n/en", "x.net", "/\n/en", "net/", "block"),
]


def test_url_rules(spark):
    rows = [(i, u[0], "h", "r") for i, u in enumerate(URLS + URLS)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, verdict string")
    found = url_rules.judge(pages, url_rules.rule_table(spark, url_rules.RULES)).collect()
    assert len(found) == len(rows)
    for r in found:
        assert tuple(r[1:]) == URLS[r.page_id % len(URLS)][1:], r
    assert url_rules.judge(pages.limit(0), url_rules.rule_table(spark, url_rules.RULES)).count() == 0
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r.verdict for r in url_rules.judge(pages, none).collect()} == {"allow"}


NORMAL = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_items(text, items):
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    words, hit, found = NORMAL.findall(lower(text)), set(), set()
    for item_id, item in items:
        own = NORMAL.findall(lower(item))
        size = min(10, len(own))
        for start in range(len(own) - size + 1) if own else []:
            window = own[start : start + size]
            for i in range(len(words) - size + 1):
                if words[i : i + size] == window:
                    hit |= set(range(i, i + size))
                    found.add(item_id)
    return len(words), hit, found


@pytest.fixture(scope="module")
def contaminated():
    rng = random.Random(9)
    words = ["a", "b", "c", "é", "D"]
    make = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choice(words) for _ in range(n))
    items = [(i, make(rng.choice([1, 3, 7, 9, 10, 11, 25, 60])) if i > 3 else make(30)) for i in range(30)]
    items = [(i, t) for i, t in items if len(t) > 12] + [(100, items[5][1]), (101, None), (102, ""), (103, "!!")]
    items += [(104, "zz yy"), (105, "zz"), (106, "xx yy zz")]
    texts = [None, "", "!", "zz", "yy zz yy", "xx", items[0][1], "q " + items[1][1].upper() + " q"]
    texts += [make(rng.randrange(80)) for _ in range(40)]
    texts += ["q " * 30 + items[2][1] + " r " * 30, "q" * 30_000]
    return texts, items


@pytest.mark.parametrize("part_words", [100_000, 60])
def test_items_against_brute_force(spark, docs, contaminated, part_words):
    texts, items = contaminated
    benchmark = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "'x' AS doc_id")
    found = decontaminate.find_items(docs(texts), benchmark, part_words=part_words).collect()
    assert len(found) == len(texts)
    for r in found:
        n, hit, names = brute_items(texts[r.doc_id], items)
        listed = ",".join(sorted(map(str, names)))
        digest = hashlib.sha256(listed.encode()).hexdigest()
        assert tuple(r[1:]) == (n, len(hit), len(names), digest, bool(hit)), texts[r.doc_id]


def test_cleaning_leaves_no_window(spark, docs, contaminated):
    texts, items = contaminated
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    table = docs(texts)
    cleaned = decontaminate.clean(table, benchmark)
    assert cleaned.columns == table.columns
    left = {r.doc_id: r for r in cleaned.collect()}
    for i, text in enumerate(texts):
        n, hit, _ = brute_items(text, items)
        assert (i in left) == (len(hit) <= 0.5 * n)
        if i in left:
            assert not brute_items(left[i].text, items)[1]
            if not hit:
                assert left[i].text == text
            else:
                assert left[i].n_chars == len(left[i].text)
    empty = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.find_items(table, empty).filter("contaminated").count() == 0
    assert decontaminate.find_items(docs([]), benchmark).count() == 0


def test_items_beyond_one_block(spark, docs, contaminated, monkeypatch):
    texts, items = contaminated
    benchmark = spark.createDataFrame(items + [items[0], (None, "r r q q")], "item_id bigint, text string")
    table = docs(texts + [texts[7], "x r r q q y"])
    rows = lambda df: sorted(df.collect(), key=repr)
    found, cleaned = rows(decontaminate.find_items(table, benchmark)), rows(decontaminate.clean(table, benchmark))
    monkeypatch.setattr(decontaminate, "MAX_ITEM_WORDS", 150)
    assert len(decontaminate.parts_of(benchmark, part_words=40)) > 2
    assert rows(decontaminate.find_items(table, benchmark, part_words=40)) == found
    assert rows(decontaminate.clean(table, benchmark)) == cleaned

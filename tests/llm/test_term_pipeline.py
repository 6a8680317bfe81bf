"""Ranked search against scoring every document for every item."""

import math
import random
import re
from collections import Counter

import pytest

from riskstream.llm import queries, term_pipeline

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(rows, items, top=10):
    """(item, rank, doc, score) for rows of (doc_id, text) in table order and items {id: text}."""
    docs = [(doc_id, Counter(t)) for doc_id, text in rows if (t := terms(text))]
    if not docs:
        return []
    n_docs, n_words = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * k + 1))) for t, k in df.items()}
    found = []
    for item, text in items.items():
        asked, scored = Counter(terms(text)), []
        for at, (doc_id, c) in enumerate(docs):
            m = 25 + 75 * sum(c.values()) * n_docs // n_words
            score = sum(k * weight[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, k in asked.items() if t in c)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, at))
        for rank, (score, null, doc_id, _) in enumerate(sorted(scored)[:top], 1):
            found.append((item, rank, None if null else doc_id, -score))
    return sorted(found, key=str)


def ranked(docs, items, **options):
    return sorted((tuple(r) for r in term_pipeline.rank(docs, items, **options).collect()), key=str)


def frames(spark, rows, items):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame(list(items.items()), "item_id long, text string")


@pytest.mark.parametrize("block", [16, 2048])
def test_random_texts_with_common_words_and_ties(spark, monkeypatch, block):
    monkeypatch.setattr(term_pipeline, "BLOCK_DOCS", block)
    rng = random.Random(block)
    rare = [f"r{k}" for k in range(60)]
    common = ["the", "of", "a", "in"]
    rows = []
    for k in range(300):
        text = " ".join(rng.choices(common, k=rng.randrange(1, 30)) + rng.choices(rare, k=rng.randrange(0, 3)))
        rows.append((1000 - k, text))
    rows += [(5000 + k, "the same of r1 r2 r2") for k in range(30)]  # ties
    items = {k: " ".join(rng.choices(rare, k=4) + rng.choices(common, k=6)) for k in range(20)}
    items |= {90: "the of", 91: "the the The", 92: "r1 r2", 93: "nowhere", 94: "... --"}
    assert ranked(*frames(spark, rows, items)) == brute(rows, items)


def test_items_in_batches(spark, monkeypatch):
    monkeypatch.setattr(term_pipeline, "BATCH_ITEMS", 2)
    rows = [(k, f"w{k % 7} w{k % 11} x") for k in range(50)]
    items = {k: f"w{k} w{k + 1} x" for k in range(9)}
    assert ranked(*frames(spark, rows, items)) == brute(rows, items)


def test_awkward_rows(spark):
    long = " ".join(f"w{k}" for k in range(20000)) + " needle"
    rows = [
        (1, None), (2, ""), (3, " \t "), (4, "Needle NEEDLE needle"), (5, long), (6, "straße Éa \U0001f600 needle"),
        (7, "needle-thread"), (7, "needle-thread"), (None, "needle thread"), (8, "ÉA needle\x7fpin"), (9, "straße"),
    ]
    items = {1: "needle", 2: None, 3: "", 4: "straße ÉA Éa", 5: "thread " * 500, 6: "\U0001f600"}
    docs, asked = frames(spark, rows, items)
    docs = docs.selectExpr("doc_id", "text", "1 AS rank", "'x' AS term", "2 AS n", "3 AS score", "4 AS number")
    assert ranked(docs, asked.unionByName(asked)) == brute(rows, items)


def test_empty_tables(spark):
    docs, items = frames(spark, [(1, "a b")], {1: "a"})
    assert ranked(docs.filter("doc_id > 1"), items) == []
    assert ranked(docs, items.filter("item_id > 1")) == []


def test_ids_of_text(spark):
    docs = spark.createDataFrame([("b", "x y z"), ("a", "x y z"), ("c", "y")], "doc_id string, text string")
    items = spark.createDataFrame([("i", "x")], "item_id string, text string")
    found = ranked(docs, items)
    assert [r[:3] for r in found] == [("i", 1, "a"), ("i", 2, "b")]


def test_given_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    found = sorted((tuple(r) for r in queries.REGISTRY["op11_ranked_search"](spark, sf).collect()), key=str)
    assert found == brute([tuple(r) for r in docs], items)

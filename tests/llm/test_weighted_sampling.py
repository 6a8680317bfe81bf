"""Fingerprints against a plain version: edited texts, next documents, and likeness against true similarity."""

import hashlib
import re
from collections import Counter

import pytest

from riskstream.llm import queries, weighted_sampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def weights(text):
    return Counter(WORD.findall(text.translate(LOWER)))


def similarity(a, b):
    """Generalised Jaccard similarity; 1 for two texts without words."""
    a, b = weights(a), weights(b)
    if not a and not b:
        return 1.0
    return sum((a & b).values()) / sum((a | b).values())


def edited(text, after):
    third = len(text) // 3
    return text[: len(text) - third] + after[:third]


def neighbours(rows):
    """(doc_id, text, next text) for rows with different ids."""
    order = sorted(rows, key=lambda r: r[0], reverse=True)
    return [(k, text, order[(i + 1) % len(order)][1]) for i, (k, text) in enumerate(order)]


def signed(docs, **options):
    found = weighted_sampling.fingerprints(docs, **options)
    return found.withColumns(
        {
            "near_edited": weighted_sampling.likeness("samples", "edited_samples"),
            "near_next": weighted_sampling.likeness("samples", "next_samples"),
        }
    ).collect()


@pytest.mark.parametrize("group_rows", [7, 1000])
def test_edited_texts_and_likeness_of_given_documents(spark, sf, group_rows):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    found = {r.doc_id: r for r in signed(docs, samples=128, group_rows=group_rows)}
    assert len(found) == len(rows)
    errors = []
    for k, text, after in neighbours(rows):
        other = edited(text, after)
        assert found[k].n_chars == len(text)
        assert found[k].edited_sha256 == hashlib.sha256(other.encode()).hexdigest()
        errors += [found[k].near_edited - similarity(text, other), found[k].near_next - similarity(text, after)]
    assert abs(sum(errors) / len(errors)) < 0.01
    assert max(map(abs, errors)) < 0.25
    assert (sum(e * e for e in errors) / len(errors)) ** 0.5 < 0.05


def test_equal_texts_have_equal_fingerprints(spark):
    text = "one two two three " * 9
    docs = spark.createDataFrame([(1, text), (5, "else"), (9, text), (7, text.upper())], "doc_id long, text string")
    found = {r.doc_id: r.samples for r in signed(docs)}
    assert found[1] == found[9] == found[7] != found[5]


def test_weights_count(spark):
    """A word's count matters: the likeness follows the weights, not the set of words."""
    docs = spark.createDataFrame([(2, "a " * 30 + "b"), (1, "a b")], "doc_id long, text string")
    (first,) = [r for r in signed(docs, samples=1024) if r.doc_id == 2]
    assert abs(first.near_next - 2 / 31) < 0.04


def test_awkward_rows(spark):
    long = " ".join(f"w{k}" for k in range(30000))
    rows = [(None, "no id"), (3, None), (2, ""), (1, " -- "), (8, long), (8, long), (8, "other"), (4, "Ünï 日本 \U0001f600x")]
    docs = spark.createDataFrame([(k, t, 1, "x", "y") for k, t in rows], "doc_id long, text string, place int, at string, word string")
    found = signed(docs, group_rows=2)
    assert sorted((r.doc_id or 0, r.n_chars) for r in found) == sorted((k or 0, len(t or "")) for k, t in rows)
    by = {r.doc_id: r for r in found if r.doc_id != 8}
    assert by[3].near_next == by[2].near_next == 1.0  # no words on either side
    assert by[3].near_edited == 1.0 and by[1].near_next == 0.0
    (last,) = [r for r in found if r.doc_id is None]  # its next is the first of all
    assert last.edited_sha256 in {hashlib.sha256(edited("no id", t).encode()).hexdigest() for t in (long, "other")}
    assert 1.0 in {r.near_next for r in found if r.doc_id == 8}


def test_single_row_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    (only,) = signed(docs)
    assert only.near_next == 1.0 and only.edited_sha256 == hashlib.sha256(b"a b a").hexdigest()
    assert signed(docs.filter("doc_id > 1")) == []


def test_ids_of_text(spark):
    docs = spark.createDataFrame([(f"k{k:03}", f"text {k}") for k in range(40)], "doc_id string, text string")
    found = {r.doc_id: r for r in signed(docs, group_rows=8)}
    for k, text, after in neighbours([(f"k{k:03}", f"text {k}") for k in range(40)]):
        assert found[k].edited_sha256 == hashlib.sha256(edited(text, after).encode()).hexdigest()


def test_query_columns_and_plan(spark, sf):
    result = queries.REGISTRY["op12_fingerprints"](spark, sf)
    assert dict(result.dtypes) == {
        "doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string",
        "edited_fingerprint": "string", "near_edited": "double", "near_next": "double",
    }
    plan = result._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

"""Ranked search against scoring every document in plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter
from math import floor, log

import numpy as np
import pytest

from launchtide.llm import search
from launchtide.llm.search import Segment, _Top, quotients, search_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    """``docs``, ``items``: (id, text) rows."""
    bags = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    n_docs = sum(1 for _, bag in bags if bag)
    n_words = sum(sum(bag.values()) for _, bag in bags)
    df = Counter(term for _, bag in bags for term in bag)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, bag in bags:
            score = 0
            for term in set(terms(text)):
                if tf := bag[term]:
                    m = 10 + (90 * sum(bag.values()) * n_docs) // n_words
                    w = floor(1000 * log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, row[3], -row[0]) for rank, row in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(row) for row in df.collect()), key=str)


@pytest.mark.parametrize("pairs", [1 << 21, 40])
def test_equals_scoring_every_document(spark, monkeypatch, pairs):
    monkeypatch.setattr(search, "WINDOW", 16)
    rng = random.Random(3)
    vocabulary = [f"t{int(rng.paretovariate(0.7))}" for _ in range(400)] + ["Ärger", "日本", "x9"]
    docs = [(k % 290, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 60)))) for k in range(300)]
    items = [(k % 7, "; ".join(rng.choice(vocabulary).upper() for _ in range(rng.randrange(1, 25)))) for k in range(20)]
    df = search_documents(
        spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5),
        spark.createDataFrame(items, "item_id bigint, text string").repartition(2),
        pairs=pairs,
    )
    assert found(df) == brute(docs, items)


def test_edge_rows(spark, edge_docs, edge_rows):
    """Nulls, blanks, a very long text, ties, repeated rows; items without text or id."""
    items = [(1, "w1 W2 w3 w1"), (1, "one"), (None, "naïve Über"), (2, None), (3, " \t.,"), (4, "nowhere"), (5, "x" * 300_000)]
    asked = spark.createDataFrame([(*row, 1.0, 7) for row in items], "item_id bigint, text string, score double, rank int")
    assert found(search_documents(edge_docs, asked)) == brute([row[:2] for row in edge_rows], items)


def test_empty_tables(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, "w1")], "item_id bigint, text string")
    for docs, asked in ((no_docs, items), (edge_docs, items.limit(0)), (edge_docs.filter("doc_id in (4, 5, 6)"), items)):
        assert found(search_documents(docs, asked)) == []


def test_hot_document_and_ties(spark):
    """Half of all rows are one text: equal scores go by doc_id, whatever part they lie in."""
    docs = [(k, "hot words here") for k in range(400)] + [(1000 + k, f"cold{k} words") for k in range(400)]
    random.Random(1).shuffle(docs)
    items = [(1, "hot here"), (2, "words cold7")]
    df = search_documents(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7), spark.createDataFrame(items, "item_id bigint, text string"))
    assert found(df) == brute(docs, items)


def test_windows_are_skipped():
    """Once good documents are known, fewer postings are looked at than there are."""
    rng = np.random.default_rng(2)
    n = 6 * search.WINDOW
    lists = [np.arange(0, n, 2), np.arange(0, n, 3), np.arange(5, 40), np.arange(n - 9, n)]
    lengths = np.array([len(x) for x in lists])
    counts = rng.integers(1, 3, lengths.sum())
    weights = np.array([3, 5, 4000, 9000])
    segment = Segment(np.arange(n), np.zeros(n, bool), np.full(n, 50), np.arange(4), lengths, np.concatenate(lists), counts, weights, n, 50 * n)
    every = np.zeros(n, np.int64)
    ends = np.cumsum(lengths)
    part = quotients(counts, np.full(lengths.sum(), 50), n, 50 * n)
    for k, own in enumerate(lists):
        every[own] += weights[k] * part[ends[k] - lengths[k] : ends[k]]
    top = _Top(10)
    looked = segment.search(np.arange(4), top)
    assert top.scores.tolist() == np.sort(every)[::-1][:10].tolist()
    assert looked < lengths.sum() / 2
    assert segment.search(np.arange(4), top) < lengths.sum() / 2


def test_whole_numbers_past_64_bits():
    assert quotients(np.array([7]), np.array([1 << 40]), 1 << 30, 1 << 45).tolist() == [7_000_000_000 // (7000 + 8 * (10 + (90 << 70) // (1 << 45)))]

"""Phrases against counting all of them in plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from launchtide.llm import phrases
from launchtide.llm.phrases import _filters, _has, _key, _keys, mine_phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, most=2000, least=30, covered=80):
    """``rows``: (text, lang)."""
    counts = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            for size in range(1, 5):
                counts["und" if lang is None else lang].update(words[k : k + size] for k in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        n = sum(a for phrase, a in f.items() if len(phrase) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        dropped = {
            p[i:j]
            for p, a in candidates.items()
            for i in range(len(p))
            for j in range(i + 2, len(p) + 1)
            if j - i < len(p) and 100 * a >= covered * f[p[i:j]]
        }
        kept = []
        for p, a in candidates.items():
            if p not in dropped:
                score, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), l, r))
        kept.sort()
        out += [(lang, rank, p.decode(), -a, l, r, n, -score) for rank, (score, a, p, l, r) in enumerate(kept[:most], 1)]
    return sorted(out)


def found(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {kind for name, kind in df.dtypes if name not in ("lang", "phrase")} == {"bigint"}
    return sorted(tuple(row) for row in df.collect())


def made(rng, n, words):
    """Prose with phrases that come back, some inside longer ones."""
    fixed = [" ".join(rng.choice(words) for _ in range(rng.randrange(2, 7))) for _ in range(12)]
    for _ in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.5 else rng.choice(words) for _ in range(rng.randrange(0, 25))]
        yield rng.choice([" ", "  ", "\t"]).join(p + rng.choice(["", "", "", ",", ". ", "\n", "\xa0"]) for p in parts)


@pytest.mark.parametrize("most, least", [(2000, 30), (3, 2), (1, 5), (40, 3)])
def test_equals_counting_all(spark, most, least):
    rng = random.Random(most)
    words = [f"w{int(rng.paretovariate(0.8))}" for _ in range(60)] + ["Ärger", "ÉTÉ", "日本", "a\x00b"]
    rows = [(text, rng.choice(["en", "en", "en", "fr", None, "und"])) for text in made(rng, 300, words)]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    assert found(mine_phrases(df, most=most, least=least)) == brute(rows, most, least)


def test_rounds_until_settled(spark, monkeypatch):
    """Where the best pairs are all covered, the floor falls until enough phrases survive."""
    rounds = []
    grown = phrases._grown
    monkeypatch.setattr(phrases, "_grown", lambda *a: rounds.append(1) or grown(*a))
    rows = [(" . ".join(f"a{k} b{k} c{k} d{k}" for k in range(30)), "en")] * 5
    rows += [(" . ".join(f"x{k % 7} y{k}" for k in range(40)), "en")] * 5 + [("one two", "fr")] * 4
    df = spark.createDataFrame(rows, "text string, lang string")
    assert found(mine_phrases(df, most=35, least=3)) == brute(rows, 35, 3)
    assert len(rounds) > 1


def test_growth_is_pruned(spark, monkeypatch):
    """Prefixes whose bound is below the floor don't grow."""
    counted = []
    triples = phrases.triple_counts
    monkeypatch.setattr(phrases, "triple_counts", lambda *a: counted.append(triples(*a)) or counted[-1])
    rng = random.Random(4)
    rows = [(" ".join(f"w{min(30, int(rng.paretovariate(0.9)))}" for _ in range(600)), "en") for _ in range(10)]
    rows += [("best pair . best pair . next pair", "en")] * 20
    df = spark.createDataFrame(rows, "text string, lang string")
    assert found(mine_phrases(df, most=1, least=3)) == brute(rows, 1, 3)
    every = Counter(t for text, _ in rows for w in [text.split()] for t in zip(w, w[1:], w[2:]))
    assert 0 < counted[0].count() < len(every) / 4


def test_edge_rows_and_hot_phrase(spark, edge_docs, edge_rows):
    rows = [(row[1], row[2]) for row in edge_rows]
    assert found(mine_phrases(edge_docs, least=2)) == brute(rows, least=2)
    hot = [("the same line again and again", "en")] * 500 + [(f"cold {k}", None) for k in range(500)]
    df = spark.createDataFrame(hot, "text string, lang string").repartition(6)
    assert found(mine_phrases(df)) == brute(hot)


def test_nothing_to_find(spark, no_docs):
    assert found(mine_phrases(no_docs)) == []
    assert found(mine_phrases(spark.createDataFrame([(None, None), ("", "en"), ("one", "en")], "text string, lang string"))) == []


def test_filters_lose_no_key(spark):
    keys = np.random.default_rng(1).integers(-(2**63), 2**63, 5000)
    df = spark.createDataFrame([(int(k),) for k in keys], "k bigint")
    every, some = _filters(df, F.col("k"), 5000, F.lit(True), F.col("k") > 0).value
    assert _has(every, keys.view(np.uint64)).all()
    assert _has(some, keys[keys > 0].view(np.uint64)).all()
    others = np.random.default_rng(2).integers(-(2**63), 2**63, 5000).view(np.uint64)
    assert _has(every, others).mean() < 0.1


def test_keys_are_the_same_in_columns(spark):
    ids = np.random.default_rng(3).integers(-(2**63), 2**63, 50)
    rows = [tuple(map(int, ids[k : k + 3])) for k in range(48)]
    df = spark.createDataFrame(rows, "w1 bigint, w2 bigint, w3 bigint")
    found = [tuple(r) for r in df.select(_key("w1", "w2"), _key("w1", "w2", "w3")).collect()]
    two, three = (_keys(ids.view(np.uint64), size).view(np.int64).tolist() for size in (2, 3))
    assert found == list(zip(two, three))

"""Near duplicates against all pairs of full shingle sets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from launchtide.llm import near_duplicates as module
from launchtide.llm.components import components
from launchtide.llm.minhash import signatures
from launchtide.llm.near_duplicates import drop_near_duplicates, near_duplicates
from launchtide.llm.words import mix, shingle_sets


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute_force(rows, size, percent):
    sets = {}
    parent = {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for doc_id, text in rows:
        parent[doc_id] = doc_id
        sets.setdefault(doc_id, []).append(shingles(text, size))
    flat = [(doc_id, own) for doc_id, many in sets.items() for own in many if own]
    for k, (a, one) in enumerate(flat):
        for b, two in flat[:k]:
            if 100 * len(one & two) >= percent * len(one | two):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {doc_id: find(doc_id) for doc_id in parent}


@pytest.mark.parametrize("size", [4, 5])
def test_equals_all_pairs(copies, size):
    found = near_duplicates(copies, size=size).collect()
    rows = [(row.doc_id, row.text) for row in copies.collect()]
    assert {row.doc_id: row.component_id for row in found} == brute_force(rows, size, 80)
    assert {row.doc_id: row.n_shingles for row in found} == {i: len(shingles(t, size)) for i, t in rows}
    assert all(row.kept == (row.doc_id == row.component_id) for row in found)


def test_edges(edge_docs, edge_rows, no_docs):
    found = near_duplicates(edge_docs, size=4).collect()
    assert len(found) == len(edge_rows)
    known = [(i, t) for i, t, *_ in edge_rows if i is not None]
    expected = brute_force(known, 4, 80)
    assert {row.doc_id: row.component_id for row in found if row.doc_id is not None} == expected
    assert expected[2] == expected[3] == 1 and expected[8] == 7 and expected[6] == 6
    assert all(row.kept and row.component_id is None for row in found if row.doc_id is None)
    assert {row.n_shingles for row in found if row.doc_id in (4, 5, 6)} == {0}
    assert near_duplicates(no_docs).count() == 0
    kept = drop_near_duplicates(edge_docs, size=4)
    assert kept.columns == edge_docs.columns
    ids = sorted((row.doc_id for row in kept.collect()), key=str)
    assert ids == sorted((i for i, *_ in edge_rows if i is None or expected[i] == i), key=str)
    assert drop_near_duplicates(no_docs).count() == 0


def passages(n, seed, shared=60, own=40, pair_every=5):
    """Documents that share a passage; each ``pair_every``-th is near the one before it as well."""
    draw = np.random.Generator(np.random.PCG64(seed))
    common = [f"c{k}" for k in range(shared)]
    rows, last = [], None
    for doc_id in range(n):
        if last is None or doc_id % pair_every:
            tail = [f"w{k}" for k in draw.integers(0, 1 << 40, own)]
        else:
            tail = last[:-2] + ["x", f"y{doc_id}"]
        rows.append((doc_id, " ".join(common + tail)))
        last = tail
    return rows


def test_over_full_buckets_are_split(spark, copies, monkeypatch):
    """Many documents that share a passage, and near pairs among them that no star's centre is near."""
    monkeypatch.setattr(module, "BLOCK", 16)
    rows = passages(600, 3)
    found = near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), size=4).collect()
    expected = brute_force(rows, 4, 80)
    assert sum(k != v for k, v in expected.items()) == 119
    assert {row.doc_id: row.component_id for row in found} == expected
    rows = [(row.doc_id, row.text) for row in copies.collect()]
    found = near_duplicates(copies, size=4).collect()
    assert {row.doc_id: row.component_id for row in found} == brute_force(rows, 4, 80)


def test_no_pair_of_the_threshold_is_lost_in_the_parts(spark, monkeypatch):
    """Pairs of similarity 0.8 to 0.83 within buckets of many: the parts find them all the same."""
    monkeypatch.setattr(module, "BLOCK", 16)
    draw = np.random.Generator(np.random.PCG64(5))
    common = [f"c{k}" for k in range(120)]
    rows = []
    for k in range(400):
        tail = [f"w{x}" for x in draw.integers(0, 1 << 40, 80)]
        rows += [(2 * k, " ".join(common + tail)), (2 * k + 1, " ".join(common + tail[:-20] + [f"v{k}.{x}" for x in range(20)]))]
    one, two = (shingles(text, 4) for _, text in rows[:2])
    assert 0.8 <= len(one & two) / len(one | two) < 0.83
    found = near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), size=4).collect()
    assert {row.doc_id: row.component_id for row in found} == {doc_id: doc_id - doc_id % 2 for doc_id, _ in rows}


def test_signatures_estimate_similarity_of_small_and_large_sets():
    draw = np.random.Generator(np.random.PCG64(1))
    for n in (5, 20, 2000):
        common = mix(draw.integers(0, 1 << 63, 4 * n, np.uint64))
        pairs = []
        for _ in range(60):
            whole = mix(draw.integers(0, 1 << 63, n, np.uint64))
            other = whole.copy()
            other[: n // 5] = mix(draw.integers(0, 1 << 63, n // 5, np.uint64))
            pairs += [np.sort(whole), np.sort(other)]
        rows = signatures(pairs, 128)
        agree = (rows[::2] == rows[1::2]).mean()
        truth = (n - n // 5) / (n + n // 5)
        assert abs(agree - truth) < 0.05, (n, agree, truth)
        assert len(common)
    assert not signatures([np.zeros(0, np.uint64)], 64).any()


def test_words_do_not_depend_on_where_they_stand():
    long = " ".join(f"Word{i % 977}" for i in range(900_000))
    column = pa.array(["a", long, None, "x" * 5_000_000 + " end", long + " tail", ""])
    sets = [own for part in shingle_sets(column, 5) for own in part]
    (alone,) = next(shingle_sets(pa.array([long]), 5))
    assert list(map(len, sets)) == [1, 977, 0, 1, 978, 0]
    assert (sets[1] == alone).all()
    assert len(np.intersect1d(sets[1], sets[4])) == 977


def test_components(spark):
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(500, k) for k in range(600, 700)]
    odd = [(9, 9), (None, 3), (7, 8), (8, 7), (7, 8)]
    links = spark.createDataFrame(chain + star + odd, "a bigint, b bigint")
    found = {row.node: row.component for row in components(links).collect()}
    expected = {k: 100 for k in range(100, 161)} | {k: 500 for k in [500, *range(600, 700)]} | {7: 7, 8: 7}
    assert found == expected
    assert components(links.limit(0)).count() == 0

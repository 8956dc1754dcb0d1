"""Fingerprints against exact texts and exact similarities."""

from __future__ import annotations

import random
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from tests.llm.test_near_duplicates import shingles

from launchtide.llm.fingerprints import edited, fingerprint_documents, likeness, packed
from launchtide.llm.minhash import probe_order
from launchtide.llm.words import shingle_sets


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def hashed(text):
    """Spark's xxhash64 of a text, which is its seed for a null."""
    found = 42 if text is None else xxhash.xxh64_intdigest(text.encode(), 42)
    return found - (1 << 64) if found >= 1 << 63 else found


def check(rows, found):
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, hashed(r[1]), r[1] or ""))
    ids, texts = [r[0] for r in ordered], [r[1] or "" for r in ordered]
    expected = []
    for k, text in enumerate(texts):
        new = edited(text, texts[(k + 1) % len(texts)])
        expected.append((ids[k], len(text), sha256(new.encode()).hexdigest()))
    assert sorted(map(str, expected)) == sorted(str((r.doc_id, r.n_chars, r.edited_sha256)) for r in found)
    return ordered, texts


def test_edges(edge_docs, edge_rows, no_docs):
    found = fingerprint_documents(edge_docs).collect()
    check([(i, t) for i, t, *_ in edge_rows], found)
    by_id = {row.doc_id: row for row in found}
    assert by_id[1].fingerprint == by_id[2].fingerprint != by_id[13].fingerprint
    assert by_id[1].near_next == 1.0 and by_id[4].near_next == 1.0 and by_id[6].near_next == 0.0
    assert by_id[4].fingerprint == by_id[5].fingerprint == by_id[6].fingerprint == ""
    assert all(0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1 for row in found)
    assert fingerprint_documents(no_docs).count() == 0
    one = edge_docs.filter("doc_id = 9")
    (row,) = fingerprint_documents(one).collect()
    assert row.near_next == 1.0 and row.edited_sha256 == sha256(edited("one two three", "one two three").encode()).hexdigest()


def test_likeness_is_near_the_exact_similarity(spark):
    rng = random.Random(3)
    rows = [(k, prose(rng, rng.randrange(100, 900))) for k in range(150)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = {row.doc_id: row for row in fingerprint_documents(docs, size=2).collect()}
    _, texts = check(rows, found.values())
    errors, others = [], []
    for k, text in enumerate(texts):
        after = texts[(k + 1) % len(texts)]
        own = shingles(text, 2)
        errors.append(found[k].near_edited - jaccard(own, shingles(edited(text, after), 2)))
        others.append(found[k].near_next - jaccard(own, shingles(after, 2)))
    assert np.std(errors) < 0.05 and abs(np.mean(errors)) < 0.01
    assert np.std(others) < 0.03 and abs(np.mean(others)) < 0.02


def test_packing_keeps_the_low_bits():
    values = np.array([1, 2, 15, 8], np.uint32)
    assert packed(values, 4) == "12f8"
    a, b = np.arange(16)[None] % 16, np.zeros((1, 16))
    assert likeness(a, a, 4)[0] == 1 and likeness(a, b, 4)[0] == 0


def plain_signature(own, n_bins):
    """Bins of 64-bit shingle hashes, one by one, then densified one by one."""
    mask, bins = (1 << 64) - 1, [None] * n_bins
    least = [None] * n_bins
    for h in own:
        at = h >> (64 - (n_bins.bit_length() - 1))
        if least[at] is None or h < least[at]:
            least[at], bins[at] = h, ((h * 0x2545F4914F6CDD1D) & mask) >> 32
    filled = [b is not None for b in bins]
    if not any(filled):
        return [0] * n_bins
    order = probe_order(n_bins)
    return [bins[k] if filled[k] else next(bins[j] for j in order[k] if filled[j]) for k in range(n_bins)]


def test_fingerprints_equal_a_loop_over_shingles(spark, edge_docs, edge_rows):
    for row in fingerprint_documents(edge_docs).collect():
        texts = [t for i, t, *_ in edge_rows if i == row.doc_id]
        made = set()
        for text in texts:
            (own,) = next(iter(shingle_sets(pa.array([text or ""]), 5)))
            bins = plain_signature([int(h) for h in own], 256)
            made.add("".join(f"{b & 15:x}" for b in bins) if len(own) else "")
        assert row.fingerprint in made


def test_half_of_all_rows_without_doc_id(spark):
    """The hot key is parted without adaptive execution, and the next text crosses the parts."""
    rows = [(None, f"text number {k % 40} of the hot key") for k in range(600)] + [(k, f"other text {k}") for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = fingerprint_documents(docs)
        check(rows, found.collect())
        parts = docs.repartitionByRange(8, F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), F.monotonically_increasing_id())
        sizes = [r.n for r in parts.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(sizes) < 300

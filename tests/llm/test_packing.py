"""Packing: exact round trips to the ids of the library ``tokenizers``, and full sequences."""

from __future__ import annotations

import random
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from launchtide.llm import packing
from launchtide.llm.packing import CAPACITY, END_ID, pack, pack_lengths

ODD = [
    "don't  stop\n\n we'll\tsee '  s 12.5% of 3,000",
    "é̀ ü日本語 한국어 русский ١٢٣ ½ ① 𝒳 \U0001f600\U0001f1e9\U0001f1ea",
    "<|endoftext|> stands in a text <|endoftext|>",
    "\x00\x01\x7f   　﻿​ x\r\n\r\n  ",
    "   leading and trailing   ",
    "ǅ ʰ ⁿ ª ͅ ᛮ ꧏ",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(rows, texts, tokenizer):
    """``texts``: how many rows have each (doc_id, text)."""
    by_doc, by_sequence = {}, {}
    for row in rows:
        by_doc.setdefault(row.doc_id, []).append(row)
        by_sequence.setdefault(row.sequence_id, []).append(row)
    expected = {}
    for doc_id, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, END_ID], "<u4")
        for start in range(0, len(ids), CAPACITY):
            part = ids[start : start + CAPACITY]
            expected.setdefault(doc_id, []).append((start, len(part), crc32(part.tobytes()), len(ids)))
    found = {k: sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in v) for k, v in by_doc.items()}
    assert found == {k: sorted(v) for k, v in expected.items()}
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for own in by_sequence.values():
        own.sort(key=lambda r: r.offset)
        ends = np.cumsum([r.length for r in own])
        assert [r.offset for r in own] == [0, *ends[:-1].tolist()] and ends[-1] <= CAPACITY


def test_round_trip(copies, tokenizer, spark):
    check(pack(copies).collect(), [(r.doc_id, r.text) for r in copies.collect()], tokenizer)
    odd = spark.createDataFrame(list(enumerate(ODD)), "doc_id bigint, text string")
    check(pack(odd).collect(), list(enumerate(ODD)), tokenizer)


def test_edges(edge_docs, edge_rows, no_docs, tokenizer):
    check(pack(edge_docs).collect(), [(i, t) for i, t, *_ in edge_rows], tokenizer)
    assert pack(no_docs).count() == 0


def test_the_given_texts_have_the_ids_of_the_library(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(pack(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()], tokenizer)


def test_patterns_hold_every_piece_with_little_padding():
    rng = random.Random(1)
    for n, most in ((1, 1024), (40, 1024), (20_000, 1024), (20_000, 300)):
        counts = {}
        for _ in range(n):
            length = rng.randrange(1, most + 1)
            counts[length] = counts.get(length, 0) + 1
        packs = pack_lengths(counts)
        placed = {}
        for pattern, count in packs:
            assert sum(pattern) <= CAPACITY and count > 0
            for length in pattern:
                placed[length] = placed.get(length, 0) + count
        assert placed == counts
        used = sum(k * v for k, v in counts.items())
        assert len(packs) < 4000
        if n > 1000:
            assert used / (sum(count for _, count in packs) * CAPACITY) > 0.98
    assert pack_lengths({}) == []
    assert pack_lengths({1: 10**12}) == [([1] * 1024, 10**12 // 1024)]


def test_marks_of_special_tokens_are_those_of_the_library(spark, tokenizer):
    assert tokenizer.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    texts = [*ODD, "a <|endoftext|> b", "<|endoftext|><|endoftext|>", "x  <|endoftext|>\n\n y <|endoftext|", "é<|endoftext|>" * 1500]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    check(pack(docs).collect(), list(enumerate(texts)), tokenizer)


SPACES = list("\t\n\v\f\r \x85\xa0\u1680\u2000\u200a\u2028\u2029\u202f\u205f\u3000")


@pytest.mark.parametrize("run", ["{0}", "a{0}", "{0}b", "a{0}b", "a{0}!{0}1", "a{0}<|endoftext|>{0}c", " {0}\n{0}é"])
def test_long_runs_of_white_space(tokenizer, monkeypatch, run):
    """Each kind of white space, alone and beside others, cut where the pattern parts it."""
    monkeypatch.setattr(packing, "LONG", 5)
    encoder = packing.Encoder()
    for a in SPACES:
        for spaces in (a * 4, a * 5, a * 40, (a + " ") * 10, (" " + a) * 10, "\n" + a * 9 + "\t"):
            text = run.format(spaces)
            assert encoder.encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_two_million_spaces(spark, tokenizer):
    texts = [pattern.format(kind * 2_000_000) for kind in " \n" for pattern in ("{0}", "a{0}b")] + ["\xa0" * 2_000_000 + "!", "\u3000" * 400_000 + "x"]
    encoder = packing.Encoder()
    for text in texts:
        assert encoder.encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    docs = spark.createDataFrame([(1, texts[1]), (2, "short")], "doc_id bigint, text string")
    check(pack(docs).collect(), [(1, texts[1]), (2, "short")], tokenizer)


def test_half_of_all_pieces_on_one_key(spark, tokenizer, monkeypatch):
    """Equal texts without doc_id, numbered in groups, with adaptive execution off."""
    monkeypatch.setattr(packing, "GROUP", 50)
    texts = [(None, "the same")] * 600 + [(k, f"other {k}") for k in range(600)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = pack(df).collect()
        pieces = packing.stored(packing.token_pieces(df), "pieces")
        counts = {r.length: r.k for r in pieces.groupBy("length").agg(packing.F.count("*").alias("k")).collect()}
        ranked = packing._ranked(pieces, counts)
        # The window's input: no partition has more than a few groups.
        sizes = [r.n for r in ranked.groupBy(packing.F.spark_partition_id()).agg(packing.F.count("*").alias("n")).collect()]
        ranks = [(r.length, r.rank) for r in ranked.collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    check(rows, texts, tokenizer)
    assert sorted(ranks) == sorted((length, k) for length, n in counts.items() for k in range(n))
    assert len(rows) == 1200 and max(sizes) < 900
    places = [(r.sequence_id, r.offset) for r in rows]
    assert len(set(places)) == 1200

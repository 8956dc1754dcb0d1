"""License scans: base phrases, and an exact containment join of text blocks with templates.

The join is the prefix-filter set join. Template tokens are ordered by how often they
occur in all documents, rarest first. A template of t tokens that must share o of them with
a block shares one of its t - o + 1 rarest; so only blocks with such a token are looked at.
Those are then held against the length of block and template, and against the places of
the shared token in both orders, before their common tokens are counted.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from launchtide.llm.shared import stored
from launchtide.llm.words import ALPHANUMERIC, pieces, texts_of, words

# Phrases that stand for a license, with its label.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Passages of public license notices, with their labels. Openings first, then
# what stands only in the body of one license; each has 80 words at most.
TEMPLATES = [
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the Software), to deal in the Software "
        "without restriction",
    ),
    (
        "apache-2",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
        "except in compliance with the License",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    ("gpl-3", "licensed under the GNU General Public License, version 3"),
    (
        "gpl-3",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted",
    ),
    (
        "mpl-2",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    ),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    (
        "cc-by-nc",
        "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    (
        "mit",
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
        "is furnished to do so, subject to the following conditions: The above copyright notice and "
        "this permission notice shall be included in all copies or substantial portions of the "
        "Software",
    ),
    (
        "bsd",
        "Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution",
    ),
    (
        "bsd",
        "This software is provided by the copyright holders and contributors as is and any express "
        "or implied warranties, including, but not limited to, the implied warranties of "
        "merchantability and fitness for a particular purpose are disclaimed. In no event shall the "
        "copyright holder or contributors be liable for any direct, indirect, incidental, special, "
        "exemplary, or consequential damages",
    ),
    (
        "bsd",
        "liable for any direct, indirect, incidental, special, exemplary, or consequential damages "
        "(including, but not limited to, procurement of substitute goods or services; loss of use, "
        "data, or profits; or business interruption) however caused and on any theory of liability",
    ),
    (
        "bsd-3",
        "Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written "
        "permission",
    ),
    (
        "apache-2",
        "Unless required by applicable law or agreed to in writing, software distributed under the "
        "License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions "
        "and limitations under the License",
    ),
    (
        "apache-2",
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You "
        "a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright "
        "license to reproduce, prepare Derivative Works of, publicly display, publicly perform, "
        "sublicense, and distribute the Work and such Derivative Works in Source or Object form",
    ),
    (
        "isc",
        "The software is provided as is and the author disclaims all warranties with regard to this "
        "software including all implied warranties of merchantability and fitness. In no event shall "
        "the author be liable for any special, direct, indirect, or consequential damages or any "
        "damages whatsoever resulting from loss of use, data or profits, whether in an action of "
        "contract, negligence or other tortious action",
    ),
    (
        "mpl-2",
        "If a copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/",
    ),
    (
        "unlicense",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, "
        "either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means",
    ),
    (
        "unlicense",
        "In jurisdictions that recognize copyright laws, the author or authors of this software "
        "dedicate any and all copyright interest in the software to the public domain",
    ),
    (
        "zlib",
        "Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions",
    ),
    (
        "zlib",
        "The origin of this software must not be misrepresented; you must not claim that you wrote "
        "the original software. Altered source versions must be plainly marked as such, and must not "
        "be misrepresented as being the original software",
    ),
    (
        "bsl-1",
        "to any person or organization obtaining a copy of the software and accompanying "
        "documentation covered by this license (the Software) to use, reproduce, display, "
        "distribute, execute, and transmit the Software, and to prepare derivative works of the "
        "Software",
    ),
    (
        "cc0",
        "To the extent possible under law, the person who associated CC0 with this work has waived "
        "all copyright and related or neighboring rights to this work",
    ),
]

_SCANNED = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
    "found array<int>, blocks array<struct<words:int,tokens:array<int>>>"
)


def tokens_of(text: str) -> np.ndarray:
    """Hashes of a short text's words: runs of a-z, 0-9 and non-ASCII bytes, A-Z lower-cased."""
    data, offsets = texts_of(pa.array([text]))
    return words(data, offsets, ALPHANUMERIC)[0]


def token_counts(docs: DataFrame, tokens: np.ndarray) -> np.ndarray:
    """How often each of the sorted token hashes occurs in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(tokens), np.int64)
        for batch in batches:
            data, offsets = texts_of(batch.column(0))
            for a, b in pieces(offsets):
                inner = offsets[a : b + 1] - offsets[a]
                hashes, _, _ = words(data[offsets[a] : offsets[b]], inner, ALPHANUMERIC)
                at = np.minimum(np.searchsorted(tokens, hashes), len(tokens) - 1)
                total += np.bincount(at[tokens[at] == hashes], minlength=len(tokens))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(tokens))), pa.array(total)], ["token", "n"])

    rows = docs.select("text").mapInArrow(count, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    counts = np.zeros(len(tokens), np.int64)
    for row in rows.collect():  # a row per template token
        counts[row["token"]] = row["n"]
    return counts


def scan_licenses(
    docs: DataFrame,
    *,
    phrases: Mapping[str, str] = PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = 0.8,
    block: int = 96,
) -> DataFrame:
    """One row per document: words, base phrases, labels and a score.

    Columns: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.
    ``n_base`` counts all places where a phrase's words stand one after another;
    ``first_word`` and ``last_word`` are the least and greatest of those places, null if there
    is none. ``labels`` adds the labels of templates of which a text block holds at least
    ``threshold`` of the distinct tokens; blocks are ``block`` words long and begin every
    half block, so they cover the whole text, and hold at least 0.8 of any passage of up to 5/6 of a
    block (80 words) wherever it begins. ``score`` is the greatest share of a
    template found in a block, 1 if there is a base phrase, 0 if nothing was found.

    A null text is empty and has no labels. Every row gets one row, also when doc_ids
    repeat or are null. Only ``doc_id`` and ``text`` are read. Phrases and templates are
    few, so their tokens and counts, and nothing that grows with the documents, are on
    the driver.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = [np.unique(tokens_of(text)) for _, text in templates]
    vocabulary = np.unique(np.concatenate(sets))
    counts = token_counts(docs, vocabulary)
    order = np.lexsort((vocabulary, counts))
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order))
    ranked = [sorted(rank[np.searchsorted(vocabulary, own)].tolist()) for own in sets]
    needed = [ceil(threshold * len(own) - 1e-9) for own in ranked]
    rare = np.zeros(len(order), bool)
    for own, need in zip(ranked, needed, strict=True):
        rare[own[: len(own) - need + 1]] = True
    least = min(needed)
    sequences = [tokens_of(phrase) for phrase in phrases]
    half = block // 2

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts_of(batch.column(1))
            ids = batch.column(0)
            for a, b in pieces(offsets):
                inner = offsets[a : b + 1] - offsets[a]
                hashes, row, _ = words(data[offsets[a] : offsets[b]], inner, ALPHANUMERIC)
                first = np.searchsorted(row, np.arange(b - a + 1))
                n_words = np.diff(first)
                places, kinds = [], []
                for kind, sequence in enumerate(sequences):
                    end = max(len(hashes) - len(sequence) + 1, 0)
                    here = np.ones(end, bool)
                    for k, token in enumerate(sequence):
                        here &= hashes[k : k + end] == token
                    here = np.flatnonzero(here)
                    here = here[row[here] == row[here + len(sequence) - 1]]
                    places.append(here)
                    kinds.append(np.full(len(here), kind))
                place, kind = np.concatenate(places), np.concatenate(kinds)
                by_row: dict[int, list[tuple[int, int]]] = {}
                for r, p, k in zip(row[place].tolist(), place.tolist(), kind.tolist(), strict=True):
                    by_row.setdefault(r, []).append((p - int(first[r]), k))
                at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
                own = np.where(vocabulary[at] == hashes, rank[at], -1)
                blocks: dict[int, list[dict]] = {}
                hit = np.flatnonzero((own >= 0) & rare[own])
                number = (hit - first[row[hit]]) // half
                wanted = {(r, k) for r, n in zip(row[hit].tolist(), number.tolist(), strict=True) for k in (n, n - 1) if k >= 0}
                for r, k in sorted(wanted):
                    begin = int(first[r]) + k * half
                    inside = own[begin : min(begin + block, int(first[r + 1]))]
                    tokens = np.unique(inside[inside >= 0])
                    if len(tokens) >= least:
                        blocks.setdefault(r, []).append({"words": len(inside), "tokens": tokens.tolist()})
                none: list = []
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(a, b - a),
                        pa.array(n_words, pa.int64()),
                        pa.array([len(by_row.get(r, none)) for r in range(b - a)], pa.int64()),
                        pa.array([min(by_row[r])[0] if r in by_row else None for r in range(b - a)], pa.int64()),
                        pa.array([max(by_row[r])[0] if r in by_row else None for r in range(b - a)], pa.int64()),
                        pa.array([sorted({k for _, k in by_row.get(r, none)}) for r in range(b - a)], pa.list_(pa.int32())),
                        pa.array([blocks.get(r, none) for r in range(b - a)], pa.list_(pa.struct([("words", pa.int32()), ("tokens", pa.list_(pa.int32()))]))),
                    ],
                    ["doc_id", "n_words", "n_base", "first_word", "last_word", "found", "blocks"],
                )

    scanned = stored(
        docs.mapInArrow(scan, _SCANNED).withColumn("row", F.monotonically_increasing_id()), "scanned"
    )
    # A row per prefix token of a template, as many as templates have tokens.
    prefixes = spark.createDataFrame(
        [
            (token, place, label, own, len(own), need)
            for (label, _), own, need in zip(templates, ranked, needed, strict=True)
            for place, token in enumerate(own[: len(own) - need + 1])
        ],
        "token int, place int, label string, template array<int>, size int, need int",
    )
    shared = F.size(F.array_intersect("tokens", "template"))
    matches = (
        scanned.select("row", F.explode("blocks").alias("block"))
        .select("row", "block.tokens", F.posexplode("block.tokens").alias("at", "token"))
        .join(F.broadcast(prefixes), "token")
        .filter(F.size("tokens") >= F.col("need"))
        # The first shared token: what follows it in both must be enough.
        .filter(1 + F.least(F.col("size") - F.col("place") - 1, F.size("tokens") - F.col("at") - 1) + F.least("place", "at") >= F.col("need"))
        .withColumn("share", shared / F.col("size"))
        .filter(shared >= F.col("need"))
        .groupBy("row")
        .agg(F.collect_set("label").alias("more"), F.max("share").alias("best"))
    )
    names = F.array(*(F.lit(label) for label in phrases.values()))
    base = F.transform("found", lambda k: F.element_at(names, k + 1))
    return (
        scanned.drop("blocks")
        .join(matches, "row", "left")
        .select(
            "doc_id",
            "n_words",
            "n_base",
            "first_word",
            "last_word",
            F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
            F.array_join(F.array_sort(F.array_union(base, F.coalesce("more", F.array().cast("array<string>")))), ",").alias("labels"),
            F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        )
    )
